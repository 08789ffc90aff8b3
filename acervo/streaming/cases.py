"""Cases as streams: alarms by event time, acts joined with index entries, sessions and sliding windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Days that a concluded case waits until it is noted, and until it is grave.
WAITS = {30: "concluded over 30 days", 60: "concluded over 60 days"}
DAY_MS = 86_400_000
ALARM = "case_id string, alert string, since timestamp, at timestamp"


class Waiting(StatefulProcessor):
    """One state for each case: its conclusions with no act behind them, and its last act.

    The first open conclusion starts the waits, each with a timer; an act that
    is not older ends them.  The order in which rows arrive doesn't matter.  An
    alarm is raised once, when event time has passed the wait; a wait is over
    one day after its last whole day, as days are counted without their time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("waiting", "opens array<long>, acted long")

    def known(self) -> tuple[list[int], int | None]:
        opens, acted = self.state.get() if self.state.exists() else ([], None)
        return list(opens), acted

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        opens, acted = self.known()
        before = min(opens, default=None)
        for part in rows:
            ms = part["day"].astype("datetime64[ms]").astype("int64")
            on_time = ms >= timerValues.getCurrentWatermarkInMs()
            part, ms = part[on_time], ms[on_time]
            opens += ms[part["concludes"]].tolist()
            acted = max(ms[~part["concludes"]].tolist() + [acted] * (acted is not None), default=None)
        opens = sorted({x for x in opens if acted is None or x > acted})
        since = min(opens, default=None)
        if since != before:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            for days in WAITS if since is not None else ():
                self.handle.registerTimer(due(since, days))
        self.state.update((opens, acted))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        since = min(self.known()[0], default=None)
        at = expiredTimerInfo.getExpiryTimeInMs()
        said = [text for days, text in WAITS.items() if since is not None and due(since, days) == at]
        yield pd.DataFrame({"case_id": [key[0]] * len(said), "alert": said, "since": pd.to_datetime([since] * len(said), unit="ms"), "at": pd.to_datetime([at] * len(said), unit="ms")})

    def close(self) -> None:
        pass


def due(since_ms: int, days: int) -> int:
    """When more than so many whole days have passed."""
    return since_ms // DAY_MS * DAY_MS + (days + 1) * DAY_MS


def alarms(acts: DataFrame, late: str) -> DataFrame:
    """A stream of alarms out of a stream of acts (case_id, kind, day, concludes); needs the RocksDB state store.

    Repeated rows change nothing; rows later than `late` are left out."""
    stream = acts.withWatermark("day", late).select("case_id", "day", "concludes")
    return stream.groupBy("case_id").transformWithStateInPandas(statefulProcessor=Waiting(), outputStructType=ALARM, outputMode="append", timeMode="eventTime")


def open_conclusions(acts: DataFrame, as_of: Column) -> DataFrame:
    """The same alarms from a table: of each case whose last conclusion has no act behind it, those whose wait is over as of a day."""
    last = acts.where(~F.col("concludes")).groupBy("case_id").agg(F.max("day").alias("acted"))
    still = acts.where("concludes").join(last, "case_id", "left").where(F.col("acted").isNull() | (F.col("day") > F.col("acted"))).groupBy("case_id").agg(F.min("day").alias("since"))
    waits = F.explode(F.map_from_arrays(F.lit(list(WAITS)), F.lit(list(WAITS.values())))).alias("days", "alert")
    over = F.datediff(as_of, F.col("since")) > F.col("days")
    return still.select("case_id", "since", waits).where(over).select("case_id", "alert", "since", F.date_add(F.to_date("since"), F.col("days") + 1).cast("timestamp").alias("at"))


def joined_ids(acts: DataFrame, index: DataFrame, late: str, within: str) -> DataFrame:
    """Each act with the identifier of index entries of its case and kind that come at most `within` before or after it; null if none does.

    acts: case_id, kind, day.  index: case_id, kind, entered, index_id.  Both
    are streams with watermarks, and the bound on time lets Spark forget rows
    that can meet no more; an act without entry appears when none can come."""
    a = acts.withWatermark("day", late)
    b = index.withWatermark("entered", late).select(F.col("case_id").alias("of_case"), F.col("kind").alias("of_kind"), "entered", "index_id")
    near = F.expr(f"entered >= day - interval {within} AND entered <= day + interval {within}")
    return a.join(b, (F.col("case_id") == F.col("of_case")) & (F.col("kind") == F.col("of_kind")) & near, "leftOuter").drop("of_case", "of_kind")


def sessions(acts: DataFrame, key: str, at: str, kind: str, gaps: dict[str, str], otherwise: str, late: str | None = None) -> DataFrame:
    """Runs of acts of one key with no pause longer than the gap of the last act's kind; the same for a stream (with `late`) and a table."""
    gap = F.lit(otherwise)
    for k, v in gaps.items():
        gap = F.when(F.col(kind) == k, v).otherwise(gap)
    rows = acts if late is None else acts.withWatermark(at, late)
    return rows.groupBy(F.session_window(at, gap).alias("session"), key).agg(F.count("*").alias("n")).select(key, F.col("session.start").alias("first"), F.col("session.end").alias("last"), "n")


def sliding(acts: DataFrame, at: str, size: str, step: str, by: str, late: str | None = None) -> DataFrame:
    """Acts of each kind in windows that overlap; the same for a stream and a table."""
    rows = acts if late is None else acts.withWatermark(at, late)
    return rows.groupBy(F.window(at, size, step).alias("window"), by).agg(F.count("*").alias("n")).select(by, F.col("window.start").alias("first"), F.col("window.end").alias("last"), "n")
