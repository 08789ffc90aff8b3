"""Streams against the same rows as a table; moves that stop half-way."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from acervo.streaming import cases, moves

DAY0 = datetime(2024, 1, 1)
day = lambda n, hours=0: (DAY0 + timedelta(days=n, hours=hours)).isoformat()


def landed(folder, batches):
    """Files in order of time, one a batch."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        path = f"{folder}/{i:03}.json"
        with open(path, "w") as f:
            f.write("\n".join(map(json.dumps, rows)))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return folder


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


ACTS = "case_id string, kind string, day timestamp, concludes boolean"


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_alarms_equal_the_table(spark, rocks, tmp_path):
    act = lambda c, n, concludes, h=3: {"case_id": c, "kind": "x", "day": day(n, h), "concludes": concludes}
    batches = [
        [act("a", 0, True), act("b", 0, True), act("c", 1, True), act("d", 2, False)],
        [act("a", 0, True), act("c", 5, False), act("d", 4, True), act("d", 9, True), act("e", 6, True)],  # a's conclusion again
        [act("d", 6, False), act("b", 8, True), act("f", 8, True)],  # d's act comes late: its second conclusion stays open
        [act("clock", 45, False)],
        [act("g", 46, True), act("f", 2, False), act("late", 3, True)],  # beyond the watermark: left out
        [act("clock", 80, False)],
        [act("clock", 90, False)],
    ]
    folder = landed(f"{tmp_path}/acts", batches)
    run(cases.alarms(stream(spark, folder, ACTS), "10 days"), "alarms")
    got = sorted((r.case_id, r.alert, r["since"], r["at"]) for r in spark.table("alarms").collect())
    rows = spark.read.schema(ACTS).json(folder).where("case_id != 'late'")
    want = sorted((r.case_id, r.alert, r["since"].replace(microsecond=0), r["at"]) for r in cases.open_conclusions(rows, F.to_date(F.lit(day(80)[:10]))).collect())
    assert got == want and len(got) == 11
    assert {c for c, *_ in got} == {"a", "b", "d", "e", "f", "g"}


def test_acts_meet_index_entries(spark, tmp_path):
    acts = [[{"case_id": "a", "kind": "k", "day": day(0)}, {"case_id": "b", "kind": "k", "day": day(0)}], [{"case_id": "z", "kind": "z", "day": day(20)}], [{"case_id": "z", "kind": "z", "day": day(40)}], [{"case_id": "old", "kind": "k", "day": day(1)}, {"case_id": "z", "kind": "z", "day": day(60)}]]
    entries = [[{"case_id": "a", "kind": "k", "entered": day(1), "index_id": "1"}, {"case_id": "a", "kind": "other", "entered": day(1), "index_id": "2"}, {"case_id": "old", "kind": "k", "entered": day(1), "index_id": "4"}], [{"case_id": "z", "kind": "z", "entered": day(20), "index_id": "3"}], [{"case_id": "z", "kind": "z", "entered": day(40), "index_id": "5"}], [{"case_id": "z", "kind": "none", "entered": day(60), "index_id": "6"}]]
    a = stream(spark, landed(f"{tmp_path}/a", acts), "case_id string, kind string, day timestamp")
    b = stream(spark, landed(f"{tmp_path}/b", entries), "case_id string, kind string, entered timestamp, index_id string")
    q = run(cases.joined_ids(a, b, "2 days", "3 days"), "joined")
    got = {(r.case_id, r.day.day, r.index_id) for r in spark.table("joined").collect()}
    assert {("a", 1, "1"), ("b", 1, None), ("z", 21, "3")} <= got
    assert not any(c == "old" and i for c, _, i in got)  # its entry was forgotten before the act came
    sizes = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert max(sizes) > sizes[-1] and sizes[-1] <= 4  # what can meet no more is forgotten


@pytest.mark.parametrize("which", ["sessions", "sliding"])
def test_windows_equal_the_table(spark, tmp_path, which):
    rows = [{"case_id": c, "kind": k, "at": (DAY0 + timedelta(minutes=m)).isoformat()} for c, k, m in [("a", "x", 0), ("a", "x", 4), ("a", "y", 12), ("a", "x", 40), ("b", "y", 3), ("b", "y", 60), ("b", "x", 61), ("a", "x", 43), ("c", "z", 200), ("c", "z", 600), ("c", "z", 1200)]]
    folder, schema = landed(f"{tmp_path}/acts", [rows[:4], rows[4:8], rows[8:10], rows[10:]]), "case_id string, kind string, at timestamp"
    make = {
        "sessions": lambda df, late: cases.sessions(df, "case_id", "at", "kind", {"x": "10 minutes", "y": "30 minutes"}, "5 minutes", late),
        "sliding": lambda df, late: cases.sliding(df, "at", "30 minutes", "10 minutes", "kind", late),
    }[which]
    run(make(stream(spark, folder, schema), "2 hours"), which)
    end = (DAY0 + timedelta(minutes=1080)).isoformat()  # the last act less two hours
    want = make(spark.read.schema(schema).json(folder), None).where(F.col("last") <= F.lit(end).cast("timestamp"))
    key = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert key(spark.table(which)) == key(want) and want.count() > 4


def test_moves_go_on_where_they_stopped(spark, tmp_path, monkeypatch):
    source, inbox, log = (f"{tmp_path}/{x}" for x in ("work", "inbox", "log"))
    for name in ("one", "two", "three", "four"):
        os.makedirs(f"{source}/{name}")
        with open(f"{source}/{name}/a.txt", "w") as f:
            f.write(name)
    os.makedirs(f"{inbox}/two")
    with open(f"{inbox}/two/a.txt", "w") as f:
        f.write("here before")
    landed(f"{tmp_path}/approved", [[{"folder": x} for x in ("one", "two", "three", "one", "gone")]])
    rows = lambda: stream(spark, f"{tmp_path}/approved", "folder string")
    start = lambda: moves.moving(rows(), source, inbox, f"file://{log}", f"{tmp_path}/checkpoint").awaitTermination()
    real, calls = moves.move, []

    def stopping(*args):
        calls.append(args[1])
        if len(calls) == 2:
            raise RuntimeError("stopped between two moves")
        return real(*args)

    monkeypatch.setattr(moves, "move", stopping)
    with pytest.raises(Exception, match="stopped between two moves"):
        start()
    manifest = os.listdir(f"{log}/manifest/0")
    monkeypatch.setattr(moves, "move", real)
    start()
    assert os.listdir(f"{log}/manifest/0") == manifest  # not drawn up anew
    assert {(r.folder, r.status) for r in moves.moved(spark, f"file://{log}").collect()} == {("one", "moved"), ("two", "exists"), ("three", "moved"), ("gone", "gone")}
    assert sorted(os.listdir(inbox)) == ["one", "three", "two"] and sorted(os.listdir(source)) == ["four", "two"]
    with open(f"{inbox}/two/a.txt") as f:
        assert f.read() == "here before"
    os.makedirs(f"{source}/one")
    start()  # nothing new
    moves.move_batch(spark.createDataFrame([("four",)], "folder string"), 0, source, inbox, f"file://{log}")  # a batch with a result does nothing
    assert sorted(os.listdir(source)) == ["four", "one", "two"]
