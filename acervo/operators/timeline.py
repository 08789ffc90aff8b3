"""Acts of a case in order: runs, milestones, phases, alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.functions.text import norm_ws


def runs(acts: DataFrame, case: str, kind: str, order: list[str], day: str, routine: list[str], least: int = 3) -> DataFrame:
    """Runs of at least `least` acts of one routine kind with nothing between become one row; other acts stay as they are, with n = 1."""
    along = Window.partitionBy(case).orderBy(*order)
    begins = ~F.col(kind).eqNullSafe(F.lag(kind).over(along)) | ~F.col(kind).isin(routine)
    numbered = acts.withColumn("_run", F.sum(F.coalesce(begins, F.lit(True)).cast("int")).over(along))
    sized = numbered.withColumn("_n", F.count("*").over(Window.partitionBy(case, "_run")))
    alone = F.when(F.col("_n") < least, F.row_number().over(Window.partitionBy(case, "_run").orderBy(*order))).otherwise(0)
    return sized.withColumn("_alone", alone).groupBy(case, "_run", "_alone").agg(F.first(kind).alias(kind), F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day")).drop("_run", "_alone")


def since_milestone(acts: DataFrame, case: str, order: str, milestone: Column, filing: Column, last: int = 5) -> DataFrame:
    """Acts after the last milestone; where that is only the filing or there is none, the last few."""
    marks = acts.groupBy(F.col(case).alias("_case")).agg(F.max(F.when(milestone & ~filing, F.col(order))).alias("_mark"))
    rank = F.row_number().over(Window.partitionBy(case).orderBy(F.desc(order)))
    met = acts.join(marks, F.col(case).eqNullSafe(F.col("_case"))).withColumn("_rank", rank)
    return met.where(F.when(F.col("_mark").isNotNull(), F.col(order) > F.col("_mark")).otherwise(F.col("_rank") <= last)).drop("_case", "_mark", "_rank")


def last_of_each(rows: DataFrame, case: str, *order: str, n: int = 3) -> DataFrame:
    """The last n rows of each case."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(case).orderBy(*[F.desc(c) for c in order]))).where(F.col("rank") <= n)


def duration(first: Column, last: Column) -> Column:
    """Whole years, months and days between two days."""
    months = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) - (F.dayofmonth(last) < F.dayofmonth(first)).cast("int")
    return F.struct(F.floor(months / 12).cast("int").alias("years"), (months % 12).alias("months"), F.datediff(last, F.add_months(first, months)).alias("days"))


#: Phases by rising precedence, each with the milestone that begins it: the last whose milestone is there holds.
PHASES = [
    ("distribuicao", "Inicial"), ("citacao expedida", "Citação"), ("citacao", "Resposta"), ("contestacao", "Instrução"), ("saneamento", "Saneamento"),
    ("conclusos para sentenca", "Julgamento"), ("sentenca", "Sentenciado"), ("recurso", "Recursal"), ("transito em julgado", "Trânsito"), ("cumprimento", "Cumprimento"),
]


def phase(acts: DataFrame, case: str, kind: str, phases: list[tuple[str, str]] = PHASES) -> DataFrame:
    """The phase of each case; kinds of acts are compared in normal form."""
    rank = reduce(lambda out, x: F.when(norm_ws(F.col(kind)) == x[1][0], x[0]).otherwise(out), enumerate(phases), F.lit(-1))
    best = acts.groupBy(case).agg(F.max(rank).alias("_rank"))
    return best.select(case, F.get(F.array(*[F.lit(p) for _, p in phases]), F.col("_rank")).alias("phase")).select(case, F.coalesce("phase", F.lit("INDEFINIDA")).alias("phase"))


def alerts(cases: DataFrame, as_of: Column, concluded: str, appeal: str, defended: Column) -> DataFrame:
    """Alerts of a case and the colour of the worst; as_of is given, never taken from a clock."""
    waited = F.datediff(as_of, F.col(concluded))
    found = F.array_compact(F.array(
        F.when(waited > 60, F.struct(F.lit(3).alias("level"), F.lit("concluded over 60 days").alias("alert"))),
        F.when((waited > 30) & (waited <= 60), F.struct(F.lit(2).alias("level"), F.lit("concluded over 30 days").alias("alert"))),
        F.when(F.datediff(as_of, F.col(appeal)) > 365, F.struct(F.lit(3).alias("level"), F.lit("appeal over a year").alias("alert"))),
        F.when(~defended, F.struct(F.lit(2).alias("level"), F.lit("no defence").alias("alert"))),
    ))
    worst = F.coalesce(F.array_max(F.transform(found, lambda a: a["level"])), F.lit(1))
    return cases.withColumn("alerts", F.array_join(F.transform(found, lambda a: a["alert"]), "; ")).withColumn("colour", F.get(F.array(F.lit("GREEN"), F.lit("YELLOW"), F.lit("RED")), worst - 1))


#: Alerts by level (3 red, 2 yellow, 1 blue), in the order in which they count, and how many a case may have.
ALERTS = {
    "concluded over 60 days": 3, "citation by notice without curator": 3, "no defence": 3, "expert report granted, not made": 3, "deceased party without successors": 3, "incomplete citation of joint parties": 3, "limitation near or past": 3, "appeal over a year": 3,
    "concluded over 30 days": 2, "no attempt at conciliation": 2, "documents as sole evidence": 2, "party without lawyer": 2, "value of the claim out of date": 2, "several redistributions": 2,
    "no witnesses asked for": 1, "documents not contested": 1, "priority asked for": 1, "partial settlement": 1, "claim withdrawn in part": 1,
}
MOST_ALERTS = 5


def raised(cases: DataFrame, conditions: dict[str, Column], most: int = MOST_ALERTS) -> DataFrame:
    """cases with `alerts`, at most `most` in the fixed order, the gravest first; null if there are none, and the colour of the gravest.

    conditions: by the names of ALERTS; those that aren't given, or are null
    for a case, are not raised."""
    unknown = [name for name in conditions if name not in ALERTS]
    if unknown:
        raise ValueError(f"no such alerts: {', '.join(unknown)}")
    found = F.array_compact(F.array(*[F.when(conditions[name], F.lit(name)) for name in ALERTS if name in conditions]))
    red, yellow = ([name for name, x in ALERTS.items() if x == level] for level in (3, 2))
    among = lambda names: F.arrays_overlap("_found", F.array(*map(F.lit, names)))
    out = cases.withColumn("_found", found)
    return out.withColumns({"alerts": F.nullif(F.array_join(F.slice("_found", 1, most), "; "), F.lit("")), "colour": F.when(among(red), "RED").when(among(yellow), "YELLOW").otherwise("GREEN")}).drop("_found")


def waits(as_of: Column, concluded: Column, appealed: Column, redistributions: Column | None = None) -> dict[str, Column]:
    """The conditions of raised() that follow from days and counts."""
    days = F.datediff(as_of, concluded)
    out = {"concluded over 60 days": days > 60, "concluded over 30 days": (days > 30) & (days <= 60), "appeal over a year": F.datediff(as_of, appealed) > 365}
    return out if redistributions is None else out | {"several redistributions": redistributions > 1}


def drifted(rulings: DataFrame, panel: str, position: str, order: list[str]) -> DataFrame:
    """Rulings at which a panel left its position: with the one before, by the given order."""
    along = Window.partitionBy(panel).orderBy(*order)
    return rulings.withColumn("before", F.lag(position).over(along)).where(F.col("before").isNotNull() & (F.col("before") != F.col(position)))


def with_ids(acts: DataFrame, index: DataFrame, day: str, kind: str, body_id: str, index_id: str) -> DataFrame:
    """Each act's identifier: its own, else that of the index's first entry of the same day and kind, else N/I."""
    known = index.groupBy(F.col(day).alias("_day"), F.col(kind).alias("_kind")).agg(F.min(index_id).alias("_id"))
    met = acts.join(known, F.col(day).eqNullSafe(F.col("_day")) & F.col(kind).eqNullSafe(F.col("_kind")), "left")
    return met.withColumn("id", F.coalesce(F.nullif(F.trim(F.col(body_id)), F.lit("")), "_id", F.lit("N/I"))).drop("_day", "_kind", "_id")
