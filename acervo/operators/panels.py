"""Judgment lists and demand statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def contradictions(answers: DataFrame, group: list[str], position: str) -> DataFrame:
    """Questions that got several positions: how many rows hold each and how many pairs of rows differ.

    Pairs are counted from the counts of positions, not listed.
    """
    by_position = answers.groupBy(*group, position).agg(F.count("*").alias("n"), F.min("ordem").alias("first"))
    out = by_position.groupBy(*group).agg(F.count("*").alias("n_positions"), F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("n")).alias("same"), F.min("first").alias("first"))
    return out.where("n_positions > 1").select(*group, "n_positions", ((F.col("rows") * F.col("rows") - F.col("same")) / 2).cast("long").alias("n_pairs"), "first")


def thematic(answers: DataFrame, category: str, position: str) -> DataFrame:
    """ISOLATED, ALIGNED or CONTRADICTION for each category."""
    out = answers.groupBy(category).agg(F.count("*").alias("n"), F.count_distinct(position).alias("n_positions"))
    return out.withColumn("status", F.when(F.col("n") == 1, "ISOLATED").when(F.col("n_positions") > 1, "CONTRADICTION").otherwise("ALIGNED"))


def alignment(rulings: DataFrame, key: str, position: str, few: int = 5, share: float = 0.8) -> DataFrame:
    """SCARCE below `few` rulings, else CONSOLIDATED if one position has the share, else EVOLVING."""
    counts = rulings.groupBy(key, position).agg(F.count("*").alias("n"))
    out = counts.groupBy(key).agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    return out.withColumn("status", F.when(F.col("n") < few, "SCARCE").when(F.col("most") >= F.col("n") * share, "CONSOLIDATED").otherwise("EVOLVING"))


def capped(alerts: DataFrame, case: str, priority: str, *tie: str, most: int = 5) -> DataFrame:
    """At most `most` alerts of a case, by priority."""
    return alerts.withColumn("rank", F.row_number().over(Window.partitionBy(case).orderBy(priority, *tie))).where(F.col("rank") <= most)


#: Kinds of alerts of a judgment list, the most pressing first.
ALERTS = ["cross contradiction", "binding precedent", "own panel", "internal contradiction", "sensitive case", "minority position"]


def pressing(alerts: DataFrame, case: str, kind: str, *tie: str, most: int = 5) -> DataFrame:
    """At most `most` alerts of a case in the fixed order of their kinds, with `rank`; unknown kinds come last."""
    place = F.array_position(F.array(*map(F.lit, ALERTS)), F.lower(F.trim(F.col(kind))))
    order = F.when(place > 0, place).otherwise(len(ALERTS) + 1)
    return alerts.withColumn("rank", F.row_number().over(Window.partitionBy(case).orderBy(order, *tie))).where(F.col("rank") <= most)


def quorum(reports: DataFrame, key: str, valid: Column, least: int = 3, of: int = 5) -> DataFrame:
    """Whether a case's valid reports suffice: CONSOLIDATE with `least` of them, PARTIAL with fewer, NONE without any; missing: reports of the `of` expected that are not there at all."""
    out = reports.groupBy(key).agg(F.count("*").alias("n"), F.count_if(valid).alias("n_valid"))
    status = F.when(F.col("n_valid") >= least, "CONSOLIDATE").when(F.col("n_valid") > 0, "PARTIAL").otherwise("NONE")
    return out.withColumn("missing", F.greatest(F.lit(of) - F.col("n"), F.lit(0))).withColumn("status", status)


def page_quality(pages: DataFrame, key: str, text: str, method: str | None = None, least: int = 500, share: float = 0.7) -> DataFrame:
    """Pages of each file with enough text, and whether the file goes on to the next way of extraction: when less than `share` of its pages have.

    method: a column with how each page was extracted; adds `methods`, the pages and per cent of each, and `quality` by the share of adequate pages."""
    good = F.coalesce(F.length(text) >= least, F.lit(False))
    if method is None:
        out = pages.groupBy(key).agg(F.count("*").alias("n_pages"), F.count_if(good).alias("n_adequate"))
        return out.withColumn("share", F.round(F.col("n_adequate") * 100.0 / F.col("n_pages"), 2)).withColumn("next_stage", F.col("n_adequate") / F.col("n_pages") < share)
    each = pages.groupBy(key, method).agg(F.count("*").alias("n"), F.count_if(good).alias("good"))
    mix = F.array_sort(F.collect_list(F.struct(F.col(method).alias("method"), "n")))
    out = each.groupBy(key).agg(F.sum("n").alias("n_pages"), F.sum("good").alias("n_adequate"), mix.alias("mix"))
    ratio = F.col("n_adequate") / F.col("n_pages")
    said = F.transform("mix", lambda m: F.struct(m["method"].alias("method"), m["n"].alias("n"), F.round(m["n"] * 100.0 / F.col("n_pages"), 2).alias("percent")))
    quality = F.when(ratio >= 0.95, "EXCELENTE").when(ratio >= 0.85, "BOA").when(ratio >= share, "REGULAR").otherwise("BAIXA")
    return out.withColumns({"methods": said, "quality": quality, "next_stage": ratio < share}).drop("mix")


def overlap(precedents: DataFrame, key: list[str], source: str, least: int = 2) -> DataFrame:
    """Precedents that several sources have."""
    return precedents.groupBy(*key).agg(F.count_distinct(source).alias("n_sources"), F.count("*").alias("n")).where(F.col("n_sources") >= least)


def demand(rows: DataFrame, panel: str, label: str) -> DataFrame:
    """Totals by panel, by label, by both and overall in one pass; `level` says which."""
    return rows.cube(panel, label).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def concentration(rows: DataFrame, panel: str, label: str) -> DataFrame:
    """For each label the panel that has most of it, and its share."""
    counts = rows.groupBy(label, panel).agg(F.count("*").alias("n"))
    out = counts.groupBy(label).agg(F.sum("n").alias("n"), F.min_by(F.struct(panel, "n"), F.struct(-F.col("n"), panel)).alias("top"))
    return out.select(label, "n", F.col(f"top.{panel}").alias(panel), F.round(F.col("top.n") * 100.0 / F.col("n"), 2).alias("share"))


def trend(rows: DataFrame, day: str, by: str) -> DataFrame:
    """Rows of each month, and the change from the month before that has any."""
    months = rows.groupBy(by, F.date_format(F.date_trunc("month", day), "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))
    return months.withColumn("change", F.col("n") - F.lag("n").over(Window.partitionBy(by).orderBy("month")))


def coverage(rows: DataFrame, key: str, day: Column, recent: Column, since: Column) -> DataFrame:
    """CURRENT with recent rows, else STALE with rows since a day, else FROZEN."""
    out = rows.groupBy(key).agg(F.count_if(day >= recent).alias("n_recent"), F.count_if(day >= since).alias("n_since"))
    return out.withColumn("status", F.when(F.col("n_recent") > 0, "CURRENT").when(F.col("n_since") > 0, "STALE").otherwise("FROZEN"))


def totals(tenants: dict[str, DataFrame], name: str) -> DataFrame:
    """Hits of each tenant, kept apart, and of all together."""
    each = reduce(DataFrame.unionAll, [df.agg(F.count("*").alias("n")).select(F.lit(k).alias(name), "n") for k, df in tenants.items()])
    return each.withColumn("total", F.sum("n").over(Window.partitionBy()))


def per_court(rows: DataFrame, court: Column) -> DataFrame:
    """Hits of each court, by its code."""
    return rows.groupBy(court.alias("court")).agg(F.count("*").alias("n")).orderBy("court")


def metrics(rows: DataFrame, **kinds: Column) -> DataFrame:
    """How many items a list has, of each kind, and the share of the first kind in percent."""
    first = next(iter(kinds))
    return rows.agg(F.count("*").alias("n"), *[F.count_if(c).alias(f"n_{k}") for k, c in kinds.items()], F.round(F.count_if(kinds[first]) * 100.0 / F.count("*"), 1).alias(f"share_{first}"))


def listed(rows: DataFrame, by: str, order: list[str], most: int = 100) -> DataFrame:
    """The first rows of a list, each with the size of its kind and of the whole list, which count all rows."""
    kinds = rows.groupBy(F.col(by).alias("_kind")).agg(F.count("*").alias("n_of_kind"))
    whole = kinds.withColumn("n_all", F.sum("n_of_kind").over(Window.partitionBy()))
    first = rows.orderBy(*order).limit(most)
    return first.join(whole, F.col(by).eqNullSafe(F.col("_kind"))).drop("_kind")
