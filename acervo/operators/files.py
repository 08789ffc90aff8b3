"""Document indexes and case queues: classification, selection, filters and download plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Classes by falling priority.
CLASSES = ["NUCLEAR", "IMPORTANTE", "IRRELEVANTE"]


#: Rules that are sent to the tasks at a time.
MOST_RULES = 10_000


def classified(index: DataFrame, rules: DataFrame, kind: str = "tipo", default: str = "OUTRO") -> DataFrame:
    """Each kind's class: the highest of the rules whose term contains the kind or is contained in it; an empty kind matches nothing.

    Only distinct kinds meet the rules (term, classe).  These are counted, and
    sent to the tasks in blocks of at most MOST_RULES, of which a usual table is
    one.
    """
    low = F.lower(F.trim(F.col(kind)))
    kinds = index.select(F.col(kind).alias("_kind"), low.alias("_low")).distinct()
    rank = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("classe"))
    holds = (F.col("_low") != "") & (F.contains("_low", F.lower("term")) | F.contains(F.lower("term"), F.col("_low")))
    blocks = max(1, -(-rules.count() // MOST_RULES))
    met = reduce(DataFrame.unionAll, [kinds.join(F.broadcast(rules.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == b)), holds).select("_kind", "classe") for b in range(blocks)])
    best = met.groupBy("_kind").agg(F.min_by("classe", rank).alias("_class"))
    return index.join(best, index[kind].eqNullSafe(best["_kind"]), "left").withColumn("classe", F.coalesce("_class", F.lit(default))).drop("_kind", "_class")


def zero_filled(rows: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Counts over a fixed domain, with shares of the total."""
    counts = rows.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    full = rows.sparkSession.createDataFrame([(x,) for x in domain], f"{column} string").join(counts, F.col(column) == F.col("v"), "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return full.withColumn("share", F.coalesce(F.round(F.try_divide(F.col("n") * 100.0, total), 2), F.lit(0.0)))


def selection(kind: Column, text: Column, age_days: Column, kilobytes: Column, nuclear: list[str], triggers: list[str], generic: list[str]) -> Column:
    """Why a document is taken, or "excluded" for old, small ones of a generic kind; when unsure, it is taken."""
    hit = reduce(Column.__or__, [F.contains(F.lower(text), F.lit(t)) for t in triggers])
    return F.when(kind.isin(nuclear), "nuclear").when(hit, "trigger").when(age_days <= 180, "recent").when(kilobytes > 500, "large").when(kind.isin(generic), "excluded").otherwise("unsure")


def guarded(selected: DataFrame, case: str, age: str = "age_days", most: float = 0.8, revert_days: int = 90) -> DataFrame:
    """Where a case would lose over `most` of its documents, those of the last days are taken after all."""
    shares = selected.groupBy(F.col(case).alias("_case")).agg((F.count_if(F.col("reason") == "excluded") / F.count("*")).alias("_share"))
    met = selected.join(shares, F.col(case).eqNullSafe(F.col("_case")))
    back = (F.col("reason") == "excluded") & (F.col("_share") > most) & (F.col(age) <= revert_days)
    return met.withColumn("reason", F.when(back, "reverted").otherwise(F.col("reason"))).drop("_case", "_share")


def strategy(n: Column, n_irrelevant: Column, has_kinds: Column) -> Column:
    """How to download a case: in full up to 100 documents or where no kinds are known; selectively beyond, but in full where few would be left out."""
    share = F.coalesce(F.try_divide(n_irrelevant, n), F.lit(0.0))
    return F.when(~has_kinds, "full").when(n <= 100, "full").when((n > 500) & (share < 0.1), "full").when(n > 300, "selective").when(share > 0.3, "selective").otherwise("full")


def composition(selected: DataFrame, kind: str = "classe", reason: str = "reason", size: str = "kilobytes") -> DataFrame:
    """What a download plan takes and leaves out, by class and reason, with totals of each class and of all (null for what is totalled).

    n and share: documents, in per cent of all; taken and left: kilobytes by
    whether the reason is "excluded"; savings: what is left out in per cent of
    all documents and of all kilobytes."""
    out = F.col(reason) == "excluded"
    cells = selected.groupBy(kind, reason).agg(F.count("*").alias("n"), F.count_if(out).alias("n_left"), F.coalesce(F.sum(F.when(~out, F.col(size))), F.lit(0)).alias("taken"), F.coalesce(F.sum(F.when(out, F.col(size))), F.lit(0)).alias("left"))
    sums = cells.rollup(kind, reason).agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in ("n", "n_left", "taken", "left")])
    of_all = lambda c: F.max(F.when(F.col("level") == 3, c)).over(Window.partitionBy())  # noqa: E731  a row for each class and reason, no more
    percent = lambda part, whole: F.coalesce(F.round(F.try_divide(part * 100.0, whole), 2), F.lit(0.0))
    n, kb = of_all(F.col("n")), of_all(F.col("taken") + F.col("left"))
    return sums.withColumns({"share": percent(F.col("n"), n), "n_savings": percent(F.col("n_left"), n), "savings": percent(F.col("left"), kb)}).drop("n_left")


def merge_order(names: DataFrame, within: str, name: str, *ties: str, unnamed: str | None = None) -> DataFrame:
    """Files to merge with their `place`: by the number before the first underscore, not by its digits as text; names that begin with one, or whose start is no number, are left out.

    ties: columns that order files of one name; unnamed: column with the number of
    files whose name is null, which are kept then, after the named ones of their
    number, and last of all where that is null too."""
    number = F.substring_index(name, "_", 1).try_cast("bigint")
    taken = ~F.startswith(name, F.lit("_")) & number.isNotNull()
    if unnamed:
        number, taken = F.coalesce(number, F.when(F.col(name).isNull(), F.col(unnamed).cast("bigint"))), taken | F.col(name).isNull()
    order = Window.partitionBy(within).orderBy(number.asc_nulls_last(), F.col(name).asc_nulls_last(), *ties)
    return names.where(taken).withColumn("place", F.row_number().over(order))


def not_there(candidates: DataFrame, destination: DataFrame, key: str) -> DataFrame:
    """Candidates whose key the destination doesn't have; a null key is in none."""
    return candidates.join(destination.select(F.col(key).alias("_there")).distinct(), F.col(key) == F.col("_there"), "left_anti")


def queue(cases: DataFrame, tags_all: list[str] | None = None, tags_any: list[str] | None = None, untagged: bool | None = None, text: str | None = None, flags: dict[str, bool | None] | None = None) -> DataFrame:
    """Filters that are null are ignored; tags are compared as written."""
    out = cases
    if tags_all:
        out = out.where(F.forall(F.array(*map(F.lit, tags_all)), lambda t: F.array_contains("etiquetas", t)))
    if tags_any:
        out = out.where(F.arrays_overlap("etiquetas", F.array(*map(F.lit, tags_any))))
    if untagged is not None:
        out = out.where((F.size("etiquetas") == 0) == untagged)
    if text:
        out = out.where(F.contains(F.lower("texto"), F.lit(text.lower())))
    for c, v in (flags or {}).items():
        if v is not None:
            out = out.where(F.coalesce(F.col(c), F.lit(False)) == v)
    return out


def by_conclusion(cases: DataFrame, descending: bool = False, most: int = 0) -> DataFrame:
    """By the date of conclusion, missing first when ascending; ties keep their order. most: 0 for all."""
    day = F.coalesce(F.col("data_conclusao"), F.lit(""))
    out = cases.orderBy(day.desc() if descending else day.asc(), "position")
    return out.limit(most) if most else out
