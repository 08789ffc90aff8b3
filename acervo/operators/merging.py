"""Merging partial source files: reading, validation with the first reason, deduplication and numbering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.functions.text import blank, norm_ws, padded
from acervo.sources.shared import stored

#: Origins with the prefixes of their identifiers, fields, and what a source must have.
PREFIXES = {"bnp-api": "BNP", "cjf-jurisprudencia": "CJF", "julia-trf5": "JULIA", "pesquisa-stj": "STJ", "tnu-eproc": "TNU"}
FIELDS = ["acordao", "ementa", "sumula", "tese"]
REQUIRED = ["origem_mcp", "tribunal", "tipo", "referencia", "campo", "trecho_verbatim"]
OPTIONAL = ["orgao_julgador", "data_julgamento", "url"]


def reject_reason(origins: list[str], fields: list[str], required: list[str] = REQUIRED) -> Column:
    """The first rule that an item breaks, or null."""
    out = F.when(F.lit(False), "")
    for c in required:
        out = out.when(blank(F.col(c)), f"required field missing: {c}")
    return out.when(~F.col("origem_mcp").isin(origins), F.concat(F.lit("origin not authorised: "), F.col("origem_mcp"))).when(~F.col("campo").isin(fields), "invalid field")


def validated(items: DataFrame, origins: list[str] | None = None, fields: list[str] = FIELDS) -> DataFrame:
    """items with `reason`, null if valid."""
    return items.withColumn("reason", reject_reason(origins or list(PREFIXES), fields))


def first_of_each(items: DataFrame, key: list[Column], order: list[str]) -> DataFrame:
    """The first row of each key in the given order; later ones are duplicates.

    An aggregation picks them, so that a key that many rows share is combined
    before the shuffle.
    """
    names = items.columns
    keyed = items.select(F.struct(*order).alias("_order"), F.struct(*names).alias("_row"), *[k.alias(f"_k{i}") for i, k in enumerate(key)])
    return keyed.groupBy(*[f"_k{i}" for i in range(len(key))]).agg(F.min_by("_row", "_order").alias("_row")).select("_row.*")


def ranged(rows: DataFrame, *by: Column | str) -> DataFrame:
    """rows with `_part`, the range of this order that they are in, written once.

    Range bounds come from a sample, so a plan that runs twice may draw others:
    all that reads a row's range must read the same table."""
    return stored(rows.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "ranged", "_part")


def numbered(keys: DataFrame, group: str, order: tuple[str, ...]) -> DataFrame:
    """keys with `number`, their place from 1 within their group.

    The keys are ranged by group and order, numbered within each range, and
    moved by the counts of the group's ranges before: no task gets a group.
    """
    rows = ranged(keys, group, *order)
    local = rows.withColumn("_at", F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order)))
    counts = rows.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col(group).alias("_group"), F.col("_part").alias("_of"), before.alias("_before"))
    met = local.join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of")))
    return met.withColumn("number", (F.col("_at") + F.col("_before")).cast("long")).drop("_part", "_at", "_group", "_of", "_before")


def merged(items: DataFrame, prefixes: dict[str, str] = PREFIXES, fields: list[str] = FIELDS, order: tuple[str, ...] = ("file", "position")) -> DataFrame:
    """Valid sources, each once by origin, reference and excerpt in normal form, numbered within their origin; blank optional fields are null.

    The order tells items apart.  Excerpts are compared by 128-bit digests, and
    only keys are aggregated and numbered; whole items meet their numbers last.
    """
    valid = validated(items, list(prefixes), fields).where("reason is null").drop("reason")
    keys = valid.select("origem_mcp", "referencia", F.md5(norm_ws(F.col("trecho_verbatim"))).alias("excerpt"), *order)
    once = first_of_each(keys, [F.col("origem_mcp"), F.col("referencia"), F.col("excerpt")], list(order))
    prefix = F.col("origem_mcp")
    for k, v in prefixes.items():
        prefix = F.when(F.col("origem_mcp") == k, v).otherwise(prefix)
    named = numbered(once, "origem_mcp", order).select(*[F.col(c).alias(f"_{c}") for c in ("origem_mcp", *order)], F.concat_ws("-", prefix, padded(F.col("number"), 3)).alias("_id"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("origem_mcp", *order)])
    out = valid.join(named, same).withColumn("id", F.col("_id")).drop("_id", *[f"_{c}" for c in ("origem_mcp", *order)])
    return out.withColumns({c: F.nullif(c, F.lit("")) for c in OPTIONAL if c in out.columns})


def counters(items: DataFrame, prefixes: dict[str, str] = PREFIXES, fields: list[str] = FIELDS) -> DataFrame:
    """Valid, rejected and duplicate items of each origin."""
    checked = validated(items, list(prefixes), fields)
    valid = F.col("reason").isNull()
    keys = checked.groupBy("origem_mcp", F.when(valid, F.struct("referencia", F.md5(norm_ws(F.col("trecho_verbatim"))).alias("t"))).alias("key")).agg(F.count("*").alias("n"))
    good = F.col("key").isNotNull()
    return keys.groupBy("origem_mcp").agg(
        F.coalesce(F.sum(F.when(good, F.col("n"))), F.lit(0)).alias("n_valid"), F.coalesce(F.sum(F.when(~good, F.col("n"))), F.lit(0)).alias("n_rejected"), F.coalesce(F.sum(F.when(good, F.col("n") - 1)), F.lit(0)).alias("n_duplicates")
    )
