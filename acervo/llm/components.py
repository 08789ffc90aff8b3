"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.common import erase, stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node of its component.

    edges has (u, v) with u > v, each once.  A round makes each node's larger
    neighbours point to its smallest one, then each node's smaller ones; the
    edges end as one star for each component.  Only a count and a checksum
    come to the driver.
    """
    e = stored(edges, "edges")
    mark = state(e)
    for _ in range(most_rounds):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("n")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.withColumnRenamed("u", "n"), F.col("u") == F.col("n")).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, e = e, stored(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        erase(before)
        last, mark = mark, state(e)
        if last == mark:
            break
    else:
        raise RuntimeError(f"components still change after {most_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
