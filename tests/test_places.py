"""Numbers and pages that are found by ranges, also where Spark runs a plan twice."""

import pytest
from pyspark.sql import functions as F

from acervo.operators import merging, search


@pytest.fixture
def no_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    yield
    spark.conf.unset("spark.sql.exchange.reuse")


def test_numbers_without_exchange_reuse(spark, no_reuse):
    n = 300_000
    keys = spark.range(n).select(F.concat(F.lit("g"), F.when(F.col("id") % 10 < 6, 0).otherwise(F.col("id") % 3)).alias("g"), (F.xxhash64("id") % 1_000_003).alias("k"), "id", F.repeat(F.lit("x"), 40).alias("other"), F.md5(F.col("id").cast("string")).alias("more"))
    got = merging.numbered(keys, "g", ("k", "id"))
    assert got.count() == n
    by = got.groupBy("g").agg(F.count("*").alias("n"), F.min("number").alias("low"), F.max("number").alias("high"), F.countDistinct("number").alias("d")).collect()
    assert all(r.low == 1 and r.high == r.n == r.d for r in by) and len(by) == 3
    steps = got.alias("a").join(got.alias("b"), F.expr("a.g = b.g and a.number + 1 = b.number")).where("(a.k, a.id) > (b.k, b.id)")
    assert steps.count() == 0


def test_deep_pages(spark):
    rows = spark.range(60_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"), "id")
    want = [tuple(r) for r in rows.orderBy(F.desc("v"), "id").collect()]
    for number in (1, 2, 500, 600, 601):
        got = search.deep_page(rows, number, 100, F.desc("v"), "id").orderBy("place").collect()
        assert [(r.v, r.id) for r in got] == want[(number - 1) * 100 : number * 100]
        assert [r.place for r in got] == list(range((number - 1) * 100 + 1, min(number * 100, 60_000) + 1))
    plan = search.deep_page(rows, 300, 100, F.desc("v"), "id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_part" in plan.split("PartitionFilters: [")[1][:80] and "TakeOrdered" not in plan
    assert search.deep_page(rows.limit(0), 1, 10, "id").count() == 0
