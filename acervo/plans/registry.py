"""All queries of the engine and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one that fills fewer tasks than there are cores (a small file is one row group, so one task) is dealt to all of them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in TEXTS and df.rdd.getNumPartitions() <= cores else df


#: Tables whose rows are texts, which take most of a query's time.
TEXTS = ("documents", "pages")


def query(sql: str | None = None) -> Callable:
    """Registers a function of a table reader and the session as a query, by its name."""

    def register(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: table(spark, sf_dir, name), spark)

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from acervo.plans import cases, landing, records, statistics, texts  # noqa: F401  they register themselves

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
