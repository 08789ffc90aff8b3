"""Intermediate tables in the folder that all machines of a cluster share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local temporary one only where none is set and the master is local, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='acervo-')}")
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Writes df once and reads it back, so that all that reads it sees the same rows in the same places; by: columns that folders are made of."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
