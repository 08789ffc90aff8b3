"""Reading the tables, shared folders, and cutting lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which all machines of a cluster see; a local temporary one only where none is set, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='acervo-')}")
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: The setting that limits the bytes of rows that a task sends to a Python worker at once (64 MB by default).
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def at_once(spark: SparkSession, most: int) -> None:
    """From now on tasks send workers about `most` bytes at once (a longer row goes alone), unless the session has a limit of its own.

    A batch lies in an executor's memory several times: beside its heap, and in the worker."""
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, str(most))


#: The folders that stored() has made within finished(), one list for each of its calls that runs.
MADE: list[list[str]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: it is computed once, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    if MADE:
        MADE[-1].append(path)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def finished(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Stores what make() returns, then deletes everything else that was stored on the way, also if it fails."""
    MADE.append([])
    try:
        out = stored(make(), name)
        MADE[-1].pop()
        return out
    finally:
        for path in MADE.pop():
            delete(spark, path)


def file_system(spark: SparkSession, path: str) -> tuple:
    """The store that has a path, and the path as it takes it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def delete(spark: SparkSession, path: str) -> None:
    store, at = file_system(spark, path)
    store.delete(at, True)


def erase(df: DataFrame) -> None:
    """Deletes what stored() wrote for df, which nothing reads any more."""
    files = df.inputFiles()
    if files:
        delete(df.sparkSession, files[0].rpartition("/")[0])
