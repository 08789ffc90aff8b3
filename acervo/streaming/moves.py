"""Moving approved workspaces to the inbox: a manifest before, renames, a result after.

Each batch of a stream writes a manifest of its folders first, then renames
them one by one, then writes what became of each.  A run that stops anywhere is
run again with the same batch: the manifest is not drawn up anew, a folder that
has moved already counts as moved, and a batch with a result does nothing.
Nothing at the destination is ever overwritten.  The driver sees folder names
alone, one at a time; contents stay where the store has them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


class Store:
    """The file system of a path, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def rename(self, path: str, to: str) -> bool:
        """False if it couldn't; a folder that is there already is never written into."""
        at = self.path(to)
        self.fs.mkdirs(at.getParent())
        return not self.fs.exists(at) and self.fs.rename(self.path(path), at)


def move(store: Store, folder: str, source: str, inbox: str) -> str:
    """moved, or why not: exists (at the destination), gone (at both), failed."""
    here, there = store.exists(f"{source}/{folder}"), store.exists(f"{inbox}/{folder}")
    if not here:
        return "moved" if there else "gone"
    if there:
        return "exists"
    return "moved" if store.rename(f"{source}/{folder}", f"{inbox}/{folder}") else "failed"


def move_batch(batch: DataFrame, number: int, source: str, inbox: str, log: str) -> None:
    """Moves the folders (column folder) of one batch; safe to call again with the same number after any stop."""
    spark = batch.sparkSession
    store = Store(spark, log)
    manifest, result = f"{log}/manifest/{number}", f"{log}/result/{number}"
    if store.exists(f"{result}/_SUCCESS"):
        return
    if not store.exists(f"{manifest}/_SUCCESS"):
        batch.select("folder").distinct().write.parquet(manifest, mode="overwrite")

    def moves() -> Iterator[tuple[str, str]]:
        places = Store(spark, source)
        for r in spark.read.schema("folder string").parquet(manifest).toLocalIterator():
            yield r.folder, move(places, r.folder, source, inbox)

    spark.createDataFrame(list(moves()), "folder string, status string").write.parquet(result, mode="overwrite")


def moving(approved: DataFrame, source: str, inbox: str, log: str, checkpoint: str) -> StreamingQuery:
    """Moves all approved folders that are new and ends; `log` holds the manifests and results."""
    return approved.writeStream.foreachBatch(lambda batch, number: move_batch(batch, number, source, inbox, log)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def moved(spark: SparkSession, log: str) -> DataFrame:
    """(folder, status) of all batches that are complete."""
    return spark.read.schema("folder string, status string").parquet(f"{log}/result/*")
