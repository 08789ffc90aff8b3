"""Sweeps of an inbox: new artifacts go through the gate once, however often the sweep runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from acervo.functions.text import CASE_ID, norm
from acervo.operators.gates import problems


def arrivals(spark: SparkSession, path: str, schema: str = "workspace_id string, suffix string, text string, arrived timestamp") -> DataFrame:
    """Artifacts that land as JSON lines."""
    return spark.readStream.schema(schema).json(path)


def judged(stream: DataFrame, contracts: DataFrame) -> DataFrame:
    """Each artifact's stage and problems; a stream joined with the contract table, of fixed size."""
    met = stream.join(contracts, "suffix").withColumn("n", norm(F.col("text")))
    return met.select("workspace_id", "stage", "arrived", problems(F.col("text"), F.col("n")).alias("problems"))


def sweep(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends what is new to Parquet and ends; the checkpoint remembers what was seen."""
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def pending(stages: DataFrame, done: DataFrame) -> DataFrame:
    """Stages that have no valid artifact yet, so that a run goes on where it stopped."""
    valid = done.where(F.size("problems") == 0).select("workspace_id", "stage").distinct()
    return stages.join(valid, ["workspace_id", "stage"], "left_anti")


#: Folders of the sweep's own state, and the form of a case's folder.
STATE_FOLDER = r"^0\d-"


def approved(status: DataFrame, inbox: DataFrame) -> DataFrame:
    """Workspaces to move: valid in all stages, named as a case, no state folder, and not in the inbox yet, so that nothing there is overwritten.

    status: workspace_id, folder, exit_code.  inbox: folder.
    """
    good = (F.col("exit_code") == 0) & ~F.col("folder").rlike(STATE_FOLDER) & F.col("folder").rlike(f"^{CASE_ID}$")
    return status.where(good).join(inbox.select("folder").distinct(), "folder", "left_anti")


def per_window(stream: DataFrame, late: str, size: str, by: Column) -> DataFrame:
    """Artifacts of each time window and kind; rows later than `late` are left out."""
    return stream.withWatermark("arrived", late).groupBy(F.window("arrived", size), by.alias("kind")).agg(F.count("*").alias("n"))
