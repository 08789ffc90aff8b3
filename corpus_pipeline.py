"""The corpus pipeline: from the documents to token shards.

Defined results for every stage: null identifiers and texts are allowed (a null
text is an empty one), rows that repeat both identifier and text are judged
alike, texts may have any length, columns beyond those of documents are carried
on, and an empty table stays empty.

Each stage calls one operator on all that the stage before kept.  A stage's
result is written as Parquet and read again as the next one's documents, so a
lost executor costs at most the stage that it worked on.  A stage's folder is
deleted when the next one's is complete, what a stage wrote on the way when its
own result is.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from acervo.llm import decontamination, mixing, quality, shards, simhash
from acervo.llm.common import at_once, erase, finished, stored, table

#: The mixture's tokens as a share of all, and how often a document may be taken: once, since what is repeated would be a duplicate again.
FRACTION, MAX_EPOCHS = 0.95, 1
#: What a worker keeps and encodes at a time in the last stage, less than the operator's own: executors' heaps are full from the stages before.
KEPT_PIECES, ENCODED_BYTES = 300_000, 3 << 20
#: Bytes of rows that workers get at once in all stages, for the same reason.
BATCH_BYTES = 1 << 20


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the trees reject go: empty and null texts fail the base rule."""
    at_once(spark, BATCH_BYTES)
    return quality.good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest identifier: five-word shingles, a similarity of 0.8 or more.

    Rows that repeat the identifier and text that stay all stay; a row without
    identifier goes if its group has one with."""
    at_once(spark, BATCH_BYTES)
    return simhash.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, with its numbers and names changed too; an empty or null text holds none."""
    at_once(spark, BATCH_BYTES)
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"), whole=True)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are taken by their budgets: a document stays whole if the budget takes any of its tokens, so a leaf may exceed its budget by less than one document.

    A null source or language is a leaf of its own; texts without tokens are
    never taken.  Ties where a budget ends go by a seeded hash."""
    return mixing.mixture(docs, FRACTION, MAX_EPOCHS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token shards and returns what they hold, read back from the files: (doc_id, start, n_tokens, ids_crc32), a null text as the end id alone, rows without identifier first."""
    at_once(spark, BATCH_BYTES)
    return shards.tokenized(docs, public_tokenizers.path("word_bpe_49k.json"), 1, kept=KEPT_PIECES, encoded_bytes=ENCODED_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: Trained trees, fingerprints and tokens have no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = finished(spark, name, lambda: stage(spark, docs, sf_dir))  # noqa: B023
        if before is not None:
            erase(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
