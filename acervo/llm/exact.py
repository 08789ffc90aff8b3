"""Exact dedup by progressive refinement.

Texts are equal when identical after deleting the six ASCII white-space
characters.  Groups are refined in three steps, each on what the step before
left: by length, then by a hash of the first PREFIX bytes, then by the SHA-256
of the whole text.  After each step the keys that a single row has are done
with; those that recur travel as a bit table of bounded size, whose false hits
cost a hash and change nothing.  Only rows whose length and prefix recur are
hashed as a whole, and texts are never shuffled.

Of each group one row stays: that with the most code points, then the smallest
identifier.  Groups are aggregated before the shuffle; groups that hold a large
share of all rows are looked up without moving their rows.

Defined results: a null text is an empty one; a null identifier counts as
larger than any; of rows that repeat the identifier and the number of code
points as well, one stays; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.llm import bits
from acervo.llm import text as tx
from acervo.llm.common import stored
from acervo.llm.refine import looked_up, recurring

SPACE = b"\x20\t\n\v\f\r"
PREFIX = 128


def normal(column) -> list[bytes]:
    return [t.translate(None, SPACE) for t in tx.texts(column).cast(pa.large_binary()).to_pylist()]


def length_keys(found: list[bytes]) -> np.ndarray:
    return tx.mix(np.fromiter(map(len, found), np.uint64, len(found)))


def prefix_keys(found: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t[:PREFIX], len(t)) for t in found), np.uint64, len(found))


def lengths(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(length_keys(normal(b.column("text")))))], ["key"])

    return docs.select("text").mapInArrow(run, "key long")


def prefixes(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """The prefix keys of texts whose lengths recur."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            found = normal(b.column("text"))
            again = bits.may_have(sent.value, length_keys(found))
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(prefix_keys([t for t, x in zip(found, again.tolist(), strict=True) if x])))], ["key"])

    return docs.select("text").mapInArrow(run, "key long")


def measured(docs: DataFrame, known: np.ndarray, digests: bool) -> DataFrame:
    """Every row with its code points and, if its length and prefix recur (digests: in any case), the SHA-256 of its text; a short name of it groups rows."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            t = tx.texts(b.column("text"))
            found = normal(t)
            again = bits.may_have(sent.value, prefix_keys(found)).tolist()
            full = [hashlib.sha256(x).digest() if y or digests else None for x, y in zip(found, again, strict=True)]
            cols = [b.column("doc_id"), pc.utf8_length(t).cast(pa.int64()), pa.array(again, pa.bool_()), pa.array(full, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "chars", "again", "sha"])

    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, chars long, again boolean, sha binary")
    return made.withColumn("row", F.monotonically_increasing_id())


def best() -> Column:
    """The row that stays comes first in this order."""
    return F.struct((-F.col("chars")).alias("short"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")


def grouped(docs: DataFrame, digests: bool = False) -> DataFrame:
    """Every row with the identifier of the row of its group that stays (null if that has none), the group's size, and whether it is that row."""
    known = recurring(prefixes(docs, recurring(lengths(docs))))
    rows = stored(measured(docs, known, digests), "measured")
    groups = stored(rows.where("again").groupBy("sha").agg(F.count("*").alias("n"), F.min(best()).alias("best")).where("n > 1"), "groups")
    alone = F.coalesce(F.col("n") == 1, F.lit(True))
    met = looked_up(rows.where("again"), groups, ["sha"], "n", rows.count()).unionByName(rows.where("not again"), allowMissingColumns=True)
    return met.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("group_size"), (alone | (F.col("row") == F.col("best.row"))).alias("kept"), *[F.lower(F.hex("sha")).alias("text_sha256")] * digests)


def deduplicated(docs: DataFrame) -> DataFrame:
    """Every row's place: doc_id, keep_id, group_size, kept and the digest of its normalised text."""
    return grouped(docs, digests=True)


def oracle_sql() -> str:
    """The same in DuckDB's SQL."""
    return r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY sha)::BIGINT AS group_size,
  row_number() OVER w = 1 AS kept, sha AS text_sha256
FROM n WINDOW w AS (PARTITION BY sha ORDER BY chars DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""
