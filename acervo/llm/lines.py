"""Line dedup: removes boilerplate, lines that stand on many distinct sites.

Each line hash gets a HyperLogLog sketch of its sites, merged by aggregation.
A first aggregation of counts leaves out lines that cannot reach the
threshold (they have fewer rows than that, or a single site), so sketches are
made for the rest alone.  Where an estimate is near the threshold, the sites
are counted exactly.  Lines over it are removed from every document.

The hashes of removed lines go to the tasks if they are at most MOST_HASHES;
if there are more, they are joined with the documents' lines.

Defined results: a line is what stands between line feeds, compared without
the white space at its ends; lines of white space alone always stay; a null or
empty text has no lines and stays empty; a null site is a site; repeated rows
are treated alike; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm import text as tx
from acervo.llm.bits import bit_table, may_have
from acervo.llm.common import stored

SITES = 10
#: Sketches of 2**LG_K registers (error about 1.6 %); estimates within this share of the threshold are counted exactly.
LG_K, NEAR = 12, 0.15
MOST_HASHES = 2_000_000


def split(column) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All lines of the texts, the row of each, and its hash; 0 for lines of white space."""
    parts = pc.split_pattern(tx.texts(column), "\n")
    counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = parts.flatten()
    coded = pc.ascii_trim(flat, " \t\n\v\f\r").dictionary_encode()
    h = tx.hashed(coded.dictionary)
    h[pc.equal(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)] = 0
    return flat, np.repeat(np.arange(len(counts)), counts), h[coded.indices.to_numpy(zero_copy_only=False)]


def on_sites(docs: DataFrame, site: str, only: np.ndarray | None = None) -> DataFrame:
    """(line, site, n) for each batch, its rows summed; only: lines that may be in the table."""
    sent = docs.sparkSession.sparkContext.broadcast(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for b in tx.sliced(batches):
            _, row, h = split(b.column("text"))
            ok = (h != 0) & may_have(known, h) if known is not None else h != 0
            sites = b.column("site").to_numpy()[row[ok]]
            order = np.lexsort((sites, h[ok]))
            h, sites = h[ok][order], sites[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (sites[1:] != sites[:-1])])) if len(h) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(h[new])), pa.array(sites[new]), pa.array(np.diff(np.append(new, len(h))))], ["line", "site", "n"])

    return docs.select("text", F.xxhash64(F.coalesce(F.col(site).cast("string"), F.lit(""))).alias("site")).mapInArrow(run, "line long, site long, n long")


def boilerplate(docs: DataFrame, site: str, sites: int) -> DataFrame:
    """The hashes of lines that stand on at least so many distinct sites."""
    rows = on_sites(docs, site).groupBy("line").agg(F.sum("n").alias("n"), F.min("site").alias("a"), F.max("site").alias("b"))
    maybe = stored(rows.where((F.col("n") >= sites) & ((F.col("a") < F.col("b")) | F.lit(sites <= 1))).select("line"), "maybe")
    spread = stored(on_sites(docs, site, bit_table(maybe)).select("line", "site"), "spread")
    sketched = spread.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
    guessed = stored(sketched.select("line", F.hll_sketch_estimate("sketch").alias("about")).where(F.col("about") >= sites * (1 - NEAR)), "estimates")
    near = guessed.where(F.col("about") <= sites * (1 + NEAR)).select("line")
    exact = spread.join(near, "line", "left_semi").distinct().groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= sites)
    return stored(guessed.where(F.col("about") > sites * (1 + NEAR)).select("line").unionAll(exact.select("line")), "boilerplate")


SCHEMA = "doc_id long, n_lines long, n_removed long, kept_md5 string"


def without(docs: DataFrame, gone: DataFrame, most: int = MOST_HASHES, also_text: bool = False) -> DataFrame:
    """Every document's lines, removed lines and the digest (and text) of what is kept."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    few = gone.count() <= most
    if few:
        known = np.sort(gone.toArrow()["line"].to_numpy().astype(np.int64).view(np.uint64))
        met = rows.withColumn("gone", F.lit(None).cast("array<long>"))
    else:
        known = np.empty(0, np.uint64)
        met = with_lines(rows, gone)
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            flat, row, h = split(b.column("text"))
            if few:
                at = np.minimum(np.searchsorted(sent.value, h), max(0, len(sent.value) - 1))
                bad = (sent.value[at] == h) if len(sent.value) else np.zeros(len(h), bool)
            else:
                lists = b.column("gone").to_pylist()
                own = {(i, x) for i, found in enumerate(lists) for x in found or ()}
                bad = np.fromiter(((i, x) in own for i, x in zip(row.tolist(), tx.signed(h).tolist(), strict=True)), bool, len(h))
            starts = np.searchsorted(row, np.arange(b.num_rows + 1))
            lines, keep = np.array(flat.to_pylist(), object), ~bad
            kept = ["\n".join(lines[i:j][keep[i:j]].tolist()) for i, j in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            cols = [b.column("doc_id"), pa.array(tx.per_doc(h != 0, starts)), pa.array(tx.per_doc(bad, starts)), pa.array([hashlib.md5(x.encode()).hexdigest() for x in kept], pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.string())] * also_text, ["doc_id", "n_lines", "n_removed", "kept_md5"] + ["kept_text"] * also_text)

    return met.mapInArrow(run, SCHEMA + ", kept_text string" * also_text)


def with_lines(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Gives each row the list of its own removed lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            _, row, h = split(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row)), b.column("tag").take(pa.array(row)), pa.array(tx.signed(h))], ["d", "t", "line"])

    tagged = rows.withColumn("tag", F.xxhash64("text"))
    own = tagged.mapInArrow(run, "d long, t long, line long").distinct().join(gone, "line", "left_semi").groupBy("d", "t").agg(F.collect_list("line").alias("gone"))
    return tagged.join(own, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("t")), "left").select("doc_id", "text", "gone")


def deduplicated(docs: DataFrame, site: str = "source", sites: int = SITES, most: int = MOST_HASHES, also_text: bool = False) -> DataFrame:
    """Every document without the lines that stand on at least `sites` distinct sites."""
    return without(docs, boilerplate(docs, site, sites), most, also_text)


def oracle_sql(sites: int = SITES) -> str:
    """The same in DuckDB's SQL, with exact distinct counts of the lines themselves."""
    space = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH numbered AS (SELECT row_number() OVER () AS nr, doc_id, coalesce(source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT nr, doc_id, site, i, parts[i] AS line, trim(parts[i], {space}) AS bare FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM numbered)),
gone AS (SELECT bare AS gone FROM lines WHERE bare != '' GROUP BY bare HAVING count(DISTINCT site) >= {sites})
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (bare != '')::BIGINT AS n_lines, count(gone)::BIGINT AS n_removed,
  md5(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (gone IS NULL), '')) AS kept_md5
FROM lines LEFT JOIN gone ON bare = gone GROUP BY nr"""
