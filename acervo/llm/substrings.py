"""Substring deduplication with a log-structured fingerprint index.

A window is `window` consecutive words of one document.  Each window is filed
under a fingerprint of part of it: the smallest hash among the grams of half
the window's length that it holds.  Equal windows have equal fingerprints, and
neighbouring windows mostly share theirs, so the index holds one entry for
about thirteen windows of 50 words.  A stretch is the run of windows that
share one fingerprint in one place.

The index keeps sorted immutable runs in a folder, which can be opened again:
tables bucketed and sorted by fingerprint with each fingerprint once.  A new batch's fingerprints are merge-joined with
every run; those that the batch has twice or that a run has are shared.  The
batch becomes a run of its own, and runs are compacted into one when they are
more than `fan_in`.

Shared fingerprints only say where to look.  Verification reads the texts
again: stretches with equal words (128-bit digests of their bytes) are
settled together, since all but those of the smallest identifier are repeats;
where a fingerprint has stretches of different words, the windows of each
stretch's first document are compared one by one in the same way.  What to
look at travels as a bit table of bounded size, whose false hits cost work
and change nothing.

Defined results: a null or empty text has no words; a null identifier counts
as larger than any; rows with equal identifiers don't remove each other's
words; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.llm import text as tx
from acervo.llm.bits import bit_table, may_have
from acervo.llm.common import delete, file_system, new_folder, stored

WINDOW = 50
#: An odd constant of the rolling hash.
BASE = 0x9E3779B97F4A7C15
#: A null identifier's place in the order.
LAST = (1 << 63) - 1
#: The folder of an index that says which documents have a fingerprint.
HOLDERS = "holders"


class Stretches:
    """The stretches of a batch of texts: fingerprint, first window's word, number of windows, row."""

    def __init__(self, column, window: int) -> None:
        self.window, self.words = window, (w := tx.words(column))
        half = window // 2
        span = window - half + 1
        grams = tx.rolling(tx.hashed(w.uniq)[w.codes], half, BASE) if len(w.codes) >= window else np.empty(0, np.uint64)
        whole = tx.inside(w.doc, window)
        n = len(whole)
        if not n:
            self.prints, self.at, self.n = grams[:0], np.empty(0, np.int64), np.empty(0, np.int64)
        else:
            low = lowest(grams, span)[:n]
            new = np.ones(n, bool)
            new[1:] = (low[1:] != low[:-1]) | (w.doc[1:n] != w.doc[: n - 1]) | ~whole[: n - 1]
            first = np.flatnonzero(new & whole)
            ids = np.cumsum(new)  # a stretch ends where the next begins or its row has no more windows
            self.at, self.prints = first, grams[low[first]]
            self.n = np.bincount(ids[whole], minlength=ids[-1] + 1)[ids[first]]
        self.row = w.doc[self.at] if n else self.at

    def bytes(self) -> tuple[bytes, np.ndarray]:
        """All words joined by spaces, and where each begins (one more at the end)."""
        w = self.words
        raw = np.array(w.uniq.cast("large_binary").to_pylist(), object)[w.codes].tolist()
        starts = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1, out=starts[1:])
        return b" ".join(raw), starts

    def digests(self, first: np.ndarray, n_words: np.ndarray, text: bytes, starts: np.ndarray) -> np.ndarray:
        """128-bit digests of stretches of words, as two columns."""
        cut = map(text.__getitem__, map(slice, starts[first].tolist(), (starts[first + n_words] - 1).tolist()))
        return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, cut)), np.int64).reshape(-1, 2)


def lowest(a: np.ndarray, span: int) -> np.ndarray:
    """For each place, where the smallest (leftmost if equal) of the next `span` values is; by the smallest so far from both ends of blocks. Values count without their last six bits."""
    assert span <= 64
    n = len(a) - span + 1
    blocks = -(-len(a) // span)
    key = np.full(blocks * span, np.uint64((1 << 64) - 1))
    key[: len(a)] = a >> np.uint64(6) << np.uint64(6) | np.arange(len(a), dtype=np.uint64) % np.uint64(span)
    key = key.reshape(blocks, span)
    ahead = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(key, axis=1).ravel()
    s = np.arange(n)
    left, right = ahead[:n], behind[s + span - 1]
    block = s // span * span
    six = np.uint64(63)
    at_left = block + (left & six).astype(np.int64)
    at_right = (s + span - 1) // span * span + (right & six).astype(np.int64)
    return np.where(left >> np.uint64(6) <= right >> np.uint64(6), at_left, at_right)


class FingerprintIndex:
    """Sorted immutable runs of the fingerprints seen so far, one folder each within `folder`.

    A folder that holds runs is opened with them, so that later batches meet
    all earlier ones.  A run counts once its files are complete.  Beside the
    runs stand holders, which documents have a fingerprint, if batches are
    added with them (extended() does, a single pass over all needs none)."""

    def __init__(self, spark: SparkSession, fan_in: int = 2, folder: str | None = None) -> None:
        self.spark, self.fan_in, self.folder = spark, fan_in, folder or new_folder(spark, "index")
        store, at = file_system(spark, self.folder)
        found = sorted(x.getPath().getName() for x in store.listStatus(at)) if store.exists(at) else []
        found = [name for name in found if name != HOLDERS]
        self.runs = [self.table(name) for name in found if store.exists(file_system(spark, f"{self.folder}/{name}/_SUCCESS")[1])]

    def table(self, name: str) -> str:
        """Registers the run of this name, <number>-<buckets>-<unique>, as a table."""
        table = f"run_{name.replace('-', '_')}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (print BIGINT, n BIGINT) USING parquet CLUSTERED BY (print) SORTED BY (print) INTO {int(name.split('-')[1])} BUCKETS OPTIONS (compression 'zstd') LOCATION '{self.folder}/{name}'")
        return table

    def write(self, prints: DataFrame) -> DataFrame:
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        last = max([-1, *(int(run.split("_")[1]) for run in self.runs)])
        name = f"{last + 1:06d}-{buckets}-{uuid.uuid4().hex}"
        table = self.table(name)
        prints.select("print", "n").repartition(buckets, "print").sortWithinPartitions("print").write.insertInto(table)
        self.runs.append(table)
        return self.spark.table(table)

    def add(self, prints: DataFrame) -> DataFrame:
        """Takes a batch's fingerprints, one row for each document that has it; returns those of the batch that are shared."""
        before = list(self.runs)
        batch = self.write(prints.groupBy("print").agg(F.count("*").alias("n")))
        shared = batch.where("n > 1").select("print")
        for run in before:
            shared = shared.unionAll(batch.join(self.spark.table(run).select("print").hint("merge"), "print", "left_semi").select("print"))
        shared = stored(shared.distinct(), "shared")
        if len(self.runs) > self.fan_in:
            self.compact()
        return shared

    def compact(self) -> None:
        """Merges all runs into one; they go when it is complete."""
        old = list(self.runs)
        merged = self.spark.table(old[0]).select("print", "n")
        for name in old[1:]:
            merged = merged.unionAll(self.spark.table(name).select("print", "n"))
        self.write(merged.groupBy("print").agg(F.sum("n").alias("n")))
        self.drop(old)

    def hold(self, holders: DataFrame) -> None:
        """Files (print, doc, tag) of a batch, sorted by fingerprint."""
        holders.repartitionByRange("print").sortWithinPartitions("print").write.parquet(f"{self.folder}/{HOLDERS}", mode="append", compression="zstd")

    def holders(self, shared: DataFrame) -> DataFrame | None:
        """(doc, tag) of the documents of earlier batches that have one of these fingerprints."""
        store, at = file_system(self.spark, f"{self.folder}/{HOLDERS}")
        return self.spark.read.parquet(f"{self.folder}/{HOLDERS}").join(shared, "print", "left_semi").select("doc", "tag").distinct() if store.exists(at) else None

    def drop(self, names: list[str] | None = None) -> None:
        """Deletes runs, all if none are named."""
        for name in list(names if names is not None else self.runs):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete(self.spark, f"{self.folder}/{name.removeprefix('run_').replace('_', '-')}")
            self.runs.remove(name)


def arranged(docs: DataFrame) -> DataFrame:
    """Documents with `doc`, their place in the order, and `tag`, a 64-bit hash of the text, which tells apart rows that share an identifier or have none."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumns({"doc": F.coalesce("doc_id", F.lit(LAST)), "tag": F.xxhash64("text")})


def fingerprints(docs: DataFrame, window: int, holders: bool = False) -> DataFrame:
    """(print): each document's distinct fingerprints; holders: with (doc, tag)."""
    more = ["doc", "tag"] if holders else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            s = Stretches(b.column("text"), window)
            order = np.lexsort((s.prints, s.row))
            row, prints = s.row[order], s.prints[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (prints[1:] != prints[:-1])
            at = pa.array(row[new])
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(prints[new])), *(b.column(c).take(at) for c in more)], ["print", *more])

    return docs.select("text", *more).mapInArrow(run, ", ".join(f"{c} long" for c in ["print", *more]))


STRETCH = "print long, a long, b long, doc long, tag long, at long, n long"


def stretches(docs: DataFrame, window: int, shared: np.ndarray) -> DataFrame:
    """The stretches under shared fingerprints; (a, b) digests their words."""
    sent = docs.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            s = Stretches(b.column("text"), window)
            k = np.flatnonzero(may_have(sent.value, s.prints))
            if len(k):
                d = s.digests(s.at[k], s.n[k] + window - 1, *s.bytes())
                row = s.row[k]
                cols = [tx.signed(s.prints[k]), d[:, 0], d[:, 1], b.column("doc").to_numpy()[row], b.column("tag").to_numpy()[row], s.at[k] - s.words.starts[row], s.n[k]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], STRETCH.replace(" long", "").split(", "))

    return docs.select("text", "doc", "tag").mapInArrow(run, STRETCH)


def open_key(a: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A hash of a stretch's words and its document."""
    return tx.mix(a.view(np.uint64) ^ open_doc(doc))


def open_doc(doc: np.ndarray) -> np.ndarray:
    """A hash of a document."""
    return tx.mix(doc.view(np.uint64))


def windows(docs: DataFrame, window: int, still_open: np.ndarray, shared: np.ndarray) -> DataFrame:
    """Every window of the stretches that are still open; (a, b) digests its words.  Documents without any are passed over."""
    sent, known = docs.sparkSession.sparkContext.broadcast(still_open), docs.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            b = b.filter(pa.array(may_have(sent.value, open_doc(b.column("doc").to_numpy()))))
            s = Stretches(b.column("text"), window)
            k = np.flatnonzero(may_have(known.value, s.prints))
            if not len(k):
                continue
            joined = s.bytes()
            doc = b.column("doc").to_numpy()
            d = s.digests(s.at[k], s.n[k] + window - 1, *joined)
            k = k[may_have(sent.value, open_key(np.ascontiguousarray(d[:, 0]), doc[s.row[k]]))]
            row = np.repeat(s.row[k], s.n[k])
            at = np.repeat(s.at[k] - (np.cumsum(s.n[k]) - s.n[k]), s.n[k]) + np.arange(s.n[k].sum())
            d = s.digests(at, np.full(len(at), window), *joined)
            cols = [d[:, 0], d[:, 1], doc[row], b.column("tag").to_numpy()[row], at - s.words.starts[row]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["a", "b", "doc", "tag", "at"])

    return docs.select("text", "doc", "tag").mapInArrow(run, "a long, b long, doc long, tag long, at long")


def repeats(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """found's rows with words (a, b) that a smaller document has, and its other rows.

    Words of several documents are written out first: a join of two plain
    shuffles lets Spark split the rows of words that are very common.
    """
    several = found.groupBy("a", "b").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select(F.col("a").alias("fa"), F.col("b").alias("fb"), "first")
    met = found.join(stored(several, "several"), (F.col("a") == F.col("fa")) & (F.col("b") == F.col("fb")), "left").drop("fa", "fb")
    return met.where("doc > first"), met.where("first is null or doc = first")


def covered(docs: DataFrame, window: int, shared: DataFrame) -> DataFrame:
    """(doc, tag, at, n): the places where n windows in a row are repeats, verified on the texts."""
    bits = bit_table(shared)
    found = stored(stretches(docs, window, bits), "stretches")
    again, firsts = repeats(found)
    mixed = stored(found.groupBy("print").agg((F.min("a") < F.max("a")).alias("mixed")).where("mixed").select(F.col("print").alias("p")), "mixed")
    still_open = firsts.join(mixed, F.col("print") == F.col("p"), "left_semi").select("a", "doc")

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc = b.column("doc").to_numpy()
            keys = np.concatenate([open_key(b.column("a").to_numpy(), doc), np.unique(open_doc(doc))])
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(keys))], ["key"])

    open_bits = bit_table(stored(still_open.mapInArrow(key, "key long"), "open"))
    single, _ = repeats(stored(windows(docs, window, open_bits, bits), "windows"))
    return again.select("doc", "tag", "at", "n").unionAll(single.select("doc", "tag", "at", F.lit(1).cast("long").alias("n")))


def cleaned(docs: DataFrame, places: DataFrame, window: int, also_text: bool = False) -> DataFrame:
    """Every document's number of words, of removed ones, and the digest (and text) of those kept."""
    once = places.distinct()  # rows that repeat both identifier and text have the same places
    lists = once.groupBy(F.col("doc").alias("d"), F.col("tag").alias("t")).agg(F.collect_list(F.struct("at", "n")).alias("places"))
    met = docs.join(lists, (F.col("doc") == F.col("d")) & (F.col("tag") == F.col("t")), "left").select("doc_id", "text", F.col("places.at").alias("at"), F.col("places.n").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            w = tx.words(b.column("text"))
            at, n = b.column("at").cast(pa.large_list(pa.int64())), b.column("n").cast(pa.large_list(pa.int64()))
            change = np.zeros(len(w.codes) + 1, np.int64)
            lengths = np.array([0 if x is None else x for x in at.value_lengths().to_pylist()], np.int64) if len(at) else np.empty(0, np.int64)
            begin = np.repeat(w.starts[:-1], lengths) + at.flatten().to_numpy()
            np.add.at(change, begin, 1)
            np.add.at(change, begin + n.flatten().to_numpy() + window - 1, -1)
            gone = np.cumsum(change)[:-1] > 0
            raw = np.array(w.uniq.cast(pa.large_binary()).to_pylist(), object)
            kept = [b" ".join(raw[w.codes[i:j][~gone[i:j]]].tolist()) for i, j in zip(w.starts[:-1].tolist(), w.starts[1:].tolist(), strict=True)]
            cols = [b.column("doc_id"), pa.array(np.diff(w.starts)), pa.array(tx.per_doc(gone, w.starts)), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(cols + [pa.array([x.decode() for x in kept], pa.string())] * also_text, names + ["kept_text"] * also_text)

    return met.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * also_text)


def deduplicated(docs: DataFrame, window: int = WINDOW, batches: int = 3, fan_in: int = 2, also_text: bool = False) -> DataFrame:
    """Removes each word covered by a window that also starts in a document with a smaller identifier.

    The documents enter the index in `batches` ranges of their identifiers;
    more than `fan_in` runs are compacted.
    """
    rows = arranged(docs)
    cuts = sorted(set(rows.agg(F.percentile_approx("doc", [i / batches for i in range(1, batches)])).first()[0] or [])) if batches > 1 else []
    index = FingerprintIndex(docs.sparkSession, fan_in)
    try:
        shared = None
        for low, high in zip([None, *cuts], [*cuts, None], strict=True):
            new = index.add(fingerprints(rows.where(between(low, high)), window))
            shared = new if shared is None else shared.unionAll(new)
        places = covered(rows, window, shared)
    finally:
        index.drop()
    return cleaned(rows, places, window, also_text)


def between(low: int | None, high: int | None) -> Column:
    """Documents behind low up to high in the order; a condition on identifiers, so that it reaches the files."""
    behind = F.lit(True) if low is None else F.lit(False) if low == LAST else F.col("doc_id").isNull() | (F.col("doc_id") > low)
    return behind if high is None or high == LAST else behind & (F.col("doc_id") <= high)


def extended(index: FingerprintIndex, docs: DataFrame, earlier: DataFrame | None, window: int = WINDOW, also_text: bool = False) -> DataFrame:
    """Takes a new batch into an index and cleans it: each word goes that is covered by a window which also starts in a document with a smaller identifier, of this batch or an earlier one.

    earlier: all documents of earlier batches (null at the first).  Of these,
    only those that share a fingerprint with the batch are read beyond their
    identifiers and hashes of their texts; they are not judged again, so
    batches come in the order of their identifiers.
    """
    new = arranged(docs)
    found = stored(fingerprints(new, window, True), "fingerprints")
    shared = index.add(found.select("print"))
    holders = index.holders(shared)
    index.hold(found)
    rows = new
    if earlier is not None and holders is not None:
        rows = new.unionByName(arranged(earlier).join(stored(holders, "holders"), ["doc", "tag"], "left_semi").select(*new.columns))
    places = covered(rows, window, shared)
    return cleaned(new, places, window, also_text)
