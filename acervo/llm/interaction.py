"""Filter interaction audit: what each filter removes, in every order of five.

Four filters look at a text alone: few words (A), few distinct words (B), many
capitals (C), symbols (D).  The fifth (E) fails a row whose text a row with a
smaller identifier has too.  It is found by partition refinement: rows are
split by their number of code points, then by the hashes of successive blocks
of their text, each block BLOCK_GROWTH times as long as all before it.  Classes
of one row are dropped after each block; the others travel as a bit table of
bounded size.  The whole texts of what survives are compared (grouped by text,
combined before the shuffle), so that no hash decides; a class whose texts
differ, which only a hash collision makes, is settled by the texts themselves.

Each row then is one mask of five bits.  Rows are counted by part and mask, of
which a part has 32; all orders and steps follow from those counts.

Defined results: a null text is an empty one and fails A alone, and E if a
smaller identifier has one too; a null identifier counts as larger than any
other but not than another null, so that rows which repeat an identifier don't
fail E by one another; a null language is the empty string; of several labels
of an identifier any counts; other columns are ignored; an empty table has no
parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm import bits
from acervo.llm import text as tx
from acervo.llm.common import stored
from acervo.llm.refine import looked_up, recurring

#: The filters' names, their bounds, and the symbols of D.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 100, 80, 10
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The first block's bytes; each further one ends at this multiple of the bytes before.
BLOCK, BLOCK_GROWTH = 64, 16
WIDE = (1 << 64) - 1


def block_keys(t: pa.Array, rounds: int, width: int = WIDE) -> np.ndarray:
    """Keys of texts by their code points and their first `rounds` blocks; width: the bits of a key that count."""
    keys = tx.mix(pc.utf8_length(t).to_numpy(zero_copy_only=False).astype(np.uint64)) & np.uint64(width)
    if rounds:
        raw = t.cast(pa.large_binary()).to_pylist()
        for r in range(rounds):
            low, high = BLOCK * BLOCK_GROWTH ** (r - 1) if r else 0, BLOCK * BLOCK_GROWTH**r
            keys = np.fromiter((xxhash.xxh3_64_intdigest(x[low:high], k) & width for x, k in zip(raw, keys.tolist(), strict=True)), np.uint64, len(raw))
    return keys


def class_keys(docs: DataFrame, rounds: int, known: np.ndarray | None, width: int) -> DataFrame:
    """The keys after so many blocks, and the bytes of the texts, of rows whose keys before the last block recur."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            t = tx.texts(b.column("text"))
            if sent.value is not None:
                t = t.filter(pa.array(bits.may_have(sent.value, block_keys(t, rounds - 1, width))))
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(block_keys(t, rounds, width))), pc.binary_length(t)], ["key", "size"])

    return docs.select("text").mapInArrow(run, "key long, size long")


def refined(docs: DataFrame, width: int = WIDE) -> tuple[int, np.ndarray]:
    """How many blocks tell all texts apart that differ (but for collisions), and the keys that recur after them."""
    rounds, known = 0, None
    while True:
        classes = stored(class_keys(docs, rounds, known, width).groupBy("key").agg(F.count("*").alias("n"), F.max("size").alias("size")).where("n > 1"), "classes")
        known = bits.bit_table(classes.select("key"))
        longest = classes.agg(F.max("size")).first()[0] or 0
        if longest <= (BLOCK * BLOCK_GROWTH ** (rounds - 1) if rounds else 0):
            return rounds, known
        rounds += 1


def masked(docs: DataFrame, rounds: int, known: np.ndarray, width: int, with_text: bool = False) -> DataFrame:
    """Every row's part, failures of A to D as bits, and key if its text may recur; with_text: those rows alone, with their texts."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            t = tx.texts(b.column("text"))
            keys = block_keys(t, rounds, width)
            again = bits.may_have(sent.value, keys)
            if with_text:
                b, t, keys, again = b.filter(pa.array(again)), t.filter(pa.array(again)), keys[again], again[again]
            w = tx.words(t)
            n = np.diff(w.starts)
            size = len(w.uniq) + 1
            distinct = np.bincount(np.unique(w.doc * size + w.codes) // size, minlength=len(t))
            fails = [n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT_PERCENT * n, 100 * tx.byte_counts(t, CAPITALS) > MOST_CAPITALS_PERCENT * pc.utf8_length(t).to_numpy(zero_copy_only=False), tx.byte_counts(t, SYMBOLS) > 0]
            mask = sum((f.astype(np.int32) << i for i, f in enumerate(fails)), np.zeros(len(t), np.int32))
            cols = [b.column("doc_id"), b.column("part"), pa.array(mask), pa.array(tx.signed(keys), mask=~again)]
            yield pa.RecordBatch.from_arrays(cols + [t.cast(pa.string())] * with_text, ["doc_id", "part", "mask", "key"] + ["text"] * with_text)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    return slim.mapInArrow(run, "doc_id long, part string, mask int, key long" + ", text string" * with_text)


def failures(docs: DataFrame, width: int = WIDE) -> DataFrame:
    """(doc_id, part, mask) of every row; bit i of the mask is set if it fails the filter FILTERS[i]."""
    rounds, known = refined(docs, width)
    rows = stored(masked(docs, rounds, known, width), "masked")
    texts = stored(masked(docs, rounds, known, width, True).groupBy("key", "text").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "texts")
    classes = stored(texts.groupBy("key").agg(F.count("*").alias("texts"), F.min("first").alias("first"), F.sum("n").alias("n")), "classes")
    mixed = classes.where("texts > 1").select("key")
    same = looked_up(rows.where("key is not null"), classes.where("texts = 1").drop("texts"), ["key"], "n", rows.count())
    marked = rows.where("key is null").unionByName(same, allowMissingColumns=True)
    if not mixed.isEmpty():
        differ = masked(docs, rounds, known, width, True).join(mixed, "key", "left_semi").join(texts.drop("n"), ["key", "text"]).drop("text")
        marked = marked.join(mixed, "key", "left_anti").unionByName(differ, allowMissingColumns=True)
    repeats = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")))
    return marked.select("doc_id", "part", (F.col("mask") + F.when(repeats, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))


def counted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows, good ones and toxic ones of each part and mask; rows of one identifier are combined before they meet its labels."""
    flags = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    alike = rows.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    share = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c)
    return alike.join(flags, "doc_id", "left").groupBy("part", "mask").agg(F.sum("n").alias("n"), share("good"), share("toxic"))


def audit(masks: DataFrame) -> DataFrame:
    """Every part, order and step, from the counts of masks."""
    orders = F.explode(F.lit(["".join(p) for p in permutations(FILTERS)]))
    steps = masks.withColumn("filter_order", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    at = lambda i: F.expr(f"if({i} < step, shiftleft(1, position(substring(filter_order, {i}, 1), '{FILTERS}') - 1), 0)")
    steps = steps.withColumns({"own": F.expr(f"shiftleft(1, position(substring(filter_order, step, 1), '{FILTERS}') - 1)"), "before": sum((at(i) for i in range(2, len(FILTERS))), at(1))})
    mask, own, before = F.col("mask"), F.col("own"), F.col("before")
    fails, earlier = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) != 0
    total = lambda c, where, name: F.sum(F.when(where, F.col(c)).otherwise(0)).alias(name)
    turns = F.expr("n * (120 div bit_count(mask))")  # of all orders, those in which a filter comes first among the ones that a row fails
    return steps.groupBy("part", "filter_order", "step").agg(
        total("n", ~fails & ~earlier, "kept"), total("n", fails & ~earlier, "removed"), total("n", fails & earlier, "redundant"), total("n", mask == own, "unique_fails"),
        total("good", fails & ~earlier, "good_lost"), total("toxic", fails & ~earlier, "toxic_lost"), F.sum(F.when(fails, turns).otherwise(0)).alias("shapley"),
    )


def audited(docs: DataFrame, labels: DataFrame, width: int = WIDE) -> DataFrame:
    """The audit of a table of documents."""
    return audit(stored(counted(failures(docs, width), labels), "masks"))


def oracle_sql() -> str:
    """The same in DuckDB's SQL."""
    own, before = "contains(fails, letter)", "translate(fails, earlier, '') != fails"
    return rf"""
WITH words AS (SELECT row_number() OVER () AS nr, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
judged AS (SELECT part, doc_id, CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM words),
flags AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
masks AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM judged LEFT JOIN flags USING (doc_id) GROUP BY part, fails),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step::INT AS step, filter_order[step] AS letter, left(filter_order, step::INT - 1) AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS step)),
done AS (SELECT part, filter_order, step, letter,
  sum(n) FILTER (NOT {own} AND NOT ({before})) AS kept, sum(n) FILTER ({own} AND NOT ({before})) AS removed, sum(n) FILTER ({own} AND {before}) AS redundant,
  sum(n) FILTER ({own} AND length(fails) = 1) AS unique_fails, sum(good) FILTER ({own} AND NOT ({before})) AS good_lost, sum(toxic) FILTER ({own} AND NOT ({before})) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM done"""
