"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints that differ in at most `radius` bits link.  The 64 bits are
grouped into partitions of correlated bits, each with a threshold of its own,
such that the thresholds plus one add up to radius + 1: two fingerprints that
link then differ by no more than the threshold in at least one partition.
Dynamic programming picks the thresholds (-1 leaves a partition out) that
cost least by the candidate counts estimated from a sample of pairs; the
sample bears on cost alone, never on which links are found.  Each fingerprint
is indexed under its bits in each partition and probes all values within the
threshold; candidates are verified on all 64 bits inside the join.

Equal fingerprints are one row throughout.  A key that has many (a large
group of near copies) gets a pivot, its smallest fingerprint: rows within the
radius of it link to it alone, and only pairs with a row that is not are
compared.  That keeps all components and needs no pairs among the copies.

Defined results: a null or empty text has fingerprint zero, linked like any
other; repeated rows and identifiers are all returned; a null identifier is
larger than any; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.llm import text as tx
from acervo.llm.bits import bit_table, may_have
from acervo.llm.common import erase, stored
from acervo.llm.components import components

#: Fixed values of the fingerprint.
SHINGLE, SEED = 4, 42

#: At most so many fingerprints, those with the smallest hash, inform the plan.
PLAN_SAMPLE = 3000
#: The cost of a probe in that of a compared pair.
PROBE_COST = 30
#: A key with more fingerprints than this gets a pivot.
DENSE = 128
#: The same for candidates of near texts, each of which is decided by whole sets.
NEAR_DENSE = 8
#: Before all other pairs meet, texts meet hubs in so many turns, which leaves fewer groups to compare.
HUB_TURNS = 2
#: One of so many texts, by their hashes, tells which shingles are common: those that so many of them have, the
#: most common first if there are more than COMMON_MOST (24 MB).  They bear on the order of shingles alone, never on which links are found.
COMMON_EVERY, COMMON_LEAST, COMMON_MOST = 20, 4, 2_000_000


#: So many hashes are unpacked into bits at a time (about 40 MB).
VOTES = 1 << 17


def voted(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SimHash of each text's hashes: a bit is set if it is in over half of them; zero if there are none."""
    out, n = np.zeros(len(starts) - 1, np.uint64), np.diff(starts)
    unpacked = lambda x: np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1)
    full, at = np.flatnonzero(n), 0
    while at < len(full):
        first = starts[full[at]]
        end = max(at + 1, int(np.searchsorted(starts[full + 1], first + VOTES, side="right")))
        part = full[at:end]
        if n[part[0]] > VOTES:
            sums = sum(unpacked(h[i : min(i + VOTES, starts[part[0] + 1])]).sum(0, dtype=np.int64) for i in range(first, starts[part[0] + 1], VOTES))[None]
        else:
            sums = np.add.reduceat(unpacked(h[first : starts[part[-1] + 1]]), starts[part] - first, axis=0, dtype=np.int32)
        out[part] = np.packbits(2 * sums > n[part, None], axis=1).view(np.uint64).ravel()
        at = end
    return out


def fingerprints(column, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """64 bits for each text: a bit is set if it is in over half of the shingles' hashes. A text without words has zero."""
    w = tx.words(column, lower=True)
    counts = np.diff(w.starts)
    if not len(w.codes):
        return np.zeros(len(counts), np.uint64)
    size = pc.binary_length(w.uniq).to_numpy(zero_copy_only=False).astype(np.int64)[w.codes]
    text = b" ".join(np.array(w.uniq.cast(pa.large_binary()).to_pylist(), object)[w.codes].tolist())
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    n_shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    firsts = np.repeat(w.starts[:-1] - (np.cumsum(n_shingles) - n_shingles), n_shingles) + np.arange(n_shingles.sum())
    lasts = np.minimum(firsts + shingle, np.repeat(w.starts[1:], n_shingles)) - 1
    cut = map(text.__getitem__, map(slice, starts[firsts].tolist(), ends[lasts].tolist()))
    h = np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(seed)), np.uint64, len(firsts))
    return voted(h, np.concatenate([[0], np.cumsum(n_shingles)]))


class Part(NamedTuple):
    """A partition: its bits' places and its threshold."""

    bits: list[int]
    threshold: int

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)

    @property
    def flips(self) -> list[int]:
        """Every difference within the threshold."""
        out = [0]
        for level in range(self.threshold):
            out += [f | 1 << b for f in out if f.bit_count() == level for b in self.bits if 1 << b > f]
        return out


def probes(width: int, threshold: int) -> int:
    return sum(comb(width, d) for d in range(threshold + 1))


def allocate(shares: list[dict[int, float]], widths: list[int], n: float, radius: int) -> tuple[float, list[int]]:
    """The cheapest thresholds; shares[i][t] estimates which share of all pairs differ by at most t bits in partition i."""
    best = {0: (0.0, [])}
    for share, width in zip(shares, widths, strict=True):
        new = {}
        for spent, (cost, chosen) in best.items():
            for t, p in share.items():
                c = cost + n * PROBE_COST * probes(width, t) + n * n / 2 * p
                k = spent + t + 1
                if k <= radius + 1 and (k not in new or c < new[k][0]):
                    new[k] = (c, [*chosen, t])
        best = new
    return best.get(radius + 1, (float("inf"), []))


def plan(sample: np.ndarray, n: int, radius: int, most: int = 6) -> list[Part]:
    """Partitions and thresholds for n distinct fingerprints that are like the sample."""
    bits = (sample[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(float)
    bits -= bits.mean(0, keepdims=True) if len(bits) else 0
    spread = np.sqrt((bits**2).sum(0)) + 1e-9
    near = np.abs(bits.T @ bits / np.outer(spread, spread))
    np.fill_diagonal(near, 0)
    order = np.argsort(np.linalg.eigh(np.diag(near.sum(0)) - near)[1][:, 1], kind="stable")  # neighbours along this order go together
    a, b = np.triu_indices(len(sample), 1)
    apart = sample[a] ^ sample[b]
    best = (float("inf"), [])
    for m in range(1, most + 1):
        groups = [sorted(g.tolist()) for g in np.array_split(order, m)]
        shares = []
        for g in groups:
            d = np.bitwise_count(apart & np.uint64(sum(1 << x for x in g)))
            share = {-1: 0.0}
            for t in range(min(radius, 3) + 1):
                even = probes(len(g), t) / 2 ** len(g)
                share[t] = max(even, float((d <= t).mean()) if len(d) else 0.0)
            shares.append(share)
        cost, chosen = allocate(shares, list(map(len, groups)), n, radius)
        if cost < best[0]:
            best = (cost, [Part(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0])
    return best[1]


def prints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(tx.signed(fingerprints(b.column("text"), shingle)))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def as_signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct: DataFrame, radius: int, dense: int = DENSE, whole: bool = True) -> DataFrame:
    """Links (u, v) among distinct fingerprints, enough to join all that link directly or by way of others.

    whole=False: in a dense key only links to its pivot, a number in proportion
    to its fingerprints, where others find what these leave out."""
    n = distinct.count()
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(PLAN_SAMPLE).toArrow()["fp"].to_numpy().astype(np.int64).view(np.uint64)
    parts = plan(sample, n, radius)
    one = lambda i, p: distinct.select(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(as_signed(p.mask))).alias("key"), "fp")
    index = reduce(DataFrame.unionAll, [one(i, p) for i, p in enumerate(parts)])
    probe = reduce(
        DataFrame.unionAll,
        [one(i, p).withColumn("flip", F.explode(F.array(*[F.lit(as_signed(f)) for f in p.flips]))).select("part", F.col("key").bitwiseXOR(F.col("flip")).alias("key"), "fp") for i, p in enumerate(parts)],
    )
    pivots = index.groupBy("part", "key").agg(F.min("fp").alias("pivot"), F.count("*").alias("n")).where(F.col("n") > dense).drop("n")
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius
    marked = lambda df: df.join(pivots, ["part", "key"], "left").withColumn("held", F.coalesce(near("fp", "pivot"), F.lit(False)))
    index, probe = marked(index), marked(probe)
    stars = probe.where(F.col("held") & (F.col("fp") != F.col("pivot"))).select(F.col("fp").alias("u"), F.col("pivot").alias("v"))

    def compared(left: DataFrame, right: DataFrame) -> DataFrame:
        left, right = left.select("part", "key", F.col("fp").alias("u")), right.select("part", "key", F.col("fp").alias("v"))
        return left.join(right, (left.part == right.part) & (left.key == right.key) & (F.col("u") != F.col("v")) & near("u", "v")).select("u", "v")

    if not whole:
        few = F.col("pivot").isNull()
        return stars.unionAll(compared(index.where(few), probe.where(few))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    free = ~F.col("held")
    return stars.unionAll(compared(index.where(free), probe)).unionAll(compared(index.where("held"), probe.where(free))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def grouped(docs: DataFrame, radius: int = 4, shingle: int = SHINGLE) -> DataFrame:
    """Every row's fingerprint and its component, named by its smallest identifier."""
    rows = stored(prints(docs, shingle), "prints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-prints")
    roots = components(links(distinct.select("fp"), radius))
    by_root = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = by_root.groupBy("root").agg(F.min("first").alias("component_id"))
    named = by_root.join(names, "root").select(F.col("fp").alias("print"), "component_id")
    return rows.join(named, F.col("fp") == F.col("print")).select("doc_id", "fp", "component_id")


def with_hex(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


class Near(NamedTuple):
    """What makes two texts near-duplicates, and how candidates are found.

    Texts are near if their sets of `words`-word shingles have at least this
    similarity (Jaccard).  Fingerprints of word pairs (an edited word changes
    `words` shingles but only two pairs) link most copies: those at most
    `radius` bits apart.  All other near texts meet by their rarest shingles:
    of n shingles, the first n - ceil(similarity * n) + 1 in any common order.
    Texts of a and b shingles that are near have at least
    o = similarity / (1 + similarity) * (a + b) in common, and so at least
    o - ceil(similarity * max(a, b)) + 1 of their rarest; fewer make no pair.
    Whole sets of shingles decide every pair.
    """

    words: int = 5
    similarity: float = 0.8
    radius: int = 4


def rolled(w: tx.Words, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles (a shorter text has one) and where each text's begin."""
    counts = np.diff(w.starts)
    n = np.where(counts > 0, np.maximum(counts - k + 1, 1), 0)
    starts = np.concatenate([[0], np.cumsum(n)])
    h = tx.hashed(w.uniq, seed)[w.codes]
    full = tx.rolling(np.concatenate([h, np.zeros(k - 1, np.uint64)]), k, 0x9E3779B97F4A7C15)
    at = np.repeat(w.starts[:-1] - starts[:-1], n) + np.arange(starts[-1])
    out = full[at] if len(at) else np.empty(0, np.uint64)
    for i in np.flatnonzero((counts > 0) & (counts < k)):  # the rolling window runs into the next text there
        out[starts[i]] = tx.rolling(np.concatenate([h[w.starts[i] : w.starts[i + 1]], np.zeros(k - counts[i], np.uint64)]), k, 0x9E3779B97F4A7C15)[0]
    return out, starts


def node_of(w: tx.Words) -> np.ndarray:
    """A hash of each text's words."""
    words = np.array(w.uniq.cast(pa.large_binary()).to_pylist(), object)[w.codes]
    return np.array([xxhash.xxh3_64_intdigest(b" ".join(words[i:j].tolist())) for i, j in zip(w.starts[:-1].tolist(), w.starts[1:].tolist(), strict=True)], np.uint64)


def fresh(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of sorted hashes of each text: whether each is the first of its value there."""
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return first


def distinct_shingles(w: tx.Words, near: Near) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all shingles and where each text's begin; of the distinct ones, sorted within each text, the hashes and the texts."""
    h, starts = rolled(w, near.words, 2)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((h, doc))
    k = order[fresh(h[order], doc[order])]
    return h, starts, h[k], doc[k]


def sets(docs: DataFrame, near: Near, only: np.ndarray | None = None) -> DataFrame:
    """Every row's node and its whole set of shingles; only: rows whose texts may be among these alone."""
    sent = docs.sparkSession.sparkContext.broadcast(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            if sent.value is not None:
                b = b.filter(pa.array(may_have(sent.value, b.column("digest").to_numpy().view(np.uint64))))
            w = tx.words(b.column("text"), lower=True)
            _, _, h, doc = distinct_shingles(w, near)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(node_of(w))), pa.ListArray.from_arrays(offsets, pa.array(tx.signed(h)))], ["node", "shingles"])

    return docs.select(F.xxhash64("text").alias("digest"), "text").mapInArrow(run, "node long, shingles array<long>")


def common(docs: DataFrame, near: Near) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several sampled texts, sorted, and how many have each."""
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(COMMON_EVERY)) == 0).select("text").distinct()
    found = sets(some, near).select(F.explode("shingles").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON_LEAST).orderBy(F.desc("n"), "key").limit(COMMON_MOST).toArrow()
    key, n = found["key"].to_numpy().astype(np.int64).view(np.uint64), found["n"].to_numpy().astype(np.int32)
    order = np.argsort(key)
    return key[order], n[order]


def rarest(h: np.ndarray, doc: np.ndarray, size: np.ndarray, often: tuple[np.ndarray, np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each text's distinct shingles, as many of the rarest as near texts can't all lack; and where each text's begin."""
    key, n = often
    count = np.zeros(len(h), np.int32)
    if len(key):
        place = np.minimum(np.searchsorted(key, h), len(key) - 1)
        count = np.where(key[place] == h, n[place], 0)
    order = np.lexsort((h, count, doc))
    first = np.concatenate([[0], np.cumsum(size)])
    most = np.where(size > 0, size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1, 0)
    taken = np.arange(len(h)) - np.repeat(first[:-1], size) < np.repeat(most, size)
    return h[order][taken], np.concatenate([[0], np.cumsum(np.minimum(most, size))])


def texts(docs: DataFrame, near: Near, often: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64), np.empty(0, np.int32))) -> DataFrame:
    """Every row's fingerprint, number of distinct shingles and rarest ones; node is a hash of its words in lower case."""
    sent = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            w = tx.words(b.column("text"), lower=True)
            _, _, h, doc = distinct_shingles(w, near)
            size = np.bincount(doc, minlength=b.num_rows)
            rare, cut = rarest(h, doc, size, sent.value, near.similarity)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("digest"), pa.array(tx.signed(node_of(w))), pa.array(tx.signed(voted(*rolled(w, 2, 1)))), pa.array(size.astype(np.int32)), pa.ListArray.from_arrays(cut.astype(np.int32), pa.array(tx.signed(rare)))], ["doc_id", "digest", "node", "fp", "size", "rare"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text").mapInArrow(run, "doc_id long, digest long, node long, fp long, size int, rare array<long>")


def ordered(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))


def exact(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, near: Near) -> DataFrame:
    """The pairs (u, v) whose whole sets are near; the sets are made again from one text of each node in pairs, which were stored and are deleted."""
    ends = stored(pairs.select(F.col("u").alias("end")).unionAll(pairs.select("v")).distinct(), "ends")
    wanted = nodes.join(ends, F.col("node") == F.col("end"), "left_semi").select("digest")
    made = sets(docs, near, bit_table(wanted)).join(ends, F.col("node") == F.col("end"), "left_semi")
    few = stored(made.groupBy("node").agg(F.any_value("shingles").alias("shingles")), "sets")
    of = lambda c: few.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}"))
    both = F.size(F.array_intersect("set_u", "set_v"))
    union = F.size("set_u") + F.size("set_v") - both
    found = stored(pairs.join(of("u"), "u").join(of("v"), "v").where((union == 0) | (both / union >= near.similarity)).select("u", "v"), "exact")
    for done in (few, ends, pairs):
        erase(done)
    return found


def by_fingerprint(nodes: DataFrame, near: Near, dense: int) -> DataFrame:
    """Each node with the first one whose fingerprint links to its own, so that a large group meets around few of its texts; rarest shingles find the others."""
    first = stored(nodes.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    same = nodes.join(first, "fp").where("node != head").select(F.col("node").alias("u"), F.col("head").alias("v"))
    of = lambda c: first.select(F.col("fp").alias(c), F.col("head").alias(f"head_{c}"))
    linked = ordered(links(first.select("fp"), near.radius, dense, whole=False).join(of("u"), "u").join(of("v"), "v"), "head_u", "head_v")
    return ordered(same, "u", "v").unionAll(linked.groupBy("u").agg(F.min("v").alias("v")))


def shared_keys(rows: DataFrame) -> DataFrame:
    """(key, node, size, n_keys) of the rarest shingles that several nodes have."""
    each = rows.select("node", "size", F.explode("rare").alias("key"))
    several = each.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select(F.col("key").alias("k"))
    return each.join(several, F.col("key") == F.col("k"), "left_semi").distinct().withColumn("n_keys", F.count("*").over(Window.partitionBy("node")))


def with_roots(df: DataFrame, roots: DataFrame) -> DataFrame:
    """df's nodes with their roots, themselves if they have no links."""
    return df.join(roots.withColumnRenamed("node", "of_node"), F.col("node") == F.col("of_node"), "left").withColumn("root", F.coalesce("root", "node")).drop("of_node")


def merged(roots: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, after further links (u, v): only the links between different roots, each once, are followed."""
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    u, v = F.coalesce("root_u", "u"), F.coalesce("root_v", "v")
    between = pairs.join(of("u"), "u", "left").join(of("v"), "v", "left").where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    more = components(between).select(F.col("node").alias("of_root"), F.col("root").alias("new_root"))
    known = roots.join(more, F.col("root") == F.col("of_root"), "left").select("node", F.coalesce("new_root", "root").alias("root"))
    return stored(known.unionAll(more.join(roots, F.col("of_root") == F.col("node"), "left_anti").select("of_root", "new_root")), "roots")


def enough(near: Near) -> Column:
    """How many of their rarest shingles two near texts of these sizes have in common at least."""
    common = near.similarity / (1 + near.similarity) * (F.col("size_u") + F.col("size_v"))
    return common - F.ceil(near.similarity * F.greatest("size_u", "size_v") - 1e-6) + 1 - 1e-6


def comparable(near: Near) -> Column:
    """Whether two texts differ in root and their sizes allow them to be near."""
    return (F.col("root_u") != F.col("root_v")) & (F.least("size_u", "size_v") >= near.similarity * F.greatest("size_u", "size_v") - 1e-6)


def still_apart(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of keys that nodes of several roots have, with their roots."""
    rows = with_roots(shared, roots)
    several = rows.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select(F.col("key").alias("k"))
    return rows.join(several, F.col("key") == F.col("k"), "left_semi")


def by_hubs(rows: DataFrame, texts: DataFrame, near: Near, turn: int) -> DataFrame:
    """Pairs of a node and a hub of one of its keys, at most three for each row of rows.

    Each key has a hub for each band of sizes that may be near one another, and
    a node meets those of its own band and the next ones.  In the first turn a
    hub is the text that shares the most keys (an edit makes keys of its own,
    so the least edited copy of a group), in later ones any.  So a group of any
    size meets around few of its texts, in time linear in its rows."""
    banded = rows.withColumn("band", F.floor(F.log(F.greatest("size", F.lit(1))) / F.lit(-np.log(near.similarity)).cast("double")))
    first = F.col("n_keys") if turn == 0 else F.xxhash64("node", F.lit(turn))
    hubs = banded.groupBy("key", "band").agg(F.max(F.struct(first.alias("first"), "node", "root", "size")).alias("hub"))
    hubs = hubs.select("key", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"), *[F.col(f"hub.{c}").alias(f"{c}_v") for c in ("node", "root", "size")])
    met = banded.withColumnsRenamed({c: f"{c}_u" for c in ("node", "root", "size")}).join(hubs, ["key", "band"]).where(comparable(near))
    pairs = stored(ordered(met, "node_u", "node_v").distinct(), "met")
    ends = pairs.select(F.col("u").alias("end")).unionAll(pairs.select("v")).distinct()
    rare = texts.join(ends, F.col("node") == F.col("end"), "left_semi").groupBy("node").agg(F.any_value("rare").alias("rare"), F.any_value("size").alias("size"))
    of = lambda c: rare.select(F.col("node").alias(c), F.col("rare").alias(f"rare_{c}"), F.col("size").alias(f"size_{c}"))
    close = stored(pairs.join(of("u"), "u").join(of("v"), "v").where(F.size(F.array_intersect("rare_u", "rare_v")) >= enough(near)).select("u", "v"), "candidates")
    erase(pairs)
    return close


def by_keys(rows: DataFrame, near: Near) -> DataFrame:
    """All pairs of nodes of different roots that have as many of their rarest shingles in common as near ones must."""
    of = lambda x: rows.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "root", "size")])
    met = of("u").join(of("v"), "key").where((F.col("node_u") > F.col("node_v")) & comparable(near))
    return met.groupBy(F.col("node_u").alias("u"), F.col("node_v").alias("v"), "size_u", "size_v").agg(F.count("*").alias("n")).where(F.col("n") >= enough(near)).select("u", "v")


def near_groups(docs: DataFrame, near: Near = Near(), dense: int = NEAR_DENSE) -> DataFrame:
    """Every row with a hash of its text and the smallest identifier of its group of near-duplicates.

    Pairs are found by fingerprints, then by rarest shingles: each text meets
    few hubs alone, then all texts that are still in different groups meet; a
    group's texts aren't compared again."""
    rows = stored(texts(docs, near, common(docs, near)), "texts")
    nodes = stored(rows.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("digest").alias("digest"), F.any_value("fp").alias("fp"), F.any_value("size").alias("size")), "nodes")
    roots = stored(components(exact(stored(by_fingerprint(nodes, near, dense), "candidates"), nodes, docs, near)), "roots")
    shared = stored(shared_keys(rows), "shared")
    for turn in range(HUB_TURNS):
        roots = merged(roots, exact(by_hubs(still_apart(shared, roots), rows, near, turn), nodes, docs, near))
    candidates = stored(by_keys(still_apart(shared, roots), near), "candidates")
    roots = merged(roots, exact(candidates, nodes, docs, near))
    by_root = with_roots(nodes.select("node", "first"), roots)
    names = by_root.groupBy("root").agg(F.min("first").alias("group_id"))
    return rows.select("doc_id", "digest", "node").join(by_root.join(names, "root").select(F.col("node").alias("n"), "group_id"), F.col("node") == F.col("n")).select("doc_id", "digest", "group_id")


def deduplicated(docs: DataFrame, near: Near = Near(), dense: int = NEAR_DENSE) -> DataFrame:
    """The documents, one of each group of near-duplicates: that with the smallest identifier.

    Rows that repeat both identifier and text stay or go together; a row
    without identifier goes if a row of its group has one."""
    groups = near_groups(docs, near, dense).where(F.col("group_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("group_id")))
    gone = stored(groups.select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_digest"]), "left_anti")
