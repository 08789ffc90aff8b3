"""Quality rules: gradient-boosted trees over document statistics.

`statistics` measures every whole text in Arrow batches.  `fit` grows the
trees on a bounded sample of labelled documents, and `QualityModel` holds
them flattened into node arrays, so that a batch is scored by a few numpy
gathers for each tree and level.

Defined results: a null or empty text has no words, so it fails the base
rule; repeated rows are scored alike; without labels of both kinds the
verdict is the base rule's alone; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm import text as tx

#: Fixed values of the base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Statistics that the trees see, and +1 / -1 where the score may only rise / fall with them.
FEATURES = {"log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "bang_share": -1, "distinct_share": 0, "digit_share": 0, "words_per_line": 0}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{c} double" for c in FEATURES)

#: At most so many labelled documents, those with the smallest hash of their id, train the trees.
MAX_LABELLED = 20_000


def repeat_words(w: tx.Words) -> np.ndarray:
    """For each text, its words in 3-word windows that it has twice or more, the first included."""
    hit = np.zeros(len(w.codes), bool)
    n = len(w.codes) - 2
    if n > 0:
        ok = tx.inside(w.doc, 3)
        size = len(w.uniq)
        pairs = np.unique(w.codes[:n] * size + w.codes[1 : n + 1], return_inverse=True)[1]
        key = (w.doc[:n] * (pairs.max() + 1) + pairs) * size + w.codes[2:]
        at = np.flatnonzero(ok)
        order = at[np.argsort(key[at], kind="stable")]
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(n, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for j in range(3):
            hit[j : j + n] |= twice
    return tx.per_doc(hit, w.starts)


def duplicate_lines(t: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each text: lines with a word, and how many of them equal an earlier line."""
    split = pc.split_pattern(t, "\n")
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    flat, doc = split.flatten(), np.repeat(np.arange(len(t)), counts)
    full = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0)
    flat, doc = flat.filter(full), doc[full.to_numpy(zero_copy_only=False)]
    if not len(flat):
        return np.zeros(len(t), np.int64), np.zeros(len(t), np.int64)
    coded = flat.dictionary_encode()
    key = doc * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lines = np.bincount(doc, minlength=len(t))
    first = np.unique(key) // len(coded.dictionary)
    return lines, lines - np.bincount(first, minlength=len(t))


def measured(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    t = tx.texts(batch.column("text"))
    w = tx.words(batch.column("text"))
    n = np.diff(w.starts)
    chars = pc.utf8_length(w.uniq).to_numpy(zero_copy_only=False).astype(np.int64)
    word_chars = tx.per_doc(chars[w.codes], w.starts)
    symbols = tx.byte_counts(t, SYMBOLS)
    lines, dup = duplicate_lines(t)
    repeat = repeat_words(w)
    pairs = np.unique(w.doc * max(1, len(w.uniq)) + w.codes) // max(1, len(w.uniq))
    distinct = np.bincount(pairs, minlength=len(t))
    share = lambda a, b: a / np.maximum(b, 1)
    return {
        "n_words": n, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat,
        "log_words": np.log1p(n), "mean_word": share(word_chars, n), "symbol_share": share(symbols, word_chars),
        "dup_line_share": share(dup, lines), "repeat_share": share(repeat, n), "upper_share": share(tx.byte_counts(t, bytes(range(65, 91))), word_chars),
        "bang_share": share(tx.byte_counts(t, b"!"), n), "distinct_share": share(distinct, n),
        "digit_share": share(tx.byte_counts(t, b"0123456789"), word_chars), "words_per_line": share(n, lines),
    }


def statistics(docs: DataFrame, also: list[str] | None = None) -> DataFrame:
    """Statistics of every document; also: further columns to carry on."""
    also = also or []
    types = dict(docs.dtypes)
    schema = ", ".join([SCHEMA, *(f"`{c}` {types[c]}" for c in also)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            m = measured(b)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(v) for v in m.values()), *(b.column(c) for c in also)], ["doc_id", *m, *also])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *also).mapInArrow(run, schema)


class QualityModel(NamedTuple):
    """Trees as node arrays: node i of a tree has its children at left[i] and left[i] + 1; a leaf is its own child. value holds each node's part of the score."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability that each row of x is good."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, reg: float = 1.0, least: int = 5) -> QualityModel | None:
    """Boosts depth-limited trees on logistic loss, from histograms of quantile bins.

    A split on a constrained feature is allowed only if its children's values
    go the right way, and the midpoint between them bounds all values below,
    so the whole score is monotone in that feature.  None unless y has both kinds.
    """
    if len(y) == 0 or y.min() == y.max():
        return None
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(p / (1 - p)))
    total = np.full(len(y), bias)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        i = len(feature)
        feature.append(0), threshold.append(np.inf), left.append(i), right.append(i), value.append(0.0)
        return i

    def leaf_value(g: float, h: float, lo: float, hi: float) -> float:
        return min(hi, max(lo, -g / (h + reg)))

    def grow(i: int, rows: np.ndarray, level: int, lo: float, hi: float, g: np.ndarray, h: np.ndarray) -> None:
        sum_g, sum_h = g[rows].sum(), h[rows].sum()
        value[i] = rate * leaf_value(sum_g, sum_h, lo, hi)
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * least:
            loss = lambda gg, hh, v: -(gg * v + 0.5 * (hh + reg) * v * v)
            here = loss(sum_g, sum_h, leaf_value(sum_g, sum_h, lo, hi))
            for j, c in enumerate(cuts):
                b = binned[rows, j]
                n = np.cumsum(np.bincount(b, minlength=len(c) + 1))
                gs, hs = (np.cumsum(np.bincount(b, weights=a[rows], minlength=len(c) + 1)) for a in (g, h))
                for k in range(len(c)):
                    if least <= n[k] <= len(rows) - least:
                        vl, vr = leaf_value(gs[k], hs[k], lo, hi), leaf_value(sum_g - gs[k], sum_h - hs[k], lo, hi)
                        gain = loss(gs[k], hs[k], vl) + loss(sum_g - gs[k], sum_h - hs[k], vr) - here
                        if (vr - vl) * monotone[j] >= 0 and gain > best[0]:
                            best = (gain, (j, k, vl, vr))
        if best[1] is None:
            return
        j, k, vl, vr = best[1]
        feature[i], threshold[i] = j, float(cuts[j][k])
        left[i], right[i] = node(), node()
        mid = (vl + vr) / 2
        low, high = ((lo, mid), (mid, hi)) if monotone[j] > 0 else ((mid, hi), (lo, mid)) if monotone[j] < 0 else ((lo, hi), (lo, hi))
        goes = binned[rows, j] <= k
        grow(left[i], rows[goes], level + 1, *low, g, h)
        grow(right[i], rows[~goes], level + 1, *high, g, h)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        root = node()
        roots.append(root)
        grow(root, np.arange(len(y)), 0, -np.inf, np.inf, p - y, p * (1 - p))
        one = QualityModel(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array([root]), depth, 0.0)
        s = one.score(x)
        total += np.log(s / (1 - s))
    return QualityModel(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots), depth, bias)


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> QualityModel | None:
    """Fits on at most `most` labelled documents.  A document with several labels takes the worst; of several texts of an identifier one is taken."""
    sample = (
        labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("double")).alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    measured = F.struct(*FEATURES, "quality")  # one row an identifier, however many texts share it
    rows = statistics(found, ["quality"]).groupBy("doc_id").agg(F.min(measured).alias("m")).select("doc_id", "m.*").toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return None
    x = np.stack([rows[c].to_numpy() for c in FEATURES], 1)
    return fit(x, rows["quality"].to_numpy(), list(FEATURES.values()))


def judged(docs: DataFrame, model: QualityModel | None, least: float = 0.5) -> DataFrame:
    """Every document's statistics, base verdict, score and final verdict."""
    names = list(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            m = measured(b)
            failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
            score = model.score(np.stack([m[c] for c in names], 1)) if model else np.where(failed, 0.0, 1.0)
            cols = {"doc_id": b.column("doc_id")} | {c: pa.array(m[c]) for c in COUNTS}
            cols |= {"base_failed": pa.array(failed), "score": pa.array(score), "kept": pa.array(~failed & (score >= least))}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def good(docs: DataFrame, model: QualityModel | None, least: float = 0.5) -> DataFrame:
    """The documents that pass, with all their columns, judged where they lie: no shuffle."""
    names = list(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            m = measured(b)
            kept = (m["n_words"] >= MIN_WORDS) & (100 * m["n_repeat_words"] <= MAX_REPEAT_PERCENT * m["n_words"])
            if model:
                kept &= model.score(np.stack([m[c] for c in names], 1)) >= least
            yield b.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
