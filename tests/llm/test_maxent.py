import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from acervo.llm import maxent


def plain(rows):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) + ["\n"]) for i, t in rows]
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    c = Counter(x for i, w in words if not held(i) for x in w)
    n, v = sum(c.values()), len(c)
    return sorted((str(i), held(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)) for i, w in words)


def found(docs, **more):
    got = maxent.scored(docs, **more).collect()
    return got, sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)


def test_base_equals_plain_python_and_the_model_learns(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    after = {w: rng.sample(vocabulary, 3) for w in vocabulary}
    rows = []
    for i in range(600):
        w, t = rng.choice(vocabulary), []
        for _ in range(rng.randint(0, 200)):
            t.append(w.upper() if rng.random() < 0.2 else w)
            w = rng.choice(after[w])
        rows.append((i, " ".join(t)))
    rows += [(None, "w1 unseen É é"), (7, rows[7][1]), (7, "x y"), (700, None), (701, ""), (702, "w3 " * 30_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, block int").repartition(3)
    got, same = found(docs, block_bytes=20_000, rounds=2)
    assert same == plain(rows)
    chain = [r for r in got if r.held_out and r.n_tokens > 5 and r.doc_id is not None and r.doc_id < 600]
    assert sum(r.score for r in chain) > 0.8 * sum(r.base_score for r in chain)
    assert all(r.score < 0 for r in got)
    assert maxent.scored(docs.limit(0)).count() == 0
    assert all(r.base_score == 0 and r.train_tokens == 0 for r in maxent.scored(docs.where("doc_id is null")).collect())


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(0)
    b = maxent.Block({"doc_ids": [1], "held": b"\0", "starts": np.array([0, 4]).tobytes(), "codes": maxent.packed(np.array([0, 1, 2, 0], np.int32)), "words": rng.integers(0, 1 << 62, 3)})
    model = maxent.Model(*(rng.normal(size=s).astype(np.float32) for s in (maxent.CLASSES, (maxent.CLASSES, maxent.MEMBERS), (maxent.ROWS, maxent.CLASSES), (maxent.ROWS, maxent.MEMBERS))))
    total = np.zeros(4)
    for slot in range(maxent.CLASSES * maxent.MEMBERS):
        s = np.full(4, slot)
        rows, crossed = maxent.features(b, s)
        z, y = model.logits(rows, crossed, s // maxent.MEMBERS)
        total += np.exp(z[:, slot // maxent.MEMBERS] - maxent.softmax(z)[1] + y[:, slot % maxent.MEMBERS] - maxent.softmax(y)[1])
    assert total == pytest.approx(np.ones(4), abs=1e-4)


def test_contexts_have_more_rows_than_a_small_table():
    n = 60_000
    words = np.random.default_rng(1).integers(0, 1 << 62, n)
    b = maxent.Block({"doc_ids": [1], "held": b"\0", "starts": np.array([0, n]).tobytes(), "codes": maxent.packed(np.arange(n, dtype=np.int32)), "words": words})
    for rows in sum(maxent.features(b, maxent.slots(b.words)), []):
        assert len(np.unique(rows)) > 1 << 14


def test_held_out_texts_are_more_likely_than_by_counts(spark):
    """On the smallest real tables: log10 probability a token over all held-out documents, which training never sees."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(4)
    r = maxent.scored(docs).where("held_out").selectExpr("sum(score) / sum(n_tokens) AS model", "sum(base_score) / sum(n_tokens) AS base", "count(*) AS n").first()
    assert r.n > 50 and r.model > r.base + 0.1
