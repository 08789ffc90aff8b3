import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import pyarrow as pa
from acervo.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    hit = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit)


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab# \n\té \x1c!|", max_size=60)), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_counts_equal_plain_python(found):
    b = pa.RecordBatch.from_arrays([pa.array(range(len(found))), pa.array(found, pa.string())], ["doc_id", "text"])
    m = quality.measured(b)
    assert [tuple(int(m[c][i]) for c in quality.COUNTS) for i in range(len(found))] == [plain(t) for t in found]


def test_trees_learn_and_are_monotone():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality.FEATURES)))
    y = ((x[:, 2] < 0.5) & (x[:, 0] > 0.3)).astype(float)
    m = quality.fit(x, y, list(quality.FEATURES.values()))
    test = rng.random((1000, x.shape[1]))
    truth = (test[:, 2] < 0.5) & (test[:, 0] > 0.3)
    assert ((m.score(test) > 0.5) == truth).mean() > 0.93
    for j, sign in enumerate(quality.FEATURES.values()):
        if sign:
            grid = np.repeat(test[:50], 21, 0)
            grid[:, j] = np.tile(np.linspace(-0.1, 1.1, 21), 50)
            assert (np.diff(m.score(grid).reshape(50, 21), axis=1) * sign >= -1e-12).all()
    assert quality.fit(x, np.ones(len(x)), [0] * x.shape[1]) is None


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "a b", None), (3, "word " * 60, "x"), (4, " ".join(f"w{i}" for i in range(60)), None), (4, " ".join(f"w{i}" for i in range(60)), None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(4, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    rows = quality.judged(docs, quality.train(docs, labels)).collect()
    assert len(rows) == 6 and all(r.base_failed != (r.doc_id == 4) for r in rows)
    assert quality.train(docs, labels.limit(0)) is None
    assert quality.judged(docs.limit(0), None).count() == 0
    assert [r.doc_id for r in quality.good(docs, None).collect()] == [4, 4]
