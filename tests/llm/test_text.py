import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import pyarrow as pa
from acervo.llm import text as tx

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBÉ \t\n\x0b\x0c\r\x1c\x85\xa0", max_size=20)), min_size=1, max_size=12), st.integers(1, 30), st.booleans())
@settings(max_examples=200, deadline=None)
def test_words_of_slices_equal_plain_python(found, limit, lower):
    batch = pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["text"])
    got = []
    for b in tx.sliced(iter([batch.slice(0, 0), batch.slice(1), batch]), limit=limit):
        w = tx.words(b.column("text"), lower)
        u = w.uniq.to_pylist()
        got += [[u[c] for c in w.codes[w.starts[i] : w.starts[i + 1]]] for i in range(b.num_rows)]
        assert np.array_equal(w.doc, np.repeat(np.arange(b.num_rows), np.diff(w.starts)))
    assert got == [WORD.findall((t or "").translate(LOWER) if lower else t or "") for t in found[1:] + found]


def test_rolling_hashes_follow_the_words_alone():
    h = np.random.default_rng(0).integers(0, 1 << 63, 200).astype(np.uint64)
    h[100:160] = h[20:80]
    r = tx.rolling(h, 50, 0x9E3779B97F4A7C15)
    assert len(r) == 151 and np.array_equal(r[100:111], r[20:31]) and len(np.unique(r)) == 151 - 11
    assert len(tx.rolling(h[:49], 50, 3)) == 0
