import random
import re

import numpy as np
import pytest
import xxhash

from acervo.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    s = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum((2 * sum(x >> i & 1 for x in h) > len(h)) << i for i in range(64))


def plain_components(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_whole_operator_equals_plain_python(spark):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in "abÉdE" for b in "xyzwv"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(60)]
    rows = []
    for t in texts:
        rows.append(t)
        for _ in range(rng.randint(0, 4)):
            w = t.split()
            w[rng.randrange(len(w))] = rng.choice(words)
            rows.append("\n".join(w))
    rows += [None, "", "  ", texts[0], "a", "b c"]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    docs = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, rows)] + [(ids[0], rows[0], 1), (None, "a", 1)], "doc_id long, text string, fp int")
    out = simhash.with_hex(simhash.grouped(docs)).collect()
    prints = [plain_print(t) for t in rows]
    comp = plain_components(prints, 4)
    name = {c: min(i for i, x in zip(ids, comp) if x == c) for c in comp}
    want = sorted((i, f"{p:016x}", name[c]) for i, p, c in zip(ids, prints, comp))
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in out if r.doc_id is not None)
    assert [g for k, g in enumerate(got) if not k or g != got[k - 1]] == want and len(out) == len(rows) + 2
    assert simhash.grouped(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("radius", "dense"), [(4, 3), (4, 1000), (9, 5)])
def test_links_keep_all_components(spark, radius, dense):
    rng = np.random.default_rng(radius + dense)
    centres = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    found = set(centres.tolist())
    for c in centres[:6].tolist():
        for _ in range(60):
            x = c
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                x ^= 1 << int(b)
            found.add(x)
    found = sorted(found)
    df = spark.createDataFrame([(simhash.as_signed(x),) for x in found], "fp long")
    edges = [(r.u % (1 << 64), r.v % (1 << 64)) for r in simhash.links(df, radius, dense).collect()]
    assert all((u ^ v).bit_count() <= radius for u, v in edges)
    got = {r.node % (1 << 64): r.root for r in simhash.components(simhash.links(df, radius, dense)).collect()}
    want = plain_components(found, radius)
    pairs = {}
    for x, c in zip(found, want):
        pairs.setdefault(c, set()).add(got.get(x, simhash.as_signed(x)))
    assert all(len(s) == 1 for s in pairs.values()) and len({next(iter(s)) for s in pairs.values()}) == len(pairs)


def test_thresholds_cover_the_radius():
    rng = np.random.default_rng(0)
    sample = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    for n in (100, 10**5, 10**8):
        for radius in (1, 4, 9):
            parts = simhash.plan(sample, n, radius)
            assert sum(p.threshold + 1 for p in parts) == radius + 1
            assert all(len(p.flips) == len(set(p.flips)) == simhash.probes(len(p.bits), p.threshold) for p in parts)


def test_votes_of_long_and_short_texts_equal_plain_sums(monkeypatch):
    monkeypatch.setattr(simhash, "VOTES", 10)
    rng = np.random.default_rng(1)
    n = np.array([0, 3, 25, 10, 0, 0, 1, 4, 4, 11, 0])
    h = rng.integers(0, 1 << 63, n.sum()).astype(np.uint64)
    starts = np.concatenate([[0], np.cumsum(n)])
    want = [sum((2 * sum(x >> b & 1 for x in h[i:j].tolist()) > j - i) << b for b in range(64)) for i, j in zip(starts[:-1], starts[1:])]
    assert simhash.voted(h, starts).tolist() == want
