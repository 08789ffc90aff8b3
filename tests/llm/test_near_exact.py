import random

import pytest

from acervo.llm import simhash
from tests.llm.test_pipeline import jaccard


def pairs_of(rng, n, changed):
    """A random text, and one with this many words in a row replaced in its middle."""
    t = [f"w{rng.randrange(10**6)}" for _ in range(n)]
    return " ".join(t), " ".join(t[: n // 3] + [f"x{rng.randrange(10**6)}" for _ in range(changed)] + t[n // 3 + changed :])


def test_long_texts_are_decided_by_their_whole_sets(spark):
    rng = random.Random(4)
    texts = [pairs_of(rng, n, int(n * share)) for n in (1000, 3000) for share in (0.09, 0.1, 0.104, 0.107, 0.109, 0.113, 0.116, 0.125) for _ in range(3)]
    texts += [pairs_of(rng, n, int(n * share)) for n in (200, 255) for share in (0.1, 0.13)]
    want = {i for i, (a, b) in enumerate(texts) if jaccard(a, b) >= 0.8}
    assert 0 < len(want) < len(texts)
    docs = spark.createDataFrame([(2 * i + j, t) for i, p in enumerate(texts) for j, t in enumerate(p)], "doc_id long, text string")
    near = simhash.Near()
    rows = simhash.stored(simhash.texts(docs, near), "texts")
    one = {r.doc_id: r.node for r in rows.collect()}
    pairs = spark.createDataFrame([(max(one[2 * i], one[2 * i + 1]), min(one[2 * i], one[2 * i + 1])) for i in range(len(texts))], "u long, v long")
    got = {(r.u, r.v) for r in simhash.exact(pairs, rows, docs, near).collect()}
    assert {i for i in range(len(texts)) if (max(one[2 * i], one[2 * i + 1]), min(one[2 * i], one[2 * i + 1])) in got} == want


@pytest.mark.parametrize("radius", [0, 4])
def test_groups_equal_brute_force(spark, radius):
    """Chains, groups around one text, common passages, short and repeated texts: exactly the groups of all pairs."""
    rng = random.Random(radius)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage, texts = rng.choices(vocabulary, k=60), []
    for i in range(60):
        t = rng.choices(vocabulary, k=rng.choice([3, 6, 30, 90, 200, 320]))
        t = t + passage if i % 3 == 0 else t
        texts.append(t)
        for _ in range(rng.choice([0, 1, 3, 25 if i < 4 else 5])):
            u = list(texts[-1] if rng.random() < 0.5 else t)  # of the last copy or of the first
            for _ in range(rng.randint(0, 1 + len(u) // 40)):
                at = rng.randrange(len(u) + 1)
                u[at : at + rng.choice([0, 1, 1, 5])] = rng.choices(vocabulary, k=rng.choice([0, 1, 1, 4]))
            texts.append(u)
    texts = [" ".join(t) for t in texts] + ["", " ", None, "A B", "a b"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    root = list(range(len(texts)))
    cut = [{tuple(w[i : i + 5]) for w in [(t or "").lower().split()] for i in range(max(1, len(w) - 4))} for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if len(cut[i] & cut[j]) >= 0.8 * len(cut[i] | cut[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    name = {r: min(i for i, x in zip(ids, root) if x == r) for r in root}
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in simhash.near_groups(docs, simhash.Near(radius=radius), dense=3).collect()}
    assert len(set(name.values())) < 0.6 * len(texts)
    assert got == {i: name[r] for i, r in zip(ids, root)}


def test_blocks_appended_cut_off_or_replaced_are_found(spark):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts, cases = [], []
    for n in (60, 250, 1200):
        for share in (0.8, 0.83, 0.86, 0.9):
            for kind in ("append", "cut", "replace") * 2:
                t = [word() for _ in range(n)]
                lost = int(n * (1 - share)) - 1
                u = {"append": t + [word() for _ in range(lost)], "cut": t[:-lost], "replace": t[: n // 3] + [word() for _ in range(lost // 2)] + t[n // 3 + lost // 2 :]}[kind]
                cases.append((len(texts), len(texts) + 1))
                texts += [" ".join(t), " ".join(u)]
    heads = " ".join(word() for _ in range(30))  # common to texts that are not near
    for _ in range(40):
        texts.append(heads + " " + " ".join(word() for _ in range(70)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in simhash.near_groups(docs).collect()}
    near = {(i, j) for i, j in cases if jaccard(texts[i], texts[j]) >= 0.8}
    assert len(near) >= 0.7 * len(cases)
    assert {(i, j) for i, j in cases if got[i] == got[j]} == near
    assert all(got[i] == i for i in range(2 * len(cases), len(texts)))
