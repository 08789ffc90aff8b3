import random

import pytest

from acervo.llm import decontamination as dc


def plain(docs, items):
    """Pairs of places, compared window by window."""

    def sequence(t):
        out, start = [], True
        for w in (t or "").split():
            low, kind, ends = dc.canonical(w)
            kind = dc.PLAIN if kind == dc.CAP and start else kind
            out.append((dc.PLACEHOLDERS[kind] or low, low if kind else None))
            start = ends
        return out

    def windows(s):
        return {i: s[i : i + dc.WINDOW] for i in range(len(s) - dc.WINDOW + 1) if sum(v is None for _, v in s[i : i + dc.WINDOW]) >= dc.LEAST_PLAIN}

    out = []
    for d, t in docs:
        mine, held = windows(sequence(t)), []
        for i, u in items:
            theirs, offsets = windows(sequence(u)), {}
            for p, x in theirs.items():
                for a, y in mine.items():
                    if [c for c, _ in x] == [c for c, _ in y]:
                        places, pairs = offsets.setdefault(a - p, (set(), set()))
                        places.add(p)
                        pairs |= {(v, w) for (_, v), (_, w) in zip(x, y) if v is not None}
            good = [places for places, pairs in offsets.values() if len(pairs) - len({v for v, _ in pairs}) <= dc.CONFLICTS * len({v for v, _ in pairs})]
            if good and len(set().union(*good)) >= dc.COVERAGE * len(theirs):
                held.append(i)
        out.append((str(d), len(held)))
    return sorted(out)


ITEM = "Yesterday morning Anna bought 12 red apples and 7 green pears from the market for 35 dollars and later Anna gave 12 of them away to Peter who lives near the old river bridge."
SAME = "So it goes: in short, yesterday morning Maria bought 40 red apples and 9 green pears from the market for 81 euros and later Maria gave 40 of them away to Hugo who lives near the old river bridge. The end."
MIXED = SAME.replace("gave 40", "gave 41").replace("later Maria", "later Clara")


@pytest.mark.parametrize("most", [dc.MOST_HASHES, 0])
def test_equals_plain_python(spark, most):
    rng = random.Random(9)
    words = "the of and river old Anna Peter 5 12 km apples. market bought (red) green, lives near to who so".split()
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 8, 20, 40])))) for i in range(12)] + [(50, ITEM), (51, None), (52, "")]
    docs = [(1, SAME), (2, MIXED), (3, None), (4, ""), (None, ITEM), (5, ITEM), (5, ITEM), (5, "other text"), (6, "word " * 50_000 + ITEM)]
    for i in range(100, 160):
        t = rng.choices(words, k=rng.randint(0, 60))
        j = rng.randrange(len(t) + 1)
        u = (rng.choice(items)[1] or "").split()
        docs.append((i, " ".join(t[:j] + u[rng.randint(0, 5) : rng.randint(15, 60)] + t[j:])))
    table = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    got = dc.judged(table, bench, most=most).collect()
    assert sorted((str(r.doc_id), r.n_items) for r in got) == plain(docs, items)
    by = {r.doc_id: r.contaminated for r in got}
    assert by[1] and not by[2] and by[6] and by[None]
    kept = dc.decontaminated(table, bench, most=most)
    assert kept.columns == table.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if not r.contaminated)
    assert dc.judged(table.limit(0), bench).count() == 0 and not any(r.contaminated for r in dc.judged(table, bench.limit(0)).collect())
