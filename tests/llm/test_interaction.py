import random
import re
from itertools import permutations

import pytest

from acervo.llm import interaction

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failing(rows):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        of = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)), t in first and (i is None or i > first[t])]
        yield i, part or "", "".join(x for x, y in zip("ABCDE", of, strict=True) if y)


def plain(rows, labels):
    """Each document goes through each order, one filter after the other."""
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    found = list(failing(rows))
    out = {}
    for part in {p for _, p, _ in found}:
        mine = [(i, f) for i, p, f in found if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [m for m in left if x in m[1]]
                shapley[x] += len(gone)
                stay = [m for m in left if x not in m[1]]
                redundant = sum(x in f for _, f in mine) - len(gone)
                out[part, order, step] = [len(stay), len(gone), redundant, sum(f == x for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), x]
                left = stay
        for k, v in out.items():
            if k[0] == part:
                v[-1] = shapley[v[-1]]
    return out


@pytest.mark.parametrize("width", [interaction.WIDE, 0b11])
def test_equals_plain_python(spark, width):
    """Also when keys have two bits, so that texts are told apart by themselves."""
    rng = random.Random(13)
    words = [f"w{i}" for i in range(400)] + ["UPPER"] * 30 + ["#tag", "é", "a\x1cb"]
    make = lambda: " ".join(rng.choices(words[: rng.choice([20, 433])], k=rng.choice([3, 99, 100, 140])))
    base = [make() for _ in range(40)]
    same_start = "word " * 40 + "z" * 1200
    base += [same_start + "a", same_start + "b", "a" * 64 + "1", "a" * 64 + "2", "", "   ", "LONG " * 40_000]
    rows = [(i, rng.choice([*base, None]), rng.choice(["en", "en", "de", None])) for i in range(200)]
    rows += [(None, base[0], "en"), (None, None, "de"), (3, rows[3][1], "en"), (3, rows[3][1], "en"), (5, base[1], "")] + [(900 + i, "hot copy", "fr") for i in range(150)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 200, 2)] + [(4, 1, 0), (None, 1, 1), (3, 1, 1)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, mask int").repartition(5)
    table = spark.createDataFrame([(*x, 2) for x in labels], "doc_id long, quality int, toxic int, part int")
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in interaction.audited(docs, table, width).collect()}
    assert got == plain(rows, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audited(docs.limit(0), labels).count() == 0
    assert interaction.audited(docs, labels).count() == 600
