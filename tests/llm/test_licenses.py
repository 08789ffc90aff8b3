import random
import re

from acervo.llm import licenses

LOWER = str.maketrans(licenses.UPPER, licenses.LOWER)


def base(t):
    w = re.findall(licenses.WORD, (t or "").translate(LOWER))
    at = [(i, label) for p, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_base_places_equal_plain_python(spark):
    rng = random.Random(3)
    parts = ["MIT License", "GNU General Public License", "GNU general", "public license", "cc", "BY", "apache", "license", "é", "İ", "\x00", "mit license mit license", "4.0"]
    rows = [(i % 90, " ".join(rng.choices(parts, k=rng.randint(0, 30)))) for i in range(100)] + [(None, "mit license"), (500, None), (501, ""), (502, "x " * 60_000 + "CC BY"), (503, "cc by"), (503, "cc by")]
    docs = spark.createDataFrame([(*r, "clash", 1.5) for r in rows], "doc_id long, text string, labels string, score double")
    out = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scanned(docs).collect()]
    assert sorted(out, key=str) == sorted([(i, *base(t)) for i, t in rows], key=str)
    assert licenses.scanned(docs.limit(0)).count() == 0


def test_broken_notices_merge_over_neighbouring_diagonals(spark):
    notice = next(p for p in licenses.NOTICES if p.startswith("permission is hereby granted"))
    w = notice.split()
    broken = " ".join([*w[:9], "indeed", *w[9:]])
    docs = spark.createDataFrame([(1, notice), (2, broken), (3, " ".join(w[:9])), (4, " ".join(sorted(w)))], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.n_base) for r in licenses.scanned(docs).collect()}
    assert got == {1: ("mit", 0), 2: ("mit", 0), 3: ("", 0), 4: ("", 0)}
    plan = licenses.scanned(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_texts_are_found_and_told_apart(spark):
    """Each text with a word in twenty changed, among other words, has its label; a family's others only if they share most of their words."""
    rng = random.Random(1)
    rows, labels = [], {}
    for i, (text, label) in enumerate(licenses.TEXTS):
        w = text.split()
        for j in range(7, len(w), 20):
            w[j] = "other"
        rows.append((i, " ".join(rng.choices(["some", "more", "prose"], k=200)) + "\n" + " ".join(w).upper() + " and so on"))
        labels[i] = label
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: set(r.labels.split(",")) for r in licenses.scanned(docs).collect()}
    missed = [labels[i] for i in labels if labels[i] not in found[i]]
    assert not missed
    assert {labels[i] for i in labels} >= {"gpl", "lgpl", "agpl", "apache", "mpl", "epl", "bsd", "isc", "mit", "bsl", "unlicense", "cc-by", "cc-by-sa", "cc0", "zlib"}
    assert all("mit" not in found[i] for i in labels if labels[i] in ("gpl", "apache", "mpl", "epl", "cc0", "cc-by"))
