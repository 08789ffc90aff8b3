import random
import re
from collections import Counter, defaultdict

import pytest

from acervo.llm import divergence
from acervo.llm.common import stored

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least, most):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    in_docs, counts = defaultdict(Counter), defaultdict(Counter)
    for t, lang, source in rows:
        found = [x.translate(lower) for x in TERM.findall(t or "")]
        in_docs[lang or ""].update(set(found))
        counts[lang or "", source or ""].update(found)
    out = set()
    for lang in in_docs:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        groups = {s: c for (x, s), c in counts.items() if x == lang}

        def prices(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        of = {s: prices(c) for s, c in groups.items()}
        whole = prices(sum(groups.values(), Counter()))
        far = lambda p, q: (p - q) ** 2 // (p + q)
        for s in groups:
            pairs = [(o, sum(far(of[s][t], of[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, far(of[s][t], whole[t])) for t in kept if groups[s][t] and of[s][t] > whole[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, i) for i, (item, value) in enumerate(found, 1) if part == "pair" or i <= most}
    return out


@pytest.mark.parametrize(("least", "most"), [(2, 10), (1, 3), (10_000, 10)])
def test_equals_plain_python(spark, least, most):
    rng = random.Random(12)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)] + ["É", "é", "straße", "日本", "prefix" * 50 + "a", "prefix" * 50 + "b", "prefix" * 50]
    rows = []
    for _ in range(300):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["hot", "hot", "hot", *[f"s{i}" for i in range(9)], None])
        low = rng.choice([0, 60])
        rows.append((" ".join(rng.choice([str.upper, str])(x) + rng.choice([" ", "1", "_", "\n"]) for x in rng.choices(vocabulary[low:], k=rng.randint(0, 40))), lang, source))
    rows += [("12 34 !", "en", "none"), (None, "en", "none"), ("", "xx", "alone"), ("only here", "yy", "alone"), rows[0], rows[0], ("far " * 50_000, "en", "s1")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "text string, lang string, source string, term int").repartition(6)
    got = [tuple(r) for r in divergence.diverging(docs, least, most).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(rows, least, most)
    assert divergence.diverging(docs.limit(0), least, most).count() == 0


@pytest.mark.parametrize("k", [1, 4, 50])
def test_selection_breaks_ties_by_utf8(spark, k):
    rng = random.Random(k)
    items = list({"".join(rng.choices("ab\xe9\U0001f600～", k=rng.randint(0, 7))) for _ in range(400)})
    rows = [(g, rng.choice([0, 5, 5, 5, 1 << 40, rng.randrange(1 << 62)]), x) for g in ("a", "b") for x in items] + [("c", 1, "x")]
    table = stored(spark.createDataFrame(rows, "g string, v long, i string"), "rows")
    want = sorted(x for g in "abc" for x in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2].encode()))[:k])
    assert sorted(map(tuple, divergence.selected(table, ["g"], "v", "i", k).collect())) == want
