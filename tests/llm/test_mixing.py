import hashlib
import random
import re

from acervo.llm import mixing

W = {"d0": 4.0, "d1": 3.0, "d2": 0.0, "d3": 1.0}


def split(total, children):
    """children: {name: (weight, capacity)}. Fills one after another until no shortage is left."""
    out, live = {}, {k: v for k, v in children.items() if v[0] > 0}
    while live:
        share = {k: total * w / sum(x for x, _ in live.values()) for k, (w, _) in live.items()}
        short = [k for k in live if share[k] > live[k][1]]
        if not short:
            return out | share
        for k in short:
            out[k] = live.pop(k)[1]
            total -= out[k]
    return out


def plain(rows, fraction, most, seed):
    sized = []
    for i, t, lang, source in rows:
        m = re.search("([0-9]{1,9})$", source or "")
        sized.append(((i, hashlib.md5((t or "").encode()).hexdigest()[:16]), f"d{int(m[1]) % 4 if m else 0}", lang or "", source or "", len(re.findall(mixing.WORD, t or ""))))
    leaves = {}
    for _, *leaf, n in sized:
        leaves[tuple(leaf)] = leaves.get(tuple(leaf), 0) + n
    leaves = {k: n for k, n in leaves.items() if n}
    cap = lambda *p: most * sum(n for k, n in leaves.items() if k[: len(p)] == p)
    plan = {}
    for d, given in split(cap() / most * fraction, {d: (W.get(d, 1), cap(d)) for d in {k[0] for k in leaves}}).items():
        for lang, more in split(given, {x: (mixing.LANGS.get(x, 1), cap(d, x)) for x in {k[1] for k in leaves if k[0] == d}}).items():
            for s, budget in split(more, {x: (1, cap(d, lang, x)) for x in {k[2] for k in leaves if k[:2] == (d, lang)}}).items():
                plan[d, lang, s] = divmod(int(budget + 1e-6), leaves[d, lang, s])
    out = []
    for i, *leaf, n in sized:
        epochs, rest = plan.get(tuple(leaf), (0, 0))
        key = lambda x: hashlib.md5(f"{seed}:{epochs}:{'' if x[0] is None else x[0]}:{x[1]}".encode()).hexdigest()  # noqa: B023, E731
        start = sum(m for j, *other, m in sized if other == leaf and key(j) < key(i))
        part = max(0, min(n, (rest - start) // sum(j == i and other == leaf for j, *other, _ in sized)))
        out.append((str(i[0]), *leaf, n, epochs if n else 0, part, (epochs if n else 0) * n + part))
    return sorted(out)


def test_equals_plain_python(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([None, "", "a " * rng.randint(1, 60), "b\tc"]) if rng.random() < 0.2 else "w " * rng.randint(1, 200), rng.choice(["en", "en", "de", "es", None]), rng.choice(["src0", "src0", "src0", "src1", "src5", "src2", "web3", "x", None])) for i in range(400)]
    rows += [(3, "again and again", "en", "src0"), (3, "again and again", "en", "src0"), (None, "no id", "en", "src0"), (9999, "long " * 30_000, "fr", "src7")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, epochs int")
    for fraction, most in ((0.8, 3), (0.3, 1), (5.0, 2)):
        got = mixing.mixed(docs, fraction, most, 7, W).collect()
        assert sorted((str(r.doc_id), *r[1:]) for r in got) == plain(rows, fraction, most, 7)
        out = mixing.mixture(docs, fraction, most, 7, W)
        assert out.columns == docs.columns and out.count() == sum(r.whole_epochs + (r.part_tokens > 0) for r in got)
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.mixture(docs.limit(0), 0.5, 1).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_budgets_hold_when_one_row_or_identifier_repeats(spark):
    rows = [(None, "same text of six words here", "en", "src0")] * 3000 + [(None, f"another text {i}", "en", "src0") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for fraction in (0.001, 0.3, 0.9):
        got = [r.taken_tokens for r in mixing.mixed(docs, fraction, 1).collect()]
        assert len(got) == 6000 and 0.6 * fraction * 27_000 - 3000 <= sum(got) <= fraction * 27_000
