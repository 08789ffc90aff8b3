import hashlib
import random

import pytest

from acervo.llm import lines


def plain(rows, sites):
    bare = lambda x: x.strip(" \t\n\v\f\r")
    seen = {}
    for _, t, s in rows:
        for x in (t or "").split("\n"):
            seen.setdefault(bare(x), set()).add(s)
    gone = {x for x, s in seen.items() if x and len(s) >= sites}
    out = []
    for i, t, _ in rows:
        parts = (t or "").split("\n")
        out.append((str(i), sum(bare(x) != "" for x in parts), sum(bare(x) in gone for x in parts), hashlib.md5("\n".join(x for x in parts if bare(x) not in gone).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("sites", "most"), [(1, 1000), (4, 1000), (9, 0), (30, 1000)])
def test_equals_plain_python(spark, sites, most):
    rng = random.Random(sites)
    common = [f"line {i} é\x1c" for i in range(30)] + ["", "  ", "\t"]
    rows = []
    for i in range(200):
        s = rng.choice(["hot", "hot", *[f"s{j}" for j in range(40)], None])
        rows.append((i, "\n".join(rng.choice(["", " "]) + x for x in rng.choices(common, k=rng.randint(0, 6)) + [f"own {i}"] * rng.randint(0, 2)), s))
    rows += [(None, "line 1 é\x1c\nline 1 é\x1c", "s1"), (5, None, "s1"), (5, "", None), (7, rows[7][1], "s3"), (7, rows[7][1], "s3"), (900, "line 1 é\x1c\n" * 30_000, "s2")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, line int")
    got = lines.deduplicated(docs, "source", sites, most).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == plain(rows, sites)
    assert lines.deduplicated(docs.limit(0), "source", sites, most).count() == 0
