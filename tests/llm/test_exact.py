import hashlib
import random
import re

from acervo.llm import exact


def plain(rows):
    """(doc_id, keep_id, group_size, n kept) by comparing whole texts; rows that repeat identifier and length count together."""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        left = 1
        for m in sorted(members, key=lambda m: (m[0], m[1], m[2] or 0)):
            out.append((str(m[2]), str(best[2]), len(members), bool(left), hashlib.sha256(text.encode()).hexdigest()))
            left = 0
    return sorted(out)


def test_equals_plain_python(spark):
    rng = random.Random(11)
    long = "wörd " * 60_000
    bodies = ["a b c", "abc", "ab  c\n", "", " \t\n\v\f\r", "a\x1cbc", "a\xa0bc", "é", "é", "x" * exact.PREFIX + "1", "x" * exact.PREFIX + "2", long, long + " ", long[:-2] + "e "]
    rows = [(i, rng.choice(bodies)) for i in range(300)] + [(1000 + i, "hot  copy") for i in range(200)] + [(2000 + i, "hot copy") for i in range(200)]
    rows += [(None, "hot copy"), (None, None), (None, None), (7, "only here"), (7, "only here"), (7, " only here"), (8, "abc"), (8, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, chars string").repartition(5)
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in exact.deduplicated(docs).collect())
    assert got == plain(rows)
    without = exact.grouped(docs)
    assert without.columns == ["doc_id", "keep_id", "group_size", "kept"]
    assert sorted((str(r[0]), str(r[1]), *r[2:]) for r in without.collect()) == [r[:4] for r in plain(rows)]


def test_empty_table(spark):
    assert exact.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
