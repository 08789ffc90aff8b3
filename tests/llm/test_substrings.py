import hashlib
import random
import re

import numpy as np

from acervo.llm import substrings


def plain(rows, window):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    key = lambda i: substrings.LAST if i is None else i
    first = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            x = tuple(w[s : s + window])
            first[x] = min(first.get(x, key(i)), key(i))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < key(i):
                gone |= set(range(s, s + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_equals_plain_python(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    some = lambda n: rng.choices(vocabulary, k=n)
    passages = [some(rng.choice([49, 50, 51, 60, 80, 200])) for _ in range(12)]
    rows = []
    for i in range(150):
        w = some(rng.randint(0, 90))
        for _ in range(rng.randint(0, 3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = "x"
            w += p + some(rng.randint(0, 60))
        rows.append((i * 3, rng.choice([" ", "\n", " \t"]).join(w)))
    rows += [(None, rows[5][1]), (None, rows[5][1]), (1000, rows[7][1]), (1000, rows[7][1]), (1000, rows[8][1] + " y"), (2000, None), (2001, ""), (2002, "same " * 300), (2003, "same " * 120), (2004, "a b " * 90), (2005, "a b " * 40_000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "clash", 2) for r in rows], "doc_id long, text string, tag string, n int")
    for window, batches, fan_in in ((50, 3, 3), (50, 4, 1), (9, 1, 3)):
        part = [r for r in rows if r[0] != 2005] if window == 9 else rows
        got = substrings.deduplicated(docs.where("doc_id is null or doc_id != 2005") if window == 9 else docs, window, batches, fan_in).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == plain(part, window)
    assert substrings.deduplicated(docs.limit(0)).count() == 0


def test_lowest_is_leftmost():
    rng = np.random.default_rng(0)
    for n in (5, 26, 27, 100, 333):
        a = rng.integers(0, 40, n).astype(np.uint64) << np.uint64(6)
        for span in (1, 5, 26):
            if span <= n:
                assert substrings.lowest(a, span).tolist() == [i + int(np.argmin(a[i : i + span])) for i in range(n - span + 1)]


def test_compaction_keeps_every_fingerprint(spark):
    index = substrings.FingerprintIndex(spark, fan_in=2)
    shared = []
    for batch in ([1, 2, 3], [4, 4, 5], [3, 6], [5, 7], [8], [9]):
        shared.append(sorted(r.print for r in index.add(spark.createDataFrame([(x,) for x in batch], "print long")).collect()))
    assert shared == [[], [4], [3], [5], [], []] and len(index.runs) == 2
    assert sorted({r.print for run in index.runs for r in spark.table(run).collect()}) == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    plan = spark.table(index.runs[0]).join(spark.table(index.runs[1]).hint("merge"), "print", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    index.drop()


def test_many_rows_without_identifier(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(None, f"q{i} short" if i % 2 else " ".join(f"q{i}x{j}" for j in range(i % 5 * 50)) + " " + passage) for i in range(20_000)] + [(1, passage), (2, "x " + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.deduplicated(docs).collect())
    assert got == plain(rows, 50)


def test_an_index_opens_again(spark):
    prints = lambda *x: spark.createDataFrame([(i,) for i in x], "print long")
    one = substrings.FingerprintIndex(spark, fan_in=2)
    for batch in ((1, 2), (3, 4), (5, 6)):
        one.add(prints(*batch))
    again = substrings.FingerprintIndex(spark, fan_in=2, folder=one.folder)
    assert len(again.runs) == len(one.runs) == 1  # compacted
    assert sorted(r.print for r in again.add(prints(6, 7, 1)).collect()) == [1, 6]
    third = substrings.FingerprintIndex(spark, folder=one.folder)
    assert len(third.runs) == 2 and [r.print for r in third.add(prints(7, 8)).collect()] == [7]
    third.drop()
    assert not substrings.FingerprintIndex(spark, folder=one.folder).runs


def test_batches_against_an_opened_index(spark, tmp_path):
    """Three calls, the index opened anew each time, give the same as all at once; earlier documents that share nothing aren't verified."""
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(400)]
    passages = [rng.choices(vocabulary, k=rng.choice([50, 55, 90])) for _ in range(6)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 70)) + (rng.choice(passages) if rng.random() < 0.5 else []) + rng.choices(vocabulary, k=20))) for i in range(120)]
    rows += [(120, rows[3][1]), (None, rows[3][1]), (None, None)]
    folder, earlier, got, read = f"file://{tmp_path}/index", None, [], []
    covered = substrings.covered
    for low, high in ((0, 40), (40, 90), (90, 123)):
        docs = spark.createDataFrame(rows[low:high], "doc_id long, text string")
        index = substrings.FingerprintIndex(spark, 1, folder)
        assert len(index.runs) == (1 if low else 0)
        substrings.covered = lambda found, *more: read.append(found.count()) or covered(found, *more)
        try:
            got += substrings.extended(index, docs, earlier).collect()
        finally:
            substrings.covered = covered
        earlier = docs if earlier is None else earlier.unionAll(docs)
    index.drop()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == plain(rows, 50)
    assert read[0] == 40 and read[1] < 90 and read[2] < 123 and any(r.n_removed for r in got)


def test_repeated_rows_take_linear_time(spark):
    """Many rows without identifier share one text with a document."""
    words = [f"w{i}" for i in range(60)]
    rows = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    copies = spark.range(60_000).selectExpr("cast(null as long) AS doc_id").crossJoin(rows.select("text"))
    got = substrings.deduplicated(rows.unionByName(copies))
    found = {(r.doc_id, r.n_removed): r["count"] for r in got.groupBy("doc_id", "n_removed").count().collect()}
    assert found == {(1, 0): 1, (None, 60): 60_000}
