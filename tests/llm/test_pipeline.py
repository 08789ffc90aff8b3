import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from acervo.llm import decontamination, mixing, quality, simhash
from tests.llm.test_simhash import LOWER


def jaccard(a, b, k=5):
    cut = lambda t: {tuple(w[i : i + k]) for w in [t.translate(LOWER).split()] for i in range(max(1, len(w) - k + 1))}
    return len(cut(a) & cut(b)) / len(cut(a) | cut(b))


@pytest.mark.parametrize("dense", [3, 1000])
def test_near_groups_follow_similarity(spark, dense):
    rng = random.Random(dense)
    vocabulary = [f"{a}{b}{c}" for a in "abÉdE" for b in "xyzwv" for c in "mnopq"]
    texts = []
    for i in range(40):
        t = rng.choices(vocabulary, k=rng.randint(60, 250))
        texts.append(" ".join(t))
        for _ in range(40 if i == 0 else rng.randint(0, 4)):
            u = list(t)
            for _ in range(rng.choice([1, 1, 2, 12])):
                u[rng.randrange(len(u))] = rng.choice(vocabulary)
            texts.append("\n".join(u))
    texts += [texts[0], "a b", "A b", "", " "]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1) for r in rows] + [(None, None, 1), (None, texts[0], 1), (None, "no other text", 1), (3, texts[3], 1), (3, "of its own", 1)], "doc_id long, text string, node int")
    got = {r.doc_id: r.group_id for r in simhash.near_groups(docs.where("text != 'of its own'"), dense=dense).collect() if r.doc_id is not None}
    near = [[jaccard(a, b) >= 0.8 for b in texts[:i]] for i, a in enumerate(texts)]
    links = [(i, j) for i, row in enumerate(near) for j, x in enumerate(row) if x]
    root = list(range(len(texts)))
    for i, j in links:
        a, b = root[i], root[j]
        root = [min(a, b) if r in (a, b) else r for r in root]
    assert all(root[g] == root[i] for i, g in got.items())  # no group joins texts that no links join
    assert sum(got[i] == got[j] for i, j in links) >= 0.95 * len(links)
    kept = simhash.deduplicated(docs, dense=dense)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted([*set(got.values()), *[3] * (got[3] == 3), 3])
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["no other text"]
    assert simhash.deduplicated(docs.limit(0)).count() == 0


def test_each_stage_equals_brute_force(spark):
    """Every stage on what the one before kept, from documents with odd rows, against plain Python or the operator's own verdicts on its rows."""
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = docs.where("n_chars between 800 and 4000").orderBy("doc_id").first()
    odd = [(None, good.text + " with another end", "en", "src1", 1), (None, None, None, None, None), (7, "", "en", "src1", 0), (good.doc_id, good.text, good.lang, good.source, good.n_chars), (900_000, good.text.upper(), None, None, 5)]
    docs = p.stored(docs.unionAll(spark.createDataFrame(odd, docs.schema)), "documents")
    assert [n for n, _ in p.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_output"]
    kept = {"documents": docs}
    for name, stage in p.STAGES[:-1]:
        docs = p.stored(stage(spark, docs, sf), name)
        kept[name] = docs
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count()
    rows = {k: [(r.doc_id, r.text) for r in v.collect()] for k, v in kept.items()}
    key = lambda x: sorted(map(str, x))

    model = quality.train(kept["documents"], p.table(spark, sf, "labels"))
    verdict = {(r.doc_id, r.n_words): r.kept for r in quality.judged(kept["documents"], model).collect()}
    n_words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert key(rows["quality_rules"]) == key(x for x in rows["documents"] if verdict[x[0], n_words(x[1])])
    assert all(n_words(t) >= 50 for _, t in rows["quality_rules"])

    texts = sorted(set(rows["quality_rules"]), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    cut = [{tuple(w[i : i + 5]) for w in [t.translate(LOWER).split()] for i in range(max(1, len(w) - 4))} for _, t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if min(len(cut[i]), len(cut[j])) >= 0.8 * max(len(cut[i]), len(cut[j])) and len(cut[i] & cut[j]) >= 0.8 * len(cut[i] | cut[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    stays = {x for x, r in zip(texts, root) if x[0] is not None and x[0] == texts[r][0] or x[0] is None and texts[r][0] is None}
    assert key(rows["simhash_near_dedup"]) == key(x for x in rows["quality_rules"] if x in stays) and len(stays) < len(texts)

    held = {(r.doc_id, r.contaminated) for r in decontamination.judged(kept["simhash_near_dedup"], p.table(spark, sf, "benchmark"), whole=True).collect()}
    assert key(rows["benchmark_decontamination"]) == key(x for x in rows["simhash_near_dedup"] if (x[0], False) in held)
    gone = {x[0] for x in rows["simhash_near_dedup"]} - {x[0] for x in rows["benchmark_decontamination"]}
    items = [r.text for r in p.table(spark, sf, "benchmark").collect()]
    assert {i for i, t in rows["simhash_near_dedup"] if any(" ".join(x.split()) in " ".join(t.split()) for x in items)} <= gone

    taken = {r.doc_id: r.taken_tokens for r in mixing.mixed(kept["benchmark_decontamination"], p.FRACTION, p.MAX_EPOCHS).collect()}
    assert key(rows["source_mixing"]) == key(x for x in rows["benchmark_decontamination"] if taken[x[0]] > 0)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, want = 0, []
    for i, t in sorted(rows["source_mixing"], key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    out = p.STAGES[-1][1](spark, docs, sf).collect()
    assert sorted([tuple(r) for r in out], key=lambda r: r[1]) == want


def test_run_gives_the_last_stage(spark):
    import corpus_pipeline as p

    out = p.run(spark, "/root/testdata/sf0.001").collect()
    assert len(out) > 50 and sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


def test_workers_get_few_bytes_at_once(spark, monkeypatch):
    """Six MB in one task: whatever the stage, they come in batches of about BATCH_BYTES, unless the session has a limit of its own."""
    import corpus_pipeline as p
    import pyarrow as pa
    from acervo.llm.common import BATCH_LIMIT

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat('word ', 400) as text")
    sent = lambda df: df.mapInArrow(sizes, "n long, size long").selectExpr("sum(n)", "max(size)").first()
    monkeypatch.setattr(p.quality, "train", lambda *a: None)
    for module, name in ((p.quality, "good"), (p.simhash, "deduplicated"), (p.decontamination, "decontaminated"), (p.shards, "tokenized")):
        monkeypatch.setattr(module, name, lambda docs, *a, **b: docs)
    try:
        for name, stage in p.STAGES:
            if name != "source_mixing":  # SQL alone
                spark.conf.unset(BATCH_LIMIT)
                n, most = sent(stage(spark, docs, "/root/testdata/sf0.001"))
                assert n == 3000 and most < 1.2 * p.BATCH_BYTES, name
        spark.conf.set(BATCH_LIMIT, "3m")
        p.simhash_near_dedup(spark, docs, "")
        assert spark.conf.get(BATCH_LIMIT) == "3m"
    finally:
        spark.conf.unset(BATCH_LIMIT)
