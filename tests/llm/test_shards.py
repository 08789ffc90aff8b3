import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import pyarrow as pa
from acervo.llm import shards

FILE = public_tokenizers.path("word_bpe_49k.json")
TOK = Tokenizer.from_file(FILE)
ENCODE = shards.encoder(FILE, 1)


@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aΣσ́ '\nslt<|endoftext|>9\x1c \xa0É", max_size=40)), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_encoding_by_words_equals_encoding_whole_texts(found):
    ids, starts = ENCODE(pa.array(found, pa.string()))
    for i, t in enumerate(found):
        assert ids[starts[i] : starts[i + 1]].tolist() == [*TOK.encode(t or "", add_special_tokens=False).ids, 1]


@given(st.lists(st.lists(st.text(alphabet="abcÉéßñøЖжё×÷ªĀ中ςΣİ5.,'-_*́", min_size=1, max_size=6), max_size=30), min_size=1, max_size=4), st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_words_encoded_together_and_forgotten_pieces_give_the_same_ids(batches, kept):
    encode = shards.encoder(FILE, 1, kept)
    for words in batches:
        text = " ".join(words)
        assert encode(pa.array([text]))[0].tolist() == [*TOK.encode(text, add_special_tokens=False).ids, 1]


def test_letters_are_one_run_to_the_tokenizer_and_others_stay_in_their_word():
    found = re.findall(f"[{shards.LETTER}]", "".join(map(chr, range(0xD800))))
    for c in found:
        assert len(TOK.pre_tokenizer.pre_tokenize_str(TOK.normalizer.normalize_str(f"a{c}a"))) == 1, c
    assert len(found) > 30_000
    texts = [f"a{c},. {c}_" for c in "İ\u0958\ufb1dé中5"]
    ids, starts = ENCODE(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == [*TOK.encode(t, add_special_tokens=False).ids, 1]


def test_the_tokenizer_is_asked_for_many_words_at_once_and_only_for_new_ones(monkeypatch):
    asked = []

    class Counting:
        from_file = classmethod(lambda cls, path: cls())
        __getattr__ = lambda self, name: getattr(TOK, name)

        def encode_batch_fast(self, texts, **more):
            asked.append(len(texts))
            return TOK.encode_batch_fast(texts, **more)

    monkeypatch.setattr("tokenizers.Tokenizer", Counting)
    shards.tx.KEPT.clear()
    encode = shards.encoder(FILE, 1, 2500)
    words = ["".join("abcdefghij"[int(c)] for c in str(n)) for n in range(10_000, 13_000)]
    for some in (words[:2000], words[1000:]):  # the second doesn't fit beside the first
        asked.clear()
        got = encode(pa.array([" ".join(some)]))[0].tolist()
        assert got == [*TOK.encode(" ".join(some), add_special_tokens=False).ids, 1]
        assert sum(asked) <= 2000 // 50
    assert sum(asked) <= 1000 // 50
    shards.tx.KEPT.clear()


def test_lookup_and_round_trip(tmp_path):
    path, rng = str(tmp_path / "x.sst"), np.random.default_rng(0)
    with open(path, "wb") as f:
        w = shards.ShardWriter(f, 2)
        rows = {i: rng.integers(0, 60_000, rng.integers(0, 3000)).astype(np.uint32) for i in [None, *sorted(rng.integers(-(1 << 40), 1 << 40, 500).tolist())]}
        for i, ids in rows.items():
            w.add(shards.key_of(i), ids)
        w.close()
    r = shards.ShardReader(path)
    assert len(r.index) > 3 and r.n_docs == len(rows)
    assert [shards.id_of(k) for k, _ in r] == list(rows)
    for i, ids in rows.items():
        assert r.get(i).tolist() == ids.tolist()
    assert r.get(5) is None
    assert np.mean([r.may_have(shards.key_of(i)) for i in range(2000)]) < 0.05
    (tmp_path / "y").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        shards.ShardReader(str(tmp_path / "y"))


def test_table(spark):
    rows = [(5, "b a"), (None, "null id"), (-3, None), (7, ""), (5, "b a"), (9, "x" * 50_000)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, start int")
    out = shards.tokenized(docs, FILE, 1).collect()
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    want = sorted((d is not None, d or 0, zlib.crc32(np.array([*TOK.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes())) for d, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids_crc32) for r in out) == want
    assert [r.doc_id for r in sorted(out, key=lambda r: r.start)] == [None, -3, 5, 5, 7, 9]
    assert shards.tokenized(docs.limit(0), FILE, 1).count() == 0


def test_many_tiny_texts_make_bounded_shards(spark, monkeypatch):
    docs = spark.range(60_000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) AS doc_id", "if(id % 2 = 0, '', cast(id AS string)) AS text")
    folder = shards.new_folder(spark, "shards")
    manifest = shards.write(docs, folder, FILE, 1, shard_docs=5000)
    assert manifest.agg({"n_docs": "sum"}).first()[0] == 60_000 and all(r.n_docs <= 5000 for r in manifest.collect())
    assert manifest.where("first_id = 7 and last_id = 7").count() > 1  # one identifier in several shards
    out = shards.read(manifest).toPandas().sort_values("start")
    assert len(out) == 60_000 and (out.start.diff().iloc[1:] == out.n_tokens.iloc[:-1].to_numpy()).all()
    assert (out.doc_id.fillna(-1).diff().iloc[1:] >= 0).all()
