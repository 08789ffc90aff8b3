"""Index, near rulings, segments and accruals against brute force and values worked out by hand."""

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from acervo.functions.text import norm_ws
from acervo.operators import accrual, citations, index, search, segments, similar


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    vocabulary = ["casa", "Ação", "de", "de", "lei", "não", "x1", "É"]
    out = ["".join(rng.choice(vocabulary) + rng.choice([" ", " ", ". ", "\n", "-", "! "]) for _ in range(rng.randint(0, 40))) for _ in range(120)]
    return [*out, None, "", "casa casa casa", "lei. De casa", "de " * 5000 + "casa"]


def test_index_equals_search(spark, texts, tmp_path):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    i = index.build(rows, "id", "text", f"file://{tmp_path}/index")
    tok, text = search.tokens(F.col("text")), F.col("text")
    for got, want in [
        (i.has("ACAO"), search.has(tok, "acao")), (i.has("de-lei"), search.has(tok, "de lei")), (i.has("casa casa"), search.has(tok, "casa casa")), (i.has("--"), search.has(tok, "--")), (i.has("nowhere"), search.has(tok, "nowhere")),
        (i.all_of("casa", "de lei"), search.all_of(tok, "casa", "de lei")), (i.any_of("x1", "é"), search.any_of(tok, "x1", "é")), (i.without(i.has("casa"), "lei", "x1"), search.has(tok, "casa") & ~search.any_of(tok, "lei", "x1")),
        (i.either("x1", "e"), search.either(search.has(tok, "x1"), search.has(tok, "e"))), (i.followed("casa", "lei", 2), search.followed(tok, "casa", "lei", 2)), (i.followed("de casa", "de lei", 3), search.followed(tok, "de casa", "de lei", 3)),
        (i.followed("casa", "casa", 2), search.followed(tok, "casa", "casa", 2)), (i.close("casa", "x1", 2), search.close(tok, "casa", "x1", 2)), (i.close("de lei", "nao", 1), search.close(tok, "de lei", "nao", 1)),
        (i.together(["casa", "lei"], "sentence"), search.together(text, ["casa", "lei"], "sentence")), (i.together(["casa", "lei", "de"], "paragraph"), search.together(text, ["casa", "lei", "de"], "paragraph")),
    ]:
        assert sorted(r.key for r in got.collect()) == sorted(r.id for r in rows.where(want).collect())
    again = index.Index(spark, f"file://{tmp_path}/index")
    assert again.has("casa").count() == i.has("casa").count()
    plan = i.all_of("casa", "lei")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(bucket") == 2 and "EqualTo(word,casa)" in plan and "EqualTo(word,lei)" in plan


def test_numbered_words(spark):
    rows = spark.createDataFrame([("Um dois. Três!\nQuatro? cinco\n\nseis",), ("",), (None,)], "text string")
    got = [r.w for r in rows.select(segments.numbered_words(F.col("text")).alias("w")).collect()]
    assert [tuple(x) for x in got[0]] == [("um", 0, 0, 0), ("dois", 1, 0, 0), ("tres", 2, 1, 0), ("quatro", 3, 2, 1), ("cinco", 4, 3, 1), ("seis", 5, 3, 3)]
    assert got[1] == [] and got[2] is None


def test_blocks_by_hand(spark):
    card = r'<card id="[^"]+">'
    cases = {"before<card id=\"1\">a$1\nb<card id=\"2\"><card id=\"2\">c": [(1, '<card id="1">', 0, "a$1\nb"), (2, '<card id="2">', 0, ""), (3, '<card id="2">', 0, "c")], "none": [], "": [], "<x><card id=\"9\">": [(1, "<x>", 1, ""), (2, '<card id="9">', 0, "")], "<x><x>y" * 2: [(1, "<x>", 1, ""), (2, "<x>", 1, "y"), (3, "<x>", 1, ""), (4, "<x>", 1, "y")]}
    rows = spark.createDataFrame([(x,) for x in cases], "text string")
    got = {r.text: [tuple(b) for b in r.b] for r in rows.select("text", segments.blocks(F.col("text"), card, "<x>").alias("b")).collect()}
    assert got == cases
    rng = random.Random(8)
    many = ["".join(rng.choices(["ab", "a", "b", "ba", " "], k=30)) for _ in range(200)]
    rows = spark.createDataFrame([(x,) for x in many], "text string")
    for r in rows.select("text", segments.blocks(F.col("text"), "aba", "bb").alias("b")).collect():
        at = [m.span() for m in re.finditer("aba|bb", r.text)] + [(len(r.text), 0)]
        assert [(b.marker, b.body) for b in r.b] == [(r.text[s:e], r.text[e : at[k + 1][0]]) for k, (s, e) in enumerate(at[:-1])]
    labels = {"PROCESSO": "processo", "UF": "uf"}
    block = "<i>Processo </i>12<i>Outro</i>z<i> UF</i> <i>uf</i>SP <i>processo</i>13"
    assert spark.createDataFrame([(block,)], "b string").select(segments.fields(F.col("b"), "<i>([^<]+)</i>", labels).alias("f")).first().f == {"processo": "12", "uf": "SP"}


def test_numbered_words_of_odd_texts(spark):
    """Marks that stand in the text are no sentence's end, and combining marks and final sigmas stay with their sentence."""
    values = [None, "", "a\ue000b. c", "\ufffdx!\n\n y", ".\u0301 x? z", "ΑΣ.\nΒΣ"]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, text string").select("i", segments.numbered_words(F.col("text")).alias("w")).orderBy("i").collect()
    want = [None, [], [("a", 0, 0, 0), ("b", 1, 0, 0), ("c", 2, 1, 0)], [("x", 0, 0, 0), ("y", 1, 1, 2)], [("x", 0, 0, 0), ("z", 1, 1, 0)], [("ας", 0, 0, 0), ("βς", 1, 1, 1)]]
    assert [r.w and [tuple(x) for x in r.w] for r in rows] == want
    plan = spark.range(1).select(segments.numbered_words(F.col("id").cast("string")).alias("w"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1  # the normal form is made once


def test_texts_are_not_dealt_by_workspace(spark):
    """A workspace with most of the texts would be one task."""
    parts = spark.createDataFrame([("a", "one two three four five six"), ("b", "x")], "workspace_id string, part string")
    wanted = spark.createDataFrame([("a", "two three four five"), ("a", "ne two"), ("b", "one two three four"), ("b", "y")], "workspace_id string, fragment string")
    held = citations.held_in(wanted, parts)
    assert sorted(tuple(r) for r in held.collect()) == [("a", "ne two"), ("a", "two three four five")]
    assert not re.search(r"hashpartitioning\(workspace_id#\d+, \d+\)", held._jdf.queryExecution().executedPlan().toString())


def test_words_of_a_text_are_grouped_within_it(spark):
    rng = random.Random(9)
    values = [None, "", "x"] + [" ".join(rng.choices(["a", "b.", "Ç!", "é\n"], k=rng.randint(1, 40))) for _ in range(60)]
    words = spark.createDataFrame([(v,) for v in values], "text string").select(segments.numbered_words(F.col("text")).alias("w"))
    for r in words.select("w", segments.by_word(F.col("w")).alias("g")).collect():
        want = {}
        for x in r.w or []:
            want.setdefault(x.word, []).append(tuple(x[1:]))
        assert [(g.word, [tuple(p) for p in g.places]) for g in r.g or []] == sorted(want.items())


def test_near_rulings_equal_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    found = []
    for i in range(25):
        t = rng.choices(vocabulary, k=rng.randint(1, 120))
        found.append(t)
        for _ in range(30 if i == 0 else 3):
            u = list(t)
            for _ in range(rng.choice([0, 1, 2])):
                u[rng.randrange(len(u))] = rng.choice(vocabulary)
            found.append(u + rng.choices(vocabulary, k=rng.choice([0, 0, 9])))
    values = [" ".join(t) for t in found] + [None, "", "  ", "A b", "a  B"]
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := (v or "").lower().split()) else frozenset() for v in values]
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(s, i)
    each = list(first)
    near = {s: sum(t != s and len(s & t) >= 0.8 * len(s | t) for t in each) for s in each}
    rows = spark.createDataFrame(list(enumerate(values)), "id int, text string")
    got = {r.id: (r.class_id, r.n_near) for r in similar.near(rows, "id", "text").collect()}
    assert got == {i: (first[s], near[s]) for i, s in enumerate(sets)} and max(near.values()) > 5
    assert similar.near(rows.limit(0), "id", "text").count() == 0


def test_near_rulings_store_little(spark):
    """Long texts store and send less than one hash for each of their shingles; rows that repeat a key are still compared by their own texts."""
    from pathlib import Path

    from acervo.sources.shared import shared_dir

    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(5000)], k=400)) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[8] + " more"), (1000, texts[7] + " more"), (1001, texts[9])]
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    got = sorted(tuple(r) for r in similar.near(spark.createDataFrame(rows, "id int, text string"), "id", "text").collect() if r.n_near or r.id >= 1000)
    assert got == [(7, 7, 2), (7, 7, 2), (8, 8, 1), (1000, 1000, 1), (1001, 9, 0)]
    size = sum(f.stat().st_size for d in set(folder.iterdir()) - before for f in d.rglob("*.parquet"))
    assert size < 8 * 396 * 300


def test_accrual_by_hand(spark):
    """Two months of an index with interest, then three of one rate for both."""
    month = lambda m: f"2021-{m:02}-01" if m < 13 else f"2022-{m - 12:02}-01"
    rates = [("INPC", month(11), "0.0084", "0.0050"), ("INPC", month(12), "0.0100", "0.004412"), *[("SELIC", month(m), "0", "0.0073") for m in (13, 14, 15)]]
    table = spark.createDataFrame([(p, m, Decimal(c), Decimal(i)) for p, m, c, i in rates], "period string, month string, correction decimal(12,6), interest decimal(12,6)").withColumn("month", F.col("month").cast("date"))
    debts = spark.createDataFrame([(1, Decimal("1000.00"), month(11), month(15)), (2, Decimal("1000.00"), month(12), month(12)), (3, Decimal("1000.00"), month(14), month(15)), (4, Decimal("1000.00"), "2010-01-01", "2010-05-01"), (5, None, month(11), month(15))], "id int, owed decimal(18,2), a string, b string").select("id", "owed", F.col("a").cast("date").alias("a"), F.col("b").cast("date").alias("b"))
    out = {r.id: tuple(None if x is None else str(x) for x in r[4:]) for r in accrual.statement(debts, table, "INPC", "SELIC", principal="owed", first="a", last="b").collect()}
    # 1000 * (1 + 0.0084 + 0.0100) = 1018.40; * (0.0050 + 0.004412) = 9.585...; (1018.40 + 9.59) * 0.0219 = 22.512...
    assert out[1] == ("1018.40", "9.59", "22.51", "1050.50")
    assert out[2] == ("1010.00", "4.46", "0.00", "1014.46")
    assert out[3] == ("1000.00", "0.00", "14.60", "1014.60")
    assert out[4] == ("1000.00", "0.00", "0.00", "1000.00") and out[5] == (None,) * 4
    assert [tuple(map(str, r)) for r in accrual.method_changes(table).orderBy("period").collect()] == [("INPC", "2021-11-01", "2021-12-01"), ("SELIC", "2022-01-01", "2022-03-01")]
    kinds = spark.createDataFrame([(["SELIC"],), (["SELIC", "INPC"],), (["INPC", "TR"],)], "k array<string>")
    assert [r.d for r in kinds.select(accrual.doubled(F.col("k"), "SELIC").alias("d")).collect()] == [False, True, False]


def test_proximity_equals_brute_force(spark):
    rng = random.Random(2)
    texts = [rng.choices(["a", "b", "c"], k=rng.randint(0, 25)) for _ in range(150)]
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "id int, text string")
    tok = search.tokens(F.col("text"))
    for a, b, n in (("a", "b", 1), ("a", "b", 3), ("a", "a", 2), ("a b", "c", 2), ("b", "c a", 4)):
        at = lambda t, w: [i for i in range(len(t)) if t[i : i + len(w.split())] == w.split()]
        forth = {i for i, t in enumerate(texts) if any(1 <= y - x - len(a.split()) + 1 <= n for x in at(t, a) for y in at(t, b))}  # noqa: B023
        back = {i for i, t in enumerate(texts) if any(1 <= y - x - len(b.split()) + 1 <= n for x in at(t, b) for y in at(t, a))}  # noqa: B023
        assert {r.id for r in rows.where(search.followed(tok, a, b, n)).collect()} == forth
        assert {r.id for r in rows.where(search.close(tok, a, b, n)).collect()} == forth | back


def test_quotes_are_found_by_their_rarest_run(spark):
    """Fragments of any number of words, cut within words, against plain containment."""
    rng = random.Random(4)
    words = ["de", "de", "de", "lei", "ação", "código", "art"]
    parts = [("w", " ".join(rng.choices(words, k=rng.randint(1, 40)))) for _ in range(60)] + [("v", "de lei de ação"), ("w", "x" * 70 + " " + "y" * 70)]
    wanted = []
    for space, text in parts:
        a = rng.randrange(len(text))
        wanted += [(space, text[a : a + rng.randint(1, 60)]), ("v", text[:20]), (space, text[a:] + "z")]
    wanted += [("w", "x" * 65 + " " + "y" * 65), ("w", "x" * 69), ("none", "de")]
    f, c = spark.createDataFrame(wanted, "workspace_id string, fragment string").withColumn("fragment", norm_ws(F.col("fragment"))).where("fragment != ''"), spark.createDataFrame(parts, "workspace_id string, part string")
    norms = [(r.workspace_id, r.n) for r in c.select("workspace_id", norm_ws(F.col("part")).alias("n")).collect()]
    want = {(r.workspace_id, r.fragment) for r in f.collect() if any(w == r.workspace_id and r.fragment in n for w, n in norms)}
    got = [tuple(r) for r in citations.held_in(f, c).collect()]
    assert set(got) == want and len(got) == len(want) > 50
