"""Text functions against the standard library and values written by hand."""

import html
import random

import pytest
from pyspark.sql import functions as F

from acervo.functions import records, text
from acervo.operators import rules, search


def column(spark, values, f):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r.y for r in rows.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_unescaped_equals_the_standard_library(spark):
    rng = random.Random(5)
    names = rng.sample(sorted(html.entities.html5), 400)
    pieces = ["&", ";", "#", "&#", "&#x", "x", " ", "\n", "<", "copy", "&notit;", "&amp;lt;", "&NotEqualTilde;", "&no", "é", "😀"]
    pieces += [f"&{n}" for n in names] + [f"&#{rng.choice([0, 1, 9, 11, 13, 31, 65, 127, 128, 129, 150, 159, 160, 55296, 57343, 64976, 65533, 65534, 131071, 1114111, 1114112, 99999999999999999999])}{rng.choice([';', ''])}" for _ in range(100)]
    pieces += [f"&#{rng.choice('xX')}{'0' * rng.randrange(9)}{rng.randrange(1 << rng.choice([7, 8, 16, 21, 40])):x}{rng.choice([';', ''])}" for _ in range(100)]
    values = ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(3000)] + ["", "no entity", None]
    want = [None if v is None else html.unescape(v) for v in values]
    assert column(spark, values, text.unescaped) == want


def test_html_by_hand(spark):
    x = "um<strong>dois</strong><mark class='y'>tres</mark><div>quatro</div>cinco<bold>seis</bold>"
    assert column(spark, [x], text.html_spaced) == ["um dois tres quatrocincoseis"]
    assert column(spark, [x], text.html_bare) == ["umdoistresquatrocincoseis"]
    page = "a<script>x < 1</script>b<style>\n</style>c<br/>d</p> \n\xa0\n e&copy2 &#150;</h2>f "
    assert column(spark, [page], text.html_text) == ["a b c\nd\n\n e©2 –\nf"]
    assert column(spark, ["<x>&lt;![CDATA[a &amp; b]]></x><![CDATA[c]]&gt;"], text.cdata) == ["a & bc"]


def test_entities_with_their_semicolon_alone(spark):
    values = ["a &amp</h1>", "&copy2 &copy; &notit; &not; &#65 &#65; &#x41 &#x41;", "&amp;lt; &none; & &&amp;"]
    assert column(spark, values, lambda c: text.html_text(c, ended=True)) == ["a &amp", "&copy2 © &notit; ¬ &#65 A &#x41 A", "&lt; &none; & &&"]


def test_dates_that_do_not_exist_stay(spark):
    given = ["2020-02-29T10:00:00Z", "2021-02-29T10:00:00", "2020-13-45T00", "2020-01-02T25:00", "2020-01-02T00", "20201345", "2020-01-02", "02/01/2020", ""]
    want = ["29/02/2020", "2021-02-29T10:00:00", "2020-13-45T00", "2020-01-02T25:00", "02/01/2020", "45/13/2020", "2020-01-02", "02/01/2020", ""]
    assert column(spark, given, text.brazilian_date) == want


@pytest.mark.parametrize(
    ("said", "outcome"),
    [
        ("RECURSO PROVIDO", "granted"), ("Recurso não provido", "refused"), ("RECURSO DESPROVIDO", "refused"), ("Apelações improvidas", "refused"), ("pedido não procedente", "refused"), ("julgo improcedente", "refused"), ("Procedência", "granted"),
        ("nego-lhe provimento", "refused"), ("a que se nega provimento", "refused"), ("nega seguimento ao agravo", "refused"), ("dá-se parcial provimento", "granted"), ("PROVIMENTO PARCIAL", "granted"), ("deu provimento", "granted"), ("não merece provimento", "refused"),
        ("denega-se a segurança", "refused"), ("concessão da segurança", "granted"), ("concedida a ordem", "granted"), ("não foi concedida a ordem", "refused"), ("concessionária de energia", None), ("contrato de concessão de rodovia", None), ("providências", None), ("procedente dos autos", "granted"), ("", None),
    ],
)
def test_outcomes_by_hand(spark, said, outcome):
    assert column(spark, [said], rules.outcome) == [outcome]


def test_official_citation(spark):
    raw = "EMENTA:  Um\n&lt;b&gt; caso. (TNU, velho)  (TNU, Rel.\n Fulano&nbsp;de Tal, 2020) (fim)"
    got = spark.range(1).select(records.official_citation(F.lit(raw), "TNU,").alias("c"), records.official_citation(F.lit("sem"), "TNU,").alias("none")).first()
    assert got.c.citation == "(TNU, Rel. Fulano de Tal, 2020)" and got.c.summary == "Um <b> caso. (TNU, velho) (TNU, Rel. Fulano de Tal, 2020) (fim)"
    assert got.none.citation is None and got.none.summary == "sem"


def test_fuzzy_takes_terms_without_words(spark):
    tok = F.array(F.lit("casa"), F.lit("casas"))
    assert spark.range(1).select(search.fuzzy(tok, "--"), search.fuzzy(tok, "cosa", 1)).first()[:] == (False, True)
