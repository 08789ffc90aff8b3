"""Source divergence audit: how the terms of each source differ from those of its language and of its other sources.

Terms are counted in Arrow batches, summed by (language, source, term) in one
shuffle, and kept if enough documents of the language have them.  A group
prices each kept term at p = 1 + floor(SCALE * (count + 2) / (N + 2 V)); two
prices diverge by floor((p - q)^2 / (p + q)).  All of it is whole numbers.

Pairs of sources add up the divergence of all kept terms, most of which a
source lacks.  A term that neither has adds the same to every such pair, so the
sum starts from that baseline times V.  It is corrected for the terms that one
has, which depend on its count alone and so come from a histogram of counts,
and then, term by term, for those that both have.  The result has a row for
each pair of sources of a language; a term's rows meet once for each such
pair, are summed where they meet, and never leave the task as pairs.

Terms are ranked by radix selection.  Histograms over the values' bits, digit
by digit, narrow each group's kth value; terms above it are taken, and those
that tie with it are told apart by the first byte of their UTF-8 form that
differs among them, in histograms again.  A histogram has at most 2^DIGIT rows
a group, or 257 for bytes; no task sorts the terms of a group.

Defined results: null text, language and source are empty strings; a group
without kept terms has pairs and no terms, and if its language keeps none the
pairs have value zero; a language of one source has no pairs; repeated rows are
documents of their own; other columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

import os.path
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from acervo.llm import text as tx
from acervo.llm.common import stored
from acervo.llm.refine import looked_up

#: Documents that a kept term is in, what prices are scaled to and smoothed with, and the ranks reported for terms.
LEAST_DOCS, SCALE, ADDED, TERMS = 10, 1_000_000_000, 2, 10
#: Bits of a value that a histogram tells apart.
DIGIT = 10
#: Text that a task counts before it hands on its counts.
COUNT_BYTES = 8 << 20


def _letters() -> np.ndarray:
    """Every byte's place in a term: letters in lower case, bytes beyond ASCII as they are, all others a space."""
    table = np.full(256, 0x20, np.uint8)
    small = np.arange(ord("a"), ord("z") + 1)
    table[small], table[small - 32], table[128:] = small, small, np.arange(128, 256)
    return table


LETTERS = _letters()


def terms(column) -> tx.Words:
    """The terms of texts, in lower case."""
    t = tx.texts(column)
    data, offsets = tx.raw(t)
    return tx.words(pa.LargeStringArray.from_buffers(len(t), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(LETTERS[data])))


GROUP = ["lang", "source"]


def group_columns() -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in GROUP]


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, summed over batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches, limit=COUNT_BYTES):
            w = terms(b.column("text"))
            size = max(1, len(w.uniq))
            in_doc, n = np.unique(w.doc * size + w.codes, return_counts=True)
            lang, source = (b.column(c).dictionary_encode() for c in GROUP)
            group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            key, at = np.unique(group[in_doc // size] * size + in_doc % size, return_inverse=True)
            of_group = key // size
            found = [lang.dictionary.take(pa.array(of_group // len(source.dictionary))), source.dictionary.take(pa.array(of_group % len(source.dictionary)))]
            counts = [np.bincount(at, weights=n, minlength=len(key)).astype(np.int64), np.bincount(at, minlength=len(key))]
            yield pa.RecordBatch.from_arrays([*found, w.uniq.take(pa.array(key % size)).cast(pa.string()), *map(pa.array, counts)], ["lang", "source", "term", "n", "docs"])

    rows = docs.select("text", *group_columns())
    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(n: str, total: str, kept: str) -> str:
    """SQL for 1 + floor(SCALE * (n + ADDED) / (total + ADDED * kept)), in decimals, since the product outgrows 64 bits; null if nothing is kept."""
    return f"if({kept} > 0, 1 + (cast({n} + {ADDED} as decimal(19,0)) * {SCALE}bd) div cast({total} + {ADDED} * {kept} as decimal(20,0)), null)"


def apart(p: str, q: str) -> str:
    """SQL for the divergence of two prices, which are under 2^31."""
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def priced(docs: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """Every group with the sums and number of its language's kept terms and its price of an absent one; and every kept term of a group with both prices."""
    here = Window.partitionBy("lang", "term")
    counts = term_counts(docs).withColumns({"in_docs": F.sum("docs").over(here), "in_lang": F.sum("n").over(here), "lead": F.col("source") == F.min("source").over(here)})
    kept = stored(counts.where(F.col("in_docs") >= least_docs).drop("docs", "in_docs"), "terms")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("lead").alias("kept"))
    totals = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"), F.count("*").alias("n_terms"))
    every = docs.select(*group_columns()).distinct()
    filled = every.join(totals, GROUP, "left").join(langs, "lang", "left").na.fill(0, ["total", "n_terms", "lang_total", "kept"])
    groups = stored(filled.withColumn("absent", F.expr(price("0L", "total", "kept"))), "groups")
    met = looked_up(kept, groups, GROUP, "n_terms", kept.count())
    prices = {"p": F.expr(price("n", "total", "kept")), "q": F.expr(price("in_lang", "lang_total", "kept"))}
    return groups, stored(met.withColumns(prices).select(*GROUP, "term", "n", "p", "q", "absent"), "prices")


def pairs(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, item, value) of each two sources of a language, in both directions."""
    other = groups.select("lang", F.col("source").alias("other"), F.col("absent").alias("other_absent"))
    two = groups.join(other, "lang").where("source < other")
    base = two.select("lang", F.col("source").alias("x"), F.col("other").alias("y"), F.coalesce(F.col("kept") * F.expr(apart("absent", "other_absent")), F.lit(0)).alias("value"))
    ends = [F.least("source", "other").alias("x"), F.greatest("source", "other").alias("y")]
    like = terms.groupBy(*GROUP, "p", "absent").agg(F.count("*").alias("times"))
    one = like.join(other, "lang").where("source != other").groupBy("lang", *ends).agg(F.sum(F.col("times") * (F.expr(apart("p", "other_absent")) - F.expr(apart("absent", "other_absent")))).alias("value"))
    mine, theirs = (terms.select("lang", "term", F.col("source").alias(s), F.col("p").alias(p), F.col("absent").alias(a)) for s, p, a in (("x", "p", "a"), ("y", "q", "b")))
    excess = F.expr(f"{apart('p', 'q')} - {apart('p', 'b')} - {apart('a', 'q')} + {apart('a', 'b')}")
    both = mine.join(theirs, ["lang", "term"]).where("x < y").groupBy("lang", "x", "y").agg(F.sum(excess).alias("value"))
    value = base.unionByName(one).unionByName(both).groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("item")), F.struct(F.col("y").alias("source"), F.col("x").alias("item"))))
    return value.select("lang", ways.alias("way"), "value").select("lang", "way.*", "value")


@F.pandas_udf(IntegerType())
def differ_at(a: pd.Series, b: pd.Series) -> pd.Series:
    """The place, from 1, of the first byte in which two items differ; 0 if in none."""
    return pd.Series([0 if x == y else len(os.path.commonprefix([bytes(x), bytes(y)])) + 1 for x, y in zip(a, b, strict=True)], dtype="int32")


def narrowed(bins: DataFrame, group: list[str], order: Column) -> DataFrame:
    """Of each group's bins (bin, size, need), in this order, the one with the row that is still needed last, with `need` less the rows before it."""
    so_far = F.sum("size").over(Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    before = bins.withColumn("before", F.coalesce(so_far, F.lit(0))).where("before < need")
    return before.groupBy(*group).agg(F.max_by(F.struct("bin", "size", (F.col("need") - F.col("before")).alias("need"), "n"), "before").alias("cut")).select(*group, "cut.*")


def selected(rows: DataFrame, group: list[str], value: str, item: str, k: int) -> DataFrame:
    """The rows of each group that are among its k first by value, largest first, then item, in the order of UTF-8.

    rows: stored, values from 0, items distinct within a group."""
    whole, most = rows.agg(F.count("*"), F.max(value)).first()
    if not whole:
        return rows
    digits = range(0, max(1, int(most).bit_length()), DIGIT)
    cuts = None
    for shift in reversed(digits):
        digit = F.shiftright(value, shift).alias("bin")
        if cuts is None:
            bins = rows.groupBy(*group, digit).agg(F.count("*").alias("size")).withColumns({"need": F.lit(k).cast("long"), "n": F.sum("size").over(Window.partitionBy(*group))})
        else:
            within = looked_up(rows, cuts, group, "n", whole).where(F.shiftright(value, shift + DIGIT) == F.col("bin")).drop("bin", "size")
            bins = within.groupBy(*group, "need", "n", digit).agg(F.count("*").alias("size"))
        cuts = stored(narrowed(bins, group, F.desc("bin")), "cuts")
    met = looked_up(rows, cuts, group, "n", whole).where(F.col(value) >= F.col("bin"))
    tie = (F.col(value) == F.col("bin")) & (F.col("size") > F.col("need"))
    met = stored(met.withColumn("tie", tie).drop("n"), "met")
    taken, ties = met.where("not tie").select(*rows.columns), met.where("tie").select(*rows.columns, "need", F.col("size").alias("n"))
    while not ties.isEmpty():
        ends = ties.groupBy(*group).agg(F.min(item).cast("binary").alias("low"), F.max(item).cast("binary").alias("high"), F.first("n").alias("n"))
        places = stored(ends.select(*group, "n", differ_at("low", "high").alias("at")), "places")
        spread = stored(looked_up(ties.drop("n"), places, group, "n", whole).withColumn("byte", F.expr(f"substring(cast({item} as binary), at, 1)")), "bytes")
        cuts = stored(narrowed(spread.groupBy(*group, "need", "n", F.col("byte").alias("bin")).agg(F.count("*").alias("size")), group, F.asc("bin")), "cuts")
        met = looked_up(spread.drop("n", "need"), cuts, group, "n", whole).where(F.col("byte") <= F.col("bin"))
        met = stored(met.withColumn("tie", (F.col("byte") == F.col("bin")) & (F.col("size") > F.col("need")) & (F.col("at") > 0)).drop("n"), "met")
        taken, ties = taken.unionByName(met.where("not tie").select(*rows.columns)), met.where("tie").select(*rows.columns, "need", F.col("size").alias("n"))
    return taken


def ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def diverging(docs: DataFrame, least_docs: int = LEAST_DOCS, most: int = TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): each group's other sources by divergence, and the `most` terms that it has more often than its language."""
    groups, terms = priced(docs, least_docs)
    more = stored(terms.where("p > q").select(*GROUP, F.col("term").alias("item"), F.expr(apart("p", "q")).alias("value")), "more")
    top = ranked(selected(more, GROUP, "value", "item", most)).withColumn("part", F.lit("term"))
    return ranked(pairs(groups, terms)).withColumn("part", F.lit("pair")).unionByName(top).select(*GROUP, "part", "item", "value", "rank")


def oracle_sql() -> str:
    """The same in DuckDB's SQL, every group with every kept term."""
    p = lambda n, total: f"(1 + ({SCALE}::HUGEINT * ({n} + {ADDED})) // ({total} + {ADDED} * v))"
    f = "((p - q) * (p - q)) // (p + q)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found FROM documents),
each AS (SELECT nr, lang, source, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS in_lang FROM each GROUP BY lang, term HAVING count(DISTINCT nr) >= {LEAST_DOCS}),
counts AS (SELECT lang, source, term, count(*) AS n FROM each SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(in_lang) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT lang, source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {p('coalesce(c.n, 0)', 'total')} AS p, {p('in_lang', 'lang_total')} AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT lang, source, other AS item, sum({f}) AS value FROM (SELECT a.lang, a.source, b.source AS other, a.p, b.p AS q FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source) GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, {f} FROM dense WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM every
QUALIFY part = 'pair' OR rank <= {TERMS}"""
