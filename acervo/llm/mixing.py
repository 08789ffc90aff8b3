"""Mixing sources to target weights, in DataFrame functions alone.

The leaves of a domain - language - source tree get token budgets from the
root down.  Each node splits its budget among its children by their weights; a
child that cannot take its part (its documents times `max_epochs` are too few)
leaves the rest to its siblings, so a shortage moves to an ancestor's siblings
only when a whole subtree is used up.  Windows over sorted children do this in
one pass for each level.

A leaf's budget is met by whole epochs and a prefix of one more, in which its
documents are ordered by a seeded hash.  All that a leaf keeps of the prefix
is its cut, the key where the budget ends, which is found by sums over the
first three hex digits of the keys, the next three, and then the keys that
share all six: no task gets a leaf's documents, and documents meet only the
table of leaves.

Defined results: null leaf columns are empty strings; a null or empty text has
no tokens and is never taken; the place in the order comes from identifier and
text, so rows that repeat both share it, and where the budget ends among them
each gets the same whole part of what is left; a weight of zero or less, or
null, gives nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.llm.common import stored

LEAF = ["domain", "lang", "source"]
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of a key that each step of the search for the cut sums over.
DIGITS = 3

#: Production weights; what isn't named weighs 1.
DOMAINS = {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0}
LANGS = {"en": 6.0, "de": 2.0, "fr": 2.0}


def domain_of(source: Column) -> Column:
    """The production domains: sources are dealt to four by the number that ends their name."""
    number = F.regexp_extract(F.coalesce(source.cast("string"), F.lit("")), "([0-9]{1,9})$", 1).try_cast("int")
    return F.concat(F.lit("d"), (F.coalesce(number, F.lit(0)) % 4).cast("string"))


def weight(name: str, weights: dict[str, float]) -> Column:
    out = F.lit(1.0)
    for k, v in weights.items():
        out = F.when(F.col(name) == k, F.lit(float(v))).otherwise(out)
    return out


def measured(docs: DataFrame, *also: Column) -> DataFrame:
    """Each document's leaf, number of words and digest, and further columns."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(*also, "doc_id", domain_of(F.col("source")).alias("domain"), named("lang"), named("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"), F.substring(F.md5(F.coalesce(F.col("text"), F.lit(""))), 1, 16).alias("digest"))


def shared_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Splits each parent's `given` among its nodes, which have a weight and a capacity `cap`; adds `budget`.

    Sorted by capacity for each unit of weight, the nodes up to some place are
    filled and all others get one level times their weight: the highest of the
    levels that no node below them falls short of.
    """
    along = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), name)
    before = F.coalesce(F.sum("cap").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    lighter = F.coalesce(F.sum("weight").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(Window.partitionBy(*parent)) - lighter
    level = (F.col("given") - before) / after
    levels = nodes.where("weight > 0").withColumn("level", F.when(level <= F.col("cap") / F.col("weight"), level))
    highest = F.max("level").over(Window.partitionBy(*parent))
    return levels.withColumn("budget", F.least("cap", F.coalesce(highest * F.col("weight"), F.col("cap")))).drop("level", "weight", "given")


def leaf_plan(sized: DataFrame, fraction: float, max_epochs: int, domains: dict[str, float], langs: dict[str, float], sources: dict[str, float]) -> DataFrame:
    """For each leaf its tokens, whole epochs and the tokens of the part epoch."""
    leaves = sized.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0").withColumn("cap", F.col("tokens").cast("double") * max_epochs)
    by_lang = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"))
    by_domain = by_lang.groupBy("domain").agg(F.sum("cap").alias("cap"))
    top = by_domain.withColumn("weight", weight("domain", domains)).withColumn("given", F.sum("cap").over(Window.partitionBy()) / max_epochs * fraction)
    given = shared_out(top, [], "domain").select("domain", F.col("budget").alias("given"))
    middle = by_lang.withColumn("weight", weight("lang", langs)).join(given, "domain")
    given = shared_out(middle, ["domain"], "lang").select("domain", "lang", F.col("budget").alias("given"))
    bottom = leaves.withColumn("weight", weight("source", sources)).join(given, ["domain", "lang"])
    wanted = shared_out(bottom, ["domain", "lang"], "source").withColumn("wanted", F.floor(F.col("budget") + 1e-6))
    return wanted.select(*LEAF, "tokens", F.expr("wanted div tokens").alias("epochs"), F.expr("wanted % tokens").alias("rest"))


def key_of(seed: int) -> Column:
    """A document's place in the epoch that its leaf takes part of."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest"))


def cuts(sized: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """plan with each leaf's cut key, and what each row of that key gets; a leaf without a part epoch has none."""
    found = plan.where("rest > 0").withColumns({"cut": F.lit(""), "start": F.lit(0).cast("long"), "rows": F.lit(0).cast("long")})
    for step in (1, 2, 3):
        size = DIGITS * step if step < 3 else 32
        within = sized.join(found, LEAF).withColumn("key", key_of(seed)).where(F.substring("key", 1, DIGITS * (step - 1)) == F.col("cut"))
        sums = within.groupBy(*LEAF, "epochs", "rest", "start", F.substring("key", 1, size).alias("next")).agg(F.sum("n_tokens").alias("n"), F.count_if(F.col("n_tokens") > 0).alias("rows"))
        through = F.col("start") + F.sum("n").over(Window.partitionBy(*LEAF).orderBy("next").rowsBetween(Window.unboundedPreceding, 0))
        placed = sums.withColumn("through", through).where((F.col("through") >= F.col("rest")) & (F.col("through") - F.col("n") < F.col("rest")))
        found = stored(placed.select(*LEAF, "epochs", "rest", F.col("next").alias("cut"), (F.col("through") - F.col("n")).alias("start"), "rows"), "cuts")
    return plan.join(found.select(*LEAF, "cut", F.expr("(rest - start) div rows").alias("each")), LEAF, "left")


def taken(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """rows (with their leaf and n_tokens) with whole_epochs, part_tokens and taken_tokens."""
    part = F.when(F.col("key") < F.col("cut"), F.col("n_tokens")).when(F.col("key") == F.col("cut"), F.least("n_tokens", "each")).otherwise(F.lit(0))
    met = rows.join(plan, LEAF, "left").withColumn("key", key_of(seed)).withColumn("part_tokens", part.cast("long")).withColumn("whole_epochs", F.when(F.col("n_tokens") > 0, F.coalesce("epochs", F.lit(0))).otherwise(0).cast("long"))
    return met.withColumn("taken_tokens", F.col("whole_epochs") * F.col("n_tokens") + F.col("part_tokens")).drop("tokens", "epochs", "rest", "cut", "each", "key", "digest")


def planned(docs: DataFrame, fraction: float, max_epochs: int, seed: int, domains: dict[str, float], langs: dict[str, float], sources: dict[str, float]) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes and the table of leaves with their cuts."""
    sized = stored(measured(docs), "sized")
    plan = stored(leaf_plan(sized, fraction, max_epochs, domains, langs, sources), "leaves")
    return sized, stored(cuts(sized, plan, seed), "cuts")


def mixed(docs: DataFrame, fraction: float = 0.8, max_epochs: int = 3, seed: int = 7, domains: dict[str, float] = DOMAINS, langs: dict[str, float] = LANGS, sources: dict[str, float] = {}) -> DataFrame:
    """What the mixture takes of every document; the budget is `fraction` of all tokens."""
    sized, plan = planned(docs, fraction, max_epochs, seed, domains, langs, sources)
    return taken(sized, plan, seed).select("doc_id", *LEAF, "n_tokens", "whole_epochs", "part_tokens", "taken_tokens")


def mixture(docs: DataFrame, fraction: float, max_epochs: int, seed: int = 7, domains: dict[str, float] = DOMAINS, langs: dict[str, float] = LANGS, sources: dict[str, float] = {}) -> DataFrame:
    """The documents, with all their columns and whole texts, once for each epoch that takes any of their tokens.  Only the table of leaves joins them."""
    _, plan = planned(docs, fraction, max_epochs, seed, domains, langs, sources)
    sized = measured(docs, F.struct(*docs.columns).alias("whole"))
    times = F.col("whole_epochs") + (F.col("part_tokens") > 0).cast("long")
    return taken(sized, plan, seed).where(times > 0).select("whole", F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("epoch")).select("whole.*")


def oracle_sql(fraction: float = 0.8, max_epochs: int = 3, seed: int = 7, domains: dict[str, float] = DOMAINS, langs: dict[str, float] = LANGS) -> str:
    """The same in DuckDB's SQL, with one running sum over each leaf instead of the search for the cut."""
    case = lambda c, w: f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in w.items()) + " ELSE 1.0 END::DOUBLE"

    def level(name: str, table: str, parent: list[str], child: str) -> str:
        by = f"PARTITION BY {', '.join(parent)} " if parent else ""
        return f"""
{name}_levels AS (
  SELECT *, cap / weight AS ratio,
    (given - coalesce(sum(cap) OVER ({by}ORDER BY cap / weight, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER ({by}ORDER BY cap / weight, {child} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM {table} WHERE weight > 0),
{name}_out AS (
  SELECT *, least(cap, coalesce(max(CASE WHEN level <= ratio THEN level END) OVER ({by.strip()}) * weight, cap)) AS budget FROM {name}_levels)"""

    return f"""
WITH sized AS (
  SELECT doc_id, 'd' || (coalesce(try_cast(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS INTEGER), 0) % 4) AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS n_tokens, substr(md5(coalesce(text, '')), 1, 16) AS digest FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::DOUBLE * {max_epochs} AS cap FROM sized GROUP BY ALL HAVING sum(n_tokens) > 0),
by_lang AS (SELECT domain, lang, sum(cap) AS cap FROM leaves GROUP BY ALL),
by_domain AS (SELECT domain, sum(cap) AS cap, {case('domain', domains)} AS weight, sum(sum(cap)) OVER () / {max_epochs} * {fraction}::DOUBLE AS given FROM by_lang GROUP BY ALL),{level('d', 'by_domain', [], 'domain')},
langs AS (SELECT l.domain, l.lang, l.cap, {case('l.lang', langs)} AS weight, d.budget AS given FROM by_lang l JOIN d_out d USING (domain)),{level('l', 'langs', ['domain'], 'lang')},
sources AS (SELECT s.domain, s.lang, s.source, s.tokens, s.cap, 1.0::DOUBLE AS weight, l.budget AS given FROM leaves s JOIN l_out l USING (domain, lang)),{level('s', 'sources', ['domain', 'lang'], 'source')},
plan AS (SELECT domain, lang, source, floor(budget + 1e-6)::BIGINT // tokens AS epochs, floor(budget + 1e-6)::BIGINT % tokens AS rest FROM s_out),
keyed AS (SELECT z.*, epochs, rest, md5('{seed}:' || epochs || ':' || coalesce(doc_id::VARCHAR, '') || ':' || digest) AS key FROM sized z LEFT JOIN plan USING (domain, lang, source)),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - sum(n_tokens) OVER (PARTITION BY domain, lang, source, key) AS start, count(*) OVER (PARTITION BY domain, lang, source, key) AS n_rows FROM keyed),
done AS (SELECT *, CASE WHEN n_tokens > 0 THEN coalesce(epochs, 0) ELSE 0 END::BIGINT AS whole_epochs, greatest(0, least(n_tokens, (coalesce(rest, 0) - start) // n_rows))::BIGINT AS part_tokens FROM run)
SELECT doc_id, domain, lang, source, n_tokens, whole_epochs, part_tokens, (whole_epochs * n_tokens + part_tokens)::BIGINT AS taken_tokens FROM done"""
