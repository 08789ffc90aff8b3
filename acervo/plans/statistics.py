"""Queries over rulings and demand: positions, facets, trends, rates, fees, scores."""

from __future__ import annotations

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from acervo.functions import records
from acervo.functions.text import padded
from acervo.operators import accrual, files, merging, panels, rules
from acervo.plans.registry import query


def rulings(t):
    return t("lineitem").withColumn("ordem", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


@query("""
WITH p AS (SELECT l_partkey, l_returnflag, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS first FROM lineitem GROUP BY ALL)
SELECT l_partkey, count(*)::BIGINT AS n_positions, ((sum(n) * sum(n) - sum(n * n)) / 2)::BIGINT AS n_pairs, min(first)::BIGINT AS first FROM p GROUP BY ALL HAVING count(*) > 1""")
def contradictions(t, spark):
    return panels.contradictions(rulings(t), ["l_partkey"], "l_returnflag")


@query("SELECT l_orderkey, count(*)::BIGINT AS n, count(DISTINCT l_linestatus)::BIGINT AS n_positions, CASE WHEN count(*) = 1 THEN 'ISOLATED' WHEN count(DISTINCT l_linestatus) > 1 THEN 'CONTRADICTION' ELSE 'ALIGNED' END AS status FROM lineitem GROUP BY ALL")
def thematic_groups(t, spark):
    return panels.thematic(t("lineitem"), "l_orderkey", "l_linestatus")


@query("""
WITH c AS (SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_partkey, sum(n)::BIGINT AS n, max(n)::BIGINT AS most, CASE WHEN sum(n) < 5 THEN 'SCARCE' WHEN max(n) >= sum(n) * 0.8::DOUBLE THEN 'CONSOLIDATED' ELSE 'EVOLVING' END AS status FROM c GROUP BY ALL""")
def precedent_alignment(t, spark):
    return panels.alignment(t("lineitem"), "l_partkey", "l_returnflag")


@query("SELECT o_custkey, o_orderkey, rank::INTEGER AS rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderdate, o_orderkey) AS rank FROM orders) WHERE rank <= 5")
def capped_alerts(t, spark):
    return panels.capped(t("orders"), "o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "rank")


@query("SELECT md5(text) AS digest, count(DISTINCT source)::BIGINT AS n_sources, count(*)::BIGINT AS n FROM documents GROUP BY ALL HAVING count(DISTINCT source) >= 2")
def source_overlap(t, spark):
    return panels.overlap(t("documents").withColumn("digest", F.md5("text")), ["digest"], "source")


@query("SELECT source, lang, count(*)::BIGINT AS n, (CASE WHEN grouping(source) = 1 THEN 2 ELSE 0 END + CASE WHEN grouping(lang) = 1 THEN 1 ELSE 0 END)::BIGINT AS level FROM documents GROUP BY CUBE (source, lang)")
def demand_cube(t, spark):
    return panels.demand(t("documents"), "source", "lang")


@query("""
WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY lang) AS total, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS k FROM c)
SELECT lang, total::BIGINT AS n, source, round(n * 100.0::DOUBLE / total, 2) AS share FROM r WHERE k = 1""")
def demand_concentration(t, spark):
    return panels.concentration(t("documents"), "source", "lang")


@query("WITH m AS (SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m') AS month, count(*)::BIGINT AS n FROM orders GROUP BY ALL) SELECT *, n - lag(n) OVER (PARTITION BY o_orderstatus ORDER BY month) AS change FROM m")
def monthly_trend(t, spark):
    return panels.trend(t("orders"), "o_orderdate", "o_orderstatus")


@query("""
SELECT o_custkey, count(*) FILTER (o_orderdate >= TIMESTAMP '2001-01-01')::BIGINT AS n_recent, count(*) FILTER (o_orderdate >= TIMESTAMP '1999-01-01')::BIGINT AS n_since,
  CASE WHEN count(*) FILTER (o_orderdate >= TIMESTAMP '2001-01-01') > 0 THEN 'CURRENT' WHEN count(*) FILTER (o_orderdate >= TIMESTAMP '1999-01-01') > 0 THEN 'STALE' ELSE 'FROZEN' END AS status FROM orders GROUP BY ALL""")
def coverage_verdicts(t, spark):
    day = lambda x: F.lit(x).cast("timestamp_ntz")
    return panels.coverage(t("orders"), "o_custkey", F.col("o_orderdate"), day("2001-01-01"), day("1999-01-01"))


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k = 1")
def earliest_records(t, spark):
    return merging.first_of_each(t("orders"), [F.col("o_custkey")], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderdate")


RATES = [("1-URGENT", "1995-01-01", "1996-06-14", 6), ("1-URGENT", "1996-06-15", None, 9), ("2-HIGH", "1995-01-01", "2000-12-31", 12), ("5-LOW", "1998-01-10", "1998-01-20", 1)]
DAY = datetime.date.fromisoformat


@query(f"""
WITH rates(k, s, e, rate) AS (VALUES {', '.join(f"('{k}', DATE '{s}', {f"DATE '{e}'" if e else 'NULL'}, {r})" for k, s, e, r in RATES)})
SELECT o_orderkey, rate::INTEGER AS rate FROM orders LEFT JOIN rates ON o_orderpriority = k AND o_orderdate::DATE >= s AND o_orderdate::DATE <= coalesce(e, DATE '2002-12-31')""")
def rate_periods(t, spark):
    rates = spark.createDataFrame([(k, DAY(s), DAY(e) if e else None, r) for k, s, e, r in RATES], "o_orderpriority string, start date, end date, rate int").withColumn("last", F.to_date(F.lit("2002-12-31")))
    return rules.rates_at(t("orders").withColumn("day", F.col("o_orderdate").cast("date")), rates, "o_orderpriority", "day").select("o_orderkey", "rate")


BANDS_SQL = " + ".join(f"greatest(0, {f'least(w, {hi})' if hi else 'w'} - {lo}) * {low}" for lo, hi, low, _ in rules.BANDS)


@query(f"WITH a AS (SELECT o_orderkey, round(o_totalprice, 0)::DECIMAL(18, 4) AS w FROM orders) SELECT o_orderkey, ({BANDS_SQL})::DOUBLE AS fee FROM a")
def fee_bands(t, spark):
    wages = F.round("o_totalprice", 0).cast("decimal(18,4)")
    return t("orders").select("o_orderkey", rules.by_bands(wages).cast("double").alias("fee"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'not applicable' WHEN c_custkey % 7 = 0 THEN 'special regime'
  WHEN c_acctbal < CASE c_mktsegment WHEN 'BUILDING' THEN 1000 WHEN 'MACHINERY' THEN 500 ELSE 100 END THEN 'below the limit' WHEN c_nationkey < 5 THEN 'binding precedent' ELSE 'review' END AS decision FROM customer""")
def mandatory_review(t, spark):
    entity = F.when(F.col("c_mktsegment") == "BUILDING", "UNIAO").when(F.col("c_mktsegment") == "MACHINERY", "ESTADO").otherwise("MUNICIPIO")
    return t("customer").select("c_custkey", rules.review(entity, F.col("c_acctbal"), F.col("c_custkey") % 10 == 0, F.col("c_custkey") % 7 == 0, F.col("c_nationkey") < 5).alias("decision"))


@query("SELECT o_orderkey, least(date_diff('day', o_orderdate::DATE, DATE '2001-09-01') * 33, 2000)::INTEGER AS fine FROM orders")
def fines(t, spark):
    return t("orders").select("o_orderkey", rules.fine(F.datediff(F.to_date(F.lit("2001-09-01")), F.col("o_orderdate").cast("date"))).alias("fine"))


@query("""
WITH s AS (SELECT p_partkey, (p_size * 2)::DOUBLE AS a, (p_partkey % 101)::DOUBLE AS b FROM part),
w AS (SELECT p_partkey, round((a * 30 + b * 25 + a * 20 + b * 15 + a * 10) / 100, 2) AS deviation, round((b * 25 + a * 25 + b * 20 + a * 15 + b * 15) / 100, 2) AS causation FROM s)
SELECT p_partkey, deviation, causation, CASE WHEN p_partkey % 13 = 0 THEN 'excluded' WHEN p_partkey % 11 = 0 THEN 'no harm' WHEN least(deviation, causation) >= 60 THEN 'characterised' WHEN least(deviation, causation) >= 40 THEN 'doubtful' ELSE 'not characterised' END AS conclusion FROM w""")
def weighted_scores(t, spark):
    a, b = (F.col("p_size") * 2).cast("double"), (F.col("p_partkey") % 101).cast("double")
    s = t("part").select("p_partkey", rules.weighted([a, b, a, b, a], rules.DEVIATION).alias("deviation"), rules.weighted([b, a, b, a, b], rules.CAUSATION).alias("causation"))
    return s.withColumn("conclusion", rules.conclusion(F.col("deviation"), F.col("causation"), F.col("p_partkey") % 11 != 0, F.col("p_partkey") % 13 == 0))


@query("SELECT p_partkey, ['BAIXA', 'MEDIA', 'ALTA'][least(p_size % 3, p_partkey % 3) + 1] AS reliability FROM part")
def source_reliability(t, spark):
    at = lambda c: F.get(F.array(*map(F.lit, rules.RELIABILITY)), F.expr(f"cast({c} % 3 as int)"))
    return t("part").select("p_partkey", rules.reliability(at("p_size"), at("p_partkey")).alias("reliability"))


@query("SELECT l_orderkey, count(*)::BIGINT AS n, count(*) FILTER (l_quantity > 25)::BIGINT AS n_for, CASE WHEN count(*) FILTER (l_quantity > 25) * 2 > count(*) THEN 'PROVEN' WHEN count(*) FILTER (l_quantity > 25) * 2 < count(*) THEN 'REFUTED' ELSE 'UNDECIDED' END AS status FROM lineitem GROUP BY ALL")
def evidence_map(t, spark):
    return rules.evidence_map(t("lineitem"), "l_orderkey", F.col("l_quantity") > 25)


@query("""
WITH q AS (SELECT l_orderkey, count(*)::BIGINT AS n, count(*) FILTER (l_returnflag = 'N')::BIGINT AS n_valid FROM lineitem GROUP BY ALL)
SELECT *, greatest(5 - n, 0)::BIGINT AS missing, CASE WHEN n_valid >= 3 THEN 'CONSOLIDATE' WHEN n_valid > 0 THEN 'PARTIAL' ELSE 'NONE' END AS status FROM q""")
def quorums(t, spark):
    return panels.quorum(t("lineitem"), "l_orderkey", F.col("l_returnflag") == "N")


@query("""
WITH q AS (SELECT source, count(*)::BIGINT AS n_pages, count(*) FILTER (length(text) >= 500)::BIGINT AS n_adequate FROM documents GROUP BY ALL)
SELECT *, round(n_adequate * 100.0::DOUBLE / n_pages, 2) AS share, n_adequate / n_pages < 0.7 AS next_stage FROM q""")
def page_adequacy(t, spark):
    return panels.page_quality(t("documents"), "source", "text")


@query("""
WITH e AS (SELECT source, lang, count(*) AS n, count(*) FILTER (length(text) >= 500) AS good FROM documents GROUP BY ALL),
q AS (SELECT source, sum(n)::BIGINT AS n_pages, sum(good)::BIGINT AS n_adequate, list({'l': lang, 'n': n} ORDER BY lang) AS m FROM e GROUP BY ALL)
SELECT source, n_pages, n_adequate, array_to_string(list_transform(m, lambda x: x.l || ':' || x.n || ':' || round(x.n * 10000 / n_pages)::BIGINT), ',') AS methods,
  CASE WHEN n_adequate / n_pages >= 0.95 THEN 'EXCELENTE' WHEN n_adequate / n_pages >= 0.85 THEN 'BOA' WHEN n_adequate / n_pages >= 0.7 THEN 'REGULAR' ELSE 'BAIXA' END AS quality, n_adequate / n_pages < 0.7 AS next_stage FROM q""")
def page_methods(t, spark):
    out = panels.page_quality(t("documents"), "source", "text", method="lang")
    said = F.transform("methods", lambda m: F.concat_ws(":", m["method"], m["n"].cast("string"), F.round(m["percent"] * 100).cast("bigint").cast("string")))
    return out.withColumn("methods", F.array_join(said, ","))


@query("SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size::BIGINT, p_size || '_' || p_name)::INTEGER AS place FROM part WHERE p_partkey % 7 <> 0")
def numeric_file_order(t, spark):
    """A part's name is unknown (null) where its size or name is; those of the keys that 7 divides, or of none, begin with an underscore."""
    file = F.when(F.col("p_partkey") % 7 != 0, F.concat("p_size", F.lit("_"), "p_name")).otherwise(F.concat(F.lit("_"), F.concat_ws("_", "p_size", "p_name")))
    return files.merge_order(t("part").withColumn("file", file), "p_brand", "file", "p_partkey", unnamed="p_size").select("p_brand", "p_partkey", "place")


@query("SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def destination_anti_join(t, spark):
    return files.not_there(t("documents").select("doc_id"), t("labels"), "doc_id")


@query("SELECT doc_id, coalesce(n_name, code) AS label FROM (SELECT doc_id, (doc_id % 40)::VARCHAR AS code FROM documents) LEFT JOIN (SELECT n_nationkey::VARCHAR AS code, n_name FROM nation) USING (code)")
def code_labels(t, spark):
    names = t("nation").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label"))
    return records.labelled_codes(t("documents").select("doc_id", (F.col("doc_id") % 40).cast("string").alias("code")), names, "code").select("doc_id", "label")


@query("SELECT s_suppkey, coalesce(n_name, s_nationkey::VARCHAR) AS label, r_name AS grp FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def label_lookup(t, spark):
    return t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("s_suppkey", F.coalesce("n_name", F.col("s_nationkey").cast("string")).alias("label"), F.col("r_name").alias("grp"))


@query("SELECT n_name AS code, 1::BIGINT AS n FROM nation WHERE n_name NOT IN (SELECT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal > 5000)")
def unknown_codes(t, spark):
    known = t("supplier").where("s_acctbal > 5000").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("code"))
    return records.unknown(t("nation").select(F.col("n_name").alias("code")), known, "code")


@query("""
WITH k AS (SELECT o_custkey, o_orderkey, o_orderkey % 8 AS i FROM orders)
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN i < 6 THEN i ELSE 6 END, o_orderkey)::INTEGER AS rank FROM k QUALIFY rank <= 5""")
def alert_priorities(t, spark):
    kinds = F.array(*[F.lit(f" {k.upper()}") for k in panels.ALERTS], F.lit("other"), F.lit(""))
    rows = t("orders").select("o_custkey", "o_orderkey", F.get(kinds, (F.col("o_orderkey") % 8).cast("int")).alias("kind"))
    return panels.pressing(rows, "o_custkey", "kind", "o_orderkey").select("o_custkey", "o_orderkey", "rank")


@query("""
WITH k AS (SELECT o_orderkey, o_orderkey % 5 AS i, round(o_totalprice * 100)::BIGINT AS cents FROM orders)
SELECT o_orderkey, CASE i WHEN 0 THEN 151800000 WHEN 1 THEN 75900000 WHEN 2 THEN 15180000 WHEN 3 THEN 75900000 END::BIGINT AS least,
  CASE i WHEN 0 THEN cents >= 151800000 WHEN 1 THEN cents >= 75900000 WHEN 2 THEN cents >= 15180000 WHEN 3 THEN true ELSE cents > 20000000 END AS reviewed,
  CASE i WHEN 0 THEN (cents * 5 + 50) // 100 WHEN 1 THEN 0 WHEN 2 THEN (cents * 10 + 50) // 100 WHEN 3 THEN (cents * 10 + 50) // 100 END::BIGINT AS fee_least, CASE i WHEN 0 THEN (cents * 5 + 50) // 100 WHEN 1 THEN (cents * 10 + 50) // 100 WHEN 2 THEN (cents * 20 + 50) // 100 WHEN 3 THEN (cents * 10 + 50) // 100 END::BIGINT AS fee_most FROM k""")
def entity_values(t, spark):
    i, value = (F.col("o_orderkey") % 5).cast("int"), F.col("o_totalprice").cast("decimal(18,2)")
    pick = lambda *xs: F.get(F.array(*map(F.lit, xs)), i)
    wage, entity = F.lit("1518.00").cast("decimal(10,2)"), pick("Union", "capital", "other municipality", "state", "nobody")
    kind = pick("judgment", "judgment", "judgment", "writ of mandamus granted", "expropriation")
    fees = rules.procedure_fees(value, pick("monitory without embargoes", "monitory, embargoes rejected", "monitory, embargoes accepted", "execution", "none"))
    cents = lambda c: (c * 100).cast("bigint")
    return t("orders").select("o_orderkey", cents(rules.review_value(entity, wage)).alias("least"), rules.reviewed(entity, value, wage, kind, F.lit(100_000)).alias("reviewed"), cents(fees["least"]).alias("fee_least"), cents(fees["most"]).alias("fee_most"))


@query("SELECT 'customer' AS base, c_custkey AS id, c_name AS name, c_mktsegment AS area, NULL::DOUBLE AS price FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL, NULL FROM supplier UNION ALL SELECT 'part', p_partkey, p_name, NULL, p_retailprice FROM part")
def united_bases(t, spark):
    a = t("customer").select(F.lit("customer").alias("base"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("area"))
    b = t("supplier").select(F.lit("supplier").alias("base"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    c = t("part").select(F.lit("part").alias("base"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


@query("SELECT l_returnflag || '-' || CASE WHEN length(k::VARCHAR) < 3 THEN lpad(k::VARCHAR, 3, '0') ELSE k::VARCHAR END AS id, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_suppkey ORDER BY l_orderkey, l_linenumber) AS k FROM lineitem)")
def prefixed_numbers(t, spark):
    k = F.row_number().over(Window.partitionBy("l_returnflag", "l_suppkey").orderBy("l_orderkey", "l_linenumber"))
    return t("lineitem").select(F.concat_ws("-", "l_returnflag", padded(k, 3)).alias("id"), "l_orderkey", "l_linenumber")


@query("SELECT event_type, count(*)::BIGINT AS n, sum((props->>'$.k')::BIGINT)::BIGINT AS total, count(*) FILTER (value IS NULL)::BIGINT AS failed FROM events GROUP BY ALL")
def json_counters(t, spark):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"), F.count_if(F.col("value").isNull()).alias("failed"))


@query("SELECT 'de' AS tenant, count(*)::BIGINT AS n, (SELECT count(*) FROM documents WHERE lang IN ('de', 'fr'))::BIGINT AS total FROM documents WHERE lang = 'de' UNION ALL SELECT 'fr', count(*), (SELECT count(*) FROM documents WHERE lang IN ('de', 'fr')) FROM documents WHERE lang = 'fr'")
def tenant_totals(t, spark):
    return panels.totals({x: t("documents").where(F.col("lang") == x) for x in ("de", "fr")}, "tenant")


@query("SELECT coalesce(n_name, 'none') AS court, count(*)::BIGINT AS n FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL")
def court_totals(t, spark):
    rows = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return panels.per_court(rows, F.coalesce("n_name", F.lit("none")))


@query("""
SELECT count(*)::BIGINT AS n, count(*) FILTER (o_orderstatus = 'F')::BIGINT AS n_ok, count(*) FILTER (o_orderstatus = 'P')::BIGINT AS n_red, count(*) FILTER (o_totalprice > 300000)::BIGINT AS n_pending,
  round(count(*) FILTER (o_orderstatus = 'F') * 100.0::DOUBLE / count(*), 1) AS share_ok FROM orders""")
def list_metrics(t, spark):
    ok = F.col("o_orderstatus") == "F"
    return panels.metrics(t("orders"), ok=ok, red=F.col("o_orderstatus") == "P", pending=F.col("o_totalprice") > 300000)


@query("""
WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY l_suppkey) AS total, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) AS k FROM c)
SELECT l_suppkey, total::BIGINT AS n, l_returnflag AS tendency, round(n * 100.0::DOUBLE / total, 2) AS share FROM r WHERE k = 1""")
def panel_tendencies(t, spark):
    return panels.concentration(t("lineitem"), "l_returnflag", "l_suppkey").withColumnRenamed("l_returnflag", "tendency")


#: Headers and dispositions with the outcome that a reader gives them, written by hand.
HEADERS = [("RECURSO PROVIDO", "granted"), ("RECURSO NÃO PROVIDO", "refused"), ("Apelação desprovida.", "refused"), ("PROCEDÊNCIA DO PEDIDO", "granted"), ("Pedido não procedente", "refused"), ("CONCESSÃO DA SEGURANÇA", "granted"), ("Concessionária de energia", None)]
DISPOSITIONS = [("Dá-se parcial provimento", "granted"), ("Nego-lhe provimento", "refused"), ("NEGA SEGUIMENTO ao recurso", "refused"), ("Julga-se improcedente", "refused"), ("Denega-se a segurança", "refused"), ("concedeu a ordem", "granted"), ("remetam-se os autos", None)]


def sql_outcome(pairs: list, at: str) -> str:
    return f"CASE {at} " + " ".join(f"WHEN {i} THEN '{x}'" for i, (_, x) in enumerate(pairs) if x) + " END"


@query(f"""
WITH c AS (SELECT l_orderkey, l_linenumber, {sql_outcome(HEADERS, f'l_orderkey % {len(HEADERS)}')} AS h, {sql_outcome(DISPOSITIONS, f'(l_orderkey // {len(HEADERS)} + l_linenumber) % {len(DISPOSITIONS)}')} AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN h IS NULL OR d IS NULL THEN 'unsure' WHEN h = d THEN 'consistent' ELSE 'contradiction' END AS verdict,
  CASE WHEN h IS NULL OR d IS NULL THEN 'YELLOW' WHEN h = d THEN 'GREEN' ELSE 'RED' END AS colour FROM c""")
def header_consistency(t, spark):
    at = lambda pairs, i: F.get(F.array(*[F.lit(x) for x, _ in pairs]), i.cast("int"))
    header = at(HEADERS, F.col("l_orderkey") % len(HEADERS))
    close = at(DISPOSITIONS, (F.expr(f"l_orderkey div {len(HEADERS)}") + F.col("l_linenumber")) % len(DISPOSITIONS))
    verdict = rules.consistent(header, close)
    return t("lineitem").select("l_orderkey", "l_linenumber", verdict.alias("verdict"), rules.severity_colour(verdict).alias("colour"))


@query("""
WITH c AS (SELECT o_custkey, o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium' ELSE 'low' END AS severity, o_orderkey % 7 AS part, o_totalprice AS size FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, part ORDER BY list_position(['critical', 'high', 'medium', 'low'], severity), size, o_orderkey) AS k FROM c)
SELECT o_custkey, part, o_orderkey, severity FROM r WHERE k = 1""")
def corrections(t, spark):
    kind = F.col("o_orderpriority")
    rows = t("orders").select("o_custkey", "o_orderkey", F.when(kind == "1-URGENT", "critical").when(kind == "2-HIGH", "high").when(kind == "3-MEDIUM", "medium").otherwise("low").alias("severity"), (F.col("o_orderkey") % 7).alias("part"), "o_totalprice")
    return rules.kept_corrections(rows, ["o_custkey", "part"], "severity", ["o_totalprice", "o_orderkey"]).select("o_custkey", "part", "o_orderkey", "severity")


@query("""
SELECT o_orderkey, floor(o_totalprice * CASE WHEN o_orderkey % 3 = 0 THEN 0.05::DOUBLE WHEN o_orderkey % 3 = 1 THEN 0.1::DOUBLE ELSE 0.2::DOUBLE END)::BIGINT AS fee, floor(o_totalprice * (1 + 0.01::DOUBLE * (o_orderkey % 12)) + 0.001)::BIGINT AS due, CASE WHEN o_orderkey % 2 = 0 THEN 50 END AS percent,
  CASE WHEN o_orderkey % 10 >= 8 THEN 'accept' WHEN o_orderkey % 10 = 7 THEN 'second model' ELSE 'human' END AS tier FROM orders""")
def fee_variants(t, spark):
    k = F.col("o_orderkey")
    variant = F.when(k % 3 == 0, "monitory").when(k % 3 == 1, "execution").otherwise("other")
    standard = F.when(k % 2 == 0, "preponderance").otherwise("beyond reasonable doubt")
    monthly = F.array_repeat(F.lit(0.01).cast("decimal(18,6)"), (k % 12).cast("int"))
    return t("orders").select("o_orderkey", F.floor(rules.flat_fee(F.col("o_totalprice"), variant, F.lit(0.2))).alias("fee"), F.floor(rules.simple_interest(F.col("o_totalprice"), monthly) + 0.001).alias("due"), rules.proof_percent(standard).alias("percent"), rules.routed((k % 10) / 10).alias("tier"))


#: Monthly rates in millionths of two periods: an index with interest up to 1996-12, one rate for both from 1997-01 on.
RATES_SQL = """
months AS (SELECT unnest(generate_series(DATE '1992-01-01', DATE '1999-12-01', INTERVAL 1 MONTH))::DATE AS month),
rates AS (SELECT month, month < DATE '1997-01-01' AS early, CASE WHEN month < DATE '1997-01-01' THEN 3000 + month(month) * 100 ELSE 0 END AS correction, CASE WHEN month < DATE '1997-01-01' THEN 5000 ELSE 8000 + year(month) % 10 END AS interest FROM months)"""


@query(f"""
WITH {RATES_SQL},
debts AS (SELECT o_orderkey, round(o_totalprice * 100)::HUGEINT AS cents, date_trunc('month', o_orderdate)::DATE AS first, (date_trunc('month', o_orderdate) + to_months((o_orderkey % 60)::INTEGER))::DATE AS last FROM orders),
sums AS (SELECT o_orderkey, cents, coalesce(sum(correction) FILTER (early), 0) AS c, coalesce(sum(interest) FILTER (early), 0) AS i, coalesce(sum(interest) FILTER (NOT early), 0) AS l FROM debts LEFT JOIN rates ON month BETWEEN first AND last GROUP BY ALL),
one AS (SELECT *, (cents * (1000000 + c) + 500000) // 1000000 AS corrected FROM sums), two AS (SELECT *, (corrected * i + 500000) // 1000000 AS interest FROM one)
SELECT o_orderkey, corrected::BIGINT AS corrected, interest::BIGINT AS interest, (((corrected + interest) * l + 500000) // 1000000)::BIGINT AS later_interest, (corrected + interest + ((corrected + interest) * l + 500000) // 1000000)::BIGINT AS total FROM two""")
def accruals(t, spark):
    months = spark.sql("SELECT explode(sequence(DATE'1992-01-01', DATE'1999-12-01', interval 1 month)) AS month")
    early = F.col("month") < F.lit("1997-01-01").cast("date")
    rate = lambda c: (c / 1_000_000).cast(accrual.RATE)
    rates = months.select("month", F.when(early, "index").otherwise("base rate").alias("period"), rate(F.when(early, 3000 + F.month("month") * 100).otherwise(0)).alias("correction"), rate(F.when(early, 5000).otherwise(8000 + F.year("month") % 10)).alias("interest"))
    begin = F.trunc("o_orderdate", "month")
    debts = t("orders").select("o_orderkey", F.col("o_totalprice").cast(accrual.MONEY).alias("owed"), begin.alias("first"), F.add_months(begin, (F.col("o_orderkey") % 60).cast("int")).alias("last"))
    out = accrual.statement(debts, rates, "index", "base rate", principal="owed", first="first", last="last")
    return out.select("o_orderkey", *[(F.col(c) * 100).cast("long").alias(c) for c in ("corrected", "interest", "later_interest", "total")])
