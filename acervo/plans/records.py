"""Queries over search records."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo.functions import records, text
from acervo.operators import search
from acervo.plans.registry import query
from acervo.plans.texts import sql_norm


@query("""
WITH f AS (SELECT conv_id, turn, text, CASE WHEN contains(lower(role), 'user') THEN 'asked' WHEN contains(lower(role), 's') THEN 'answered' END AS field FROM conversations WHERE trim(text) != '')
SELECT conv_id, arg_min(text, turn) FILTER (field = 'asked') AS asked, arg_min(text, turn) FILTER (field = 'answered') AS answered FROM f WHERE field IS NOT NULL GROUP BY conv_id""")
def labelled_fields(t, spark):
    return records.labelled(t("conversations"), "conv_id", "turn", "role", "text", [("user", "asked"), ("s", "answered")])


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 's' || s_nationkey WHEN s_suppkey % 2 = 0 THEN s_name ELSE s_suppkey::VARCHAR END AS number, CASE WHEN s_suppkey % 3 = 0 THEN 'sumula' WHEN s_suppkey % 2 = 0 THEN 'acordao' ELSE 'key' END AS source FROM supplier")
def display_numbers(t, spark):
    k = F.col("s_suppkey")
    n = records.by_precedence(sumula=F.when(k % 3 == 0, F.concat(F.lit("s"), "s_nationkey")).otherwise(" "), acordao=F.when(k % 2 == 0, F.col("s_name")), key=k.cast("string"))
    return t("supplier").select("s_suppkey", n.alias("n")).select("s_suppkey", F.col("n.value").alias("number"), F.col("n.source").alias("source"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'TRU' || n_regionkey ELSE upper(n_name) END AS code FROM nation")
def region_codes(t, spark):
    return t("nation").select("n_nationkey", records.region_code(F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("Tru "), "n_regionkey", F.lit("ª Região"))).otherwise(F.col("n_name"))).alias("code"))


STATES = "TJAC TJAL TJAP TJAM TJBA TJCE TJDF TJES TJGO TJMA TJMT TJMS TJMG TJPA TJPB TJPR TJPE TJPI TJRJ TJRN TJRS TJRO TJRR TJSC TJSP TJSE TJTO"


@query(f"""
WITH asked AS (SELECT DISTINCT n_nationkey % 8 AS k FROM nation),
g(k, court, known) AS (VALUES (0, 'STF', true), (0, 'STJ', true), (0, 'TST', true), (0, 'STM', true), (0, 'TNU', true), (1, 'TJMMG', true), (1, 'TJMRS', true), (1, 'TJMSP', true), (2, 'TRF05', true), (3, 'TSE', false), (4, 'TRT12', true), (5, 'TRT03', true),
  {', '.join(f"(6, '{x}', true)" for x in STATES.split())}, (7, 'TRF01', true), (7, 'TRF02', true), (7, 'TRF03', true), (7, 'TRF04', true), (7, 'TRF05', true), (7, 'TRF06', true))
SELECT DISTINCT court, known FROM asked JOIN g USING (k)""")
def court_groups(t, spark):
    codes = ["Superiores", " tjms", "trf5", "TSE", "TRT12", "trt3 ", "tjs", "TRFs"]
    return records.expanded(t("nation").select(F.get(F.array(*map(F.lit, codes)), F.expr("cast(n_nationkey % 8 as int)")).alias("code")), "code")


@query("""
WITH asked AS (SELECT n_nationkey, ['tru', 'TR3', 'TRF6', 'TRU7', 'STJ'][n_nationkey % 5 + 1] AS code FROM nation),
g(code, court, known) AS (VALUES ('tru', 'TRU1', true), ('tru', 'TRU2', true), ('tru', 'TRU3', true), ('tru', 'TRU4', true), ('tru', 'TRU5', true), ('tru', 'TRU6', true), ('TR3', 'TR3', true), ('TRF6', 'TRF6', false), ('TRU7', 'TRU7', false), ('STJ', 'STJ', true))
SELECT DISTINCT court, known FROM asked JOIN g USING (code)""")
def federal_courts(t, spark):
    code = F.get(F.array(*map(F.lit, ["tru", "TR3", "TRF6", "TRU7", "STJ"])), F.expr("cast(n_nationkey % 5 as int)"))
    return records.expanded(t("nation").select(code.alias("code")), "code", records.FEDERAL, lambda c: F.upper(F.trim(c)))


@query("""
WITH h AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderdate, o_orderkey) AS h FROM orders GROUP BY ALL)
SELECT o_custkey, array_to_string(h[greatest(1, len(h) - 4):], ',') AS last5, array_to_string(h[1:3], ',') AS first3 FROM h""")
def history_ends(t, spark):
    h = t("orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey"))).alias("h"))
    text = lambda c: F.array_join(F.transform(c, lambda x: x["o_orderkey"].cast("string")), ",")
    return h.select("o_custkey", text(records.last_of(F.col("h"), 5)).alias("last5"), text(records.first_of(F.col("h"), 3)).alias("first3"))


@query("""SELECT l_orderkey, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) FILTER (l_linestatus = 'O') AS active FROM lineitem GROUP BY ALL""")
def active_suspensions(t, spark):
    s = t("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("nr"), (F.col("l_linestatus") == "O").alias("ativa")))).alias("s"))
    return s.select("l_orderkey", F.nullif(F.array_join(F.transform(records.active(F.col("s")), lambda x: x["nr"].cast("string")), ","), F.lit("")).alias("active"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1996-02-01' AND DATE '1996-03-31' UNION ALL SELECT o_orderkey FROM orders WHERE o_orderdate::DATE <= DATE '1995-01-31'")
def date_ranges(t, spark):
    day = F.col("o_orderdate").cast("date")
    o = t("orders")
    return o.where(records.in_range(day, "1996-02-01", "1996-03-31", both=True)).select("o_orderkey").unionAll(o.where(records.in_range(day, None, "1995-01-31")).select("o_orderkey"))


KINDS = ["RG", "rr", "IAC", "SUM", "SV", "ADPF", "IRDR", "X", "adi"]


@query("""
SELECT p_partkey,
  CASE p_size % 9 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 5 WHEN 3 THEN 4 WHEN 4 THEN 3 WHEN 5 THEN 1 WHEN 6 THEN 5 WHEN 7 THEN 6 WHEN 8 THEN 1 END AS first,
  CASE p_size % 9 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 4 WHEN 5 THEN 6 WHEN 6 THEN 3 WHEN 7 THEN 6 WHEN 8 THEN 6 END AS second FROM part""")
def precedent_ranks(t, spark):
    kind = F.get(F.array(*map(F.lit, KINDS)), F.expr("cast(p_size % 9 as int)"))
    return t("part").select("p_partkey", records.ranked(kind).alias("first"), records.ranked(kind, "second").alias("second"))


@query("""
SELECT doc_id, CASE WHEN regexp_matches(lower(lang), '^en$') AND list_contains(regexp_extract_all(lower(text), '[a-z]+'), 'the') THEN true ELSE false END AS both_fields, lang IN ('de', 'fr') AS in_lang FROM documents""")
def field_scopes(t, spark):
    has = lambda *w: lambda tok: search.any_of(tok, *w)
    return t("documents").select("doc_id", (records.in_field(F.col("lang"), has("EN")) & records.in_field(F.col("text"), has("the"))).alias("both_fields"), records.in_field(F.col("lang"), has("de", "fr")).alias("in_lang"))


@query("SELECT p_partkey, p_name FROM part WHERE p_size = 7 AND p_brand IN ('Brand#1', 'Brand#12', 'Brand#3', 'Brand#21') AND p_partkey % 5 <> 0")
def exact_numbers(t, spark):
    rows = t("part").withColumn("number", F.col("p_size").cast("string")).withColumn("cancelado", F.when(F.col("p_partkey") % 5 == 0, True).when(F.col("p_partkey") % 5 == 1, False))
    return records.exact_number(rows, "number", "p_brand", "7", ["Brand#1", "Brand#12", "Brand#3", "Brand#21"], "cancelado").select("p_partkey", "p_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey = 150 UNION ALL SELECT o_orderkey, o_custkey FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 200) WHERE o_orderkey = 151 UNION ALL SELECT o_orderkey, o_custkey FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 200) WHERE o_orderkey = 1001")
def located_records(t, spark):
    o = t("orders")
    first = lambda key: records.located(o, "o_orderkey", key, 200, ["o_orderkey"])
    return records.located(o, "o_orderkey", 150).unionAll(first(151)).unionAll(first(1001)).select("o_orderkey", "o_custkey")


@query("""
SELECT c_custkey, lpad(c_custkey::VARCHAR, 11, '0') AS cpf, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_custkey::VARCHAR END AS exact, (100000 + c_custkey)::VARCHAR AS id, 'Petição de ' || c_mktsegment AS type, strftime(DATE '2020-01-15' + to_months((c_custkey % 24)::INTEGER), '%m/%Y') AS month,
  (c_custkey + 49) // 50 AS pages, CASE WHEN c_custkey <= 25 THEN 25 WHEN c_custkey <= 50 THEN 50 ELSE 100 END AS bucket, 'caso+n%C2%BA+' || c_custkey || '%2Fx' AS url FROM customer""")
def identifier_forms(t, spark):
    k = F.col("c_custkey")
    eleven = F.lpad(k.cast("string"), 11, "0")
    dotted = F.concat(F.substring(eleven, 1, 3), F.lit("."), F.substring(eleven, 4, 3), F.lit("."), F.substring(eleven, 7, 3), F.lit("-"), F.substring(eleven, 10, 2))
    named = text.id_and_type(F.concat((k + 100000).cast("string"), F.lit(" - Petição de "), "c_mktsegment", F.lit(" (anexo)")))
    return t("customer").select(
        "c_custkey", text.digits(dotted).alias("cpf"), text.digits(F.concat(k.cast("string"), F.when(k % 2 == 0, "0").otherwise("")), F.length(k.cast("string"))).alias("exact"), named["id"].alias("id"), named["type"].alias("type"),
        text.month_label(F.add_months(F.to_date(F.lit("2020-01-15")), (k % 24).cast("int"))).alias("month"), text.pages_for(k, 50).alias("pages"), text.page_bucket(k).alias("bucket"), F.url_encode(F.concat(F.lit("caso nº "), k.cast("string"), F.lit("/x"))).alias("url"),
    )


@query("SELECT c_custkey, least(100, greatest(1, c_nationkey * 10))::INTEGER AS kept, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS summary, CASE WHEN c_custkey % 3 = 0 THEN 'a' WHEN c_custkey % 3 = 1 THEN 'b' END AS source FROM customer")
def fallbacks(t, spark):
    k = F.col("c_custkey") % 3
    found = records.by_precedence(a=F.when(k == 0, F.col("c_name")).otherwise(" \t"), b=F.when(k == 1, F.col("c_mktsegment")))
    return t("customer").select("c_custkey", text.clamped(F.col("c_nationkey") * 10, 1, 100).cast("int").alias("kept"), found["value"].alias("summary"), found["source"].alias("source"))


@query("SELECT doc_id, text[1001:3000] AS part, CASE WHEN length(text) > 3000 THEN 3000 END AS next, split_part(regexp_extract(text, '(?s)^(.*)$', 1), chr(10), 1) AS line FROM documents")
def text_windows(t, spark):
    w = text.text_window(F.col("text"), 1000, 2000)
    return t("documents").select("doc_id", w["text"].alias("part"), w["next"].alias("next"), F.substring_index("text", "\n", 1).alias("line"))


@query("SELECT s_suppkey, 'TRU ' || s_nationkey || ' a(TNU, ' || s_suppkey || ')' AS last, 'Ementa ' || s_name || ' fim' AS cdata, CASE WHEN s_suppkey % 2 = 0 THEN '1234567-89.2020.4.05.' || lpad((s_suppkey % 10000)::VARCHAR, 4, '0') ELSE 'pasta ' || s_suppkey END AS case_id FROM supplier")
def record_marks(t, spark):
    k = F.col("s_suppkey").cast("string")
    last = records.last_parenthetical(F.concat(F.lit("x (TNU, 0) y (TNU, "), k, F.lit(") (z)")), "TNU,")
    cdata = text.cdata(F.concat(F.lit("<a>&lt;![CDATA[Ementa ]]></a><b><![CDATA["), "s_name", F.lit(" fim]]&gt;</b>")))
    folder = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("/in/x 1234567-89.2020.4.05."), F.lpad((F.col("s_suppkey") % 10000).cast("string"), 4, "0"), F.lit("/"))).otherwise(F.concat(F.lit("/in/pasta "), k))
    return t("supplier").select("s_suppkey", F.concat(F.lit("TRU "), "s_nationkey", F.lit(" a"), last).alias("last"), cdata.alias("cdata"), text.case_id(folder).alias("case_id"))


@query("SELECT c_nationkey AS nation, c_custkey AS id, 0 AS priority FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT s_nationkey, s_suppkey, 1 FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000)")
def first_source_wins(t, spark):
    a = t("customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("id"))
    return records.first_hit(a, t("supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id")), key=["nation"])


@query(f"WITH r AS (SELECT doc_id, count(*) OVER w AS n_alike, row_number() OVER (PARTITION BY lang, source, {sql_norm('text')} ORDER BY n_chars DESC, doc_id DESC) AS k FROM documents WINDOW w AS (PARTITION BY lang, source, {sql_norm('text')})) SELECT doc_id, n_alike::BIGINT AS n_alike FROM r WHERE k = 1")
def newest_rulings(t, spark):
    return records.newest_of_alike(t("documents"), "source", "lang", "text", "n_chars", "doc_id").select("doc_id", "n_alike")


@query("SELECT s_suppkey, '(TNU, Rel. ' || s_name || ', & ' || s_suppkey || ')' AS citation, 'Um caso de ' || s_name || '. (TNU, velho) (TNU, Rel. ' || s_name || ', & ' || s_suppkey || ')' AS summary FROM supplier")
def official_citations(t, spark):
    raw = F.concat(F.lit("EMENTA: \n Um caso&nbsp;de "), "s_name", F.lit(". (TNU, velho)  (TNU,\tRel. "), "s_name", F.lit(",\n &amp; "), F.col("s_suppkey").cast("string"), F.lit(")"))
    return t("supplier").select("s_suppkey", records.official_citation(raw, "TNU,").alias("c")).select("s_suppkey", "c.citation", "c.summary")


@query("SELECT c_custkey, array_to_string([c_name, '', 'b ' || c_custkey, c_mktsegment, 'c', 'd'][1 + c_custkey % 2:], '|') AS lines, 'a%E7%E3o+n%BA+' || c_custkey || '%2F%3F-_.*' AS url FROM customer")
def text_lines(t, spark):
    k = F.col("c_custkey")
    ends = [F.lit(x) for x in ("\r\n", "\r", " ", "\x0c", "\x85", "\n")]
    whole = F.concat(F.when(k % 2 == 0, F.concat("c_name", ends[0])).otherwise(""), ends[1], F.lit("b "), k.cast("string"), ends[2], "c_mktsegment", ends[3], F.lit("c"), ends[4], F.lit("d"), ends[5])
    url = text.url_encoded(F.concat(F.lit("ação nº "), k.cast("string"), F.lit("/☆-_.*")), "ISO-8859-1")
    return t("customer").select("c_custkey", F.array_join(text.lines(whole), "|").alias("lines"), url.alias("url"))
