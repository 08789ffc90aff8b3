"""Queries over landed answers: envelopes, tables, timelines, pages and reports, made of the driver's rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from acervo.functions import records
from acervo.functions.text import ACCENT
from acervo.operators import cleaning, panels, search
from acervo.operators.gates import Contract, contract_table
from acervo.plans.registry import query
from acervo.plans.texts import sql_norm
from acervo.sources import landed, reports
from acervo.sources.shared import shared_dir


@query("""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'e' || o_orderkey ELSE o_orderkey::VARCHAR END AS id_processo, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS classe,
  CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00') END AS data_conclusao, CASE WHEN o_orderkey % 3 = 0 THEN 'a,' || o_orderstatus ELSE '' END AS etiquetas FROM orders""")
def queue_envelopes(t, spark):
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    kind = F.when(k % 2 == 0, "").otherwise(F.col("o_orderpriority"))
    millis = F.unix_millis(F.date_trunc("day", F.col("o_orderdate").cast("timestamp")))
    full = F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("e"), k).alias("idProcesso"), kind.alias("classeJudicial"), millis.alias("dataConclusao"), F.array(F.lit("a"), status).alias("tagsProcessoList"))).alias("entities")))
    bare = F.to_json(F.array(F.struct(F.lit("0").alias("idProcesso"), k.alias("id"), kind.alias("classe"))))
    listed = F.to_json(F.struct(F.array(F.struct(k.alias("id"), kind.alias("classe"))).alias("processos")))
    value = F.when(k % 3 == 0, full).when(k % 3 == 1, bare).otherwise(listed)
    return landed.queue_cases(t("orders").select(value.alias("value"))).select("id_processo", "classe", "data_conclusao", F.array_join("etiquetas", ",").alias("etiquetas"))


@query("""
SELECT s_suppkey, s_suppkey::VARCHAR || '|' || s_name || ' & é|b|c|d' AS row, s_nationkey::VARCHAR || '=' || s_name AS option, '1234567' || s_suppkey || ':Petição inicial,99' || (100000 + s_suppkey) || ':Laudo' AS timeline FROM supplier""")
def html_tables(t, spark):
    k = F.col("s_suppkey").cast("string")
    table = F.concat(F.lit("<table><tr><th>n</th></tr><TR class='x'><td>"), k, F.lit("</td><td><b>"), "s_name", F.lit("</b> &amp; &eacute;</td><td>b</td><td>c</td><td>d</td></TR><tr><td>x</td><td>1</td><td>2</td><td>3</td><td>4</td></tr><tr><td>5</td></tr></table>"))
    select = F.concat(F.lit('<select><option value="">-</option><option value="'), "s_nationkey", F.lit('"> '), "s_name", F.lit(' </option><option value="'), "s_nationkey", F.lit('">again</option></select>'))
    page = F.concat(F.lit("<a>1234567"), k, F.lit(" - Petição inicial (anexo)</a><a>12 - curto</a><span class='x'>1234567"), k, F.lit(" - y</span><span class=\"documento\">99"), F.col("s_suppkey") + 100000, F.lit(" - Laudo</span><span class=\"doc\">1234567"), k, F.lit(" - repetido</span>"))
    rows, options, found = landed.index_rows(table), landed.options(select), landed.timeline_documents(page)
    return t("supplier").select(
        "s_suppkey", F.array_join(F.flatten(F.transform(rows, lambda r: F.array(F.array_join(r, "|")))), ";").alias("row"), F.array_join(F.transform(F.map_entries(options), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("option"),
        F.array_join(F.transform(found, lambda d: F.concat(d["id"], F.lit(":"), d["type"])), ",").alias("timeline"),
    )


@query("""
SELECT 'acordao-completo' AS base, 'Acordao ' || p_partkey || '/2020 - ' || p_brand AS number, p_brand AS panel, '05/03/2020' AS day, 'Sumário de ' || p_name AS summary, NULL::VARCHAR AS area FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'jurisprudencia-selecionada', CASE WHEN p_size % 3 = 0 THEN 'Sumula TCU ' || p_size WHEN p_size % 3 = 1 THEN 'Acordao ' || p_size || '/2019 - ' || p_brand ELSE 'K' || p_partkey END, p_brand, '01/02/2019', p_name, 'Área' || p_type FROM part WHERE p_partkey % 3 = 1
UNION ALL SELECT 'norma', CASE WHEN p_size % 2 = 0 THEN p_name ELSE 'Portaria ' || p_size || '/2001' END, 'TCU', '31/12/2001', 'Assunto', NULL FROM part WHERE p_partkey % 3 = 2""")
def audit_bases(t, spark):
    p, size = t("part"), F.col("p_size")
    answer = lambda *fields: F.to_json(F.struct(F.array(F.struct(*fields)).alias("documentos"))).alias("value")
    full = p.where("p_partkey % 3 = 0").select(answer(F.col("p_partkey").alias("NUMACORDAO"), F.lit("2020").alias("ANOACORDAO"), F.col("p_brand").alias("COLEGIADO"), F.lit("20200305").alias("DATASESSAO"), F.lit("").alias("SUMARIO"), F.concat(F.lit("<p>Sumário de</p> "), "p_name").alias("FRAGMENTO1")))
    chosen = p.where("p_partkey % 3 = 1").select(answer(
        F.when(size % 3 == 0, size).alias("NUMSUMULA"), F.when(size % 3 < 2, size).alias("NUMACORDAO"), F.lit(2019).alias("ANOACORDAO"), F.col("p_brand").alias("COLEGIADO"), F.concat(F.lit("K"), "p_partkey").alias("KEY"),
        F.lit("2019-02-01T00:00:00").alias("DATASESSAOFORMATADA"), F.concat(F.lit("<b>"), "p_name", F.lit("</b>")).alias("ENUNCIADO"), F.concat(F.lit("Área<br>"), "p_type").alias("AREA"),
    ))
    rules = p.where("p_partkey % 3 = 2").select(answer(F.lit("Portaria").alias("TIPONORMA"), F.when(size % 2 == 0, F.col("p_name")).otherwise("").alias("TITULO"), size.alias("NUMNORMA"), F.lit(2001).alias("ANONORMA"), F.array().cast("array<string>").alias("ORIGEM"), F.lit("31/12/2001").alias("DATANORMA"), F.lit("Assunto").alias("ASSUNTO")))
    each = landed.audit_records(full, "acordao-completo").unionAll(landed.audit_records(chosen, "jurisprudencia-selecionada")).unionAll(landed.audit_records(rules, "norma"))
    return each.select("base", "number", "panel", "day", "summary", "area")


@query("""
WITH m AS (SELECT repeat('=', 60) || chr(10) || '[PAGINA 1]' || chr(10) || repeat('=', 60) AS a, repeat('=', 60) || chr(10) || '[PAGINA 2]' || chr(10) || repeat('=', 60) AS b),
x AS (SELECT c_custkey, a, b, chr(10) || CASE WHEN c_custkey % 2 = 0 THEN repeat('conteúdo ', 10) ELSE ' pouco ' END || chr(10) AS one, chr(10) || repeat(c_name || ' ', 4) || chr(10) AS two FROM customer, m)
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN trim(repeat('conteúdo ', 10)) ELSE 'pouco' END || '|' || trim(repeat(c_name || ' ', 4)) AS pages,
  md5(a || CASE WHEN c_custkey % 2 = 0 THEN one ELSE '' END || b || two) AS kept, round((CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE length(one) END) * 100.0::DOUBLE / length(a || one || b || two), 6) AS reduction,
  'x ' || chr(10) || '  fim' AS letterhead FROM x JOIN customer USING (c_custkey)""")
def marked_pages(t, spark):
    mark = lambda n: F.lit("=" * 60 + f"\n[PAGINA {n}]\n" + "=" * 60)
    one = F.concat(F.lit("\n"), F.when(F.col("c_custkey") % 2 == 0, "conteúdo " * 10).otherwise(" pouco "), F.lit("\n"))
    text = F.concat(mark(1), one, mark(2), F.lit("\n"), F.repeat(F.concat("c_name", F.lit(" ")), F.lit(4)), F.lit("\n"))
    kept = cleaning.without_empty_pages(text)
    letter = cleaning.without_furniture(F.lit("x Fone: (81) 3333-4444 ramal 2\n e-mail: a@b.com.br fim"), cleaning.LETTERHEADS)
    return t("customer").select(
        "c_custkey", F.array_join(F.transform(landed.pages(text), lambda p: p["text"]), "|").alias("pages"), F.md5(kept).alias("kept"), F.round(cleaning.reduction(F.length(text), F.length(kept)), 6).alias("reduction"), letter.alias("letterhead"),
    )


@query("""
SELECT n_nationkey, '<r>' || chr(10) || '  <name>' || n_name || ' &amp; &lt;x&gt;</name>' || chr(10) || '</r>' AS xml, 'a' || n_nationkey || chr(10) || chr(10) || 'b' || chr(10) AS merged,
  '### ' || n_name || chr(10) || '- **Região:** ' || n_regionkey AS markdown FROM nation""")
def record_reports(t, spark):
    xml = reports.xml_record("r", {"name": F.concat("n_name", F.lit(" & <x>")), "empty": F.lit("")})
    return t("nation").select("n_nationkey", xml.alias("xml"), reports.merged_sentence(F.concat(F.lit("a"), "n_nationkey", F.lit("\n\n\n")), F.lit("b\n")).alias("merged"), reports.markdown_record(F.col("n_name"), {"Região": F.col("n_regionkey"), "vazio": F.lit("")}).alias("markdown"))


PARTS = [Contract("demo", "relatorio", "-0.md", "The", ["ing", "Être"], [], 300), Contract("demo", "fundamentacao", "-1.md", "E", ["."], [], 300), Contract("demo", "sentenca", "-2.md", "der", ["."], ["and"], 900)]


@query(f"""
WITH a AS (SELECT source || '/' || doc_id // 2 AS workspace_id, doc_id % 2 AS part, text, {sql_norm('text')} AS n FROM documents),
good AS (SELECT workspace_id, part, text, length(text) >= 300 AND regexp_matches(text, '{ACCENT}') AND CASE part WHEN 0 THEN contains(n[1:400], 'the') AND (contains(right(n, 400), 'ing') OR contains(right(n, 400), 'etre')) ELSE contains(n[1:400], 'e') AND contains(right(n, 400), '.') END AS ok FROM a),
m AS (SELECT workspace_id, count(*) FILTER (ok) = 2 AS whole, regexp_replace(max(text) FILTER (part = 0), chr(10) || '+$', '') || chr(10) || chr(10) || regexp_replace(max(text) FILTER (part = 1), chr(10) || '+$', '') || chr(10) AS text FROM good GROUP BY ALL),
j AS (SELECT *, {sql_norm('text')} AS n FROM m)
SELECT workspace_id, CASE WHEN whole THEN md5(text) END AS digest, CASE WHEN whole AND length(text) >= 900 AND contains(n[1:400], 'der') AND contains(right(n, 400), '.') AND contains(n, 'and') THEN 0 ELSE 1 END AS exit_code FROM j""")
def checked_sentences(t, spark):
    """Two documents a workspace as the parts of a sentence."""
    artifacts = t("documents").select(F.concat("source", F.lit("/"), F.expr("doc_id div 2")).alias("workspace_id"), F.concat(F.lit("-"), F.expr("doc_id % 2"), F.lit(".md")).alias("suffix"), "text")
    return reports.sentences(artifacts, contract_table(spark, PARTS)).select("workspace_id", F.md5("text").alias("digest"), "exit_code")


@query("""SELECT n_regionkey, '{' || chr(10) || '  "região": ' || n_regionkey || ',' || chr(10) || '  "versao": null,' || chr(10) || '  "fontes": [' || chr(10) || string_agg('    {' || chr(10) || '      "id": ' || n_nationkey || ',' || chr(10) || '      "nome": "' || n_name || ' \\"é\\""' || chr(10) || '    }', ',' || chr(10) ORDER BY n_nationkey) || chr(10) || '  ]' || chr(10) || '}' AS document FROM nation GROUP BY n_regionkey""")
def json_documents(t, spark):
    record = reports.json_record({"id": F.col("n_nationkey"), "nome": F.concat("n_name", F.lit(' "é"'))}, 2)
    by = t("nation").select("n_regionkey", F.struct("n_nationkey", record.alias("r")).alias("x")).groupBy("n_regionkey").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return by.select("n_regionkey", reports.json_document({"região": F.col("n_regionkey"), "versao": F.lit(None).cast("string")}, "fontes", F.transform("x", lambda x: x["r"])).alias("document"))


@query("SELECT count(*) FILTER (o_orderstatus <> 'P')::BIGINT AS n_ok, count(*) FILTER (o_orderstatus = 'P')::BIGINT AS n_failed, sum(o_orderkey)::BIGINT AS before, sum(o_orderkey // 2)::BIGINT AS after, round((sum(o_orderkey) - sum(o_orderkey // 2)) * 100.0::DOUBLE / sum(o_orderkey), 6) AS reduction FROM orders")
def conversion_log(t, spark):
    rows = t("orders").select((F.col("o_orderstatus") != "P").alias("ok"), F.col("o_orderkey").alias("a"), F.expr("o_orderkey div 2").alias("b"))
    return reports.log_totals(rows, "ok", "a", "b").withColumn("reduction", F.round("reduction", 6))


@query("SELECT conv_id, arg_max(text, turn) FILTER (role = 'user') AS asked, arg_max(text, turn) FILTER (role = 'assistant') AS answered FROM conversations WHERE trim(text) != '' AND role IN ('user', 'assistant') GROUP BY conv_id")
def labelled_last(t, spark):
    return records.labelled(t("conversations"), "conv_id", "turn", "role", "text", [("user", "asked"), ("assistant", "answered")], exact=True, last=True)


@query("SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus)::BIGINT AS n_of_kind, count(*) OVER ()::BIGINT AS n_all FROM orders QUALIFY row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= 100")
def first_with_totals(t, spark):
    return panels.listed(t("orders"), "o_orderstatus", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_orderstatus", "n_of_kind", "n_all")


@query("SELECT r_name AS term, r_name AS word FROM region UNION SELECT r_name, n_name FROM region JOIN nation ON n_regionkey = r_regionkey")
def synonyms(t, spark):
    known = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("term"), F.col("n_name").alias("word"))
    return search.with_synonyms(t("region").select(F.col("r_name").alias("term")), known)


@query("""
(SELECT 'newest' AS sorted, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC)::INTEGER AS place, o_orderkey FROM orders QUALIFY place <= 25)
UNION ALL (SELECT 'oldest', row_number() OVER (ORDER BY o_orderdate, o_orderkey)::INTEGER AS place, o_orderkey FROM orders QUALIFY place <= 25)
UNION ALL (SELECT 'relevance', row_number() OVER (ORDER BY o_totalprice DESC, o_orderstatus, o_orderdate DESC, o_orderkey DESC)::INTEGER AS place, o_orderkey FROM orders QUALIFY place <= 25)""")
def result_orders(t, spark):
    found = t("orders").withColumns({"day": F.col("o_orderdate"), "score": F.col("o_totalprice")})
    return search.sorted_pages(found, ["newest", "oldest", "relevance"], 25, day="day", score="score", ties=[F.asc("o_orderstatus"), F.desc("day")], key="o_orderkey").select("sorted", "place", "o_orderkey")


@query("SELECT doc_id::VARCHAR AS id, row_number() OVER (PARTITION BY source, doc_id // 200 ORDER BY doc_id)::INTEGER - 1 AS position, 'bnp-api' AS origem_mcp, source AS tribunal, md5(text) AS digest FROM documents")
def landed_sources(t, spark):
    """Each source's documents as partial files of a few hundred, an object or a bare list, beside one that is no JSON; written, then read as they land."""
    path = f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"
    fonte = F.struct(F.col("doc_id").cast("string").alias("id"), F.lit("bnp-api").alias("origem_mcp"), F.col("source").alias("tribunal"), F.col("text").alias("trecho_verbatim"))
    listed = t("documents").groupBy("source", F.expr("doc_id div 200").alias("block")).agg(F.array_sort(F.collect_list(F.struct("doc_id", fonte.alias("f")))).alias("x")).select("source", F.transform("x", lambda x: x["f"]).alias("fontes"))
    value = F.when(F.crc32("source") % 2 == 0, F.to_json(F.struct("fontes"))).otherwise(F.to_json("fontes"))
    listed.select(value.alias("value")).unionAll(t("region").limit(1).select(F.lit("{broken").alias("value"))).write.option("maxRecordsPerFile", 1).text(path)
    items, _ = landed.partial_sources(spark, path)
    return items.select("id", "position", "origem_mcp", "tribunal", F.md5("trecho_verbatim").alias("digest"))
