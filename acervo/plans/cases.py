"""Queries over cases: queues, document selection, timelines, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo.operators import files, timeline
from acervo.plans.registry import query
from acervo.streaming import cases as streams

AS_OF = "2001-09-01"


def cases(t):
    """Orders as the cases of a queue."""
    return t("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("position"), F.array("o_orderstatus", F.substring("o_orderpriority", 1, 1)).alias("etiquetas"), F.col("o_orderpriority").alias("texto"),
        F.when(F.col("o_orderkey") % 5 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("data_conclusao"), (F.col("o_totalprice") > 200000).alias("prioridade"),
    )


CASES_SQL = """
WITH cases AS (SELECT o_orderkey AS id, [o_orderstatus, o_orderpriority[1:1]] AS etiquetas, o_orderpriority AS texto, CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS data_conclusao, o_totalprice > 200000 AS prioridade FROM orders)
"""


@query(CASES_SQL + "SELECT id, data_conclusao, prioridade FROM cases WHERE list_contains(etiquetas, 'F') AND list_has_any(etiquetas, ['1', '2', '3']) AND contains(lower(texto), 'e') AND prioridade")
def queue_filters(t, spark):
    return files.queue(cases(t), tags_all=["F"], tags_any=["1", "2", "3"], untagged=False, text="E", flags={"prioridade": True, "other": None}).select("id", "data_conclusao", "prioridade")


@query(CASES_SQL + "SELECT id, data_conclusao FROM cases ORDER BY coalesce(data_conclusao, '') DESC, id LIMIT 50")
def queue_by_conclusion(t, spark):
    return files.by_conclusion(cases(t), descending=True, most=50).select("id", "data_conclusao")


RULES = [("ANODIZED", "NUCLEAR"), ("brass", "NUCLEAR"), ("BURNISHED STEEL", "IMPORTANTE"), ("tin", "IMPORTANTE"), ("promo", "IRRELEVANTE"), ("copper", "IRRELEVANTE")]
CLASSES_SQL = f"""
WITH rules(term, classe) AS (VALUES {', '.join(map(str, RULES))}),
best AS (SELECT p_type, arg_min(classe, list_position(['NUCLEAR', 'IMPORTANTE', 'IRRELEVANTE'], classe)) AS classe FROM (SELECT DISTINCT p_type FROM part) JOIN rules ON trim(p_type) != '' AND (contains(lower(p_type), lower(term)) OR contains(lower(term), lower(p_type))) GROUP BY ALL),
classed AS (SELECT p_partkey, p.p_type, coalesce(classe, 'OUTRO') AS classe FROM part p LEFT JOIN best b ON p.p_type = b.p_type)
"""


def classed(t, spark):
    return files.classified(t("part"), spark.createDataFrame(RULES, "term string, classe string"), "p_type")


@query(CLASSES_SQL + "SELECT p_type, classe, count(*)::BIGINT AS n FROM classed GROUP BY ALL")
def document_classes(t, spark):
    return classed(t, spark).groupBy("p_type", "classe").agg(F.count("*").alias("n"))


@query(CLASSES_SQL + ", n AS (SELECT classe, count(*) AS n FROM classed GROUP BY ALL) SELECT d.classe, coalesce(n, 0)::BIGINT AS n, round(coalesce(n, 0) * 100.0::DOUBLE / (SELECT sum(n) FROM n), 2) AS share FROM (VALUES ('NUCLEAR'), ('IMPORTANTE'), ('IRRELEVANTE'), ('OUTRO'), ('NONE')) d(classe) LEFT JOIN n USING (classe)")
def class_shares(t, spark):
    return files.zero_filled(classed(t, spark), "classe", [*files.CLASSES, "OUTRO", "NONE"])


SELECTED_SQL = f"""
WITH rows AS (SELECT l_orderkey, l_linenumber, l_returnflag AS kind, date_diff('day', l_shipdate::DATE, DATE '{AS_OF}') AS age_days, l_quantity * 12 AS kb, p_name AS text FROM lineitem JOIN part ON p_partkey = l_partkey),
picked AS (SELECT *, CASE WHEN kind = 'R' THEN 'nuclear' WHEN contains(lower(text), 'red') OR contains(lower(text), '9') THEN 'trigger' WHEN age_days <= 180 THEN 'recent' WHEN kb > 500 THEN 'large' WHEN kind IN ('N') THEN 'excluded' ELSE 'unsure' END AS reason FROM rows),
shares AS (SELECT l_orderkey, count(*) FILTER (reason = 'excluded') / count(*) AS share FROM picked GROUP BY ALL)
SELECT l_orderkey, l_linenumber, CASE WHEN reason = 'excluded' AND share > 0.8 AND age_days <= 400 THEN 'reverted' ELSE reason END AS reason FROM picked JOIN shares USING (l_orderkey)"""


@query(SELECTED_SQL)
def document_selection(t, spark):
    rows = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("age_days", F.datediff(F.to_date(F.lit(AS_OF)), F.col("l_shipdate").cast("date")))
    reason = files.selection(F.col("l_returnflag"), F.col("p_name"), F.col("age_days"), F.col("l_quantity") * 12, ["R"], ["red", "9"], ["N"])
    return files.guarded(rows.withColumn("reason", reason), "l_orderkey", revert_days=400).select("l_orderkey", "l_linenumber", "reason")


@query("""
WITH n AS (SELECT l_suppkey, count(*) * 2 AS n, count(*) FILTER (l_returnflag = 'N') AS bad FROM lineitem GROUP BY ALL), s AS (SELECT *, bad / n AS share FROM n)
SELECT l_suppkey, CASE WHEN l_suppkey % 9 = 0 THEN 'full' WHEN n <= 100 THEN 'full' WHEN n > 500 AND share < 0.1 THEN 'full' WHEN n > 300 THEN 'selective' WHEN share > 0.3 THEN 'selective' ELSE 'full' END AS strategy FROM s""")
def download_strategies(t, spark):
    n = t("lineitem").groupBy("l_suppkey").agg((F.count("*") * 2).alias("n"), F.count_if(F.col("l_returnflag") == "N").alias("bad"))
    return n.select("l_suppkey", files.strategy(F.col("n"), F.col("bad"), F.col("l_suppkey") % 9 != 0).alias("strategy"))


KINDS = ["view", "click"]
RUNS_SQL = f"""
WITH a AS (SELECT user_id, event_type, ts, event_id, coalesce(event_type <> lag(event_type) OVER w OR event_type NOT IN ({', '.join(map(repr, KINDS))}), true) AS begins FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(begins::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM a),
c AS (SELECT *, count(*) OVER (PARTITION BY user_id, run) AS size, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS k FROM b)
SELECT user_id, event_type, count(*)::BIGINT AS n, min(ts) AS first_day, max(ts) AS last_day FROM c GROUP BY user_id, run, event_type, CASE WHEN size < 2 THEN k ELSE 0 END"""


@query(RUNS_SQL)
def act_runs(t, spark):
    return timeline.runs(t("events"), "user_id", "event_type", ["ts", "event_id"], "ts", KINDS, least=2)


@query("""
WITH marks AS (SELECT user_id, max(event_id) FILTER (event_type = 'purchase') AS mark FROM events GROUP BY ALL),
r AS (SELECT e.*, mark, row_number() OVER (PARTITION BY e.user_id ORDER BY event_id DESC) AS k FROM events e JOIN marks USING (user_id))
SELECT user_id, event_id, event_type FROM r WHERE CASE WHEN mark IS NOT NULL THEN event_id > mark ELSE k <= 5 END""")
def since_milestone(t, spark):
    mark = F.col("event_type").isin("purchase", "signup")
    return timeline.since_milestone(t("events"), "user_id", "event_id", mark, F.col("event_type") == "signup").select("user_id", "event_id", "event_type")


@query("SELECT l_orderkey, l_linenumber, rank::INTEGER AS rank FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC) AS rank FROM lineitem) WHERE rank <= 3")
def last_pieces(t, spark):
    return timeline.last_of_each(t("lineitem"), "l_orderkey", "l_shipdate", "l_linenumber").select("l_orderkey", "l_linenumber", "rank")


@query("""
WITH a AS (SELECT o_custkey, min(o_orderdate)::DATE AS f, max(o_orderdate)::DATE AS l FROM orders GROUP BY ALL),
b AS (SELECT *, (year(l) - year(f)) * 12 + month(l) - month(f) - CASE WHEN day(l) < day(f) THEN 1 ELSE 0 END AS m FROM a)
SELECT o_custkey, (m // 12)::INTEGER AS years, (m % 12)::INTEGER AS months, date_diff('day', (f + to_months(m::INTEGER))::DATE, l)::INTEGER AS days FROM b""")
def case_durations(t, spark):
    ends = t("orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("f"), F.max("o_orderdate").cast("date").alias("l"))
    return ends.select("o_custkey", timeline.duration(F.col("f"), F.col("l")).alias("d")).select("o_custkey", "d.years", "d.months", "d.days")


ACTS = ["Distribuição", "Citação expedida", "CITAÇÃO", "Contestação", "Saneamento", "Conclusos para sentença", "Sentença", "Recurso", "Trânsito em julgado", "Cumprimento", "Juntada"]


@query("""
WITH k AS (SELECT l_orderkey, max((CASE WHEN l_suppkey % 3 = 0 THEN l_partkey % 11 ELSE l_partkey % 3 + CASE WHEN l_quantity < 10 THEN 10 ELSE 0 END END)::INTEGER) FILTER (CASE WHEN l_suppkey % 3 = 0 THEN l_partkey % 11 ELSE l_partkey % 3 + CASE WHEN l_quantity < 10 THEN 10 ELSE 0 END END < 10) AS k FROM lineitem GROUP BY ALL)
SELECT l_orderkey, CASE k WHEN 0 THEN 'Inicial' WHEN 1 THEN 'Citação' WHEN 2 THEN 'Resposta' WHEN 3 THEN 'Instrução' WHEN 4 THEN 'Saneamento' WHEN 5 THEN 'Julgamento' WHEN 6 THEN 'Sentenciado' WHEN 7 THEN 'Recursal' WHEN 8 THEN 'Trânsito' WHEN 9 THEN 'Cumprimento' ELSE 'INDEFINIDA' END AS phase FROM k""")
def case_phases(t, spark):
    k = F.expr("cast(CASE WHEN l_suppkey % 3 = 0 THEN l_partkey % 11 ELSE l_partkey % 3 + CASE WHEN l_quantity < 10 THEN 10 ELSE 0 END END as int)")
    acts = t("lineitem").select("l_orderkey", F.coalesce(F.get(F.array(*map(F.lit, ACTS)), k), F.lit("outro")).alias("act"))
    return timeline.phase(acts, "l_orderkey", "act")


@query("SELECT o_custkey, o_orderkey, o_orderstatus, before FROM (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders) WHERE before <> o_orderstatus")
def panel_drift(t, spark):
    return timeline.drifted(t("orders"), "o_custkey", "o_orderstatus", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus", "before")


@query("""
WITH i AS (SELECT l_shipdate::DATE AS day, l_returnflag AS kind, min('i' || l_orderkey) AS id FROM lineitem WHERE l_linenumber = 1 GROUP BY ALL)
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 4 = 0 THEN 'b' || l_partkey ELSE coalesce(i.id, 'N/I') END AS id FROM lineitem LEFT JOIN i ON i.day = l_shipdate::DATE AND i.kind = l_returnflag WHERE l_linenumber > 1""")
def act_ids(t, spark):
    rows = t("lineitem").withColumns({"day": F.col("l_shipdate").cast("date"), "own": F.when(F.col("l_partkey") % 4 == 0, F.concat(F.lit("b"), "l_partkey")).when(F.col("l_partkey") % 4 == 1, " "), "entry": F.concat(F.lit("i"), "l_orderkey")})
    return timeline.with_ids(rows.where("l_linenumber > 1"), rows.where("l_linenumber = 1"), "day", "l_returnflag", "own", "entry").select("l_orderkey", "l_linenumber", "id")


@query(RUNS_SQL.replace("size < 2", "size < 3"))
def routine_runs(t, spark):
    return timeline.runs(t("events"), "user_id", "event_type", ["ts", "event_id"], "ts", KINDS)


@query(f"""
WITH a AS (SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '2001-09-01') AS w, o_orderstatus FROM orders),
b AS (SELECT o_orderkey, list_filter([CASE WHEN w > 60 THEN 'concluded over 60 days' END, CASE WHEN w > 30 AND w <= 60 THEN 'concluded over 30 days' END, CASE WHEN w + 30 > 365 THEN 'appeal over a year' END, CASE WHEN o_orderstatus = 'P' THEN 'no defence' END], lambda x: x IS NOT NULL) AS alerts, w, o_orderstatus FROM a)
SELECT o_orderkey, array_to_string(alerts, '; ') AS alerts, CASE WHEN w > 60 OR w + 30 > 365 THEN 'RED' WHEN w > 30 OR o_orderstatus = 'P' THEN 'YELLOW' ELSE 'GREEN' END AS colour FROM b""")
def case_alerts(t, spark):
    rows = t("orders").withColumns({"concluded": F.col("o_orderdate").cast("date"), "appeal": F.date_sub(F.col("o_orderdate").cast("date"), 30)})
    return timeline.alerts(rows, F.to_date(F.lit(AS_OF)), "concluded", "appeal", F.col("o_orderstatus") != "P").select("o_orderkey", "alerts", "colour")


@query(SELECTED_SQL.replace("SELECT l_orderkey, l_linenumber, CASE", "SELECT l_orderkey, l_linenumber, kind, kb, CASE").join(["WITH plan AS (", """),
r AS (SELECT kind, reason, grouping(kind, reason) AS level, count(*) AS n, count(*) FILTER (reason = 'excluded') AS n_left, coalesce(sum(kb) FILTER (reason <> 'excluded'), 0) AS taken, coalesce(sum(kb) FILTER (reason = 'excluded'), 0) AS left_ FROM plan GROUP BY ROLLUP (kind, reason)),
a AS (SELECT n AS n_all, taken + left_ AS kb_all FROM r WHERE level = 3)
SELECT kind, reason, level::BIGINT AS level, n::BIGINT AS n, round(taken)::BIGINT AS taken, round(left_)::BIGINT AS kept_out, round(n * 100.0::DOUBLE / n_all, 2) AS share, round(n_left * 100.0::DOUBLE / n_all, 2) AS n_savings, round(left_ * 100.0::DOUBLE / kb_all, 2) AS savings FROM r, a"""]))
def plan_composition(t, spark):
    rows = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("age_days", F.datediff(F.to_date(F.lit(AS_OF)), F.col("l_shipdate").cast("date"))).withColumnRenamed("l_returnflag", "kind")
    rows = rows.withColumn("kilobytes", F.col("l_quantity") * 12)
    reason = files.selection(F.col("kind"), F.col("p_name"), F.col("age_days"), F.col("kilobytes"), ["R"], ["red", "9"], ["N"])
    out = files.composition(files.guarded(rows.withColumn("reason", reason), "l_orderkey", revert_days=400), kind="kind")
    return out.select("kind", "reason", F.col("level").cast("long").alias("level"), "n", F.round("taken").cast("long").alias("taken"), F.round("left").cast("long").alias("kept_out"), "share", "n_savings", "savings")


@query(f"""
WITH k AS (SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '{AS_OF}') AS waited, o_orderkey % 3 = 0 AS undefended, o_orderkey % 5 AS moves FROM orders),
a AS (SELECT o_orderkey, list_filter([CASE WHEN waited > 60 THEN 'concluded over 60 days' END, CASE WHEN undefended THEN 'no defence' END, CASE WHEN o_orderkey % 2 = 0 THEN 'limitation near or past' END, CASE WHEN o_orderkey % 4 = 0 AND waited > 365 THEN 'appeal over a year' END,
  CASE WHEN waited > 30 AND waited <= 60 THEN 'concluded over 30 days' END, CASE WHEN o_orderkey % 2 = 0 THEN 'party without lawyer' END, CASE WHEN moves > 1 THEN 'several redistributions' END, CASE WHEN undefended THEN 'priority asked for' END], lambda x: x IS NOT NULL) AS found FROM k)
SELECT o_orderkey, nullif(array_to_string(found[1:5], '; '), '') AS alerts, CASE WHEN list_has_any(found, ['concluded over 60 days', 'no defence', 'limitation near or past', 'appeal over a year']) THEN 'RED' WHEN list_has_any(found, ['concluded over 30 days', 'party without lawyer', 'several redistributions']) THEN 'YELLOW' ELSE 'GREEN' END AS colour FROM a""")
def case_alerts(t, spark):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    found = timeline.waits(F.to_date(F.lit(AS_OF)), day, F.when(k % 4 == 0, day), k % 5)
    found |= {"priority asked for": k % 3 == 0, "no defence": k % 3 == 0, "limitation near or past": k % 2 == 0, "party without lawyer": k % 2 == 0}
    return timeline.raised(t("orders"), found).select("o_orderkey", "alerts", "colour")


@query("""
WITH e AS (SELECT user_id, ts, ts + CASE event_type WHEN 'view' THEN INTERVAL 30 MINUTE WHEN 'click' THEN INTERVAL 3 HOUR ELSE INTERVAL 10 MINUTE END AS until FROM events),
m AS (SELECT *, CASE WHEN ts <= max(until) OVER (PARTITION BY user_id ORDER BY ts, until ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS begins FROM e),
s AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts, until ROWS UNBOUNDED PRECEDING) AS nr FROM m)
SELECT user_id, min(ts) AS first, max(until) AS last, count(*)::BIGINT AS n FROM s GROUP BY user_id, nr""")
def act_sessions(t, spark):
    """The sessions that the stream gives, from the table."""
    return streams.sessions(t("events"), "user_id", "ts", "event_type", {"view": "30 minutes", "click": "3 hours"}, "10 minutes")


@query("""
WITH e AS (SELECT event_type, time_bucket(INTERVAL 2 HOUR, ts) - to_hours(2 * k) AS first FROM events, (SELECT unnest([0, 1, 2]) AS k))
SELECT event_type, first, first + INTERVAL 6 HOUR AS last, count(*)::BIGINT AS n FROM e GROUP BY ALL""")
def act_windows(t, spark):
    return streams.sliding(t("events"), "ts", "6 hours", "2 hours", "event_type")


ALARMS_AS_OF = "2024-06-01"


@query(f"""
WITH a AS (SELECT user_id::VARCHAR AS case_id, ts, event_type = 'purchase' AS concludes FROM events WHERE event_type = 'purchase' OR (event_type = 'error' AND user_id % 2 = 0)),
l AS (SELECT case_id, max(ts) AS acted FROM a WHERE NOT concludes GROUP BY ALL),
s AS (SELECT case_id, min(ts) AS since FROM a LEFT JOIN l USING (case_id) WHERE concludes AND (acted IS NULL OR ts > acted) GROUP BY ALL)
SELECT case_id, 'concluded over ' || days || ' days' AS alert, since, (since::DATE + days + 1)::TIMESTAMP AS at FROM s, (VALUES (30), (60)) AS d(days) WHERE date_diff('day', since::DATE, DATE '{ALARMS_AS_OF}') > days""")
def open_conclusions(t, spark):
    acts = t("events").where("event_type = 'purchase' OR (event_type = 'error' AND user_id % 2 = 0)")
    acts = acts.select(F.col("user_id").cast("string").alias("case_id"), F.col("ts").alias("day"), (F.col("event_type") == "purchase").alias("concludes"))
    return streams.open_conclusions(acts, F.to_date(F.lit(ALARMS_AS_OF)))
