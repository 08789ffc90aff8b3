"""Reports, lines, codes and plans against Python's own and values by hand."""

import csv
import json
import os
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from acervo.functions import records, text
from acervo.operators import files, gates, panels, timeline
from acervo.sources import reports


def test_lines_and_urls_equal_python(spark):
    values = ["", "\n", "a", "a\n", "a\r\nb\rc\x0bd\x0ce\x1cf\x1dg\x1eh\x85i j ", "\r\n\r\n", "a\n\r b\x1f c", "ação/º &=+~*-._ x", "é\n", "€ ☆"]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string").orderBy("i")
    got = rows.select("x", text.lines(F.col("x")).alias("l"), text.url_encoded(F.col("x"), "ISO-8859-1").alias("u")).collect()
    assert {r.x: r.l for r in got} == {v: v.splitlines() for v in values}
    assert {r.x: r.u.replace("*", "%2A") for r in got} == {v: quote_plus(v, encoding="iso-8859-1", errors="replace").replace("%3F", "%3F").replace("~", "%7E") for v in values}


def test_documents_equal_python(spark):
    rows = [{"id": 'a"\n', "ano": 2020, "url": None, "tags": ["é", "x"]}, {"id": "b", "ano": None, "url": "http://x/?a=1&b", "tags": []}]
    df = spark.createDataFrame([(r["id"], r["ano"], r["url"], r["tags"]) for r in rows], "id string, ano int, url string, tags array<string>")
    one = df.select(reports.json_record({c: F.col(c) for c in df.columns}, 2).alias("r"), "id")
    doc = one.groupBy().agg(F.array_sort(F.collect_list(F.struct("id", "r"))).alias("x")).select(reports.json_document({"processo": F.lit("1"), "versao": F.lit(1)}, "fontes", F.transform("x", lambda x: x["r"])).alias("d")).first().d
    assert json.loads(doc) == {"processo": "1", "versao": 1, "fontes": rows}
    flat = spark.createDataFrame([("a", 1)], "k string, n int").select(reports.json_record({"k": F.col("k"), "n": F.col("n"), "z": F.lit(None).cast("int")}).alias("r")).first().r
    assert flat == json.dumps({"k": "a", "n": 1, "z": None}, indent=2)
    empty = spark.range(1).select(reports.json_document({"a": F.lit(1)}, "fontes", F.array().cast("array<string>")).alias("d")).first().d
    assert empty == json.dumps({"a": 1, "fontes": []}, indent=2)


def test_csv_keeps_what_separates(spark, tmp_path):
    rows = [('a;"b"\nc', 1, ["x", "y"]), (None, None, []), ("é", 2, None)]
    reports.write_csv(spark.createDataFrame(rows, "t string, n int, l array<string>").coalesce(1), f"{tmp_path}/out")
    (part,) = [f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".csv")]
    with open(f"{tmp_path}/out/{part}", newline="", encoding="utf-8") as f:
        got = list(csv.reader(f, delimiter=";"))
    assert got == [["t", "n", "l"], ['a;"b"\nc', "1", '["x","y"]'], ["", "", "[]"], ["é", "2", ""]]


def test_merged_sentences_are_checked_again(spark):
    contracts = gates.contract_table(spark, [c for c in gates.CONTRACTS if c.pipeline == "sentenca"])
    report = "Relatório\n" + "não " * 150 + "\nÉ o que havia de relevante a relatar.\n\n"
    reasons = "Fundamentação\n" + "razão " * 100 + "\nDispositivo: procedente.\nJuiz Federal\n"
    spaces = {"good": (report, reasons), "short": (report, "Fundamentação dispositivo é Juiz Federal"), "half": (report, None), "wrong": (report.replace("Relatório", "Outro"), reasons)}
    rows = [(k, s, x) for k, pair in spaces.items() for s, x in zip(("-relatorio.md", "-fundamentacao.md"), pair, strict=True) if x]
    got = {r.workspace_id: r for r in reports.sentences(spark.createDataFrame(rows, "workspace_id string, suffix string, text string"), contracts).collect()}
    assert got["good"].exit_code == 0 and got["good"].text == report.rstrip("\n") + "\n\n" + reasons.rstrip("\n") + "\n" and got["good"].problems == []
    assert got["short"].problems == ["fundamentacao: too short"] and got["short"].text is None and got["short"].exit_code == 1
    assert got["half"].problems == ["fundamentacao: absent"] and got["wrong"].problems == ["relatorio: start marker missing"]
    strict = contracts.withColumn("contains", F.when(F.col("stage") == "sentenca", F.array(F.lit("custas"))).otherwise(F.col("contains")))
    bad = reports.sentences(spark.createDataFrame(rows[:2], "workspace_id string, suffix string, text string"), strict).first()
    assert bad.problems == ["section missing: custas"] and bad.text and bad.exit_code == 1


def test_texts_are_not_dealt_by_stage(spark):
    """All texts of a stage have one suffix; dealt by it, they would meet in one task."""
    contracts = gates.contract_table(spark)
    rows = spark.createDataFrame([("a", "-relatorio.md", "x")], "workspace_id string, suffix string, text string")
    for made in (reports.sentences(rows, contracts), gates.gate(rows, contracts), gates.analysis(rows, contracts)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(suffix" not in plan and "CartesianProduct" not in plan


def test_alerts(spark):
    one = spark.range(1)
    every = timeline.raised(one, {name: F.lit(True) for name in timeline.ALERTS}).first()
    assert every.alerts == "; ".join(list(timeline.ALERTS)[:5]) and every.colour == "RED"
    none = timeline.raised(one, {"no defence": F.lit(None).cast("boolean"), "partial settlement": F.lit(False)}).first()
    assert none.alerts is None and none.colour == "GREEN"
    assert timeline.raised(one, {"partial settlement": F.lit(True)}).first().colour == "GREEN"
    with pytest.raises(ValueError, match="no such alerts: other"):
        timeline.raised(one, {"other": F.lit(True)})
    rows = spark.createDataFrame([("a", k, i) for i, k in enumerate([None, "Minority position", "odd", "cross contradiction ", "own panel", "sensitive case", "binding precedent"])], "c string, k string, i int")
    assert [r.k for r in panels.pressing(rows, "c", "k", "i", most=6).orderBy("rank").collect()] == ["cross contradiction ", "binding precedent", "own panel", "sensitive case", "Minority position", None]


def test_files_of_one_name_keep_their_order(spark):
    rows = spark.createDataFrame([("d", "9_a", i) for i in (3, 1, 4, 2)] + [("d", "10_a", 0)], "d string, f string, i int")
    assert [r.i for r in files.merge_order(rows, "d", "f", "i").orderBy("place").collect()] == [1, 2, 3, 4, 0]


def test_files_without_name_or_number_are_placed_as_the_sql_does(spark, tmp_path):
    import duckdb

    from acervo.plans import registry

    rows = [(1, "a", "B", 5), (2, "b", "B", None), (3, None, "B", 5), (4, "c", None, 5), (None, "d", "B", 5), (-1, "e", "B", -3), (-7, "f", "B", 1), (0, None, "B", 1), (14, "n", "B", None), (8, "_x", "B", 10), (9, "y", "B", 9), (10, "z", "C", None), (11, None, None, 3)]
    path = f"{tmp_path}/part.parquet"
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_size int").write.parquet(path)
    c = duckdb.connect()
    c.sql(f"CREATE VIEW part AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(c.sql(registry.oracle_sql()["numeric_file_order"]).fetchall(), key=str)
    got = sorted(map(tuple, registry.queries()["numeric_file_order"](spark, str(tmp_path)).collect()), key=str)
    assert got == want and ("B", 2, 6) in got and ("B", 3, 3) in got and len(got) == 9


def test_small_operators(spark):
    files_ = spark.createDataFrame([("d", x) for x in ("10_b", "9_z", "_skip", "x_1", "9_a", "100")], "d string, f string")
    assert [r.f for r in files.merge_order(files_, "d", "f").orderBy("place").collect()] == ["9_a", "9_z", "10_b", "100"]
    here, there = spark.createDataFrame([("a",), ("b",), (None,)], "k string"), spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted(str(r.k) for r in files.not_there(here, there, "k").collect()) == ["None", "b"]
    asked = spark.createDataFrame([("TRF9",), ("TRF9",), ("STJ",), (" ",), (None,)], "k string")
    assert [tuple(r) for r in records.unknown(asked, spark.createDataFrame([("STJ",)], "k string"), "k").collect()] == [("TRF9", 2)]
    labels = spark.createDataFrame([("1", "um"), ("1", "uno")], "k string, label string")
    assert sorted(map(str, (r.label for r in records.labelled_codes(asked.limit(0).union(spark.createDataFrame([("1",), ("2",), (None,)], "k string")), labels, "k").collect()))) == ["2", "None", "um"]
    votes = spark.createDataFrame([("a", True)] * 3 + [("a", False)] + [("b", True)] + [("c", False)] * 6, "k string, ok boolean")
    assert {r.k: (r.n_valid, r.missing, r.status) for r in panels.quorum(votes, "k", F.col("ok")).collect()} == {"a": (3, 1, "CONSOLIDATE"), "b": (1, 4, "PARTIAL"), "c": (0, 0, "NONE")}
    pages = spark.createDataFrame([("f", "native", "x" * 500)] * 7 + [("f", "OCR", "x")] * 2 + [("f", "unreadable", None)], "f string, m string, t string")
    got = panels.page_quality(pages, "f", "t", "m").first()
    assert (got.n_pages, got.n_adequate, got.quality, got.next_stage) == (10, 7, "REGULAR", False) and [tuple(m) for m in got.methods] == [("OCR", 2, 20.0), ("native", 7, 70.0), ("unreadable", 1, 10.0)]
    plan = spark.createDataFrame([("A", "nuclear", 10), ("A", "excluded", 30), ("B", "excluded", 60)], "classe string, reason string, kilobytes int")
    rows = {(r.classe, r.reason): r for r in files.composition(plan).collect()}
    whole = rows[None, None]
    assert (whole.n, whole.taken, whole.left, whole.share, whole.n_savings, whole.savings) == (3, 10, 90, 100.0, 66.67, 90.0) and rows["A", None].savings == 30.0 and len(rows) == 6


def test_rules_in_blocks(spark, monkeypatch):
    index = spark.createDataFrame([("Petição inicial",), ("Laudo",), ("",), (None,), ("Outra coisa",)], "tipo string")
    rules = spark.createDataFrame([("petição", "NUCLEAR"), ("PETIÇÃO INICIAL COM ANEXOS", "IRRELEVANTE"), ("laudo pericial", "IMPORTANTE"), ("x", "IRRELEVANTE")], "term string, classe string")
    whole = sorted(map(str, files.classified(index, rules).collect()))
    monkeypatch.setattr(files, "MOST_RULES", 1)
    assert sorted(map(str, files.classified(index, rules).collect())) == whole
    assert {(r.tipo, r.classe) for r in files.classified(index, rules).collect()} == {("Petição inicial", "NUCLEAR"), ("Laudo", "IMPORTANTE"), ("", "OUTRO"), (None, "OUTRO"), ("Outra coisa", "OUTRO")}
