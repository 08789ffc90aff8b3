import json

from pyspark.sql import functions as F

from acervo.functions import text as tx
from acervo.operators import cleaning, gates, merging
from acervo.sources import landed, reports
from acervo.streaming import inbox

GOOD = "# Pesquisa BNP\n" + "Ação julgada. " * 40 + "\nPESQUISA BNP CONCLUIDA."


def test_artifacts_and_gate(spark, tmp_path):
    case = tmp_path / "0001234-56.2020.4.05.8000"
    case.mkdir()
    (tmp_path / "other").mkdir()
    (case / "0001234-56.2020.4.05.8000-pesquisa-bnp.md").write_text(GOOD)
    (case / "0001234-56.2020.4.05.8000-pesquisa-cjf.md").write_bytes(b"\xff\xfe bad")
    (tmp_path / "other" / "other-pesquisa-stj.md").write_text("short")
    contracts = gates.contract_table(spark, [c for c in gates.CONTRACTS if c.pipeline == "pesquisa"])
    found = landed.artifacts(spark, str(tmp_path), [c.suffix for c in gates.CONTRACTS])
    report = gates.gate(found, contracts)
    got = {(r.workspace_id, r.stage): (r.status, r.problems) for r in report.collect()}
    assert len(gates.CONTRACTS) == 27 and len(got) == 12
    assert got["0001234-56.2020.4.05.8000", "bnp"] == ("OK", [])
    assert got["0001234-56.2020.4.05.8000", "cjf"] == ("INVALID", ["unreadable"])
    assert got["other", "stj"] == ("INVALID", ["too short", "start marker missing", "end marker missing", "no accents"])
    assert got["other", "bnp"][0] == "ABSENT"
    assert {r.workspace_id: (r.n_ok, r.exit_code) for r in gates.summary(report).collect()} == {"0001234-56.2020.4.05.8000": (1, 1), "other": (0, 1)}


def item(**more):
    return {"origem_mcp": "bnp-api", "tribunal": "STF", "tipo": "RG", "referencia": "Tema 1", "campo": "tese", "trecho_verbatim": "Ação  fiscal"} | more


def test_partial_sources_merge(spark, tmp_path):
    (tmp_path / "fontes-a.json").write_text(json.dumps({"fontes": [item(), item(trecho_verbatim="acao FISCAL"), item(tribunal=" ")]}))
    (tmp_path / "fontes-b.json").write_text(json.dumps([item(origem_mcp="nowhere"), item(campo="x"), item(origem_mcp="tnu-eproc", url="")]))
    (tmp_path / "fontes-c.json").write_text("{broken")
    (tmp_path / "fontes-d.json").write_text(json.dumps({"fontes": None}))
    (tmp_path / "fontes-e.json").write_text("7")
    items, bad = landed.partial_sources(spark, str(tmp_path))
    assert [r.file for r in bad.collect()] == ["fontes-c.json"]
    assert sorted((r.id, r.url) for r in merging.merged(items).collect()) == [("BNP-001", None), ("TNU-001", None)]
    assert sorted(r.reason for r in merging.validated(items).where("reason is not null").collect()) == ["invalid field", "origin not authorised: nowhere", "required field missing: tribunal"]
    assert {r.origem_mcp: (r.n_valid, r.n_rejected, r.n_duplicates) for r in merging.counters(items).collect()} == {"bnp-api": (2, 2, 1), "nowhere": (0, 1, 0), "tnu-eproc": (1, 0, 0)}


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_html_and_envelopes(spark):
    table = "<table><tr><th>x</th></tr><tr class='a'><td>12</td><td>Peti&ccedil;&amp;</td><td><b>c</b></td><td>d</td><td>e</td></tr><tr><td>no</td><td>b</td><td>c</td><td>d</td><td>e</td></tr></table>"
    select = '<select><option value="">all</option><option value="3" selected> Três </option><option value="3">again</option></select>'
    rows, found = one(spark, landed.index_rows(F.lit(table)), landed.options(F.lit(select)))
    assert rows == [["12", "Petiç&", "c", "d", "e"]] and found == {"3": "Três"}
    landed_rows = spark.createDataFrame([('{"entities": [{"idProcesso": 5, "numero": "a", "dataConclusao": 86400000, "tagsProcessoList": ["x"]}]}',), ('[{"id": 0, "classe": ""}]',), ('{"other": 1}',), ("broken",)], "value string")
    assert sorted((r.id_processo or "", r.numero, r.data_conclusao, r.etiquetas) for r in landed.queue_cases(landed_rows).collect()) == [("", None, None, []), ("5", "a", "1970-01-02T00:00:00", ["x"])]


def test_pages(spark):
    rule = "=" * 60
    text = f"head{rule}\n[PAGINA 1]\n{rule}\n" + "long enough " * 10 + f"\n{rule}\n[PAGINA 2]\n{rule}\n tiny \n"
    got, kept, compatible = one(spark, landed.pages(F.lit(text)), cleaning.without_empty_pages(F.lit(text)), cleaning.cleaned(F.lit(text), True))
    assert [(p.page, p.text[:4]) for p in got] == [(1, "long"), (2, "tiny")]
    assert "tiny" not in kept and "[PAGINA 2]" in kept and "head" not in kept and "tiny" in compatible


def test_text_functions(spark):
    got = one(spark, tx.norm(F.lit("ÇÃO ß É")), tx.norm_ws(F.lit(" Ç \n x ")), tx.truncated(F.lit("a. " + "b" * 7 + "." + "c" * 9), 12), tx.padded(F.lit(12345), 3), tx.cdata(F.lit("<![CDATA[a]]>x<![CDATA[b\n]]>")), tx.text_window(F.lit("x" * 2500), 1000, 5)["next"], tx.case_id(F.lit("/a/x 0001234-56.2020.4.05.8000 y/")))
    assert got == ("cao ss e", "c x", "a. bbbbbbb. [...]", "12345", "ab\n", 2000, "0001234-56.2020.4.05.8000")


def test_routes_and_escalation(spark):
    block = lambda x: f"t\n```json\n{x}\n```\n```json\n{{}}\n```"
    rows = {
        block('{"rota": ["pesquisa", "pesquisa"], "temas_pesquisa": ["a"]}'): (None, "pesquisa"),
        block('{"rota": ["pesquisa"], "temas_pesquisa": [" "]}'): ("research without topics", "pesquisa"),
        block('{"rota": ["x"]}'): ("unknown track", "x"),
        block('{"rota": []}'): ("direct route without reason", "direta"),
        block('{"rota": [], "justificativa_rotina": 3}'): ("direct route without reason", "direta"),
        block('{"rota": [], "justificativa_rotina": "ok", "temas_pesquisa": "x"}'): ("topics are no list", "direta"),
        block('{"rota": ["probatica"], "temas_pesquisa": null, "fatos_probatorios": {}}'): ("facts are no list", "probatica"),
        block('{"rota": ["probatica"], "fatos_probatorios": [7]}'): (None, "probatica"),
        block('{"rota": [null]}'): ("unknown track", ""),
        block('{"rota": "pesquisa"}'): ("route missing or no list", None),
        block("{}"): ("route missing or no list", None),
        block("[1]"): ("JSON block is no object", None),
        block('{"rota": [], "justificativa_rotina": "ok"}'): (None, "direta"),
        block("{bad"): ("no valid JSON block", None),
        "none": ("no valid JSON block", None),
    }
    df = spark.createDataFrame([(x,) for x in rows], "text string").withColumn("r", gates.route(F.col("text")))
    assert {r.text: (r.p, r.k) for r in df.select("text", gates.route_problem(F.col("r")).alias("p"), gates.route_tracks(F.col("r")).alias("k")).collect()} == rows
    close = "escalar: pesquisa\nmotivo: x\n"
    texts = {
        "Escalar: pesquisa\n\nmotivo: falta": (None, ["pesquisa"], "falta"), "diz escalar: pesquisa\nmotivo: x": (None, None, None), close + "y" * 600: (None, None, None), "escalar:\nmotivo: x": ("escalation without a track", [], "x"),
        "z" * 5000 + "\n" + close + "y" * (600 - len(close)): (None, ["pesquisa"], "x"), "z" * 5000 + "\n" + close + "y" * (601 - len(close)): (None, None, None), close + "y" * (600 - len(close)): (None, ["pesquisa"], "x"),
        "escalar: probática outra\nsem motivo": ("escalation to an unknown track: outra", ["probatica", "outra"], ""), "escalar: pesquisa\nescalar: outra\nmotivo: y": (None, ["pesquisa"], ""), "a" + "\u0301" * 3000 + "\nescalar: pesquisa": (None, ["pesquisa"], ""),
    }
    df = spark.createDataFrame([(x,) for x in texts], "text string").withColumn("e", gates.escalation(F.col("text")))
    assert {r.text: (r.s, r.t, r.m) for r in df.select("text", gates.escalation_fault(F.col("e")).alias("s"), F.col("e.tracks").alias("t"), F.col("e.reason").alias("m")).collect()} == texts


def test_reports(spark, tmp_path):
    xml, merged = one(spark, reports.xml_record("r", {"a": F.lit("<&"), "b": F.lit("")}), reports.merged_sentence(F.lit("a\n\n"), F.lit("b\n")))
    assert xml == "<r>\n  <a>&lt;&amp;</a>\n</r>" and merged == "a\n\nb\n"
    log = spark.createDataFrame([(True, 100, 80), (False, 0, 0)], "ok boolean, a long, b long")
    assert reports.log_totals(log, "ok", "a", "b").first().reduction == 20.0
    reports.write_json(log, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_inbox_sweep_is_idempotent(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    contracts = gates.contract_table(spark, gates.CONTRACTS)
    add = lambda suffix, text: spark.createDataFrame([("w", suffix, text)], "workspace_id string, suffix string, text string").withColumn("arrived", F.lit("2024-01-01").cast("timestamp")).write.json(folder, mode="append")
    add("-pesquisa-bnp.md", GOOD)
    for _ in range(2):
        inbox.sweep(inbox.judged(inbox.arrivals(spark, folder), contracts), out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 1
    add("-pesquisa-cjf.md", "short")
    inbox.sweep(inbox.judged(inbox.arrivals(spark, folder), contracts), out, checkpoint).awaitTermination()
    done = spark.read.parquet(out)
    stages = spark.createDataFrame([("w", "bnp"), ("w", "cjf")], "workspace_id string, stage string")
    assert done.count() == 2 and [r.stage for r in inbox.pending(stages, done).collect()] == ["cjf"]
    counts = inbox.per_window(inbox.arrivals(spark, folder), "1 hour", "1 day", F.col("suffix")).writeStream.format("memory").queryName("per_window").outputMode("complete").trigger(availableNow=True).start()
    counts.awaitTermination()
    assert spark.table("per_window").count() == 2


def test_records(spark):
    from acervo.functions import records

    lines = F.array(*map(F.lit, ["id 123", "456", "x", "7", "a 8", "b"]))
    got = one(spark, records.rejoined(lines), records.last_parenthetical(F.lit("(TNU, a) x (TNU, b) (c)"), "TNU,"), records.last_parenthetical(F.lit("none"), "TNU,"), records.by_precedence(a=F.lit(" "), b=F.lit("v"))["source"])
    assert got == (["id 123456", "x", "7", "a 8", "b"], "(TNU, b)", None, "b")


def test_timeline_and_bases(spark):
    html = '<a href="#">129401156 - Contrarrazões (de Embargos)</a><a>12 - short</a><a><b>129401156</b> - Again</a><span class="x doc">129401156 - Other</span><span class="documento">129401999 - Peti&ccedil;&atilde;o</span><span class="y">129401777 - No</span><span class="doc">129401999 - Twice</span>'
    (got,) = one(spark, landed.timeline_documents(F.lit(html)))
    assert [tuple(x) for x in got] == [("129401156", "Contrarrazões", "Contrarrazões (de Embargos)"), ("129401156", "Again", "Again"), ("129401999", "Petição", "Petição")]
    answer = lambda **x: spark.createDataFrame([(json.dumps({"documentos": [x]}),), ("broken",), ("{}",)], "value string")
    of = lambda base, **x: landed.audit_records(answer(**x), base).first().asDict()
    full = of("acordao-completo", NUMACORDAO=7, ANOACORDAO="2020", COLEGIADO="Plenário", SUMARIO="", FRAGMENTO1="<p>a</p>b", DATASESSAO="20200131", URLARQUIVO="u")
    assert (full["number"], full["summary"], full["day"], full["url"], full["area"]) == ("Acordao 7/2020 - Plenário", "ab", "31/01/2020", "u", None)  # this court drops tags without a space
    assert [of("jurisprudencia-selecionada", **x)["number"] for x in ({"NUMSUMULA": "3", "NUMACORDAO": "1"}, {"NUMACORDAO": "1", "ANOACORDAO": "2", "COLEGIADO": "C"}, {"KEY": "k"})] == ["Sumula TCU 3", "Acordao 1/2 - C", "k"]
    rule = of("norma", ORIGEM=["A", "B"], NUMNORMA="1", ANONORMA="2")
    assert (rule["kind"], rule["number"], rule["panel"]) == ("Norma", "Norma 1/2", "A, B") and of("norma", ORIGEM=[], TITULO="T", TIPO="Portaria")["panel"] == "TCU"
    assert landed.audit_records(answer(KEY="x"), "norma").count() == 1


def test_courts(spark):
    from acervo.functions import records
    import pytest

    asked = lambda *x: spark.createDataFrame([(c,) for c in x], "code string")
    assert sorted(r.court for r in records.courts(asked(" trf5", "Superiores", "TJMSP", ""), "code").collect()) == ["STF", "STJ", "STM", "TJMSP", "TNU", "TRF05", "TST"]
    assert records.courts(asked(None), "code").count() == 65 and records.courts(asked("x").limit(0), "code").count() == 65
    with pytest.raises(Exception, match="unknown court: TSE"):
        records.courts(asked("TSE"), "code").collect()
    assert sorted((r.court, r.known) for r in records.expanded(asked("tru", "TR7"), "code", records.FEDERAL, F.upper).collect()) == [("TR7", False), *[(f"TRU{i}", True) for i in range(1, 7)]]


def test_search_terms(spark):
    from acervo.operators import search

    tok = search.tokens(F.lit("Ação julgada: dano moral coletivo, ação de dano"))
    got = one(
        spark, F.array_join(search.missing(tok, ["Ação", "JULGADA", "Dano-moral", "fé"]), ","), search.score(tok, ["Ação", "acao", "JULGADA", "x"]), search.matching(tok, "Aç$"), search.has(tok, "--"),
        search.followed(tok, "dano moral", "ação", 2), search.followed(tok, "dano moral", "ação", 1), search.close(tok, "ação", "dano moral", 2), search.phrase(tok, "dano coletivo", 1), search.phrase(tok, "coletivo moral dano", 9), search.phrase(tok, "ação dano coletivo", 2),
    )
    assert got == ("fé", 2, True, False, True, False, True, True, False, True)


def test_inbox_never_overwrites(spark):
    case = "0001234-56.2020.4.05.8000"
    status = spark.createDataFrame([(1, case, 0), (2, case.replace("1", "2"), 1), (3, "01-done", 0), (4, case.replace("1", "3"), 0), (5, "x " + case, 0)], "workspace_id int, folder string, exit_code int")
    assert [r.workspace_id for r in inbox.approved(status, spark.createDataFrame([(case,)], "folder string")).collect()] == [4]


def test_analysis_gate(spark):
    start, body = "Vamos começar. Preciso pensar profundamente sobre esse caso.\n", "Análise. " * 80
    texts = {"ok": start + body + "\nPronto.", "esc": start + body + "\nESCALAR: pesquisa\nmotivo: m", "bad": start + body + "\nESCALAR: outra", "end": start + body, "short": "ESCALAR: pesquisa"}
    rows = spark.createDataFrame([(k, "-analise.md", t) for k, t in texts.items()], "workspace_id string, suffix string, text string")
    spaces = spark.createDataFrame([(x,) for x in [*texts, "none"]], "workspace_id string")
    got = {r.workspace_id: (r.status, r.exit_code, r.problems) for r in gates.analysis(rows, gates.contract_table(spark), spaces).collect()}
    assert got == {
        "ok": ("OK", 0, []), "esc": ("ESCALATE", 3, []), "bad": ("INVALID", 1, ["escalation to an unknown track: outra"]), "end": ("INVALID", 1, ["end marker missing"]),
        "short": ("INVALID", 1, ["too short", "start marker missing", "no accents"]), "none": ("ABSENT", 1, []),
    }
