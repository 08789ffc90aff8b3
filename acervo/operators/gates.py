"""Document-contract gates: every stage's artifact against its contract."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.functions.text import ACCENT, norm, stripped


class Contract(NamedTuple):
    pipeline: str
    stage: str
    suffix: str
    start: str
    ends: list[str]
    contains: list[str]
    min_chars: int


def _of(pipeline: str, *rows: tuple) -> list[Contract]:
    return [Contract(pipeline, stage, suffix, start, ends if isinstance(ends, list) else [ends], contains, least) for stage, suffix, start, ends, contains, least in rows]


#: The contracts, in the order of the stages.
CONTRACTS = [
    *_of(
        "sentenca",
        ("linha-tempo", "-linha-tempo.md", "# linha do tempo processual", "e o que satisfaz extrair dos autos.", ["marcos processuais", "timeline completa"], 500),
        ("relatorio", "-relatorio.md", "relatorio", "e o que havia de relevante a relatar.", [], 500),
        ("triagem", "-triagem.md", "# triagem cognitiva do processo", "triagem concluida.", ["evidencias", '"rota"'], 400),
        ("analise", "-analise.md", "vamos comecar. preciso pensar profundamente sobre esse caso.", "pronto.", [], 500),
        ("fundamentacao", "-fundamentacao.md", "fundamentacao", "juiz federal", ["dispositivo"], 500),
        ("sentenca", "-sentenca.md", "relatorio", "juiz federal", ["fundamentacao", "dispositivo"], 1000),
    ),
    *_of(
        "pesquisa",
        ("bnp", "-pesquisa-bnp.md", "# pesquisa bnp", "pesquisa bnp concluída.", [], 300),
        ("cjf", "-pesquisa-cjf.md", "# pesquisa cjf", "pesquisa cjf concluída.", [], 300),
        ("julia", "-pesquisa-julia.md", "# pesquisa julia", "pesquisa julia concluída.", [], 300),
        ("stj", "-pesquisa-stj.md", "# pesquisa stj", "pesquisa stj concluída.", [], 300),
        ("tnu", "-pesquisa-tnu.md", "# pesquisa tnu", "pesquisa tnu concluída.", [], 300),
        ("consolidado", "-precedentes-consolidado.md", "# relatório consolidado de precedentes", "consolidação realizada", ["hierarquia"], 500),
    ),
    *_of(
        "probatica",
        ("inventario", "-inventario.md", "# inventário probatório", ["é o que satisfaz inventariar do acervo probatório.", "inventário probatório concluído."], [], 500),
        ("tese-pro-autor", "-tese-pro-autor.md", "# tese pró-autor", "tese pró-autor concluída.", [], 500),
        ("tese-pro-reu", "-tese-pro-reu.md", "# tese pró-réu", "tese pró-réu concluída.", [], 500),
        ("replica-pro-autor", "-replica-pro-autor.md", "# réplica pró-autor", "réplica pró-autor concluída.", [], 300),
        ("replica-pro-reu", "-replica-pro-reu.md", "# réplica pró-réu", "réplica pró-réu concluída.", [], 300),
        ("pearl", "-pearl.md", "# análise probatória causal", "análise causal concluída.", [], 500),
        ("haack", "-haack.md", "# análise probatória foundherentista", "análise foundherentista concluída.", [], 500),
        ("fbd", "-probatica-fbd.md", "## movimento 1", "análise probatória fbd concluída.", [], 500),
        ("consolidado", "-probatica-consolidado.md", "# síntese probatória consolidada", "síntese probatória consolidada concluída.", ["convergências"], 500),
    ),
    *_of(
        "revisao",
        ("embargabilidade", "-analise-embargabilidade.md", "# análise de embargabilidade", "análise de embargabilidade concluída.", [], 400),
        ("calculos", "-verificacao-calculos.md", "# relatório de verificação de cálculos", "verificação de cálculos concluída.", [], 400),
        ("fontes", "-verificacao-fontes.md", "# relatório de verificação de fontes", "verificação de fontes concluída.", [], 400),
        ("honorarios", "-verificacao-honorarios.md", "# relatório de verificação de honorários", "verificação de honorários concluída.", [], 400),
        ("remessa", "-verificacao-remessa.md", "# relatório de verificação de remessa necessária", ["verificação de remessa necessária concluída.", "verificação de remessa concluída."], [], 400),
        ("robustecida", "-minuta-robustecida.md", "# minuta robustecida", "minuta robustecida concluída.", ["log de alterações"], 800),
    ),
]

#: Characters at either end of a text where its markers stand; the same for the escalation close; valid tracks.
EDGE, ESCALATION_EDGE, TRACKS = 400, 600, ["pesquisa", "probatica"]


def contract_table(spark: SparkSession, contracts: list[Contract] = CONTRACTS) -> DataFrame:
    """The contracts, all markers in normal form."""
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(contracts)], "ordinal int, pipeline string, stage string, suffix string, start string, ends array<string>, contains array<string>, min_chars int")
    return rows.withColumns({"start": norm(F.col("start")), "ends": F.transform("ends", norm), "contains": F.transform("contains", norm)})


#: What a missing end marker is called.
NO_END = "end marker missing"


def problems(text: Column, n: Column) -> Column:
    """The faults of a text (n: its normal form) under the contract beside it; null text: unreadable."""
    tail = F.when(F.length(n) > EDGE, F.right(n, F.lit(EDGE))).otherwise(n)
    missing = F.transform(F.filter("contains", lambda c: ~F.contains(n, c)), lambda c: F.concat(F.lit("section missing: "), c))
    found = [
        F.when(F.length(text) < F.col("min_chars"), F.lit("too short")),
        F.when(~F.contains(F.substring(n, 1, EDGE), F.col("start")), F.lit("start marker missing")),
        F.when(~F.exists("ends", lambda e: F.contains(tail, e)), F.lit(NO_END)),
    ]
    faults = F.concat(F.array(*found), missing, F.array(F.when(~text.rlike(ACCENT), F.lit("no accents"))))
    return F.when(text.isNull(), F.array(F.lit("unreadable"))).otherwise(F.array_compact(faults))


def gate(artifacts: DataFrame, contracts: DataFrame, workspaces: DataFrame | None = None, stages: list[str] | None = None) -> DataFrame:
    """One row for each workspace and stage: OK, INVALID or ABSENT, with its problems.

    artifacts: workspace_id, suffix, text (null if undecodable).  stages: only
    these of the contract table.  It has a few rows and is broadcast: dealt by
    suffix, all texts of a stage would meet in one task.
    """
    if stages is not None:
        contracts = contracts.where(F.col("stage").isin(stages))
    spaces = (workspaces if workspaces is not None else artifacts).select("workspace_id").distinct()
    every = contracts.agg(F.array_sort(F.collect_list(F.struct("ordinal", "stage"))).alias("every"))
    wanted = spaces.join(F.broadcast(every)).select("workspace_id", F.explode("every").alias("s")).select("workspace_id", "s.ordinal", "s.stage")
    judged = artifacts.join(F.broadcast(contracts), "suffix").withColumn("n", norm(F.col("text"))).select("workspace_id", "ordinal", problems(F.col("text"), F.col("n")).alias("problems"), F.lit(True).alias("there"))
    met = wanted.join(judged, ["workspace_id", "ordinal"], "left")
    status = F.when(F.col("there").isNull(), "ABSENT").when(F.size("problems") > 0, "INVALID").otherwise("OK")
    return met.select("workspace_id", "ordinal", "stage", status.alias("status"), F.coalesce("problems", F.array().cast("array<string>")).alias("problems"))


def summary(report: DataFrame) -> DataFrame:
    """For each workspace: valid stages of all, the pending ones in order, and the gate's exit code."""
    pending = F.array_sort(F.collect_list(F.when(F.col("status") != "OK", F.struct("ordinal", "stage"))))
    out = report.groupBy("workspace_id").agg(F.count_if(F.col("status") == "OK").alias("n_ok"), F.count("*").alias("n_stages"), pending["stage"].alias("pending"))
    return out.withColumn("exit_code", F.when(F.size("pending") > 0, 1).otherwise(0))


def escalation(text: Column) -> Column:
    """The close of an analysis that asks for other tracks: struct(tracks, reason), or null.

    It is the first line that begins with "escalar:" within the last
    characters of the normal form; a line that the limit cuts doesn't count.
    The reason is the next line that isn't blank, if it begins with "motivo:".
    Only the end of a text is put into normal form, unless combining marks
    leave too little of it.
    """
    near = norm(F.right(text, F.lit(4 * ESCALATION_EDGE)))
    n = F.when((F.length(text) <= 4 * ESCALATION_EDGE) | (F.length(near) > ESCALATION_EDGE), near).otherwise(norm(text))
    tail = F.right(F.concat(F.lit("\n"), n), F.lit(ESCALATION_EDGE + 1))  # with the character before, so that a line's start shows
    first = r"\nescalar:([^\n]*)"
    rest = F.substring(tail, F.regexp_instr(tail, F.lit(first)), F.lit(ESCALATION_EDGE + 1))
    tracks = F.filter(F.split(F.regexp_extract(rest, first, 1), r"\s+"), lambda t: t != "")
    reason = stripped(F.regexp_extract(rest, r"^\nescalar:[^\n]*\n\s*motivo:([^\n]*)", 1))
    return F.when(tail.rlike(first), F.struct(tracks.alias("tracks"), reason.alias("reason")))


def escalation_fault(found: Column) -> Column:
    """What is wrong with an escalation, or null: an unknown track, or none.  The reason may be blank."""
    unknown = F.get(F.filter(found["tracks"], lambda t: ~t.isin(TRACKS)), F.lit(0))
    return F.when(unknown.isNotNull(), F.concat(F.lit("escalation to an unknown track: "), unknown)).when(F.size(found["tracks"]) == 0, "escalation without a track")


def analysis(artifacts: DataFrame, contracts: DataFrame, workspaces: DataFrame | None = None, stage: str = "analise") -> DataFrame:
    """The gate of the analysis stage, one row for each workspace: OK (exit code 0), ABSENT or INVALID (1), or ESCALATE (3), with problems, tracks and reason.

    An escalation stands in for the end marker; all other checks hold for it
    too and come first.
    """
    spaces = (workspaces if workspaces is not None else artifacts).select("workspace_id").distinct()
    judged = artifacts.join(F.broadcast(contracts.where(F.col("stage") == stage)), "suffix").withColumn("n", norm(F.col("text"))).select("workspace_id", problems(F.col("text"), F.col("n")).alias("p"), escalation(F.col("text")).alias("e"), F.lit(True).alias("there"))
    fault = F.array_compact(F.array(escalation_fault(F.col("e"))))
    faults = F.when(F.col("e").isNull(), F.col("p")).otherwise(F.concat(F.array_remove("p", NO_END), fault))
    met = spaces.join(judged, "workspace_id", "left").withColumn("problems", F.coalesce(faults, F.array().cast("array<string>")))
    status = F.when(F.col("there").isNull(), "ABSENT").when(F.size("problems") > 0, "INVALID").when(F.col("e").isNotNull(), "ESCALATE").otherwise("OK")
    code = F.when(F.col("status") == "OK", 0).when(F.col("status") == "ESCALATE", 3).otherwise(1)
    escalated = lambda c: F.when(F.col("status") == "ESCALATE", F.col(c))
    return met.withColumn("status", status).select("workspace_id", "status", "problems", escalated("e.tracks").alias("tracks"), escalated("e.reason").alias("reason"), code.alias("exit_code"))


def route(text: Column) -> Column:
    """The first fenced JSON block, parsed; null if there is none or it is malformed."""
    return F.try_parse_json(F.nullif(F.regexp_extract(text, r"(?s)```json\s*(.*?)```", 1), F.lit("")))


def route_problem(r: Column) -> Column:
    """The first rule that a route (of route()) breaks, or null."""
    kind = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(r, path, "variant")), F.lit("VOID"))
    list_of = lambda c: F.try_variant_get(r, f"$.{c}", "array<string>")
    wrong = lambda c: ~F.startswith(kind(f"$.{c}"), F.lit("ARRAY")) & (kind(f"$.{c}") != "VOID")
    full = lambda c: F.exists(F.coalesce(list_of(c), F.array().cast("array<string>")), lambda x: F.coalesce(stripped(x), F.lit("null")) != "")
    tracks = list_of("rota")
    return (
        F.when(r.isNull(), "no valid JSON block").when(~F.startswith(F.schema_of_variant(r), F.lit("OBJECT")), "JSON block is no object")
        .when(~F.startswith(kind("$.rota"), F.lit("ARRAY")), "route missing or no list")
        .when(F.exists(tracks, lambda t: t.isNull() | ~t.isin(TRACKS)), "unknown track")
        .when(wrong("temas_pesquisa"), "topics are no list").when(wrong("fatos_probatorios"), "facts are no list")
        .when(F.array_contains(tracks, "pesquisa") & ~full("temas_pesquisa"), "research without topics")
        .when(F.array_contains(tracks, "probatica") & ~full("fatos_probatorios"), "evidence without facts")
        .when((F.size(tracks) == 0) & ((kind("$.justificativa_rotina") != "STRING") | (F.coalesce(stripped(F.try_variant_get(r, "$.justificativa_rotina", "string")), F.lit("")) == "")), "direct route without reason")
    )


def route_tracks(r: Column) -> Column:
    """Its tracks in order, each once, or "direta"."""
    tracks = F.try_variant_get(r, "$.rota", "array<string>")
    return F.when(F.size(tracks) == 0, "direta").otherwise(F.array_join(F.array_distinct(tracks), ","))
