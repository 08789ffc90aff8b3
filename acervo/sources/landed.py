"""Reading landed files: artifacts of workspaces, partial JSON files, HTML indexes, page-marked text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.functions.text import brazilian_date, case_id, html_bare, id_and_type, stripped, unescaped
from acervo.operators.cleaning import PAGE_MARK

SOURCE = "id string, origem_mcp string, tribunal string, tipo string, referencia string, orgao_julgador string, data_julgamento string, campo string, trecho_verbatim string, url string"


def artifacts(spark: SparkSession, path: str, suffixes: list[str]) -> DataFrame:
    """(workspace_id, suffix, text) of files <workspace>/<id><suffix>; text is null where the bytes are no UTF-8."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    folder, name = F.regexp_extract("path", "^(.*)/[^/]+$", 1), F.regexp_extract("path", "([^/]+)$", 1)
    suffix = F.expr("CASE " + " ".join(f"WHEN endswith(name, '{s}') THEN '{s}'" for s in sorted(suffixes, key=len, reverse=True)) + " END")
    text = F.try_validate_utf8(F.col("content").cast("string"))
    return files.select(case_id(folder).alias("workspace_id"), name.alias("name"), text.alias("text")).withColumn("suffix", suffix).where("suffix is not null").drop("name")


def folder(spark: SparkSession, path: str, suffix: str = ".pdf", most: int | None = None) -> DataFrame:
    """The files of a folder with this suffix, by name; most: the first so many alone.  Their bytes aren't read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "path", "length").orderBy("name")
    return found if most is None else found.limit(most)


def partial_sources(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The items of partial files, an object with `fontes` or a bare list, with their file and position; and the files that are no JSON.

    Another shape, or a null list, has no items.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.try_parse_json("value").alias("v"))
    kind = F.schema_of_variant("v")
    listed = F.when(kind.startswith("ARRAY"), F.col("v")).when(kind.startswith("OBJECT"), F.try_variant_get("v", "$.fontes", "variant"))
    each = files.where("v is not null").select("file", F.posexplode(F.coalesce(F.try_variant_get(listed, "$", "array<variant>"), F.array().cast("array<variant>"))).alias("position", "item"))
    names = [c.split()[0] for c in SOURCE.split(", ")]
    return each.select("file", "position", *[F.try_variant_get("item", f"$.{c}", "string").alias(c) for c in names]), files.where("v is null").select("file")


def index_rows(html: Column) -> Column:
    """The rows of an HTML table as arrays of cell texts: at least five cells, the first a number."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), lambda c: unescaped(html_bare(c))))
    return F.filter(cells, lambda c: (F.size(c) >= 5) & F.coalesce(F.get(c, F.lit(0)).rlike(r"^\d+$"), F.lit(False)))


def options(html: Column) -> Column:
    """The options of a select as a map from value to label."""
    values = F.regexp_extract_all(html, F.lit(r'(?is)<option\b[^>]*value="([^"]*)"[^>]*>(.*?)</option>'), F.lit(1))
    labels = F.regexp_extract_all(html, F.lit(r'(?is)<option\b[^>]*value="([^"]*)"[^>]*>(.*?)</option>'), F.lit(2))
    entries = F.filter(F.arrays_zip(values.alias("value"), labels.alias("label")), lambda x: x["value"] != "")
    first = F.filter(entries, lambda x, i: F.array_position(F.transform(entries, lambda y: y["value"]), x["value"]) == i + 1)  # a value's first label holds
    return F.map_from_entries(F.transform(first, lambda x: F.struct(x["value"], stripped(x["label"]))))


def timeline_documents(html: Column) -> Column:
    """array<struct<id, type, full_type>> of a timeline page: all links that read "<six digits or more> - <type>", then spans of documents that do, unless the identifier is there already."""

    def those(tag: str) -> Column:
        texts = F.transform(F.regexp_extract_all(html, F.lit(tag), F.lit(1)), lambda x: stripped(unescaped(F.regexp_replace(x, "<[^>]+>", ""))))
        named = F.filter(texts, lambda x: x.rlike(r"^\d{6,}\s*-\s*."))
        return F.transform(named, lambda x: F.struct(id_and_type(x)["id"].alias("id"), id_and_type(x)["type"].alias("type"), stripped(F.regexp_replace(x, r"^\d+\s*-\s*", "")).alias("full_type")))

    def add(found: Column, x: Column) -> Column:
        return F.when(F.exists(found, lambda y: y["id"] == x["id"]), found).otherwise(F.concat(found, F.array(x)))

    return F.aggregate(those(r'(?is)<span\b[^>]*class="[^"]*doc[^"]*"[^>]*>(.*?)</span>'), those(r"(?is)<a\b[^>]*>(.*?)</a>"), add)


#: The audit court's bases, their kinds and fields.
AUDIT_RECORD = ["base", "kind", "number", "panel", "author", "day", "summary", "url", "status", "area", "topic", "subtopic"]


def audit_records(landed: DataFrame, base: str, column: str = "value") -> DataFrame:
    """Records out of the audit court's JSON answers (`documentos`), one schema for its three bases; fields that a base lacks are null, an unknown base counts as full rulings."""
    v = F.try_variant_get(F.try_parse_json(column), "$.documentos", "array<variant>")
    item = landed.select(F.explode(F.coalesce(v, F.array().cast("array<variant>"))).alias("item"))
    get = lambda name: F.coalesce(F.try_variant_get("item", f"$.{name}", "string"), F.lit(""))
    first = lambda *names: F.coalesce(*[F.nullif(get(n), F.lit("")) for n in names], F.lit(""))
    ruling = F.concat(F.lit("Acordao "), get("NUMACORDAO"), F.lit("/"), get("ANOACORDAO"), F.lit(" - "), get("COLEGIADO"))
    selected = F.when(get("NUMSUMULA") != "", F.concat(F.lit("Sumula TCU "), get("NUMSUMULA"))).when(get("NUMACORDAO") != "", ruling).otherwise(get("KEY"))
    kind = F.coalesce(F.nullif(first("TIPONORMA", "TIPO"), F.lit("")), F.lit("Norma"))
    origins = F.try_variant_get("item", "$.ORIGEM", "array<string>")
    rule = {
        "kind": kind, "number": F.coalesce(F.nullif(get("TITULO"), F.lit("")), F.concat(kind, F.lit(" "), get("NUMNORMA"), F.lit("/"), get("ANONORMA"))),
        "panel": F.coalesce(F.nullif(F.array_join(origins, ", "), F.lit("")), F.when(origins.isNull(), F.nullif(get("ORIGEM"), F.lit(""))), F.lit("TCU")), "day": get("DATANORMA"), "summary": html_bare(first("ASSUNTO", "FRAGMENTO1")),
        "url": get("LINKBTCU"), "status": get("SITUACAO"), "topic": get("TEMA"),
    }
    fields = {
        "jurisprudencia-selecionada": {
            "kind": F.lit("Jurisprudencia Selecionada"), "number": selected, "panel": get("COLEGIADO"), "author": get("AUTORTESE"), "day": get("DATASESSAOFORMATADA"), "summary": html_bare(get("ENUNCIADO")), "url": F.lit(""),
            "area": html_bare(get("AREA")), "topic": html_bare(get("TEMA")), "subtopic": html_bare(get("SUBTEMA")),
        },
        "norma": rule,
    }.get(base, {"kind": F.lit("Acordao"), "number": ruling, "panel": get("COLEGIADO"), "author": get("RELATOR"), "day": get("DATASESSAO"), "summary": html_bare(first("SUMARIO", "FRAGMENTO1")), "url": first("URLARQUIVOPDF", "URLARQUIVO"), "status": get("SITUACAO")})
    out = fields | {"base": F.lit(base), "day": brazilian_date(fields["day"])}
    return item.select(*[out.get(c, F.lit(None).cast("string")).alias(c) for c in AUDIT_RECORD])


def queue_cases(landed: DataFrame, column: str = "value") -> DataFrame:
    """Cases out of JSON envelopes: `entities`, `processos`, or a bare list; empty strings and zeros count as missing."""
    v = F.try_parse_json(column)
    lists = [F.try_variant_get(v, p, "array<variant>") for p in ("$.entities", "$.processos", "$")]
    item = landed.select(F.explode(F.coalesce(*lists, F.array().cast("array<variant>"))).alias("item"))
    first = lambda *names: F.coalesce(*[F.nullif(F.nullif(F.try_variant_get("item", f"$.{n}", "string"), F.lit("")), F.lit("0")) for n in names])
    concluded = F.try_variant_get("item", "$.dataConclusao", "bigint")
    return item.select(
        first("idProcesso", "id").alias("id_processo"), first("numeroProcesso", "numero").alias("numero"), first("classeJudicial", "classe").alias("classe"),
        F.date_format(F.timestamp_millis(concluded), "yyyy-MM-dd'T'HH:mm:ss").alias("data_conclusao"), F.coalesce(F.try_variant_get("item", "$.tagsProcessoList", "array<string>"), F.array().cast("array<string>")).alias("etiquetas"),
    )


def pages(text: Column) -> Column:
    """Page-marked text as array<struct<page, text>>."""
    marks = F.regexp_extract_all(text, F.lit(PAGE_MARK), F.lit(0))
    bodies = F.slice(F.split(text, PAGE_MARK, -1), 2, 1 << 30)
    return F.transform(F.arrays_zip(marks.alias("mark"), bodies.alias("body")), lambda x: F.struct(F.regexp_extract(x["mark"], r"PAGINA (\d+)", 1).cast("int").alias("page"), stripped(x["body"]).alias("text")))
