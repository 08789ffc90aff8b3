"""Report sinks: records as XML or Markdown text, merged sentences, logs."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.functions.text import norm, xml_escaped
from acervo.operators.gates import gate, problems


def xml_record(tag: str, columns: dict[str, Column]) -> Column:
    """One element with a child for each column that isn't null or empty."""
    child = lambda name, c: F.when(c.cast("string") != "", F.concat(F.lit(f"  <{name}>"), xml_escaped(c.cast("string")), F.lit(f"</{name}>")))
    return F.concat_ws("\n", F.lit(f"<{tag}>"), *[child(n, c) for n, c in columns.items()], F.lit(f"</{tag}>"))


def markdown_record(title: Column, columns: dict[str, Column]) -> Column:
    line = lambda name, c: F.when(c.cast("string") != "", F.concat(F.lit(f"- **{name}:** "), c.cast("string")))
    return F.concat_ws("\n", F.concat(F.lit("### "), title), *[line(n, c) for n, c in columns.items()])


def merged_sentence(report: Column, reasoning: Column) -> Column:
    """Both texts without trailing line ends, a blank line between and one line end after."""
    bare = lambda c: F.regexp_replace(c, r"\n+$", "")
    return F.concat(bare(report), F.lit("\n\n"), bare(reasoning), F.lit("\n"))


def sentences(artifacts: DataFrame, contracts: DataFrame, parts: tuple[str, str] = ("relatorio", "fundamentacao"), whole: str = "sentenca") -> DataFrame:
    """(workspace_id, text, problems, exit_code): the merged sentence of each workspace, checked before and after.

    Both parts must be valid first (exit code 1, no text, their problems if
    not); the merged text is written even if it breaks its own contract, with
    exit code 1 and what it breaks.  artifacts: workspace_id, suffix, text."""
    here = contracts.where(F.col("stage").isin(*parts, whole))
    spaces = artifacts.select("workspace_id").distinct()
    faults = gate(artifacts.join(F.broadcast(here.select("suffix")), "suffix", "left_semi"), here, spaces, list(parts)).where("status != 'OK'").groupBy("workspace_id").agg(F.array_sort(F.collect_list(F.concat(F.col("stage"), F.lit(": "), F.when(F.col("status") == "ABSENT", "absent").otherwise(F.array_join("problems", "; "))))).alias("before"))
    text = lambda stage: F.max(F.when(F.col("stage") == stage, F.col("text")))
    merged = artifacts.join(F.broadcast(here.select("stage", "suffix")), "suffix").groupBy("workspace_id").agg(merged_sentence(text(parts[0]), text(parts[1])).alias("text"))
    met = spaces.join(faults, "workspace_id", "left").join(merged, "workspace_id", "left").withColumn("text", F.when(F.col("before").isNull(), F.col("text")))
    written = met.join(F.broadcast(here.where(F.col("stage") == whole)))  # one row
    after = F.when(F.col("text").isNotNull(), problems(F.col("text"), norm(F.col("text"))))
    found = written.withColumn("problems", F.coalesce("before", after, F.array().cast("array<string>")))
    return found.select("workspace_id", "text", "problems", F.when(F.size("problems") > 0, 1).otherwise(0).alias("exit_code"))


def json_value(c: Column) -> Column:
    """A value as JSON on one line, letters beyond ASCII as they are."""
    text = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    return F.substring(text, 6, F.length(text) - 6)


def json_record(columns: dict[str, Column], depth: int = 0) -> Column:
    """A record as a JSON object over several lines, indented by two spaces a level; null fields stay."""
    pad = "  " * depth
    fields = [F.concat(F.lit(f"{pad}  {json.dumps(k, ensure_ascii=False)}: "), json_value(c)) for k, c in columns.items()]
    return F.concat(F.lit(f"{pad}{{\n"), F.concat_ws(",\n", *fields), F.lit(f"\n{pad}}}"))


def json_document(head: dict[str, Column], name: str, records: Column) -> Column:
    """A document of a few fields and one list of records (of json_record at depth 2)."""
    fields = [F.concat(F.lit(f"  {json.dumps(k, ensure_ascii=False)}: "), json_value(c)) for k, c in head.items()]
    items = F.when(F.size(records) == 0, "[]").otherwise(F.concat(F.lit("[\n"), F.array_join(records, ",\n"), F.lit("\n  ]")))
    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *fields, F.concat(F.lit(f'  "{name}": '), items)), F.lit("\n}"))


def log_totals(rows: DataFrame, ok: str, before: str, after: str) -> DataFrame:
    """Totals of a conversion log; the reduction is that of the sums."""
    out = rows.agg(F.count_if(F.col(ok)).alias("n_ok"), F.count_if(~F.col(ok)).alias("n_failed"), F.sum(before).alias("before"), F.sum(after).alias("after"))
    return out.withColumn("reduction", F.coalesce(F.try_divide((F.col("before") - F.col("after")) * 100.0, F.col("before")), F.lit(0.0)))


def write_csv(rows: DataFrame, path: str, separator: str = ";") -> None:
    """A report as CSV with a header, every text in quotes, so that separators and line ends in it stay; nulls are empty, lists and structs JSON."""
    flat = [F.to_json(c).alias(c) if kind.startswith(("array", "struct", "map")) else F.col(c) for c, kind in rows.dtypes]
    rows.select(*flat).write.csv(path, mode="overwrite", header=True, sep=separator, quoteAll=True, escape='"', emptyValue="", encoding="UTF-8")


def write_json(rows: DataFrame, path: str) -> None:
    """One JSON object a line; null fields stay."""
    rows.write.json(path, mode="overwrite", ignoreNullFields=False)
