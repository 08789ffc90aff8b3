"""Verbatim-citation checks: quotes of a document must stand in its corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.functions.text import blank, norm_ws
from acervo.sources.shared import stored

#: Pairs of quotes, the marks of an omission, and the least length of a fragment that counts.
QUOTES = r'(?s)"[^"]+"|“[^”]+”'
OMISSION = r"\(\s*\.\.\.\s*\)|\[\s*\.\.\.\s*\]|\(\s*…\s*\)|\[\s*…\s*\]|…|\.\.\."
LEAST = 60


def before_heading(text: Column, marker: str) -> Column:
    """The text up to the first heading line that contains the marker; a mention elsewhere, or a blank marker, doesn't cut."""
    if not marker.strip():
        return text
    lines = F.split(text, "\n", -1)
    hit = F.array_position(F.transform(lines, lambda x: F.startswith(F.ltrim(x), F.lit("#")) & F.contains(norm_ws(x), norm_ws(F.lit(marker)))), True)
    return F.when(hit > 0, F.array_join(F.slice(lines, F.lit(1), (hit - 1).cast("int")), "\n")).otherwise(text)


def quotes(text: Column) -> Column:
    """The contents of all pairs of quotes, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(QUOTES), F.lit(0)), lambda q: F.substring(q, F.lit(2), F.length(q) - 2))


def fragments(quote: Column, least: int = LEAST) -> Column:
    """The parts of a quote between omissions, in normal form, that are long enough."""
    return F.filter(F.transform(F.split(quote, OMISSION, -1), norm_ws), lambda f: F.length(f) >= least)


def odd_quotes(text: Column) -> Column:
    """Whether straight quotes don't pair up: a missing one shifts all pairs that follow."""
    return F.regexp_count(text, F.lit('"')) % 2 == 1


def runs(words: Column, k: int) -> Column:
    """Hashes of all runs of k words, each once."""
    if k == 1:
        return F.array_distinct(F.transform(words, lambda x: F.xxhash64(x)))
    zipped = F.arrays_zip(*[(F.slice(words, j + 1, 1 << 30) if j else words).alias(f"w{j}") for j in range(k)])
    return F.array_distinct(F.array_compact(F.transform(zipped, lambda x: F.when(x[f"w{k - 1}"].isNotNull(), F.xxhash64(*[x[f"w{j}"] for j in range(k)])))))


def corpus(sources: DataFrame, files: DataFrame) -> DataFrame:
    """(workspace_id, part) of what quotes are checked against: excerpts of sources, and the texts of the case, one row each; blank ones are left out."""
    parts = sources.select("workspace_id", F.col("trecho_verbatim").alias("part")).unionByName(files.select("workspace_id", F.col("text").alias("part")))
    return parts.where(~blank(F.col("part")))


#: Runs by which fragments are looked up: of three words, or of one where a fragment has fewer whole ones.
RUN, SHORT_RUN = 3, 1


def held_in(wanted: DataFrame, corpus: DataFrame) -> DataFrame:
    """The (workspace_id, fragment) that stand in a part of their workspace.

    A fragment may begin and end within a word, so its inner words are whole
    ones of any part that holds it, and so are all runs of them.  The parts'
    runs that some fragment asks for are counted: a fragment with a run that
    no part has is held nowhere, any other is compared with the parts that have
    the rarest of its runs.  Only fragments without an inner word (two long
    words) are compared with all parts of their workspace.
    """
    # written once: every step below reads the normal forms
    parts = stored(corpus.select("workspace_id", norm_ws(F.col("part")).alias("part")).distinct().withColumn("digest", F.xxhash64("part")), "parts")
    each = wanted.select("workspace_id", "fragment").distinct().withColumn("words", F.split("fragment", " "))
    each = stored(each.select("workspace_id", "fragment", F.slice("words", F.lit(2), F.greatest(F.size("words") - 2, F.lit(0))).alias("inner")), "fragments")
    k = F.when(F.size("inner") >= RUN, RUN).when(F.size("inner") >= SHORT_RUN, SHORT_RUN)
    asked = each.select("workspace_id", "fragment", k.alias("k"), F.explode(F.when(k == RUN, runs(F.col("inner"), RUN)).when(k == SHORT_RUN, runs(F.col("inner"), SHORT_RUN))).alias("run"))
    # tables of their own, so that Spark knows their sizes before it deals the texts: few large workspaces would else be a task each
    looked_for = stored(asked.select("workspace_id", "k", "run").distinct(), "looked-for")
    spaces = stored(looked_for.select("workspace_id", "k").distinct(), "asking")
    without = stored(each.where(F.size("inner") == 0).select("workspace_id", "fragment"), "bare-fragments")

    def having(k: int) -> DataFrame:
        mine = looked_for.where(F.col("k") == k).drop("k")
        near = parts.join(spaces.where(F.col("k") == k).select("workspace_id"), "workspace_id", "left_semi")
        return near.select("workspace_id", "digest", F.explode(runs(F.split("part", " "), k)).alias("run")).join(mine, ["workspace_id", "run"], "left_semi")

    found = stored(having(RUN).unionByName(having(SHORT_RUN)), "quoted-runs")
    often = found.groupBy("workspace_id", "run").agg(F.count("*").alias("n"))
    rarest = asked.join(often, ["workspace_id", "run"], "left").groupBy("workspace_id", "fragment").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "run")).alias("rarest"))
    hits = rarest.where("rarest.n > 0").select("workspace_id", "fragment", F.col("rarest.run").alias("run")).join(found, ["workspace_id", "run"])
    met = hits.join(parts, ["workspace_id", "digest"]).select("workspace_id", "fragment", "part")
    bare = without.join(parts, "workspace_id").select("workspace_id", "fragment", "part")
    return met.unionAll(bare).where(F.contains("part", F.col("fragment"))).select("workspace_id", "fragment").distinct()


def checked(documents: DataFrame, corpus: DataFrame, least: int = LEAST, marker: str = "") -> DataFrame:
    """For each document: quotes checked, failed, the first failed one, and whether its straight quotes don't pair up.

    documents: workspace_id, doc_id, text.  corpus: workspace_id, part (text).
    marker: a heading that ends what is checked.
    """
    cut = documents.select("workspace_id", "doc_id", before_heading(F.col("text"), marker).alias("text"))
    each = cut.select("workspace_id", "doc_id", F.posexplode(quotes(F.col("text"))).alias("place", "quote"))
    wanted = each.select("workspace_id", "doc_id", "place", "quote", F.explode(fragments(F.col("quote"), least)).alias("fragment"))
    held = held_in(wanted, corpus).withColumn("held", F.lit(True))
    by_quote = wanted.join(held, ["workspace_id", "fragment"], "left").groupBy("workspace_id", "doc_id", "place").agg(F.bool_and(F.coalesce("held", F.lit(False))).alias("ok"), F.first("quote").alias("quote"))
    totals = by_quote.groupBy("workspace_id", "doc_id").agg(F.count("*").alias("n_checked"), F.count_if(~F.col("ok")).alias("n_failed"), F.min_by("quote", F.when(~F.col("ok"), F.col("place"))).alias("first_failed"))
    met = cut.select("workspace_id", "doc_id", odd_quotes(F.col("text")).alias("odd_quotes")).join(totals, ["workspace_id", "doc_id"], "left")
    return met.select("workspace_id", "doc_id", F.coalesce("n_checked", F.lit(0)).alias("n_checked"), F.coalesce("n_failed", F.lit(0)).alias("n_failed"), "first_failed", "odd_quotes")
