"""Cleaning of extracted text: page furniture, repeated lines, near-empty pages, unreadable scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.functions.text import stripped

#: The furniture of court files, removed in this order.
FURNITURE = [
    r"Assinado eletronicamente por:.*?(?:Num\.|Pág\.).*?(?:\d+|\n)",
    r"Assinado eletronicamente por:[^\n]*\n",
    r"https?://pje\d?g?\.trf\d\.jus\.br/[^\s\n]*",
    r"https?://[^\s]*ConsultaDocumento[^\s\n]*",
    r"Numero do documento:\s*\d+",
    r"Número do documento:\s*\d+",
    r"Documento:\s*\d+\s*-\s*Inteiro Teor[^\n]*",
    r"Site certificado[^\n]*",
    r"DJ:\s*\d{2}/\d{2}/\d{4}\s*Página\s*\d+\s*de\s*\d+",
    r"Codigo de validacao:\s*[A-Za-z0-9]+",
    r"Código de validação:\s*[A-Za-z0-9]+",
    r"Pag\.\s*\d+\s*de\s*\d+",
    r"Página\s*\d+\s*de\s*\d+",
    r"- Pág\.\s*\d+",
    r"Este documento foi assinado digitalmente[^\n]*",
    r"Documento assinado digitalmente[^\n]*",
    r"Para verificar.*?acesse[^\n]*",
    r"^Num\.\s*\d+\s*$",
    r"\d{2}/\d{2}/\d{4}\s+\d{2}:\d{2}:\d{2}\s+Num\.\s*\d+",
]
#: Letterheads of law firms, an option.
LETTERHEADS = [
    r"(?:Fone|Tel|Telefone)s?:?\s*\(?\d{2}\)?\s*\d{4,5}[-.]\d{4}[^\n]*",
    r"e-?mail:\s*[^\s@]+@[^\s@]+\.[^\s\n]+",
    r"(?:Av\.|Avenida|Rua|R\.)[^,\n]+,\s*n[°o]?\s*\d+[^\n]*CEP[^\n]*",
    r"Filiais?:[^\n]+",
]
#: Words of which a readable file has two, and the page marker.
COMMON_WORDS = ["processo", "autor", "reu", "juiz", "sentenca", "decisao", "peticao", "direito"]
PAGE_MARK = r"={60}\n\[PAGINA \d+\]\n={60}"
FLAGS = "(?miu)"


def tidied(c: Column) -> Column:
    """Blank lines and spaces collapse, lines lose the white space at their ends, control characters go."""
    out = F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"[ \t]+", " ")
    lines = F.transform(F.split(out, "\n", -1), stripped)
    return F.regexp_replace(F.array_join(lines, "\n"), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def without_furniture(c: Column, also: list[str] = ()) -> Column:
    out = reduce(lambda x, p: F.regexp_replace(x, FLAGS + p, ""), [*FURNITURE, *also], c)
    return F.regexp_replace(F.regexp_replace(out, r"(?m)^[\s\-_=]{10,}$", ""), r"\n{4,}", "\n\n\n")


def without_empty_pages(c: Column, least: int = 50) -> Column:
    """Page markers stay; what stands between them goes unless it has over `least` characters that aren't white space."""
    bodies, marks = F.split(c, PAGE_MARK, -1), F.regexp_extract_all(c, F.lit(PAGE_MARK), F.lit(0))
    kept = F.transform(bodies, lambda b: F.when(F.length(F.regexp_replace(b, r"\s+", "")) > least, b).otherwise(""))
    return F.array_join(F.transform(kept, lambda b, i: F.concat(F.when(i > 0, F.get(marks, i - 1)).otherwise(""), b)), "")


def cleaned(c: Column, compatible: bool = False) -> Column:
    """The whole chain but for repeated lines.

    Furniture removal deletes the rules around page markers, so empty pages go
    before it; compatible: after it, when none is found.
    """
    pages = without_furniture(c) if compatible else without_empty_pages(c)
    return F.regexp_replace(tidied(without_empty_pages(pages) if compatible else without_furniture(pages)), r"\n{3,}", "\n\n")


def reduction(before: Column, after: Column) -> Column:
    """Per cent of characters removed."""
    return F.coalesce(F.try_divide((before - after) * 100.0, before), F.lit(0.0))


def without_repeated_lines(df: DataFrame, key: str, text: str, longest: int = 20, least: int = 5, share: float = 0.3) -> DataFrame:
    """Drops lines of over `longest` characters that a document repeats on at least `share` of its pages (and `least` times), but no page marker; equal rows of a key count together. n_repeated is added: how many such lines a document has.

    Lines are counted by aggregation, and a document's list of repeated lines,
    not its text, is what joins back.
    """
    bare = F.lower(stripped(F.col("line")))
    pages = F.regexp_count(text, F.lit(r"\[PAGINA "))
    lines = df.select(key, pages.alias("pages"), F.explode(F.split(text, "\n", -1)).alias("line")).select(key, "pages", bare.alias("bare"))
    often = lines.where((F.length("bare") > longest) & ~F.contains("bare", F.lit("[pagina"))).groupBy(key, "bare").agg(F.count("*").alias("n"), F.max("pages").alias("pages"))
    lists = often.where(F.col("n") >= F.greatest(F.lit(float(least)), F.col("pages") * share)).groupBy(F.col(key).alias("_of_key")).agg(F.collect_set("bare").alias("_repeated"))
    met = df.join(lists, df[key].eqNullSafe(lists["_of_key"]), "left").withColumn("_repeated", F.coalesce("_repeated", F.array().cast("array<string>")))
    kept = F.filter(F.split(text, "\n", -1), lambda x: ~F.array_contains(F.col("_repeated"), F.lower(stripped(x))))
    return met.withColumns({text: F.array_join(kept, "\n"), "n_repeated": F.size("_repeated")}).drop("_of_key", "_repeated")


def unreadable(text: Column, pages: Column, words: list[str] = COMMON_WORDS) -> Column:
    """Whether a text is likely a scan or badly encoded: few characters a page, many glyph codes, or too few common words."""
    real = stripped(F.regexp_replace(text, PAGE_MARK, ""))
    start = F.lower(F.substring(real, 1, 50_000))
    found = F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(start, w)))
    each = F.try_divide(F.length(real), pages)
    return (pages == 0) | (each < 200) | (F.regexp_count(real, F.lit(r"\(cid:\d+\)")) > 50) | ((each > 200) & (found < 2))


#: Fields of a case's first page, first match.
FIELDS = {
    "numero_cnj": (r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}", 0),
    "classe": (r"Classe:\s*([^\n]+)", 1),
    "autor": (r"(?:Autor|Requerente|Impetrante)(?:\(a\))?:\s*([^\n]+)", 1),
    "reu": (r"(?:Reu|Réu|Requerido|Impetrado)(?:\(a\))?:\s*([^\n]+)", 1),
    "assunto": (r"Assunto:\s*([^\n]+)", 1),
    "orgao_julgador": (r"(?:Orgao|Órgão)\s*(?:Julgador)?:\s*([^\n]+)", 1),
    "valor_causa": (r"Valor\s*(?:da\s*Causa)?:\s*R?\$?\s*([\d.,]+)", 1),
}


def fields(c: Column) -> Column:
    """A struct of the case's fields, null where not found."""
    return F.struct(*[F.nullif(stripped(F.regexp_extract(c, "(?iu)" + p, g)), F.lit("")).alias(name) for name, (p, g) in FIELDS.items()])
