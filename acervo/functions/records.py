"""Column functions over search records: labelled fields, fallbacks, codes, nested lists, date ranges."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.functions.text import collapsed, court_code, norm, norm_ws, stripped, unescaped

#: Groups of courts and their members.
STATES = "AC AL AP AM BA CE DF ES GO MA MT MS MG PA PB PR PE PI RJ RN RS RO RR SC SP SE TO".split()
GROUPS = {
    "superiores": ["STF", "STJ", "TST", "STM", "TNU"],
    "trfs": [f"TRF{i:02d}" for i in range(1, 7)],
    "tjs": [f"TJ{x}" for x in STATES],
    "trts": [f"TRT{i:02d}" for i in range(1, 25)],
    "tjms": ["TJMMG", "TJMRS", "TJMSP"],
}
#: The unified federal base's courts, regional panels and appeal panels.
FEDERAL = {"TODOS": ["STF", "STJ", "TNU", "TRF1", "TRF2", "TRF3", "TRF4", "TRF5"], "TRU": [f"TRU{i}" for i in range(1, 7)], "TR": [f"TR{i}" for i in range(1, 7)]}
#: Ranks of kinds of precedents, with ties, by either of two tables.
HIERARCHY = {
    "first": {"ADI": 1, "ADC": 1, "ADO": 1, "ADPF": 1, "RG": 1, "RR": 2, "SV": 3, "SUM": 4, "IRDR": 5, "IAC": 5},
    "second": {"RG": 1, "RR": 2, "IRDR": 3, "IAC": 3, "SUM": 4, "SV": 4, "DOMINANTE": 5},
}


def filled(c: Column) -> Column:
    """Null for white space."""
    return F.nullif(stripped(c), F.lit(""))


def by_precedence(**sources: Column) -> Column:
    """struct(value, source) of the first that isn't blank."""
    value = F.coalesce(*[filled(c) for c in sources.values()])
    source = reduce(lambda out, x: F.when(filled(x[1]).isNotNull(), x[0]).otherwise(out), list(sources.items())[::-1], F.lit(None).cast("string"))
    return F.struct(value.alias("value"), source.alias("source"))


def labelled(rows: DataFrame, key: str, position: str, label: str, value: str, rules: list[tuple[str, str]], exact: bool = False, last: bool = False) -> DataFrame:
    """Labelled values as one row of fields for each key.

    A label's field is that of the first rule whose text it contains (or
    equals); of several values the first, or the last, holds.
    """
    n = norm_ws(F.col(label))
    field = reduce(lambda out, r: F.when(n == r[0] if exact else F.contains(n, F.lit(r[0])), r[1]).otherwise(out), rules[::-1], F.lit(None).cast("string"))
    pick = F.max_by if last else F.min_by
    names = list(dict.fromkeys(f for _, f in rules))
    each = rows.withColumn("_field", field).where(F.col("_field").isNotNull() & filled(F.col(value)).isNotNull())
    return each.groupBy(key).agg(*[pick(F.when(F.col("_field") == f, F.col(value)), F.when(F.col("_field") == f, F.col(position))).alias(f) for f in names])


def region_code(c: Column) -> Column:
    """TRU 5ª Região becomes TRU5."""
    number = F.regexp_extract(c, r"(?i)(\d+)\s*[ªa]?\s*regi", 1)
    return F.when(number != "", F.concat(F.upper(F.regexp_extract(c, r"^\s*(\w+)", 1)), number)).otherwise(F.upper(F.trim(c)))


def expanded(codes: DataFrame, code: str, groups: dict[str, list[str]] = GROUPS, normal: Callable[[Column], Column] = court_code) -> DataFrame:
    """(court, known): a group's members in its place, each once; known tells courts from codes that no group has.

    A code's form doesn't matter (trf5 is TRF05).  A group is written in any case; blank codes are dropped."""
    table = F.create_map(*[x for k, v in groups.items() for x in (F.lit(k.upper()), F.array(*map(F.lit, v)))])
    known = F.array(*map(F.lit, dict.fromkeys(x for v in groups.values() for x in v)))
    upper = F.upper(stripped(F.col(code)))
    each = codes.where(filled(F.col(code)).isNotNull()).select(F.explode(F.coalesce(F.element_at(table, upper), F.array(normal(upper)))).alias("court")).distinct()
    return each.withColumn("known", F.array_contains(known, F.col("court")))


def courts(codes: DataFrame, code: str, groups: dict[str, list[str]] = GROUPS, normal: Callable[[Column], Column] = court_code) -> DataFrame:
    """The courts asked for, all of them if no code is given; an unknown code ends the query, since it would find nothing."""
    found = expanded(codes, code, groups, normal)
    checked = F.when(F.col("known"), F.col("court")).otherwise(F.raise_error(F.concat(F.lit("unknown court: "), F.col("court"))))
    every = codes.sparkSession.createDataFrame([(x,) for x in dict.fromkeys(x for v in groups.values() for x in v)], "court string")
    none = codes.agg((F.count(filled(F.col(code))) == 0).alias("none"))
    return found.select(checked.alias("court")).unionAll(every.join(F.broadcast(none)).where("none").select("court"))


def last_of(c: Column, n: int) -> Column:
    """The last n of a list, or all of a shorter one."""
    return F.slice(c, F.greatest(F.lit(1), F.size(c) - n + 1), n)


def first_of(c: Column, n: int) -> Column:
    return F.slice(c, 1, n)


def active(c: Column) -> Column:
    """The suspensions that are in force."""
    return F.filter(c, lambda s: F.coalesce(s["ativa"], F.lit(False)))


def in_range(day: Column, first: str | None, last: str | None, both: bool = False) -> Column:
    """A closed range; an open end is filled with a sentinel, or an error where both ends are asked for."""
    if both and (first is None) != (last is None):
        raise ValueError("a date range needs both ends")
    return day.between(F.to_date(F.lit(first or "1900-01-01")), F.to_date(F.lit(last or "2099-12-31")))


def last_parenthetical(c: Column, start: str) -> Column:
    """The last parenthesis that begins with `start`, or null."""
    found = F.regexp_extract_all(c, F.lit(rf"\({start}[^()]*\)"), F.lit(0))
    return F.get(found, F.size(found) - 1)


def official_citation(raw: Column, start: str) -> Column:
    """struct(citation, summary) of a card's escaped citation: the last parenthesis that begins with `start`, and the text without its label, for cards that have no summary; both with single spaces."""
    plain = unescaped(raw)
    found = F.regexp_extract_all(plain, F.lit(rf"(?s)\(({start}.*?)\)"), F.lit(1))
    last = collapsed(F.get(found, F.size(found) - 1))
    return F.struct(F.concat(F.lit("("), last, F.lit(")")).alias("citation"), collapsed(F.regexp_replace(plain, r"^EMENTA:\s*", "")).alias("summary"))


def rejoined(lines: Column) -> Column:
    """Lines of digits alone go to the end of the line before, whose number they continue."""
    digits = lambda x: x.rlike(r"^\s*\d+\s*$")
    next_ = F.concat(F.slice(lines, 2, 1 << 30), F.array(F.lit("")))
    joined = F.transform(F.arrays_zip(lines.alias("a"), next_.alias("b")), lambda x: F.struct(digits(x["a"]).alias("gone"), F.when(~digits(x["a"]) & digits(x["b"]) & x["a"].rlike(r"\d$"), F.concat(x["a"], F.trim(x["b"]))).otherwise(x["a"]).alias("text")))
    first = F.transform(joined, lambda x, i: F.struct((x["gone"] & (i > 0) & F.coalesce(F.get(lines, i - 1).rlike(r"\D.*\d$"), F.lit(False))).alias("gone"), x["text"].alias("text")))
    return F.transform(F.filter(first, lambda x: ~x["gone"]), lambda x: x["text"])


def ranked(kind: Column, table: str = "first") -> Column:
    """A precedent's rank, the strongest first, equal ones alike; unknown kinds come last."""
    ranks = HIERARCHY[table]
    known = F.create_map(*[x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(known, F.upper(F.trim(kind))), F.lit(max(ranks.values()) + 1))


def labelled_codes(rows: DataFrame, labels: DataFrame, code: str, label: str = "label") -> DataFrame:
    """rows with the label of their code; a code without one is its own.  labels: code, label; of several labels of a code the first by alphabet holds."""
    once = labels.groupBy(F.col(code).alias("_code")).agg(F.min(label).alias("_label"))
    return rows.join(once, F.col(code).eqNullSafe(F.col("_code")), "left").withColumn(label, F.coalesce("_label", F.col(code).cast("string"))).drop("_code", "_label")


def unknown(requested: DataFrame, known: DataFrame, code: str) -> DataFrame:
    """Requested codes that are not known, each once, with how many asked for them; null and blank ones ask for nothing."""
    asked = requested.where(stripped(F.col(code).cast("string")) != "").groupBy(code).agg(F.count("*").alias("n"))
    return asked.join(known.select(F.col(code).alias("_known")).distinct(), F.col(code) == F.col("_known"), "left_anti")


def first_hit(*sources: DataFrame, key: list[str]) -> DataFrame:
    """The rows of each key from the first source that has any."""
    each = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.withColumn("priority", F.lit(i)) for i, s in enumerate(sources)])
    best = each.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.min("priority").alias("_best"))
    met = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]) & (F.col("priority") == F.col("_best"))
    return each.join(best, met).drop(*[f"_{k}" for k in key], "_best")


def newest_of_alike(rulings: DataFrame, rapporteur: str, klass: str, summary: str, day: str, tie: str) -> DataFrame:
    """Of rulings with the same rapporteur, class and summary in normal form, the newest."""
    return rulings.groupBy(rapporteur, klass, F.md5(norm(F.col(summary))).alias("_summary")).agg(F.max_by(F.struct(*rulings.columns), F.struct(day, tie)).alias("_row"), F.count("*").alias("n_alike")).select("_row.*", "n_alike")


def in_field(field: Column, condition: Callable[[Column], Column]) -> Column:
    """A search condition on the words of one field alone; a null field meets none."""
    from acervo.operators.search import tokens

    return F.coalesce(condition(tokens(field)), F.lit(False))


def located(rows: DataFrame, key: str, value: object, first: int | None = None, order: list[str] = []) -> DataFrame:
    """The record of an identifier; first: sought among so many rows only, in the given order."""
    return (rows if first is None else rows.orderBy(*order).limit(first)).where(F.col(key) == value)


def exact_number(rows: DataFrame, number: str, kind: str, wanted: str, kinds: list[str], cancelled: str | None = None) -> DataFrame:
    """Records of a number and one of some kinds; cancelled: a flag of those to leave out."""
    found = rows.where((F.col(number) == wanted) & F.col(kind).isin(kinds))
    return found if cancelled is None else found.where(~F.coalesce(F.col(cancelled), F.lit(False)))
