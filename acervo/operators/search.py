"""Search predicates over tokenised texts, as column expressions.

Conditions are built with functions and combined with & | ~ and `either` (one
of two, not both); there is no query language to parse.  Accents and case
don't matter; a term with punctuation inside is a phrase.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.functions.text import norm
from acervo.operators.merging import ranged

TOKEN = r"[\p{L}\p{N}]+"


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(norm(c), F.lit(TOKEN), F.lit(0))


def plain(term: str) -> Column:
    return norm(F.lit(term))


def words(term: str) -> list[str]:
    import re
    import unicodedata

    bare = "".join(c for c in unicodedata.normalize("NFD", term) if unicodedata.category(c) != "Mn").casefold()
    return re.findall(r"[^\W_]+", bare)


def has(tok: Column, term: str) -> Column:
    """A term, or a phrase if it has several words; a term without words is in no text."""
    w = words(term)
    return F.lit(False) if not w else F.array_contains(tok, w[0]) if len(w) == 1 else phrase(tok, term)


def all_of(tok: Column, *terms: str) -> Column:
    return reduce(Column.__and__, [has(tok, t) for t in terms])


def any_of(tok: Column, *terms: str) -> Column:
    return reduce(Column.__or__, [has(tok, t) for t in terms])


def either(a: Column, b: Column) -> Column:
    return a != b


def places(tok: Column, term: str) -> Column:
    """Where the term, a word or a phrase, begins, from 0."""
    w = words(term)
    if not w:
        return F.array().cast("array<int>")
    same = lambda x, i: (x == w[0]) if len(w) == 1 else (x == w[0]) & (F.slice(tok, i + 1, len(w)) == F.array(*map(F.lit, w)))
    return F.array_compact(F.transform(tok, lambda x, i: F.when(same(x, i), i)))


def bound(lists: dict[str, Column], condition: Callable[[Column], Column]) -> Column:
    """A condition on lists that are each made once, however often it looks at them."""
    return F.exists(F.array(F.struct(*[c.alias(k) for k, c in lists.items()])), condition)


def phrase(tok: Column, text: str, slop: int = 0) -> Column:
    """The words one after another; slop: in this order, with at most so many more between the first and the last."""
    w = words(text)
    if not w:
        return F.lit(False)
    if slop == 0:
        return F.size(places(tok, text)) > 0

    def fits(s: Column) -> Column:
        def last(i: Column) -> Column:
            for k in range(1, len(w)):
                i = F.array_min(F.filter(s[f"w{k}"], lambda j: j > i))  # noqa: B023
            return i

        return F.exists(s["w0"], lambda i: F.coalesce(last(i) - i <= len(w) - 1 + slop, F.lit(False)))

    return bound({f"w{k}": places(tok, x) for k, x in enumerate(w)}, fits)


def behind(x: Column, y: Column, n: int) -> Column:
    """Whether one of y's places is 1 to n behind one of x's: of both lists, sorted together, one pass keeps the last of x before each of y."""
    marks = F.array_sort(F.concat(F.transform(x, lambda p: F.struct(p.cast("int").alias("at"), F.lit(1).alias("kind"))), F.transform(y, lambda p: F.struct(p.cast("int").alias("at"), F.lit(0).alias("kind")))))
    start = F.struct(F.lit(None).cast("int").alias("last"), F.lit(False).alias("hit"))
    step = lambda s, m: F.struct(F.when(m["kind"] == 1, m["at"]).otherwise(s["last"]).alias("last"), (s["hit"] | ((m["kind"] == 0) & F.coalesce(m["at"] - s["last"] <= n, F.lit(False)))).alias("hit"))
    return F.aggregate(marks, start, step, lambda s: s["hit"])


def apart(tok: Column, a: str, b: str, n: int, backwards: bool) -> Column:
    """Whether b begins at most n places after a's last word; backwards: or a after b's."""
    after = lambda x, y, more: behind(F.transform(x, lambda p: p + more), y, n)

    def fits(s: Column) -> Column:
        forth = after(s["a"], s["b"], len(words(a)) - 1)
        return forth | after(s["b"], s["a"], len(words(b)) - 1) if backwards else forth

    return bound({"a": places(tok, a), "b": places(tok, b)}, fits)


def followed(tok: Column, a: str, b: str, n: int = 1) -> Column:
    """b, a word or a phrase, at most n places after a."""
    return apart(tok, a, b, n, False)


def close(tok: Column, a: str, b: str, n: int = 1) -> Column:
    """a and b at most n places apart, in any order."""
    return apart(tok, a, b, n, True)


def together(text: Column, terms: list[str], within: str) -> Column:
    """All terms in one sentence or paragraph."""
    parts = F.split(text, r"(?<=[.!?])\s+" if within == "sentence" else r"\n", -1)
    return F.exists(parts, lambda p: all_of(tokens(p), *terms))


def matching(tok: Column, pattern: str) -> Column:
    """Wildcards: $ or * for any letters, $3 for at most three, ? for one; accents and case don't matter."""
    import re
    import unicodedata

    bare = "".join(c for c in unicodedata.normalize("NFD", pattern) if unicodedata.category(c) != "Mn").casefold()
    rule = re.sub(r"\\\$(\d+)", r".{0,\1}", re.escape(bare)).replace(r"\$", ".*").replace(r"\*", ".*").replace(r"\?", ".")
    return F.exists(tok, lambda x: x.rlike(f"^{rule}$"))


def fuzzy(tok: Column, term: str, most: int = 2) -> Column:
    """A word at most so many edits away from the term's first; a term without words is near none."""
    w = words(term)
    return F.exists(tok, lambda x: F.levenshtein(x, F.lit(w[0]), most) >= 0) if w else F.lit(False)


def missing(tok: Column, terms: list[str]) -> Column:
    """The terms, as they were given, that a text doesn't have."""
    return F.array_compact(F.array(*[F.when(~has(tok, t), F.lit(t)) for t in terms]))


def score(tok: Column, terms: list[str]) -> Column:
    """This engine's own relevance: how many of the terms a text has."""
    distinct = {tuple(words(t)): t for t in terms if words(t)}.values()
    return reduce(Column.__add__, [has(tok, t).cast("int") for t in distinct], F.lit(0))


def weighted(tok: Column, boosts: dict[str, float]) -> Column:
    """Relevance with boosts: the sum of the weights of the terms that a text has."""
    return reduce(Column.__add__, [F.when(has(tok, t), F.lit(float(w))).otherwise(0.0) for t, w in boosts.items()], F.lit(0.0))


def within_range(value: Column, low: object = None, high: object = None, low_in: bool = True, high_in: bool = True) -> Column:
    """A range of values, each end with or without the end itself; None is open. A null value is in none."""
    above = F.lit(True) if low is None else value >= low if low_in else value > low
    below = F.lit(True) if high is None else value <= high if high_in else value < high
    return F.coalesce(value.isNotNull() & above & below, F.lit(False))


def with_synonyms(terms: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(term, word): each term and the words that a dictionary gives for it."""
    return terms.select("term", F.col("term").alias("word")).unionByName(terms.join(synonyms, "term").select("term", "word")).distinct()


def faceted(found: DataFrame, *by: str, most: int = 10) -> DataFrame:
    """The most frequent values of each facet; ties by value."""
    each = [found.groupBy(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")) for c in by]
    ranked = reduce(DataFrame.unionByName, each).withColumn("rank", F.row_number().over(Window.partitionBy("facet").orderBy(F.desc("n"), "value")))
    return ranked.where(F.col("rank") <= most)


def page(found: DataFrame, number: int, size: int, *order: Column | str, largest: int = 100) -> DataFrame:
    """The 1-based page of a total order; sizes are kept to 1 to `largest`. Rows up to the page's end are all that is sorted together."""
    size, number = max(1, min(size, largest)), max(1, number)
    return found.orderBy(*order).offset((number - 1) * size).limit(size)


def deep_page(found: DataFrame, number: int, size: int, *order: Column | str, largest: int = 100) -> DataFrame:
    """The same page however far behind, with `place`: rows are ranged by the order and counted, and only the ranges that hold the page are read and sorted.

    The driver gets one count for each range, of which there are as many as shuffle partitions."""
    size, number = max(1, min(size, largest)), max(1, number)
    first, last = (number - 1) * size, number * size
    rows, before, wanted = ranged(found, *order), 0, {}
    for part, n in sorted(map(tuple, rows.groupBy("_part").agg(F.count("*")).collect())):
        if before < last and before + n > first:
            wanted[part] = before
        before += n
    offset = reduce(lambda out, x: F.when(F.col("_part") == x[0], x[1]).otherwise(out), wanted.items(), F.lit(0))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + offset
    placed = rows.where(F.col("_part").isin(list(wanted))).withColumn("place", place.cast("long")) if wanted else rows.limit(0).withColumn("place", F.lit(0).cast("long"))
    return placed.where((F.col("place") > first) & (F.col("place") <= last)).drop("_part")


def order_of(which: str, day: str, score: str, key: str, ties: list[Column] = []) -> list[Column]:
    """The columns that a result list is sorted by: newest, oldest or relevance (with further columns for equal scores); the key makes it total."""
    return {"newest": [F.desc(day), F.desc(key)], "oldest": [F.asc(day), F.asc(key)], "relevance": [F.desc(score), *ties, F.desc(key)]}[which]


def sorted_pages(found: DataFrame, orders: list[str], size: int, day: str, score: str, key: str, ties: list[Column] = []) -> DataFrame:
    """The first page by each order, with `sorted` and the place."""

    def one(which: str) -> DataFrame:
        by = order_of(which, day, score, key, ties)
        return page(found, 1, size, *by).select(F.lit(which).alias("sorted"), F.row_number().over(Window.orderBy(*by)).alias("place"), "*")

    return reduce(DataFrame.unionAll, map(one, orders))


def probe(base: int, with_operator: Column) -> Column:
    """What a portal made of an operator, by the number of its hits against that of the terms alone."""
    return F.when(with_operator == 0, "literal").when(with_operator == base, "ignored").when(with_operator < base, "narrows").otherwise("widens")
