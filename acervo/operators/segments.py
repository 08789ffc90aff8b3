"""Segments of a text: blocks from a marker to the next, and words with their sentence and paragraph."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo.functions.text import norm
from acervo.operators.search import TOKEN

#: Stands before each marker while a text is cut: two characters of Unicode's private use, which no text has side by side.
CUT = ""

#: Stands at each sentence's end while words are numbered; no part of a word.
ENDS, OTHER = "\ue000", "\ufffd"

SENTENCE_END = r"(?<=[.!?])\s+"


def blocks(text: Column, *markers: str) -> Column:
    """array<struct<nr, marker, kind, body>>: the text from each marker up to the next.

    Markers are regular expressions without groups of their own; of two that
    match at one place the first holds, and a marker begins only behind the one
    before.  nr counts from 1, kind is the marker's place in the list from 0.
    What stands before the first marker is in no block; without markers there
    are no blocks."""
    either = "|".join(f"(?:{m})" for m in markers)
    cut = F.split(F.regexp_replace(text, f"(?:{either})", F.lit(f"{CUT}$0")), CUT, -1)
    kind = lambda b: F.array_position(F.array(*[F.regexp_extract(b, f"^(?:{m})", 0) != "" for m in markers]), True) - 1

    def block(b: Column, i: Column) -> Column:
        marker = F.regexp_extract(b, f"^(?:{either})", 0)
        return F.struct((i + 1).alias("nr"), marker.alias("marker"), kind(b).cast("int").alias("kind"), F.substring(b, F.length(marker) + 1, F.length(b)).alias("body"))

    return F.transform(F.slice(cut, 2, 1 << 30), block)


def fields(block: Column, label: str, labels: dict[str, str]) -> Column:
    """map<name, value> of a block: what stands from a label (a regular expression with one group, its name) up to the next; the first of a name holds, labels that are not listed and empty values are left out."""
    found = F.regexp_extract_all(block, F.lit(label), F.lit(1))
    values = F.slice(F.split(block, label, -1), 2, 1 << 30)
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    pairs = F.transform(F.arrays_zip(found.alias("name"), values.alias("value")), lambda p: F.struct(F.element_at(names, F.upper(F.trim(p["name"]))).alias("key"), F.trim(p["value"]).alias("value")))
    kept = F.filter(pairs, lambda p: p["key"].isNotNull() & (p["value"] != ""))
    once = F.filter(kept, lambda p, i: ~F.exists(F.slice(kept, F.lit(1), i), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(once)


def numbered_words(text: Column) -> Column:
    """array<struct<word, place, sentence, paragraph>>: every word in normal form with its place, sentence and paragraph, all from 0.

    Sentences end at a full stop, exclamation or question mark before white
    space, paragraphs at a line feed; empty ones are counted too."""
    marked = norm(F.regexp_replace(F.replace(text, F.lit(ENDS), F.lit(OTHER)), SENTENCE_END, f"{ENDS}$0"))

    def numbers(words: Column) -> Column:
        return F.flatten(F.transform(words, lambda n, i: F.array_repeat(i, n)))

    def of(marked: Column) -> Column:
        """Of the normal form, which is so made once."""
        return F.struct(F.transform(F.split(marked, ENDS, -1), lambda s: F.regexp_extract_all(s, F.lit(TOKEN), F.lit(0))).alias("words"), F.transform(F.split(marked, "\n", -1), lambda p: F.regexp_count(p, F.lit(TOKEN))).alias("n"))

    def zipped(x: Column) -> Column:
        each = F.arrays_zip(F.flatten(x["words"]).alias("w"), numbers(F.transform(x["words"], F.size)).alias("s"), numbers(x["n"]).alias("p"))
        return F.transform(each, lambda y, i: F.struct(y["w"].alias("word"), i.alias("place"), y["s"].alias("sentence"), y["p"].alias("paragraph")))

    return F.when(text.isNotNull(), F.get(F.transform(F.transform(F.array(marked), of), zipped), F.lit(0)))


def by_word(words: Column) -> Column:
    """array<struct<word, places>> of numbered words: each word once with its array<struct<place, sentence, paragraph>> in order, in one sort of the text's own words."""

    def grouped(s: Column) -> Column:
        start = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["word"] != F.get(s, i - 1)["word"]))

        def posting(x: Column) -> Column:
            return F.transform(x["start"], lambda i, k: F.struct(F.get(s, i)["word"].alias("word"), F.transform(F.slice(s, i + 1, F.coalesce(F.get(x["start"], k + 1), F.size(s)) - i), lambda w: F.struct(w["place"], w["sentence"], w["paragraph"])).alias("places")))

        return F.get(F.transform(F.array(F.struct(start.alias("start"))), posting), F.lit(0))

    return F.when(F.size(words) > 0, F.get(F.transform(F.array(F.array_sort(words)), grouped), F.lit(0)))
