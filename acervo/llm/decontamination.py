"""Benchmark decontamination by template canonicalisation.

Words lose the punctuation around them and their case; numbers, units and
names (capitalised words inside a sentence) become typed placeholders.  Every
window of canonical words of a benchmark item is filed under its hash, and the
documents' windows are joined with them, so that a question is found whose
numbers and names were changed.  Hits are verified word by word.  Those of one
offset between document and item must fill the item's slots consistently: a
value of the item stands for one value in the document wherever it occurs, and
numbers stay numbers.  A document is contaminated by an item if enough of the
item's windows hold and few slots contradict.

An item without a good window (fewer words than a window, or mostly
placeholders) is sought as a whole if `whole` says so: all its words, numbers
and names as they are, in one row.  Its first words are its key; a document
holds it wherever they and the rest follow each other, so an item of one
common word is found in every document with that word.

Benchmark windows go to the documents' tasks as hashes if they are at most
MOST_HASHES, and as a bit table of bounded size if there are more; either way
only windows that may be in the benchmark leave the tasks, and the join decides.

Defined results: null or empty texts have no windows; an item without words
is never found, one without a good window only as a whole; repeated rows are judged alike; repeated items are one; texts that share an
identifier are sought apart and count as one item, by the text that is covered
most; a null identifier is one too; an empty benchmark contaminates nothing; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm import text as tx
from acervo.llm.bits import bit_table, may_have
from acervo.llm.common import stored

WINDOW = 8
#: At least so many words of a window are no placeholders.
LEAST_PLAIN = 4
#: An item is found if this share of its windows is, and at most this share of its slots contradict.
COVERAGE, CONFLICTS = 0.4, 0.2
#: Hashes of benchmark windows that may be sent to all tasks (16 MB).
MOST_HASHES = 2_000_000
BASE = 0x9E3779B97F4A7C15
ANCHOR_BASE = 0xC2B2AE3D27D4EB4F
#: The place of an item that is sought as a whole.
WHOLE = -1
#: By number of an item's first words that are its key: the keys' hashes, sorted, and the items' lengths for each; no hashes if there are too many, and all lengths.
Sought = dict[int, tuple[np.ndarray | None, list]]

NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
NUMERAL = re.compile(r"[+-]?[$€£¥]?[0-9][0-9.,:/]*(?:st|nd|rd|th|%)?")
#: Number words and units.
NUMBER_WORDS = set("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
UNITS = set("km m cm mm mile miles metre metres meter meters foot feet inch inches kg g mg lb lbs ounce ounces oz ton tons l ml litre litres liter liters second seconds minute minutes hour hours day days week weeks month months year years percent % dollar dollars euro euros cent cents pound pounds usd eur mph kph degree degrees celsius fahrenheit".split())
NUMBER_UNIT = re.compile(rf"({NUMERAL.pattern})({'|'.join(sorted(u for u in UNITS if u.isalpha() and len(u) < 4))})")
EDGE = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in "+-$%<>") + "“”‘’«»„…"
PLAIN, NUM, UNI, CAP = 0, 1, 2, 3
PLACEHOLDERS = ["", NUMBER, UNIT, NAME]


def canonical(word: str) -> tuple[str, int, bool]:
    """A word without its edges and case, its kind, and whether it ends a sentence."""
    core = word.strip(EDGE) or word
    ends = word.rstrip("\"')]}”’»")[-1:] in (".", "!", "?", "…", ":")
    low = core.lower()
    if NUMERAL.fullmatch(low) or low in NUMBER_WORDS:
        return low, NUM, ends
    if NUMBER_UNIT.fullmatch(low):
        return low, NUM, ends
    if low in UNITS:
        return low, UNI, ends
    return low, CAP if core[0].isupper() and core[1:] == core[1:].lower() else PLAIN, ends


class Templates:
    """The canonical words of a batch of texts and the hashes of their windows."""

    def __init__(self, column, window: int = WINDOW) -> None:
        w = self.words = tx.words(column)
        seen = [canonical(x) for x in w.uniq.to_pylist()]
        self.low = np.array([s[0] for s in seen], object)
        kind, ends = np.array([s[1] for s in seen], np.int8)[w.codes], np.array([s[2] for s in seen], bool)[w.codes]
        first = np.ones(len(w.codes), bool)  # of a sentence: a capital there makes no name
        first[1:] = ends[:-1]
        first[w.starts[:-1][np.diff(w.starts) > 0]] = True
        kind[(kind == CAP) & first] = PLAIN
        self.kind = kind
        of_kind = np.array([xxhash.xxh64_intdigest(x) for x in PLACEHOLDERS], np.uint64)
        of_word = np.fromiter((xxhash.xxh64_intdigest(x) for x in self.low), np.uint64, len(self.low))
        h = np.where(kind == PLAIN, of_word[w.codes], of_kind[kind]) if len(w.codes) else np.empty(0, np.uint64)
        self.plain = of_word[w.codes] if len(w.codes) else np.empty(0, np.uint64)
        self.prints = tx.rolling(h, window, BASE)
        n = len(self.prints)
        plain = np.zeros(len(kind) + 1, np.int64)
        np.cumsum(kind == PLAIN, out=plain[1:])
        self.good = tx.inside(w.doc, window) & (plain[window:] - plain[:n] >= LEAST_PLAIN) if n else np.empty(0, bool)

    def window_at(self, at: int, window: int) -> tuple[list[str], list[str | None]]:
        """Its canonical words, and the words that stand in its slots."""
        kinds, low = self.kind[at : at + window].tolist(), self.low[self.words.codes[at : at + window]].tolist()
        return [PLACEHOLDERS[k] or x for k, x in zip(kinds, low, strict=True)], [x if k else None for k, x in zip(kinds, low, strict=True)]

    def anchors(self, k: int) -> np.ndarray:
        """A hash of each k words as they are."""
        return tx.rolling(self.plain, k, ANCHOR_BASE)

    def words_at(self, at: int, n: int) -> list[str]:
        return self.low[self.words.codes[at : at + n]].tolist()

    def unseen(self, window: int) -> list[tuple[int, int, int, list[str]]]:
        """(row, place, anchor, words) of the rows that have words and no good window."""
        n = np.diff(self.words.starts)
        good = np.zeros(len(n), bool)
        good[self.words.doc[np.flatnonzero(self.good)]] = True
        out = []
        for k in range(1, window + 1):
            of_k = np.flatnonzero(~good & (np.minimum(n, window) == k))
            if len(of_k):
                anchors = tx.signed(self.anchors(k))
                out += [(i, WHOLE, int(anchors[self.words.starts[i]]), self.words_at(self.words.starts[i], n[i])) for i in of_k.tolist()]
        return sorted(out)

    def wholes(self, sought: Sought) -> list[tuple[int, int, int, list[str]]]:
        """(row, place, anchor, words) where the rows may hold whole items, each sequence of words once a row."""
        w, out = self.words, {}
        for k, (known, lengths) in sought.items():
            anchors = self.anchors(k)
            at = np.flatnonzero(tx.inside(w.doc, k)) if len(anchors) else np.empty(0, np.int64)
            place = None
            if known is not None and len(at):
                place = np.minimum(np.searchsorted(known, anchors[at]), len(known) - 1)
                same = known[place] == anchors[at]
                at, place = at[same], place[same]
            signed = tx.signed(anchors)
            for i, a in enumerate(at.tolist()):
                row = int(w.doc[a])
                for n in lengths if place is None else lengths[place[i]]:
                    if a + n <= w.starts[row + 1]:
                        found = self.words_at(a, n)
                        out.setdefault((row, tuple(found)), (row, a - int(w.starts[row]), int(signed[a]), found))
        return sorted(out.values())

HITS = "doc_id long, digest long, at array<int>, print array<long>, template array<array<string>>, slots array<array<string>>"


def among(known: tuple[str, np.ndarray], h: np.ndarray) -> np.ndarray:
    """Which hashes are among those known, ("sorted", hashes), or may be, ("bits", a bit table)."""
    how, table = known
    if how == "bits":
        return may_have(table, h)
    return table[np.minimum(np.searchsorted(table, h), len(table) - 1)] == h if len(table) else np.zeros(len(h), bool)


def windows(rows: DataFrame, window: int = WINDOW, only: tuple[str, np.ndarray] | None = None, unseen: bool = False, sought: Sought | None = None) -> DataFrame:
    """For every row of (doc_id, text): its good windows, or those whose hashes may be in `only`.

    unseen: a row without any has all its words as one; sought: rows have those of whole items too."""
    sent = rows.sparkSession.sparkContext.broadcast((only, sought))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, items = sent.value
        kinds = [pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.string())), pa.list_(pa.list_(pa.string()))]
        for b in tx.sliced(batches):
            t = Templates(b.column("text"), window)
            k = np.flatnonzero(t.good)
            if known is not None:
                k = k[among(known, t.prints[k])]
            row = t.words.doc[k]
            found = [t.window_at(i, window) for i in k.tolist()]
            at, prints = (k - t.words.starts[row]).tolist(), tx.signed(t.prints[k]).tolist()
            extra = t.unseen(window) if unseen else t.wholes(items) if items else []
            if extra:
                row = np.concatenate([row, np.array([e[0] for e in extra], np.int64)])
                order = np.argsort(row, kind="stable")
                row = row[order]
                taken = lambda values, more: [(values + more)[i] for i in order.tolist()]  # noqa: B023, E731
                at, prints, found = taken(at, [e[1] for e in extra]), taken(prints, [e[2] for e in extra]), taken(found, [(e[3], [None] * len(e[3])) for e in extra])
            cut = np.searchsorted(row, np.arange(b.num_rows + 1))
            lists = lambda values: [values[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]  # noqa: B023, E731
            cols = [at, prints, [f[0] for f in found], [f[1] for f in found]]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("digest"), *(pa.array(lists(c), kind) for c, kind in zip(cols, kinds, strict=True))], ["doc_id", "digest", "at", "print", "template", "slots"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text").mapInArrow(run, HITS)


def exploded(found: DataFrame, *keys: str) -> DataFrame:
    each = found.select(*keys, F.explode(F.arrays_zip("at", "print", "template", "slots")).alias("w"))
    return each.select(*keys, "w.at", "w.print", "w.template", "w.slots")


def sought_in(items: DataFrame, n: int, window: int, most: int) -> Sought:
    """What documents are searched for: the items that are one window of all their words."""
    wholes = items.where(F.col("place") == WHOLE).select("item_print", F.size("expected").alias("n"))
    out = {}
    if n > most:
        for (length,) in wholes.select("n").distinct().orderBy("n").collect():
            out.setdefault(min(length, window), (None, []))[1].append(length)
        return out
    by = {}
    for anchor, length in wholes.distinct().collect():
        by.setdefault(min(length, window), {}).setdefault(anchor % (1 << 64), []).append(length)
    for k, of in by.items():
        known = sorted(of)
        out[k] = (np.array(known, np.uint64), [sorted(of[a]) for a in known])
    return out


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = MOST_HASHES, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, item_id, coverage, n_slots, n_conflicts) of the documents and items that share windows, and every document's windows."""
    texts = benchmark.select(F.col("item_id").alias("doc_id"), "text").distinct()
    items = stored(exploded(windows(texts, window, unseen=whole), "doc_id", "digest").withColumnsRenamed({"doc_id": "item_id", "digest": "item_digest", "at": "place", "template": "expected", "slots": "values"}).withColumnRenamed("print", "item_print"), "items")
    n = items.count()
    prints = items.select("item_print")
    only = ("sorted", np.unique(prints.toArrow()["item_print"].to_numpy().astype(np.int64).view(np.uint64))) if n <= most else ("bits", bit_table(prints))
    found = stored(windows(docs, window, only, sought=sought_in(items, n, window, most) if whole else None), "hits")
    of_item = items.groupBy(F.col("item_id").alias("of_item"), F.col("item_digest").alias("of_digest")).agg(F.count("*").alias("n_windows"))
    hits = exploded(found, "doc_id", "digest").join(items, (F.col("print") == F.col("item_print")) & (F.col("template") == F.col("expected")))
    pairs = F.array_distinct(F.filter(F.arrays_zip("values", "slots"), lambda p: p["slots"].isNotNull()))
    key = ["doc_id", "digest", "item_id", "item_digest"]
    lines = hits.select(*key, (F.col("at") - F.col("place")).alias("offset"), "place", pairs.alias("pairs")).distinct()
    along = lines.groupBy(*key, "offset").agg(F.collect_set("place").alias("places"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    slots = F.size(F.array_distinct(F.col("pairs.values")))
    scored = along.select(*key, "places", slots.alias("n_slots"), (F.size("pairs") - slots).alias("n_conflicts"))
    judged = scored.where(F.col("n_conflicts") <= CONFLICTS * F.col("n_slots")).groupBy(*key).agg(F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("n_found"), F.sum("n_slots").alias("n_slots"), F.sum("n_conflicts").alias("n_conflicts"))
    share = (F.col("n_found") / F.col("n_windows")).alias("coverage")
    of_text = judged.join(of_item, F.col("item_id").eqNullSafe(F.col("of_item")) & (F.col("item_digest") == F.col("of_digest"))).select(*key, share, "n_slots", "n_conflicts")
    best = of_text.groupBy(*key[:3]).agg(F.max(F.struct("coverage", (-F.col("n_conflicts")).alias("less"), "n_slots", "n_conflicts")).alias("best"))
    return best.select(*key[:3], "best.coverage", "best.n_slots", "best.n_conflicts"), found


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, **more) -> tuple[DataFrame, DataFrame]:
    """The pairs of document and item that contaminate, and one row for every document."""
    pairs, found = matches(docs, benchmark, **more)
    return pairs.where(F.col("coverage") >= coverage), found.select("doc_id", "digest")


def judged(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, **more) -> DataFrame:
    """Every document with the items that it holds."""
    pairs, every = leaks(docs, benchmark, coverage, **more)
    held = pairs.groupBy(F.col("doc_id").alias("held_id"), F.col("digest").alias("held_digest")).agg(F.count("*").alias("n_items"), F.max(F.struct("coverage", (-F.col("item_id")).alias("first"), "item_id")).alias("best"))
    met = every.join(held, F.col("doc_id").eqNullSafe(F.col("held_id")) & (F.col("digest") == F.col("held_digest")), "left")
    return met.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.col("best.item_id").alias("item_id"), F.coalesce("best.coverage", F.lit(0.0)).alias("coverage"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, **more) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    pairs, _ = leaks(docs, benchmark, coverage, **more)
    bad = stored(pairs.select(F.col("doc_id").alias("bad_id"), F.col("digest").alias("bad_digest")).distinct(), "leaks")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_digest"]), "left_anti")
