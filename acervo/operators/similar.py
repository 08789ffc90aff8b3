"""Near rulings: texts whose sets of five-word shingles have a similarity (Jaccard) of 0.8 or more.

Everything is column expressions and joins, and no near pair is missed.  Texts
of equal sets form a class, named by its smallest key; only one text of a class
is compared.  Of n shingles, two near texts share one of the n - ceil(0.8 n) + 1
that come first in any common order, so texts meet by those alone.  The order
takes a fixed part of all hashes first, which spares the others of long texts
every shuffle; within a part it is by how many texts have a shingle, the rarest
first, so that common phrases bring few together.  Shingles of one text alone
are counted, not sent back.  Whole sets then decide every pair; they are made
again, of the texts that met.

Defined results: words are what white space separates, in lower case; a null
or empty text has the empty set, and all of those are one class; a text of
fewer words than a shingle has one shingle; rows that repeat a key are rows of
their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.functions.text import stripped
from acervo.sources.shared import stored

#: Words of a shingle, and the similarity of near texts.
WORDS, SIMILARITY = 5, 0.8

#: The part of all hashes that comes first in the common order, in eighths.
EARLY = 3


def shingles(text: Column, words: int = WORDS) -> Column:
    """Hashes of the distinct runs of so many words."""
    split = F.filter(F.split(stripped(F.lower(text)), r"\s+", -1), lambda w: w != "")

    def runs(s: Column) -> Column:
        """Of a struct with the words, which are so made once, not for each run."""
        w = s["w"]
        zipped = F.arrays_zip(*[(F.slice(w, j + 1, 1 << 30) if j else w).alias(f"w{j}") for j in range(words)])
        each = F.transform(F.slice(zipped, F.lit(1), F.greatest(F.size(w) - words + 1, F.lit(0))), lambda x: F.xxhash64(*[x[f"w{j}"] for j in range(words)]))
        return F.when(F.size(w) >= words, F.array_distinct(each)).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))

    return F.coalesce(F.get(F.transform(F.array(F.struct(split.alias("w"))), runs), F.lit(0)), F.array().cast("array<bigint>"))


def first_shingles(n: Column, similarity: float = SIMILARITY) -> Column:
    """How many shingles of n, the first in a common order, near texts can't all lack."""
    return n - F.ceil(F.lit(similarity) * n - 1e-9) + 1


def early(shingle: Column) -> Column:
    return F.pmod(shingle, F.lit(8)) < EARLY


def set_name(shingles: Column) -> Column:
    """The same for equal sets: 16 bytes of a digest."""
    return F.substring(F.unhex(F.sha2(F.array_join(F.transform(F.array_sort(shingles), lambda x: x.cast("string")), ","), 256)), 1, 16)


def classes(rows: DataFrame, key: str, text: str, words: int = WORDS, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(key, class_id) of every row; and of every class id (a number), name, class_id, n (its shingles), n_early, and those it may meet others by.

    Those are the early ones, or all where the early ones are fewer than the first shingles."""
    sets = rows.select(F.col(key).alias("key"), shingles(F.col(text), words).alias("all"))
    split = sets.select("key", set_name(F.col("all")).alias("name"), F.size("all").alias("n"), "all", F.filter("all", early).alias("early"))
    by = F.when(F.size("early") >= first_shingles(F.col("n"), similarity), F.col("early")).otherwise(F.col("all"))
    written = stored(split.select("key", "name", "n", F.size("early").alias("n_early"), by.alias("by")), "shingles")
    of_name = written.groupBy("name").agg(F.min("key").alias("class_id"), *[F.any_value(c).alias(c) for c in ("n", "n_early", "by")])
    each = stored(of_name.select(F.monotonically_increasing_id().alias("id"), "*"), "classes")
    members = written.select("key", "name").join(each.select("name", "class_id"), "name").select(F.col("key").alias(key), "class_id")
    return members, each


def met_pairs(each: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(id_a, id_b) of classes that share one of their first shingles and may be near by their sizes, id_a < id_b."""
    spread = each.select("id", F.explode("by").alias("shingle"))
    often = spread.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1")
    sizes = each.select("id", "n", "n_early", F.size("by").alias("n_by"))
    part = Window.partitionBy("id", "early")
    shared = spread.join(often, "shingle").withColumn("early", early(F.col("shingle")))
    ranked = shared.withColumns({"rank": F.row_number().over(part.orderBy("often", "shingle")), "n_shared": F.count("*").over(part)}).join(sizes, "id")
    # shingles of this text alone come before the shared ones of their part
    place = F.col("rank") - F.col("n_shared") + F.when(F.col("early"), F.col("n_early")).otherwise(F.col("n_by"))
    first = stored(ranked.where(place <= first_shingles(F.col("n"), similarity)).select("id", "n", "shingle"), "first-shingles")
    a, b = (first.select("shingle", F.col("id").alias(f"id_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    return a.join(b, "shingle").where((F.col("id_a") < F.col("id_b")) & (F.least("n_a", "n_b") >= F.lit(similarity) * F.greatest("n_a", "n_b") - 1e-9)).select("id_a", "id_b").distinct()


def near_pairs(rows: DataFrame, key: str, text: str, each: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity) of near classes, a < b."""
    met = stored(met_pairs(each, similarity), "met")
    wanted = met.select(F.col("id_a").alias("id")).unionAll(met.select("id_b")).distinct().join(each.select("id", "name", "class_id"), "id")
    texts = rows.select(F.col(key).alias("key"), F.col(text).alias("text")).join(wanted, F.col("key").eqNullSafe(F.col("class_id")))
    made = stored(texts.select("id", "class_id", "name", shingles(F.col("text"), words).alias("shingles")), "met-sets")
    # a key that several rows have brings other texts too
    sets = made.where(set_name(F.col("shingles")) == F.col("name")).groupBy("id").agg(F.any_value("class_id").alias("class_id"), F.any_value("shingles").alias("shingles"))
    of = lambda x: sets.select(F.col("id").alias(f"id_{x}"), F.col("class_id").alias(x), F.col("shingles").alias(f"set_{x}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    share = both / (F.size("set_a") + F.size("set_b") - both)
    found = met.join(of("a"), "id_a").join(of("b"), "id_b").withColumn("similarity", share).where(F.col("similarity") >= similarity)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")


def near(rows: DataFrame, key: str, text: str, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(key, class_id, n_near): every row's class of equal sets, and how many other classes are near it."""
    members, each = classes(rows, key, text, words, similarity)
    pairs = stored(near_pairs(rows, key, text, each, words, similarity), "near-pairs")
    links = pairs.select(F.col("a").alias("class_id")).unionAll(pairs.select("b")).groupBy("class_id").agg(F.count("*").alias("n_near"))
    return members.join(links, "class_id", "left").select(key, "class_id", F.coalesce("n_near", F.lit(0)).alias("n_near"))
