"""License scans by diagonal voting, in DataFrame functions alone.

Every position of a text gives the hashes of its rolling 2- and 4-word
grams; a hash join with the grams of the license templates (a table of fixed
size) gives each hit a diagonal: its position in the text less that in the
template.  Hits vote for their diagonal, neighbouring diagonals that hold
different parts of a template merge (words were inserted or left out), and a
span counts if enough of its template's grams, compared word by word, are
there.  Templates are notices and whole license texts, of any length.

One pass over the texts makes all rows: besides its hits each document has one
row of its own, with its number of words.

Defined results: a null or empty text has no words; rows with the same
identifier are scanned apart; equal rows get equal results; a null identifier
is an identifier; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acervo.llm.common import stored

#: The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: The method's own templates.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "this work is licensed under the gnu general public license version": "gpl",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
}

#: Whole notices and license texts, as words; a label may have several.
TEXTS = [
    (" ".join(re.findall("[a-z0-9]+", text.lower())), label)
    for label, text in [
        ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
            to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
            The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
            THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
            AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
        ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
            THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
            INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
            PERFORMANCE OF THIS SOFTWARE."""),
        ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
            conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
            distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
            PURPOSE ARE DISCLAIMED."""),
        ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
            for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the
            original software."""),
        ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
            This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
            You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
        ("gpl", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.
            This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
            You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."""),
        ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.
            This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.
            You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation."""),
        ("agpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
            This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.
            You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
        ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
            Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
            specific language governing permissions and limitations under the License."""),
        ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
        ("epl", """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"""),
        ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
            1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
            the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
            this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
            MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT
            NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
            OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
        ("bsl", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
            transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire
            statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or
            derivative works are solely in the form of machine-executable object code generated by a source language processor."""),
        ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
            commercial or non-commercial, and by any means."""),
        ("cc-by", """This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain
            View, CA 94042, USA."""),
        ("cc-by-sa", """This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/"""),
        ("cc-by-nc", """This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/"""),
        ("cc0", """To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work."""),
    ]
]

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Templates of fewer words than LONG are voted for by 2-word grams, others by 4-word ones.
LONG = 6
#: The template of a document's own row.
OWN = -1
#: Diagonals at most GAP apart merge; a span needs this share of its template's grams.
GAP, COVERAGE = 2, 0.7


def gram_rows() -> list[tuple]:
    """(template, label, base, number of grams, gram length, place, the gram's words)."""
    out = []
    for i, (phrase, label) in enumerate([*BASE.items(), *NOTICES.items(), *TEXTS]):
        w = phrase.split()
        k = 2 if len(w) < LONG else 4
        n = len(w) - k + 1
        out += [(i, label, i < len(BASE), n, k, j, w[j : j + k]) for j in range(n)]
    return out


def templates(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([*gram_rows(), (OWN, None, None, 0, 0, 0, [])], "template int, label string, base boolean, n_grams int, k int, place int, gram array<string>")
    return rows.withColumn("hash", hash_of(F.col("k"), *[F.get("gram", F.lit(j)) for j in range(4)]))


def hash_of(k: Column, *words: Column) -> Column:
    """Of the first words; nulls beyond the gram's end don't count, its length does."""
    return F.xxhash64(k, *words)


def lower(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower(text), F.lit(WORD), F.lit(0))


def hits(docs: DataFrame) -> DataFrame:
    """One row for each document, and one for each place of a text where a template's gram stands."""
    words = docs.select("doc_id", F.xxhash64("text").alias("digest"), words_of(F.col("text")).alias("words"))
    places = words.select("*", F.explode(F.sequence(F.lit(-1), F.greatest(F.lit(-1), F.size("words") - 2))).alias("pos"))
    word = lambda j: F.get("words", F.col("pos") + j)
    own = F.col("pos") < 0
    two, four = hash_of(F.lit(2), word(0), word(1)), hash_of(F.lit(4), *[word(j) for j in range(4)])
    grams = places.select("*", F.explode(F.array(F.when(own, hash_of(F.lit(0), *[F.lit(None).cast("string")] * 4)).otherwise(two), F.when(~own, four))).alias("hash"))
    found = grams.join(F.broadcast(templates(docs.sparkSession)), "hash").where(F.slice("words", F.greatest(F.lit(1), F.col("pos") + 1), F.col("k")) == F.col("gram"))
    return found.select("doc_id", "digest", F.size("words").cast("long").alias("n_words"), "template", "label", "base", "n_grams", "k", "place", (F.col("pos") - F.col("place")).alias("diagonal"))


def spans(found: DataFrame) -> DataFrame:
    """The templates' verified spans: first and last word, share of grams found, and whether it is a base phrase word by word."""
    key = ["doc_id", "digest", "template", "label", "base", "n_grams", "k"]
    votes = found.where(F.col("template") != OWN).groupBy(*key, "diagonal").agg(F.collect_set("place").alias("places"), F.min("place").alias("from_place"), F.max("place").alias("to_place"))
    along = Window.partitionBy("doc_id", "digest", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > GAP) | F.arrays_overlap(F.lag("places").over(along), "places"), F.lit(True))
    merged = votes.withColumn("apart", apart.cast("int")).withColumn("span", F.sum("apart").over(along)).groupBy(*key, "span").agg(
        F.collect_set("places").alias("sets"), F.min(F.col("diagonal") + F.col("from_place")).alias("first"), F.max(F.col("diagonal") + F.col("to_place") + F.col("k") - 1).alias("last"), F.count("*").alias("n_diagonals")
    )
    share = F.size(F.array_distinct(F.flatten("sets"))) / F.col("n_grams")
    exact = F.col("base") & (share == 1) & (F.col("n_diagonals") == 1)
    return merged.select("doc_id", "digest", "label", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), share.alias("score"), exact.alias("exact")).where((F.col("score") >= COVERAGE) & (~F.col("base") | F.col("exact")))


def scanned(docs: DataFrame) -> DataFrame:
    """Every document with its base places, labels and best score."""
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    exact = F.col("exact")
    rows = stored(hits(docs), "hits")
    found = spans(rows).groupBy("doc_id", "digest").agg(
        F.count_if(exact).alias("n_base"), F.min(F.when(exact, F.col("first"))).alias("first_word"), F.max(F.when(exact, F.col("first"))).alias("last_word"),
        joined(F.when(exact, F.col("label"))).alias("base_labels"), joined("label").alias("labels"), F.max("score").alias("score"),
    ).withColumnsRenamed({"doc_id": "found_id", "digest": "found_digest"})
    out = rows.where(F.col("template") == OWN).join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("digest") == F.col("found_digest")), "left")
    empty = {"n_base": F.lit(0), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
    return out.select("doc_id", "n_words", *[F.coalesce(c, empty[c]).alias(c) if c in empty else c for c in ("n_base", "first_word", "last_word", "base_labels", "labels", "score")])


def oracle_sql() -> str:
    """The same in DuckDB's SQL, by comparing words instead of hashes."""
    values = ", ".join(f"({t}, '{label}', {base}, {n}, {k}, {j}, {gram!r})" for t, label, base, n, k, j, gram in gram_rows())
    return f"""
WITH templates(template, label, base, n_grams, k, place, gram) AS (VALUES {values}),
texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(len(words))) AS pos FROM texts),
grams AS (SELECT doc_id, pos, k, words[pos + 1 : pos + k] AS gram FROM places, (VALUES (2), (4)) AS ks(k)),
votes AS (
  SELECT doc_id, template, label, base, n_grams, g.k, pos - place AS diagonal, list(DISTINCT place) AS places, min(place) AS from_place, max(place) AS to_place
  FROM grams g JOIN templates t ON g.k = t.k AND g.gram = t.gram GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w <= {GAP} AND NOT list_has_any(lag(places) OVER w, places) THEN 0 ELSE 1 END AS apart
  FROM votes WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM marked),
merged AS (
  SELECT doc_id, template, label, base, span, len(list_distinct(flatten(list(places)))) / n_grams AS score, min(diagonal + from_place) AS first, count(*) AS n_diagonals
  FROM numbered GROUP BY doc_id, template, label, base, n_grams, span),
spans AS (
  SELECT *, base AND score = 1 AND n_diagonals = 1 AS exact FROM merged
  WHERE score >= {COVERAGE} AND (NOT base OR (score = 1 AND n_diagonals = 1))),
found AS (
  SELECT doc_id, count(*) FILTER (exact) AS n_base, min(first) FILTER (exact) AS first_word, max(first) FILTER (exact) AS last_word,
    coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (exact)), ','), '') AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(score) AS score
  FROM spans GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM texts LEFT JOIN found USING (doc_id)"""
