"""License scan by diagonal voting.

Every run of ``GRAM`` words of every text is hashed and joined to the same runs of the
license templates. A match votes for the diagonal it lies on: its place in the text less
its place in the template. All runs of a template on one diagonal are an exact copy.
Texts with words put in or left out continue on a neighbouring diagonal, so diagonals
with enough votes are merged with their neighbours, and a merged span is verified: it
must hold enough of the template, in not much more than its length.

The templates are a fixed list, a few hundred rows at most, so they are broadcast. Texts
are read once and never moved: only matches and one row for each document are shuffled,
by document.

A null text counts as empty. Documents are told apart by id and text; repeated rows give
the same row again. Without templates, or for an empty table, nothing is found.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words of a run.
GRAM = 2
#: Votes that a diagonal needs for merging, or all runs of a shorter template.
VOTES = 3
#: Diagonals this far apart, or nearer, belong together.
NEAR = 6
#: Least share of a template's runs in a verified span, and most words of it for each word of the template.
SHARE, STRETCH = 0.7, 1.5

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Base templates are short phrases that count where they stand word for word.
    base: bool = False


# Phrases and labels of the contract, and paragraphs of well-known licenses and of their usual notices.
TEMPLATES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("bsd", "bsd license"),
    Template("mpl", "mozilla public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    Template(
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
    ),
    Template(
        "mit",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ),
    Template(
        "mit",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    ),
    Template(
        "bsd",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution",
    ),
    Template(
        "bsd",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission",
    ),
    Template(
        "bsd",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    ),
    Template(
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License",
    ),
    Template(
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details",
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies",
    ),
    Template(
        "cc-by",
        "You must give appropriate credit, provide a link to the license, and indicate if changes were made. You may do so in any reasonable "
        "manner, but not in any way that suggests the licensor endorses you or your use",
    ),
)


def _grams(spark: SparkSession, templates) -> tuple[DataFrame, int]:
    """``gram`` (words), ``template``, ``at``: every run of every template."""
    rows = []
    for number, template in enumerate(templates):
        words = [w for w in re.split(_NOT_WORD, template.text.lower()) if w]
        if len(words) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {template.text!r}")
        rows += [(words[i : i + GRAM], number, i) for i in range(len(words) - GRAM + 1)]
    return spark.createDataFrame(rows, "gram array<string>, template int, at int"), len(rows)


def _infos(spark: SparkSession, templates) -> DataFrame:
    rows = []
    for number, template in enumerate(templates):
        size = len([w for w in re.split(_NOT_WORD, template.text.lower()) if w])
        rows.append((number, template.label, template.base, size - GRAM + 1))
    return spark.createDataFrame(rows, "template int, label string, base boolean, runs int")


def _hash(words: list[Column]) -> Column:
    return F.xxhash64(*words)


def scan(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document.

    ``doc_id, n_words, n_base`` (exact places of base templates), ``first_word,
    last_word`` (least and greatest start of such a place), ``base_labels, labels``
    (arrays, distinct and sorted), ``score`` (largest verified share of a template),
    ``spans`` (label, start, end, share of every verified span, in words).
    """
    spark = docs.sparkSession
    grams, n_grams = _grams(spark, templates)
    # -1 stands for the one row that every document keeps, whether or not a run matches.
    table = grams.select(_hash([F.col("gram")[i] for i in range(GRAM)]).alias("hash"), "template", "at", F.lit(False).alias("own")).unionByName(
        spark.range(1).select(F.lit(0).cast("bigint").alias("hash"), F.lit(-1).alias("template"), F.lit(-1).alias("at"), F.lit(True).alias("own"))
    )
    # lower() differs from lower-casing A-Z only in characters that no template has.
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("digest"), F.array_remove(F.split(F.lower(text), _NOT_WORD), "").alias("words")
    )
    words = F.col("words")
    runs = F.when(F.size(words) < GRAM, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - GRAM), lambda i: _hash([F.get(words, i + k) for k in range(GRAM)]))
    )
    rows = own.select(
        "doc_id", "digest", F.size(words).cast("long").alias("n_words"), F.posexplode(F.concat(F.array(F.lit(0).cast("bigint")), runs)).alias("place", "hash")
    ).withColumn("own", F.col("place") == 0)
    matches = rows.join(F.broadcast(table) if n_grams <= 100_000 else table, ["hash", "own"]).select(
        "doc_id", "digest", "n_words", "template", "at", (F.col("place") - 1).alias("place")
    )
    # From here on one partitioning by document serves every grouping.
    key = ["doc_id", "digest"]
    votes = matches.repartition(*key).groupBy(*key, "template", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("hits"), F.min("place").alias("low"), F.max("place").alias("high"),
        F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("n"),
    )
    infos = _infos(spark, templates)
    named = votes.join(F.broadcast(infos), "template", "left")
    exact = F.size("hits") == F.col("runs")
    enough = (F.size("hits") >= F.least(F.lit(VOTES), F.col("runs"))) & (F.col("template") >= 0)
    # Short templates have no room for gaps: only their exact places count.
    short = F.col("runs") < VOTES + 1
    by_template = Window.partitionBy(*key, "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_template)
    marked = named.where(enough | (F.col("template") < 0)).withColumn(
        "opens", F.when(short | (F.col("template") < 0) | gap.isNull() | (gap > NEAR), 1).otherwise(0)
    ).withColumn("exact", exact)
    grouped = marked.withColumn("island", F.sum("opens").over(by_template)).groupBy(*key, "template", "label", "base", "runs", "island").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("held"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.max("n_words").alias("n_words"), F.max("n").alias("n"), F.min(F.when(F.col("exact"), F.col("diagonal"))).alias("first"),
        F.max(F.when(F.col("exact"), F.col("diagonal"))).alias("last"), F.sum(F.col("exact").cast("long")).alias("places"),
    )
    share = F.least(F.lit(1.0), F.col("held") / F.col("runs"))
    verified = (F.col("template") >= 0) & (
        F.when(F.col("base") | (F.col("runs") < VOTES + 1), F.col("places") > 0).otherwise(
            (share >= SHARE) & (F.col("high") - F.col("low") + GRAM <= STRETCH * (F.col("runs") + GRAM - 1))
        )
    )
    base = verified & F.col("base")
    # A long copy may hide exact places of a base phrase in one island; places counts each of them.
    start = F.when(F.col("base"), F.col("first")).otherwise(F.col("low"))
    span = F.struct(F.col("label").alias("label"), start.cast("long").alias("start"), (F.col("high") + GRAM).cast("long").alias("end"), share.alias("share"))
    found = grouped.groupBy(*key).agg(
        F.max("n_words").alias("n_words"), F.max(F.when(F.col("template") < 0, F.col("n"))).alias("copies"),
        F.coalesce(F.sum(F.when(base, F.col("places"))), F.lit(0)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("last"))).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set(F.when(verified, F.col("label")))).alias("labels"),
        F.coalesce(F.max(F.when(verified, share)), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(verified, span))).alias("spans"),
    )
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).drop("digest", "copies", "copy")
