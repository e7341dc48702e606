"""Licence recognition by sentences: sentences become identifiers, and their sequence is matched against rules.

Only DataFrame functions. The sentences and rules are tables, so a user may pass larger ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Known sentences are broadcast up to so many rows, else joined by a shuffle.
MOST_BROADCAST = 100_000

# Sentences of public licence texts and notices, by identifier.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "mit-title": "The MIT License",
    "mit-short": "Released under the MIT License",
    "mit-short-licensed": "Licensed under the MIT License",
    "apache2-short": "Licensed under the Apache License, Version 2.0",
    "apache2-short-the": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache2-compliance": "you may not use this file except in compliance with the License",
    "apache2-copy": "You may obtain a copy of the License at",
    "apache2-law": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache2-see": "See the License for the specific language governing permissions and limitations under the License",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "gpl-free": "This program is free software",
    "gpl2-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl3-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-merchant": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-details": "See the GNU General Public License for more details",
    "gpl2-short": "This work is licensed under the GNU General Public License, version 2",
    "gpl3-short": "This work is licensed under the GNU General Public License, version 3",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "mpl2-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "unlicense-free": "This is free and unencumbered software released into the public domain",
}
# The attribution licences, by their elements and versions.
CREATIVE = [f"CC {kind} {version}" for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND") for version in ("2.0", "2.5", "3.0", "4.0")]
# A licence and the identifiers of one of its texts in order. Of equal spans the earlier rule counts.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-title", "mit-grant", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-grant"]), ("MIT", ["mit-title"]), ("MIT", ["mit-short"]), ("MIT", ["mit-short-licensed"]),
    ("Apache-2.0", ["apache2-short-the", "apache2-compliance", "apache2-copy", "apache2-law", "apache2-see"]),
    ("Apache-2.0", ["apache2-short-the"]), ("Apache-2.0", ["apache2-short"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later", "gpl-hope", "gpl-merchant", "gpl-details"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-later", "gpl-hope", "gpl-merchant", "gpl-details"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-later"]),
    ("GPL-3.0-only", ["gpl3-short"]), ("GPL-2.0-only", ["gpl2-short"]),
    ("ISC", ["isc-grant", "isc-as-is"]), ("ISC", ["isc-grant"]),
    ("MPL-2.0", ["mpl2-terms", "mpl2-copy"]), ("MPL-2.0", ["mpl2-terms"]),
    ("Unlicense", ["unlicense-free"]),
]


def normal(sentence: Column) -> Column:
    """Lower case, with one blank for everything but letters and digits."""
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def unwrapped(text: Column) -> Column:
    """A text without comment marks before its lines, and with the lines of each paragraph in one."""
    bare = F.regexp_replace(text, r"(^|\n)[ \t]*(?:#+|/{2,}|/?\*+/?|--+|;+)[ \t]*", "$1")
    return F.regexp_replace(bare, r"\r?\n[ \t]*([^ \t\r\n])", " $1")


def sentences(text: Column) -> Column:
    """The normalised sentences of a text in order.

    A sentence ends at a line's end, or at one of . ! ? ; : before white space. A line that begins with a small
    letter or a bracket goes on with the sentence of the line before.
    """
    joined = F.regexp_replace(text, r"\r?\n[ \t]*([a-z(])", " $1")
    ended = F.regexp_replace(joined, r"[.!?;:]+[ \t\r\n]+|[\r\n]+", "\n")
    return F.split(F.regexp_replace(F.lower(ended), "[^a-z0-9\n]+", " "), "\n")


def known_sentences(spark: SparkSession) -> DataFrame:
    """(sentence_id, sentence): the built-in sentences, cut and normalised as texts are."""
    rows = [*SENTENCES.items(), *((f"cc {c}", f"Licensed under {c}") for c in CREATIVE)]
    return spark.createDataFrame(rows, "sentence_id string, sentence string")


def known_rules(spark: SparkSession) -> DataFrame:
    """(rule, licence, ids): the built-in rules in order of precedence."""
    rules = [*RULES, *((c.replace(" ", "-"), [f"cc {c}"]) for c in CREATIVE)]
    return spark.createDataFrame([(i, name, ids) for i, (name, ids) in enumerate(rules)], "rule int, licence string, ids array<string>")


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, rules: DataFrame | None = None) -> DataFrame:
    """doc_id, licence, rule, first_sentence and n_sentences of every licence text or notice in each document.

    Sentences that are known become identifiers; a rule matches where its identifiers follow each other, with
    only unknown sentences between them. A match inside a longer one, or over the same sentences as an earlier
    rule's, is dropped. Documents without a match, null and empty texts give no row. Rows that repeat both id
    and text give theirs once; ids may be null; other columns are ignored; an empty table gives an empty result.

    Every text is read twice, by its lines and ``unwrapped``, as a notice may be a line among others or be wrapped
    over lines of a comment. Of each licence the matches of the reading with its longest one count, of equal ones
    those by lines; first_sentence is the place in that reading.

    A known text of several sentences counts as its first one: the others must be given ids of their own.
    """
    spark = docs.sparkSession
    known = known if known is not None else known_sentences(spark)
    rules = rules if rules is not None else known_rules(spark)
    first = F.trim(F.element_at(F.filter(sentences(F.col("sentence")), lambda s: F.trim(s) != ""), 1))
    ids = known.select("sentence_id", first.alias("sentence")).where("sentence is not null").dropDuplicates(["sentence", "sentence_id"])
    ids = F.broadcast(ids) if known.count() <= MOST_BROADCAST else ids
    row = [F.xxhash64("doc_id", "text").alias("row_a"), F.xxhash64(F.lit(7), "text", "doc_id").alias("row_b")]
    readings = F.posexplode(F.array(sentences(F.col("text")), sentences(unwrapped(F.col("text"))))).alias("reading", "parts")
    said = docs.select(*row, "doc_id", readings).select(
        "row_a", "row_b", "doc_id", "reading", F.posexplode("parts").alias("place", "sentence")).withColumn("sentence", F.trim("sentence"))
    found = said.join(ids, "sentence").select("row_a", "row_b", "doc_id", "reading", "place", "sentence_id").distinct()
    order = F.dense_rank().over(Window.partitionBy("row_a", "row_b", "reading").orderBy("place"))
    steps = rules.select("rule", "licence", F.size("ids").alias("n"), F.posexplode("ids").alias("step", "sentence_id"))
    met = found.withColumn("k", order).join(F.broadcast(steps) if rules.count() <= MOST_BROADCAST else steps, "sentence_id")
    whole = met.groupBy("row_a", "row_b", "doc_id", "reading", "rule", "licence", "n", (F.col("k") - F.col("step")).alias("begin")).agg(
        F.countDistinct("step").alias("steps"), F.min("place").alias("first_sentence")).where("steps = n")
    earlier = Window.partitionBy("row_a", "row_b", "reading").orderBy("begin", F.desc("n"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    outer = F.max(F.col("begin") + F.col("n")).over(earlier)
    best = F.max(F.struct("n", (-F.col("reading")).alias("before"))).over(Window.partitionBy("row_a", "row_b", "licence"))
    return whole.withColumn("outer", outer).where("outer is null or outer < begin + n").withColumn("best", best).where(
        "best.before = -reading").select(
        "doc_id", "licence", "rule", "first_sentence", F.col("n").alias("n_sentences"))
