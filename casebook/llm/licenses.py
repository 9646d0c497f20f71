"""License scans: sparse TF-IDF cosine to templates, inherited from the nearest directory above.

Candidates of a text, after comment signs at line starts are taken off, are its
lines, its paragraphs with their lines joined (wrapped headers and comment
blocks), its sentences (statements inside long lines), and the whole text of a
file named as a license file; of these, the ones with a word that every license
statement has (``ANCHOR``; a candidate without any states no license). Words of
candidates and templates get TF-IDF weights, with document frequencies counted
over the templates; the cosine with a template is the sum over shared words of
the products of normalised weights: words are counted by (candidate, word) and
join the template table. Long license texts are given by the paragraphs that name
them. A file has the license of its best candidate; an SPDX line says it outright
(cosine 1, the name as written, without "-only" and "-or-later").

Files without a license of their own inherit: the licenses of files chosen by
``gives`` stand at their directories; the directory of every other file asks
itself and all directories above (its path is cut at each ``/`` and exploded), the
join keeps the deepest, and files join their directory's answer. Both joins are
salted, so a directory of very many files is not one task's. Only DataFrame
functions run here.

Defined results: a null or empty text has no license of its own; a null path
neither gives nor inherits; rows without ``doc_id`` are returned without license;
among equal cosines (nine digits) the license whose name sorts first wins, in a
directory the best cosine and then the first name. Repeated rows of one
``doc_id`` share what any of them has. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm import exchange as X

LEAST = 0.7

# License names and texts that state them (titles, notices, and whole texts or their naming paragraphs).
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
_BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published
by the Free Software Foundation, either version {} of the License, or (at your option) any later version."""
TEMPLATES = [
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", _GNU.format("Affero General Public License", "3")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("Apache-2.0", """Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
for the specific language governing permissions and limitations under the License."""),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_WARRANTY}"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", _BSD_NAMES),
    ("BSD-3-Clause", f"{_BSD} {_BSD_NAMES} {_BSD_WARRANTY}"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", _GNU.format("General Public License", "2")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", _GNU.format("General Public License", "3")),
    ("ISC", "ISC License"),
    ("ISC", _ISC),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", _GNU.format("Lesser General Public License", "2.1")),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", "3")),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", _MIT),
    ("MIT", _MIT[:_MIT.index("The above")]),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
ANCHOR = r"(?i)licen[cs]|copyright|redistribut|permission|public domain|warrant"
SPDX = r"SPDX-License-Identifier:\s*\(?([A-Za-z0-9][A-Za-z0-9.+-]*)"
# Comment signs of common languages at a line's start.
_LEADER = r"(?m)^[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+|%+|<!--|REM\b|dnl\b)?[ \t]*"
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
SALT = 16
_BREAK = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _BREAK), lambda x: x != "")


def template_table(spark, templates=TEMPLATES) -> DataFrame:
    """form (a template's number), license, term, weight (of unit length per template), idf."""
    rows = spark.createDataFrame([(k, *t) for k, t in enumerate(templates)], "form int, license string, text string")
    words = rows.select("form", "license", F.explode(terms(F.col("text"))).alias("term")).groupBy("form", "license", "term").agg(
        F.count(F.lit(1)).alias("tf"))
    idf = words.groupBy("term").agg((F.log((F.lit(len(templates)) + 1.0) / (F.count(F.lit(1)) + 1.0)) + 1.0).alias("idf"))
    weighted = words.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = weighted.groupBy("form").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norm, "form").select("form", "license", "term", (F.col("w") / F.col("norm")).alias("weight"), "idf")


def candidates(path: Column, text: Column) -> Column:
    """Lines, paragraphs and sentences of a text, and the whole of a license file, that have an anchor word."""
    bare = F.regexp_replace(F.regexp_replace(text, "\r", ""), _LEADER, "")
    paragraphs = F.split(bare, r"\n\s*\n")
    units = F.concat(F.split(bare, "\n"), paragraphs, F.flatten(F.transform(
        paragraphs, lambda p: F.split(F.regexp_replace(p, r"\s+", " "), r"(?<=[.!?;])\s+"))))
    units = F.concat(units, F.when(path.rlike(LICENSE_FILE), F.array(bare)).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.transform(F.filter(units, lambda u: u.rlike(ANCHOR)),
                                        lambda u: F.trim(F.regexp_replace(u, r"\s+", " "))))


def own_licenses(docs: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``docs`` (doc_id, path, text) -> doc_id, license, cosine of documents that have a matching candidate."""
    table = X.table(template_table(docs.sparkSession, templates))  # the words of the given templates
    vocabulary = F.broadcast(table.select("term", "idf").distinct())
    unseen = math.log(len(templates) + 1.0) + 1.0  # of a word that no template has
    some = docs.filter(F.col("doc_id").isNotNull() & F.col("text").rlike(ANCHOR))
    units = some.select("doc_id", F.explode(candidates(F.col("path"), F.col("text"))).alias("text"))
    units = units.withColumn("unit", F.xxhash64("text")).dropDuplicates(["doc_id", "unit"])
    words = units.select("doc_id", "unit", F.explode(terms(F.col("text"))).alias("term")).groupBy("doc_id", "unit", "term").agg(
        F.count(F.lit(1)).alias("tf"))
    words = words.join(vocabulary, "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    # a candidate's words that no template has count for its length only, so they are summed at once
    words = words.groupBy("doc_id", "unit", F.when(F.col("idf").isNotNull(), F.col("term")).alias("term")).agg(
        F.sum(F.col("w") * F.col("w")).alias("ww"), F.first("w").alias("w"))
    words = words.withColumn("norm", F.sqrt(F.sum("ww").over(Window.partitionBy("doc_id", "unit")))).filter("term is not null")
    cosines = (words.join(F.broadcast(table.select("form", "license", "term", "weight")), "term")
               .groupBy("doc_id", "unit", "license", "form")
               .agg(F.round(F.sum(F.col("w") * F.col("weight")) / F.first("norm"), 9).alias("cosine"))
               .filter(F.col("cosine") >= least).select("doc_id", "license", "cosine"))
    said = F.regexp_replace(F.regexp_extract("text", SPDX, 1), "-(only|or-later)$", "")
    stated = some.select("doc_id", said.alias("license"), F.lit(1.0).alias("cosine")).filter("license <> ''")
    return _first_best(cosines.unionByName(stated), "doc_id")


def _first_best(found: DataFrame, key: str) -> DataFrame:
    """Per key the best cosine, and of its licenses the first by name."""
    best = found.groupBy(key, "license").agg(F.max("cosine").alias("cosine"))
    return best.groupBy(key).agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b")).select(
        key, "b.license", (-F.col("b.c")).alias("cosine"))


def directories(home: Column) -> Column:
    """A directory and all those above it, the root '' first."""
    parts = F.split(home, "/")
    return F.when(home == "", F.array(F.lit(""))).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))


def _salted(table: DataFrame) -> DataFrame:
    return table.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))


def scan(docs: DataFrame, gives: Column, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``docs`` (doc_id, path, text) -> doc_id, path, license, cosine, licensed_by (the directory it is inherited
    from; null for a license of its own or none). ``gives``: which files' licenses hold for their directory."""
    # the directory of a file is its path without the last part
    home = F.array_join(F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1), "/")
    files = docs.select("doc_id", "path", gives.alias("gives"), home.alias("home"))
    own = X.table(own_licenses(docs, templates, least))  # read three times below; a row per licensed document
    files = files.join(own, "doc_id", "left")
    held = _first_best(files.filter(F.col("license").isNotNull() & F.col("gives") & F.col("path").isNotNull())
                       .select(F.col("home").alias("directory"), "license", "cosine"), "directory")
    asking = files.filter(F.col("license").isNull() & F.col("path").isNotNull()).select("home").distinct()
    asked = (asking.select("home", F.pmod(F.xxhash64("home"), F.lit(SALT)).alias("salt"),
                           F.posexplode(directories(F.col("home"))).alias("depth", "directory")))
    nearest = (asked.join(_salted(held), ["directory", "salt"]).groupBy("home")
               .agg(F.max_by(F.struct("directory", "license"), "depth").alias("n")))
    files = files.withColumn("salt", F.pmod(F.xxhash64("doc_id", "path"), F.lit(SALT)))
    return files.join(_salted(nearest), ["home", "salt"], "left").select(
        "doc_id", "path", F.coalesce("license", F.col("n.license")).alias("license"), "cosine",
        F.when(F.col("license").isNull(), F.col("n.directory")).alias("licensed_by"))
