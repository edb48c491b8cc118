"""Licences of documents: TF-IDF cosine to templates, then inheritance by directory.

Units of a document are its lines, its whole text, and runs of pieces (lines, cut at
sentence, clause and bracket ends) of up to 1.6 times a template's words, so that a
statement may be wrapped over lines or stand inside one.  A unit's vector holds the
counts of its words times their inverse document frequency over all documents.  A unit
whose cosine to a template reaches ``LEAST_COSINE`` states that licence.  A document that
a unit other than its whole text states is licensed by its header; one that is a licence
text as a whole, by a run that is most of it, by beginning as a long licence does, or by
its file's name, is a licence file and also covers its directory.  Other documents take the licence of the
nearest directory above them that has a licence file, by a join of ancestor paths.

Only documents that hold an anchor word are scored.  The anchors of a template are its
heaviest words, so many that the rest alone can't reach the cosine (by the
Cauchy-Schwarz inequality); the filter hence loses nothing.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, pick, tasks_for, text_or_empty

LEAST_COSINE = 0.8
WORD_CUT = r"[^\p{L}\p{N}]+"

#: Public licence statements, headers and openings, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
    ("GPL-2.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("LGPL-2.1-or-later", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library. If not, see https://www.gnu.org/licenses/."),
    ("LGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    # whole texts
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to http://unlicense.org/"),
    # openings of longer texts
    ("GPL-3.0-only", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and"),
    ("GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110 1301 USA Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change"),
    ("LGPL-3.0-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions"),
    ("LGPL-2.1-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. 51 Franklin Street, Fifth Floor, Boston, MA 02110 1301 USA Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. [This is the first released version of the Lesser GPL. It also counts as the successor of the GNU Library Public License, version 2, hence the version number 2.1.] Preamble The licenses for most"),
    ("AGPL-3.0-only", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. License shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. Licensor shall mean the copyright owner or entity authorized by the copyright owner that is granting the License. Legal Entity shall mean the union of the acting entity and all other entities that control, are controlled by, or are under common"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software. 1.2. Contributor Version means the combination of the Contributions of others (if any) used by a Contributor and that particular Contributor s Contribution. 1.3. Contribution means Covered Software of a particular Contributor. 1.4. Covered"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES. DISTRIBUTION OF THIS DOCUMENT DOES NOT CREATE AN ATTORNEY CLIENT RELATIONSHIP. CREATIVE COMMONS PROVIDES THIS INFORMATION ON AN AS IS BASIS. CREATIVE COMMONS MAKES NO WARRANTIES REGARDING THE USE OF THIS DOCUMENT OR THE INFORMATION OR WORKS PROVIDED HEREUNDER, AND DISCLAIMS LIABILITY FOR DAMAGES RESULTING FROM THE USE OF"),
)
#: A notice, not a licence: any licence counts before it, and it covers its own document only.
RESERVED = "LicenseRef-All-Rights-Reserved"
#: Templates of openings, which make a licence file of a text that begins with them.
OPENINGS = frozenset(range(len(TEMPLATES) - 8, len(TEMPLATES)))
#: Templates of whole texts, which make a licence file of a text that is mostly such a one.
WHOLE_TEXTS = frozenset(i for i, (_, x) in enumerate(TEMPLATES) if x.startswith("Permission is hereby")) | frozenset(range(len(TEMPLATES) - 12, min(OPENINGS)))
#: Windows reach this many times the words of their template.
REACH = 1.6
#: Ends of pieces: line ends, and sentence, clause and bracket ends within a line.
PIECE_CUT = r"\n|(?<=[.!?;:,)])\s+|\s+(?=\()"
#: Names of files that hold nothing but a licence: any statement in them is the folder's.
FILE_NAME = r"(?i)(?:^|/)(?:un)?(?:licen[cs]e|copying)(?:[-_][^/]*)?(?:\.[a-z]+)?$"
#: Words (titles, copyright lines) that may stand before an opening, and the share of a whole text.
LEAD_WORDS, MOST = 20, 2 / 3


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), F.lit(WORD_CUT)), lambda w: w != "")


def template_counts() -> list[Counter]:
    return [Counter(w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split()) for _, text in TEMPLATES]


def document_frequencies(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """word and n: in how many documents each word stands; the empty word is in all of them."""
    # words are counted where they lie before anything is sent
    held = texts.select(F.explode(F.concat(F.array_distinct(words(F.col("text"))), F.array(F.lit("")))).alias("word"))
    return scratch.save("frequencies", held.groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def inverse_frequency(n: Column, documents: int) -> Column:
    return F.log((1 + documents) / (1 + n)) + 1


def word_weights(frequencies: DataFrame) -> tuple[dict[str, float], int]:
    """Inverse document frequency of every template word, and the number of documents."""
    vocabulary = sorted(set().union(*template_counts()))
    counts = {r["word"]: r["n"] for r in frequencies.filter(F.col("word").isin("", *vocabulary)).collect()}
    n = counts.get("", 0)
    return {w: math.log((1 + n) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}, n


def template_anchors(counts: Counter, weights: dict[str, float], least: float) -> set[str]:
    found = set()
    squares = sorted(((c * weights[w]) ** 2, w) for w, c in counts.items())
    rest = sum(s for s, _ in squares)
    limit = least * least * rest
    while rest >= limit * (1 - 1e-9) and squares:
        square, word = squares.pop()
        rest -= square
        found.add(word)
    return found


def anchors(weights: dict[str, float], least: float) -> list[str]:
    return sorted(set().union(*(template_anchors(counts, weights, least) for counts in template_counts())))


def stated_licenses(texts: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """row_id, whole (the text is a licence text), granted, license, score: the best of each kind."""
    scratch = Scratch(texts.sparkSession, "stated")
    frequencies = document_frequencies(texts, scratch)
    weights, n = word_weights(frequencies)
    chosen = scratch.save("chosen", texts.filter(F.arrays_overlap(words(F.col("text")), F.lit(anchors(weights, least)))))
    # the words of texts with an anchor, which may be as many as the corpus has, by their own weights
    met = chosen.select(F.explode(F.array_distinct(words(F.col("text")))).alias("word")).distinct()
    weighed = scratch.save("weights", met.join(dealt(frequencies), "word").select("word", inverse_frequency(F.col("n"), n).alias("weight")))
    tables = Tables(texts.sparkSession, weights, weighed, least)
    scored = stated_units(chosen, tables).unionByName(stated_windows(chosen, tables, scratch))
    names = F.create_map(*(x for i, (name, _) in enumerate(TEMPLATES) for x in (F.lit(i), F.lit(name))))
    scored = scored.withColumn("license", names[F.col("template")]).withColumn("granted", F.col("license") != RESERVED)
    best = F.max(F.struct("granted", "score", (-F.col("unit")).alias("unit"), (-F.col("template")).alias("template"), "license")).alias("best")
    grouped = scored.groupBy("row_id", (F.col("file") & F.col("granted")).alias("whole")).agg(best)
    return grouped.select("row_id", "whole", "best.granted", "best.license", "best.score")


class Tables:
    """What is known of the templates, some thousand rows, whatever the input; and all words' weights, a table."""

    def __init__(self, spark: SparkSession, weights: dict[str, float], weighed: DataFrame, least: float):
        counts = template_counts()
        norms = [math.sqrt(sum((c * weights[w]) ** 2 for w, c in each.items())) for each in counts]
        shares = [(w, t, c * weights[w] / norms[t]) for t, each in enumerate(counts) for w, c in each.items()]
        self.least = least
        self.anchors = [sorted(template_anchors(each, weights, least)) for each in counts]
        self.size_of = F.create_map(*(F.lit(x) for t, each in enumerate(counts) for x in (t, sum(each.values()))))
        self.weights = dealt(weighed)
        self.shares = F.broadcast(spark.createDataFrame(shares, "word string, template int, share double"))

    def weighed(self, units: DataFrame, *keys: str) -> DataFrame:
        """``keys``, word, n and value (count times weight) of the words of ``content``."""
        counts = units.select(*keys, F.explode(words(F.col("content"))).alias("word")).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))
        return counts.join(self.weights, "word").withColumn("value", F.col("n") * F.col("weight")).drop("weight")


def dealt(table: DataFrame) -> DataFrame:
    """``table`` with the hint that a join deals both sides to tasks by their keys.

    Spark takes compressed files for a table's size and doesn't count the rows that an
    explode adds, so without it tables of many times the bytes that a broadcast may have
    would go through the driver.
    """
    return table.hint("merge")


def by_row(chosen: DataFrame) -> DataFrame:
    """One row for each row_id, dealt by it: all grouping by it and more stays where it is.

    The texts are small to send but long to score, so the tasks are not merged by their bytes.
    """
    return chosen.repartition(tasks_for(chosen.sparkSession), "row_id").dropDuplicates(["row_id"])


def stated_units(chosen: DataFrame, tables: Tables) -> DataFrame:
    """row_id, unit, template, score and file of whole texts (unit -1) and of lines that hold an anchor."""
    known = F.lit(sorted(set().union(*tables.anchors)))
    lines = F.transform(F.split("text", F.lit("\n")), lambda x, i: F.struct(i.alias("unit"), x.alias("content")))
    lines = F.filter(lines, lambda x: F.arrays_overlap(words(x["content"]), known))
    units = by_row(chosen).select("row_id", F.inline(F.concat(F.array(F.struct(F.lit(-1).alias("unit"), F.col("text").alias("content"))), lines)))
    weighed = tables.weighed(units, "row_id", "unit")
    length = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy("row_id", "unit")))
    dots = weighed.withColumn("length", length).join(tables.shares, "word").groupBy("row_id", "unit", "template").agg(F.sum(F.col("value") * F.col("share")).alias("dot"), F.max("length").alias("length"))
    scored = dots.select("row_id", "unit", "template", F.round(F.col("dot") / F.col("length"), 9).alias("score"), ((F.col("unit") == -1) & F.col("template").isin(*OPENINGS, *WHOLE_TEXTS)).alias("file"))
    return scored.filter(F.col("score") >= tables.least)


def stated_windows(chosen: DataFrame, tables: Tables, scratch: Scratch) -> DataFrame:
    """row_id, unit, template, score and file of runs of pieces that state a template.

    A dot product is the sum of its pieces', and a run's squared length at least the
    sum of its pieces'; running sums hence give a bound for every run, and only runs
    whose bound reaches the least cosine are counted out.  A template is looked for
    only in texts that hold one of its anchors.
    """

    def pieces(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.select("row_id", *keys, F.posexplode(F.split("text", PIECE_CUT)).alias("piece", "content"))

    held = F.array_compact(F.array(*(F.when(F.arrays_overlap(F.col("words"), F.lit(each)), F.lit(t)) for t, each in enumerate(tables.anchors))))
    rows = by_row(chosen).withColumn("words", words(F.col("text"))).withColumn("held", held).drop("words")
    weighed = tables.weighed(pieces(rows, "held"), "row_id", "held", "piece")
    sums = F.sum("n").alias("k"), F.sum(F.col("value") * F.col("value")).alias("square"), F.collect_list(F.struct("word", "value")).alias("values")
    before = Window.partitionBy("row_id").orderBy("piece")
    sized = weighed.groupBy("row_id", "held", "piece").agg(*sums).withColumn("upto", F.sum("k").over(before)).withColumn("squares", F.sum("square").over(before))
    sized = sized.withColumn("all", F.sum("k").over(Window.partitionBy("row_id"))).withColumn("begin", F.col("upto") - F.col("k"))
    facts = ("square", "squares", "begin", "upto", "all")
    parts = sized.select("row_id", "held", "piece", *facts, F.inline("values")).join(tables.shares, "word").filter(F.array_contains("held", F.col("template")))
    dots = parts.groupBy("row_id", "template", "piece").agg(F.sum(F.col("value") * F.col("share")).alias("part"), *(F.max(x).alias(x) for x in facts))
    size = tables.size_of[F.col("template")]
    each = Window.partitionBy("row_id", "template")
    dots = dots.withColumn("at", F.floor(F.col("begin") * 1000 / size)).withColumn("dots", F.sum("part").over(each.orderBy("piece")))
    ends = F.collect_list(F.struct("piece", "upto", "squares", "dots")).over(each.orderBy("at").rangeBetween(0, int(REACH * 1000)))

    def in_bound(end: Column) -> Column:
        square = end["squares"] - F.col("squares") + F.col("square")
        dot = end["dots"] - F.col("dots") + F.col("part")
        short = end["upto"] - F.col("begin") <= REACH * size
        return short & (dot * (1 + 1e-9) >= tables.least * F.sqrt(square))

    runs = dots.withColumn("ends", ends).withColumn("end", F.explode(F.filter("ends", in_bound)))
    dot = (F.col("end.dots") - F.col("dots") + F.col("part")).alias("dot")
    runs = scratch.save("runs", runs.select("row_id", "template", F.col("piece").alias("first"), F.col("end.piece").alias("last"), "begin", F.col("end.upto").alias("upto"), "all", dot))
    spread = runs.select("row_id", "first", "last").distinct().withColumn("piece", F.explode(F.sequence("first", "last")))
    some = chosen.join(dealt(runs.select("row_id").distinct()), "row_id", "left_semi")
    run_words = spread.join(dealt(tables.weighed(pieces(by_row(some)), "row_id", "piece")), ["row_id", "piece"]).groupBy("row_id", "first", "last", "word").agg(F.sum("value").alias("value"))
    lengths = run_words.groupBy("row_id", "first", "last").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("length"))
    scored = runs.join(dealt(lengths), ["row_id", "first", "last"]).withColumn("score", F.round(F.col("dot") / F.col("length"), 9)).filter(F.col("score") >= tables.least)
    opens = F.col("template").isin(*OPENINGS) & (F.col("begin") <= LEAD_WORDS)
    fills = F.col("template").isin(*WHOLE_TEXTS) & (F.col("upto") - F.col("begin") >= MOST * F.col("all"))
    return scored.select("row_id", F.col("first").alias("unit"), "template", "score", (opens | fills).alias("file"))


def directory(path: Column) -> Column:
    """The path without its last name; empty for a name alone."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """A directory and every one above it, the root (empty) included."""
    names = F.split(folder, F.lit("/"))
    above = F.transform(F.sequence(F.lit(1), F.size(names)), lambda k: F.array_join(F.slice(names, 1, k), "/"))
    return F.array_distinct(F.concat(F.array(F.lit("")), above))


def scan_licenses(docs: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """The licence of every document.

    Args:
        docs: doc_id, path (names joined by "/") and text; other columns are ignored.
        least: least cosine of a statement.

    Returns a row per input row: doc_id, path, license, score, origin (header, file or
    inherited) and from_path (the licence file's path where inherited); all null where
    none is found.  Equal scores go to the earlier unit, then template; of several
    licence files in a directory the least path counts.  A licence file holds a licence's
    whole text or opening, or any statement under a name like LICENSE or COPYING; prose
    with a notice in it is none.  Null texts state nothing, null
    paths inherit nothing; repeated rows get equal results; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "licenses")
    source = pick(docs, "doc_id", "path", "text")
    parts = F.col("doc_id"), F.col("path"), F.col("text")
    row_id = F.unhex(F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(seed), *parts)), 16, "0") for seed in (1, 2))))  # 128 bits
    texts = source.select(row_id.alias("row_id"), text_or_empty().alias("text"))
    kinds = stated_licenses(texts, least).groupBy("row_id").agg(
        F.max(F.when(~F.col("whole"), F.struct("granted", "score", "license"))).alias("header"), F.max(F.when(F.col("whole"), F.struct("granted", "score", "license"))).alias("file")
    )
    kinds = scratch.save("stated", kinds)
    rows = source.select("doc_id", "path", row_id.alias("row_id")).join(dealt(kinds), "row_id", "left")
    named = F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False)) & F.coalesce(F.col("header.granted"), F.lit(False))
    rows = rows.withColumn("file", F.coalesce("file", F.when(named, F.col("header"))))
    rows = rows.withColumn("own", F.coalesce("file", "header")).withColumn("origin", F.when(F.col("file").isNotNull(), "file").when(F.col("header").isNotNull(), "header"))
    rows = scratch.save("rows", rows.drop("row_id"))
    own = rows.filter("origin is not null").select("doc_id", "path", F.col("own.license").alias("license"), F.col("own.score").alias("score"), "origin", F.lit(None).cast("string").alias("from_path"))
    return own.unionByName(inherited(rows, scratch))


def inherited(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows without a licence of their own, with that of the nearest directory above them.

    Both tables that are joined by directory are saved before: where a side of a join
    comes straight from a shuffle, Spark splits a large directory's rows among tasks.
    """
    files = rows.filter("origin = 'file' and path is not null").groupBy(directory(F.col("path")).alias("folder")).agg(F.min(F.struct("path", "own")).alias("found"))
    files = scratch.save("files", files)
    plain = rows.filter("origin is null").select("doc_id", "path", directory(F.col("path")).alias("inside"))
    # each directory is looked up once, however many documents it holds
    heirs = plain.filter("inside is not null").select("inside").distinct().select("inside", F.explode(ancestors(F.col("inside"))).alias("folder"))
    nearest = heirs.join(dealt(files), "folder").groupBy("inside").agg(F.max(F.struct(F.length("folder").alias("depth"), "found")).alias("nearest"))
    nearest = scratch.save("nearest", nearest.select("inside", F.col("nearest.found").alias("found")))
    scratch.drop("files")
    taken = plain.join(dealt(nearest), "inside", "left")
    origin = F.when(F.col("found").isNotNull(), "inherited").alias("origin")
    return taken.select("doc_id", "path", F.col("found.own.license").alias("license"), F.col("found.own.score").alias("score"), origin, F.col("found.path").alias("from_path"))
