"""License scan in DataFrame functions alone: lines and whole texts against notices, by word bigrams.

A unit is a line of a text, or the whole text where that has more than one line. Both units and templates are
normalised: small letters, and every run of other characters than letters and digits is one space. A unit matches
the template with the greatest Dice coefficient, ``2 * common / (unit + template)`` over distinct word
bigrams, if that is ``LEAST`` or more. As the common bigrams can't be more than the smaller set, only templates
with ``unit * LEAST / (2 - LEAST) <= template <= unit * (2 - LEAST) / LEAST`` bigrams are compared, and units outside
these bounds for all templates with none. That holds for units of any length, so long texts cost one look.

Notices wrapped over lines or inside longer lines are found as passages: windows of consecutive words, sized by each
template within the same bounds, against the templates and the longer ``NOTICES`` (numbered on from the templates). The
best windows that don't overlap are reported with the line they begin in; of overlapping ones of different templates
that with more common bigrams. A passage is left out where a line it touches, or the whole text, is reported
for a template that is as long or longer. Full texts of thousands of words (GPL, Apache and so on) aren't among the notices.

NULL texts count as empty. Units of fewer than two words have no bigrams and match nothing. Ties go to the
template that comes first. Rows with equal ids are separate rows.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.8

#: Usual short notices and the licences they stand for.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is licensed under the GNU General Public License, version 3 or later."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. """
_MIT_REST = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. """
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. """
_BSD_REST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This {what} is free software{or_} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."""

#: Longer standard notices, looked for as passages only.
NOTICES = (
    ("MIT", _MIT + _MIT_REST),
    ("MIT", _MIT),
    ("BSD-2-Clause", _BSD + _BSD_REST),
    ("BSD-3-Clause", _BSD + _BSD_THIRD + _BSD_REST),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-3.0", _GNU.format(what="program", or_=":", kind="", version="3")),
    ("GPL-2.0", _GNU.format(what="program", or_=";", kind="", version="2")),
    ("LGPL-3.0", _GNU.format(what="library", or_=":", kind="Lesser ", version="3")),
    ("LGPL-2.1", _GNU.format(what="library", or_=";", kind="Lesser ", version="2.1")),
    ("AGPL-3.0", _GNU.format(what="program", or_=":", kind="Affero ", version="3")),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Words of the templates that most texts hold, so that they tell little.
FREQUENT = ("a", "and", "any", "be", "by", "can", "file", "found", "in", "is", "it", "may", "not", "of", "or", "person", "that", "the", "this", "to", "under", "use", "with", "without", "work", "you")


def _bigrams_of(text: str) -> list[str]:
    words = re.findall(r"[a-z0-9]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), r"[^\p{L}\p{N}]+", " "))


def _bigrams(words: Column) -> Column:
    heads, tails = F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1)
    return F.array_distinct(F.zip_with(heads, tails, lambda a, b: F.concat(a, F.lit(" "), b)))


def bounds(size: int | float, least: float = LEAST) -> tuple[int, int]:
    """The sizes of sets that can reach ``least`` with one of ``size``."""
    return math.ceil(size * least / (2 - least) - 1e-9), math.floor(size * (2 - least) / least + 1e-9)


def signal_words(grams: list[str], least: float = LEAST) -> list[str]:
    """Words of which any match of a template must hold one; longest first, as they are rarest in other texts."""
    pairs = [gram.split(" ") for gram in grams]
    lacking = len(pairs) - math.ceil(len(pairs) * least / (2 - least) - 1e-9)
    words = sorted({word for pair in pairs for word in pair}, key=lambda word: (word in FREQUENT, -len(word), word))
    chosen: list[str] = []
    while sum(any(word in chosen for word in pair) for pair in pairs) <= lacking:
        chosen.append(words[len(chosen)])
    return chosen


def signal_groups(grams: list[str], least: float = LEAST) -> list[list[str]]:
    """Groups of words; any match of a template must hold a word of each. Only the first group may hold ``FREQUENT`` ones."""
    pairs = [gram.split(" ") for gram in grams]
    lacking = len(pairs) - math.ceil(len(pairs) * least / (2 - least) - 1e-9)
    groups, group = [signal_words(grams, least)], []
    for word in sorted({word for pair in pairs for word in pair} - {*FREQUENT, *groups[0]}, key=lambda word: (-len(word), word)):
        group.append(word)
        if sum(any(word in group for word in pair) for pair in pairs) > lacking:
            groups.append(group)
            group = []
    return groups


def _passages(docs: DataFrame, templates, notices, least: float) -> DataFrame:
    """Windows of consecutive words that match, without those that a line or the whole text is reported for."""
    known = []
    for i, (name, text) in enumerate((*templates, *notices)):
        size = len(re.findall(r"[a-z0-9]+", text.lower())) - 1
        known.append((i, name, _bigrams_of(text), bounds(size, least)[1]))
    once = lambda value, name: F.explode(F.array(value)).alias(name)
    let = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select("*", once(F.lower("text"), "low"))
    any_of = lambda words: reduce(or_, [F.contains("low", F.lit(word)) for word in words])
    rows = rows.where(reduce(or_, [reduce(and_, map(any_of, signal_groups(grams, least))) for _, _, grams, _ in known])).drop("low")
    by_line = F.transform(F.split("text", "\n"), lambda line: F.filter(F.split(_normal(line), " "), lambda word: word != ""))
    rows = rows.select("doc_id", once(by_line, "lines")).select("*", once(F.flatten("lines"), "words")).where(F.size("words") > 1)

    def bigrams(words: Column) -> Column:
        count = F.greatest(F.size(words) - 1, F.lit(0))
        return F.zip_with(F.slice(words, F.lit(1), count), F.slice(words, F.lit(2), count), lambda a, b: F.concat(a, F.lit(" "), b))

    table = F.array(*[
        F.struct(
            F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(len(g)).alias("m"), F.split(F.lit("|".join(g)), r"\|").alias("set"),
            F.lit(math.ceil(len(g) * least / (2 - least) - 1e-9)).alias("need"), F.lit(most).alias("most"),
        )
        for i, name, g, most in known
    ])
    # Few texts hold enough of a template anywhere.
    rows = rows.select("*", once(bigrams(F.col("words")), "grams")).select("*", once(F.array_distinct("grams"), "own"))
    enough = F.filter(table, lambda t: F.size(F.array_intersect(t["set"], F.col("own"))) >= t["need"])
    rows = rows.select("doc_id", "lines", "words", "grams", once(enough, "near")).where(F.size("near") > 0)

    def measured(own: Column, t: Column) -> Column:
        """The common bigrams and the coefficient."""
        common = F.size(F.array_intersect(t["set"], own))
        return F.struct(common.alias("common"), (2 * common / (t["m"] + F.size(F.array_distinct(own)))).alias("dice"))

    def window(t: Column, at: Column, k: Column) -> Column:
        """The best window from the k-th hit on; it ends with a hit, has ``need`` hits, and isn't above the bounds."""
        first = F.element_at(at, k)
        ends = F.slice(at, k + t["need"] - 1, F.greatest(F.size(at) - k - t["need"] + 2, F.lit(0)))
        ends = F.filter(ends, lambda end: end - first < t["most"])

        def entry(end: Column) -> Column:
            value = measured(F.slice("grams", first, end - first + 1), t)
            return let(value, lambda v: F.struct(
                (-v["dice"]).alias("less"), first.alias("first"), end.alias("end"), v["common"].alias("common"), t["template"].alias("template"),
                t["license"].alias("license"), t["m"].alias("m"),
            ))

        return F.array_min(F.transform(ends, entry))

    def apart(found: Column) -> Column:
        """Without those that overlap an earlier one."""
        meets = lambda x: lambda y: (x["first"] <= y["end"] + 1) & (y["first"] <= x["end"] + 1)
        none = F.slice(found, F.lit(1), F.lit(0))
        return F.aggregate(found, none, lambda done, x: F.when(F.exists(done, meets(x)), done).otherwise(F.concat(done, F.array(x))))

    def windows(t: Column) -> Column:
        hits = F.filter(F.sequence(F.lit(1), F.size("grams")), lambda p: F.array_contains(t["set"], F.element_at("grams", p)))
        every = let(hits, lambda at: F.transform(F.sequence(F.lit(1), F.size(at)), lambda k: window(t, at, k)))
        return let(F.array_sort(F.filter(every, lambda x: x["less"] <= -least)), apart)

    found = rows.select("doc_id", "lines", "words", once(F.flatten(F.transform("near", windows)), "found")).where(F.size("found") > 0)
    by_size = F.array_sort(F.transform("found", lambda x: F.struct((-x["common"]).alias("fewer"), *[x[c].alias(c) for c in ("less", "template", "first", "end", "license", "m")])))
    found = found.select("doc_id", "lines", "words", once(by_size, "found")).select("doc_id", "lines", "words", F.explode(apart(F.col("found"))).alias("x"))
    line_of = F.flatten(F.transform("lines", lambda words, i: F.array_repeat(i + 1, F.size(words))))
    found = found.select("*", once(line_of, "line_of"))
    found = found.withColumn("line", F.element_at("line_of", F.col("x.first"))).withColumn("until", F.element_at("line_of", F.col("x.end") + 1))
    plain = F.filter(table, lambda t: t["template"] < len(templates))

    def reported(words: Column) -> Column:
        own = bigrams(words)
        best = F.array_max(F.transform(plain, lambda t: F.struct(measured(own, t)["dice"].alias("dice"), (-t["template"]).alias("order"), t["m"].alias("m"))))
        return let(best, lambda b: (b["dice"] >= least) & (b["m"] >= F.col("x.m")))

    units = F.concat(F.slice("lines", F.col("line"), F.col("until") - F.col("line") + 1), F.array("words"))
    found = found.where(~F.exists(units, reported))
    return found.select("doc_id", F.col("line").cast("int").alias("line"), F.col("x.license").alias("license"), F.col("x.template").alias("template"), (-F.col("x.less")).alias("dice"))


def scan(docs: DataFrame, templates=TEMPLATES, least: float = LEAST, notices=NOTICES) -> DataFrame:
    """``doc_id, line, license, template, dice`` for every unit and passage that matches; line 0 is the whole text."""
    passages = _passages(docs, templates, notices, least)
    known = [(i, name, _bigrams_of(text)) for i, (name, text) in enumerate(templates)]
    sizes = [len(grams) for _, _, grams in known]
    low, high = bounds(min(sizes), least)[0], bounds(max(sizes), least)[1]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    signals = sorted({word for _, _, grams in known for word in signal_words(grams, least)})
    # A value that is exploded alone is worked out once; else it would be where it is named.
    once = lambda value, name: F.explode(F.array(value)).alias(name)
    holds = lambda value: reduce(or_, [F.contains(value, F.lit(word)) for word in signals])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select("*", once(F.lower("text"), "low"))
    rows = rows.where(holds(F.col("low"))).drop("low")
    unit = lambda line, value: F.struct(line.cast("int").alias("line"), value.alias("unit"))
    lines = F.transform(F.split("text", "\n"), lambda value, place: unit(place + 1, value))
    whole = F.when(F.contains("text", F.lit("\n")), F.array(unit(F.lit(0), F.col("text")))).otherwise(F.array().cast("array<struct<line:int,unit:string>>"))
    units = rows.select("doc_id", F.inline(F.concat(lines, whole))).where(holds(F.lower("unit")))
    units = units.select("doc_id", "line", once(F.split(_normal(F.col("unit")), " "), "words")).where(F.size("words") > low)
    units = units.select("doc_id", "line", once(_bigrams(F.col("words")), "grams")).withColumn("n", F.size("grams")).where(F.col("n").between(low, high))
    # One comparison for each template within the size bounds.
    table = F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(len(g)).alias("m"), F.array(*map(F.lit, g)).alias("grams"))
        for i, name, g in known
    ])
    fits = F.filter(table, lambda t: (t["m"] * (2 - least) >= F.col("n") * least - 1e-9) & (F.col("n") * (2 - least) >= t["m"] * least - 1e-9))
    common = lambda t: F.size(F.array_intersect(t["grams"], F.col("grams")))
    scores = F.transform(fits, lambda t: F.struct((2 * common(t) / (t["m"] + F.col("n"))).alias("dice"), (-t["template"]).alias("order"), t["license"].alias("license")))
    best = units.select("doc_id", "line", once(F.array_max(scores), "best")).where(F.col("best.dice") >= least)
    best = best.select("doc_id", "line", F.col("best.license").alias("license"), (-F.col("best.order")).alias("template"), F.col("best.dice").alias("dice"))
    return best.unionByName(passages)


def _sql() -> str:
    rows = ", ".join(f"({i}, '{name}', {_bigrams_of(text)})" for i, (name, text) in enumerate(TEMPLATES))
    return rf"""
WITH templates(template, license, grams) AS (VALUES {rows}),
lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), units AS (
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS unit FROM lines
  UNION ALL SELECT doc_id, 0, text FROM documents WHERE contains(text, chr(10))
), words AS (
  SELECT doc_id, line, string_split(trim(regexp_replace(translate(unit, '{_UPPER}', '{_LOWER}'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM units
), grams AS (
  SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS g FROM words WHERE len(w) BETWEEN 2 AND 400
), scored AS (
  SELECT doc_id, line, template, license, 2 * len(list_intersect(t.grams, g)) / (len(t.grams) + len(g)) AS dice FROM grams, templates t
)
SELECT doc_id, cast(line AS integer) AS line, license, template, dice FROM scored WHERE dice >= {LEAST}
QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, template) = 1
"""


SQL = _sql()
