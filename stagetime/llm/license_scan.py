"""Licence scans: texts and their parts against licence notices by the Dice coefficient of word bigrams.

Text is lower-cased, and every run of other characters than a-z and 0-9 becomes one space.  A unit with a
distinct bigrams and a notice with b can reach the coefficient t only if t/(2-t) <= a/b <= (2-t)/t, so
each unit is compared with the notices of a fitting size alone.  A unit that reaches t also lacks at most
b - t/(2-t)*b of a notice's bigrams; a few words of each notice that stand in more of its bigrams than
that are its anchors, and texts without any anchor are passed over.

Units are lines, paragraphs of several lines, whole texts of several paragraphs, and windows: as many words
as a notice has, laid so that one of its anchors stands where it stands in the notice.  So a notice is also
found inside a longer line, and one that is wrapped or spans blank lines inside a longer text.  All of it is
DataFrame expressions.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Windows of a text that stand in one row at a time.
WINDOWS = 256

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"""
_BSD_2 = """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# The wording of common licences and notices, as they prescribe it or as is customary.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        _MIT,
        f"{_MIT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_WARRANTY}",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "BSD": ["Licensed under the BSD License.", _BSD],
    "BSD-2-Clause": [f"{_BSD} {_BSD_2} {_BSD_WARRANTY}"],
    "BSD-3-Clause": [f"{_BSD} {_BSD_2} {_BSD_3} {_BSD_WARRANTY}"],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    ],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "AGPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}


def _words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def _bigrams(text: str) -> list[str]:
    words = _words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def anchors(bigrams: list[str], threshold: float) -> set[str]:
    """Long words, one of which stands in every set that reaches the threshold with these bigrams."""
    may_lack = len(bigrams) - math.ceil(threshold / (2 - threshold) * len(bigrams) - 1e-9)
    chosen: set[str] = set()
    for word in sorted({w for b in bigrams for w in b.split()}, key=lambda w: (len(w), w), reverse=True):
        if sum(any(w in chosen for w in b.split()) for b in bigrams) > may_lack:
            break
        chosen.add(word)
    return chosen


def notice_table(notices: dict[str, list[str]] = NOTICES) -> list[tuple[str, int, list[str]]]:
    """(licence, number of the notice, bigrams), in order of the licences' names."""
    return [(name, k, _bigrams(text)) for name in sorted(notices) for k, text in enumerate(notices[name])]


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def anchor_places(text: str, threshold: float) -> list[tuple[str, int]]:
    """The anchors of a notice, each with its first place among the notice's words."""
    words = _words(text)
    return sorted((w, words.index(w)) for w in anchors(_bigrams(text), threshold))


def scan(docs: DataFrame, threshold: float = 0.8, notices: dict[str, list[str]] = NOTICES) -> DataFrame:
    """doc_id, unit, position, license, notice, dice: one row for each match of a unit and a notice.

    unit is line, paragraph (of several lines, cut at blank lines), text (of several paragraphs) or window;
    position counts lines, paragraphs, or the words before the window, from 0.  Null and empty texts, and
    units of fewer than two words, match nothing.  Repeated rows and null doc_ids are scanned each on its
    own; notices that tie are all returned.  A very long text is scanned whole.  Other columns are ignored;
    an empty table gives an empty result.
    """
    known = notice_table(notices)
    words = sorted(set().union(*(anchors(b, threshold) for _, _, b in known)))
    anchor_list = F.split(F.lit(" ".join(words)), " ")
    there = F.arrays_overlap(F.split(F.lower("text"), "[^a-z0-9]+"), anchor_list)
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(there)

    blank = "\n[ \t\r]*\n"
    unit = lambda kind, at, words, of=None: F.struct(F.lit(kind).alias("unit"), at.cast("int").alias("position"), words.alias("words"), (F.lit(None).cast("int") if of is None else of).alias("of"))
    split = lambda body: F.split(normalised(body), " ")
    lines = F.transform(F.split("text", "\n"), lambda x, i: unit("line", i, split(x)))
    blocks = F.transform(F.filter(F.transform(F.split("text", blank), lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda b: F.contains(F.trim(b["x"]), F.lit("\n"))), lambda b: unit("paragraph", b["i"], split(b["x"])))
    whole = F.transform(F.filter(F.array("text"), lambda x: F.regexp_like(x, F.lit(blank))), lambda x: unit("text", F.lit(0), split(x)))

    # Constants, which the optimizer reads once.
    table = [{"license": n, "notice": k, "n": len(b), "bigrams": b, "of": at} for at, (n, k, b) in enumerate(known)]
    table = F.from_json(F.lit(json.dumps(table)), "array<struct<license:string,notice:int,n:int,bigrams:array<string>,of:int>>")
    laid = [{"of": at, "word": w, "before": j} for at, (n, k, _) in enumerate(known) for w, j in anchor_places(notices[n][k], threshold)]
    laid = F.from_json(F.lit(json.dumps(laid)), "array<struct<of:int,word:string,before:int>>")

    # Places of windows as one long each, so that repeats are found by hashing: the notice, and the start past all words before an anchor.
    far = max([len(_words(text)) for texts in notices.values() for text in texts], default=0)
    places = F.filter(F.transform("w", lambda x, i: F.struct(i.cast("long").alias("i"), x.alias("x"))), lambda p: F.array_contains(anchor_list, p["x"]))
    starts = F.flatten(F.transform(places, lambda p: F.transform(F.filter(laid, lambda t: t["word"] == p["x"]), lambda t: F.shiftleft(t["of"].cast("long"), 40) + p["i"] - t["before"] + far)))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size("s") - 1) / WINDOWS).cast("int")), lambda k: F.slice("s", k * WINDOWS + 1, WINDOWS))

    def window(s: Column) -> Column:
        of = F.shiftright(s, 40).cast("int")
        start = (s - F.shiftleft(of.cast("long"), 40) - far).cast("int")
        at, length = F.greatest(start, F.lit(0)), F.element_at(lengths, of + 1)
        return unit("window", at, F.slice("w", at + 1, length + F.least(start, F.lit(0))), of)

    lengths = F.array(*[F.lit(len(_words(notices[n][k]))) for n, k, _ in known])
    placed = some.select("doc_id", "text", split(F.col("text")).alias("w")).select("doc_id", "text", "w", F.array_distinct(starts).alias("s"))
    # One pass over the texts: the null run stands for all units but windows.
    runs = F.concat(F.array(F.lit(None).cast("array<bigint>")), F.when(F.size("s") > 0, runs).otherwise(F.array().cast("array<array<bigint>>")))
    each = placed.select("doc_id", "text", "w", F.explode(runs).alias("run"))
    units = each.select("doc_id", F.explode(F.when(F.col("run").isNull(), F.concat(lines, blocks, whole)).otherwise(F.transform("run", window))).alias("u")).select("doc_id", "u.*").filter("size(words) > 1")
    pairs = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.concat_ws(" ", F.element_at("words", i), F.element_at("words", i + 1)))
    units = units.select("doc_id", "unit", "position", "of", F.array_distinct(pairs).alias("bigrams"))

    low_share, high_share = threshold / (2 - threshold), (2 - threshold) / threshold
    size = F.size("bigrams")
    fits = lambda t: (size >= t["n"] * F.lit(low_share) - 1e-9) & (size <= t["n"] * F.lit(high_share) + 1e-9) & (F.col("of").isNull() | (F.col("of") == t["of"]))
    compared = F.transform(F.filter(table, fits), lambda t: F.struct(t["license"].alias("license"), t["notice"].alias("notice"), (2.0 * F.size(F.array_intersect(F.col("bigrams"), t["bigrams"])) / (size + t["n"])).alias("dice")))
    matches = units.select("doc_id", "unit", "position", F.explode(F.filter(compared, lambda m: m["dice"] >= threshold)).alias("m"))
    return matches.select("doc_id", "unit", "position", "m.license", "m.notice", "m.dice")


def scan_sql(threshold: float = 0.8, notices: dict[str, list[str]] = NOTICES) -> str:
    """The same over the table documents in DuckDB SQL, without size bounds, and for all but windows without anchors."""
    rows = ", ".join(f"('{n}', {k}, [{', '.join(repr(x) for x in b)}])" for n, k, b in notice_table(notices))
    laid = ", ".join(f"('{n}', {k}, '{w}', {j}, {len(_words(notices[n][k]))})" for n, k, _ in notice_table(notices) for w, j in anchor_places(notices[n][k], threshold))
    normal = lambda c: f"string_split(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    pairs = lambda w: f"list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"
    dice = "2.0::DOUBLE * len(list_intersect(bigrams, known)) / (len(bigrams) + len(known))"
    return f"""
WITH notices(license, notice, known) AS (VALUES {rows}), laid(license, notice, word, before, length) AS (VALUES {laid}),
lines AS (SELECT doc_id, 'line' AS unit, generate_subscripts(p, 1) - 1 AS position, unnest(p) AS body
          FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL)),
blocks AS (SELECT doc_id, 'paragraph' AS unit, generate_subscripts(p, 1) - 1 AS position, unnest(p) AS body
           FROM (SELECT doc_id, regexp_split_to_array(text, '\n[ \t\r]*\n') AS p FROM documents WHERE text IS NOT NULL)),
units AS (SELECT * FROM lines UNION ALL SELECT * FROM blocks WHERE contains(trim(body), chr(10))
          UNION ALL SELECT doc_id, 'text', 0, text FROM documents WHERE regexp_matches(text, '\n[ \t\r]*\n')),
worded AS (SELECT doc_id, unit, position, {normal("body")} AS w FROM units),
paired AS (SELECT doc_id, unit, position, {pairs("w")} AS bigrams FROM worded WHERE len(w) > 1),
scored AS (SELECT doc_id, unit, position, license, notice, {dice} AS dice FROM paired CROSS JOIN notices),
numbered AS (SELECT row_number() OVER () AS r, doc_id, {normal("text")} AS w FROM documents WHERE text IS NOT NULL),
placed AS (SELECT r, generate_subscripts(w, 1) - 1 AS i, unnest(w) AS word FROM numbered),
starts AS (SELECT DISTINCT r, license, notice, length, i - before AS start FROM placed JOIN laid USING (word)),
cut AS (SELECT doc_id, license, notice, greatest(start, 0) AS position, w[greatest(start, 0) + 1 : start + length] AS w FROM starts JOIN numbered USING (r)),
inside AS (SELECT doc_id, 'window' AS unit, position, license, notice, {pairs("w")} AS bigrams FROM cut WHERE len(w) > 1)
SELECT doc_id, unit, position::INTEGER AS position, license, notice::INTEGER AS notice, dice FROM scored WHERE dice >= {threshold}
UNION ALL SELECT * FROM (SELECT doc_id, unit, position::INTEGER, license, notice::INTEGER, {dice} AS dice FROM inside JOIN notices USING (license, notice)) WHERE dice >= {threshold}
"""
