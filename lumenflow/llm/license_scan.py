"""License scans: Dice coefficient of word bigrams against licence templates, in DataFrame functions only.

Candidate texts are a document's lines, its paragraphs (between blank lines), its whole text and, for headers
with other lines directly around them, windows of lines. A window begins at a line and holds two lines at
least: for each template both the shortest run of lines with as many words as the template and the longest
with fewer, up to (2 - t) / t times its words. Lines without words (comment marks, blank lines) don't count. Windows
are formed only in documents that share enough bigrams with the template, and only at lines after which, within
reach, enough of them lie.
Both sides are normalised to lower-case words of letters and digits. A template with n bigrams can
only reach the threshold t with texts of n * t / (2 - t) to n * (2 - t) / t bigrams, and shares at
least that lower number of its own; so every match holds one of the template's first
``n - least + 1`` bigrams, here its ones with the longest words. Texts without one of those words,
or outside the sizes, are dropped before any bigram is made; a text is compared only with the
templates whose sizes allow it.

Defined cases: null and empty texts match nothing; equal texts of one document count once each
time they occur; rows that repeat doc_id are one document, in which a place (line or paragraph
number) counts once; windows that begin at consecutive lines are one match; work grows linearly with a text's
length; a null doc_id is a group of its own; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Notices and short texts of public licences.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0 notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-2-Clause text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "ISC text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "LGPL-3.0 header": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
}


def _words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def _bigrams(words: list[str]) -> list[str]:
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def _least(n: int, t: float) -> int:
    return max(1, math.ceil(n * t / (2 - t) - 1e-9))


def anchors(bigrams: list[str], threshold: float) -> list[str]:
    """The longer word of enough bigrams that every match holds one of them; long words are rare."""
    by_length = sorted(bigrams, key=lambda b: (-max(map(len, b.split())), b))
    return sorted({max(b.split(), key=len) for b in by_length[: len(bigrams) - _least(len(bigrams), threshold) + 1]})


def _normal(text: Column) -> Column:
    """Lower-case ASCII words: [a-z0-9]+ of the text with A-Z lowered."""
    return F.array_remove(F.split(F.lower(F.regexp_replace(text, r"[^A-Za-z0-9]+", " ")), " "), "")


def _split(joined: str) -> Column:
    """An array of words or bigrams as one literal."""
    return F.split(F.lit(joined), "\\|")


def _let(value: Column, body) -> Column:
    """The body over a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _windows(texts: dict[str, list[str]], lengths: dict[str, int], threshold: float) -> Column:
    """Windows of lines for all templates whose bigrams the whole text shares often enough.

    Takes the columns w (words), g (their bigrams), starts and stops (of lines, in words).
    """
    reach = {k: math.floor(lengths[k] * (2 - threshold) / threshold + 1e-9) for k in texts}
    known = F.array(*[
        F.struct(F.lit(k).alias("id"), F.lit(lengths[k]).alias("n"), F.lit(_least(len(b), threshold)).alias("least"), F.lit(reach[k]).alias("reach"), F.lit(anchors(b, threshold)[0]).alias("key"), _split("|".join(b)).alias("grams"))
        for k, b in texts.items()
    ])
    shared = F.array_intersect("g", _split("|".join(sorted({x for b in texts.values() for x in b}))))
    lines = F.transform("starts", lambda s, k: F.struct(s.alias("s"), k.alias("k")))

    def of_template(t: Column) -> Column:
        near = lambda flags: F.filter(lines, lambda x: F.size(F.filter(F.slice(flags, x["s"] + 1, t["reach"] - 1), lambda f: f)) >= t["least"])
        begins = _let(F.transform("g", lambda x: F.array_contains(t["grams"], x)), near)
        return F.flatten(F.transform(begins, lambda x: ends(x, t)))

    def ends(x: Column, t: Column) -> Column:
        full = lambda e: e >= x["s"] + t["n"]
        both = _let(F.slice("stops", x["k"] + 2, t["n"]), lambda e: F.array(F.array_max(F.filter(e, lambda y: ~full(y))), F.get(F.filter(e, full), 0)))
        fits = F.filter(both, lambda e: e.isNotNull() & (e - x["s"] <= t["reach"]))
        own = lambda e: F.array_distinct(F.slice("g", x["s"] + 1, e - x["s"] - 1))
        return F.transform(fits, lambda e: F.struct(F.lit("window").alias("scope"), x["k"].alias("k"), own(e).alias("own"), F.array(t["key"]).alias("anchors"), t["id"].alias("only")))

    fitting = _let(shared, lambda h: F.when(F.size(h) >= min(_least(len(b), threshold) for b in texts.values()), F.filter(known, lambda t: F.size(F.array_intersect(h, t["grams"])) >= t["least"])))
    return F.flatten(F.transform(fitting, of_template))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license_id, scope (line, paragraph, window or document), n_matches, best_dice (rounded to 6 places)."""
    spark = docs.sparkSession
    split = {k: _words(v) for k, v in (templates or TEMPLATES).items()}
    texts = {k: b for k, w in split.items() if (b := _bigrams(w))}
    rare = sorted({a for b in texts.values() for a in anchors(b, threshold)})
    most = max(math.floor(len(b) * (2 - threshold) / threshold + 1e-9) for b in texts.values())
    rows = [(k, len(b), _least(len(b), threshold), math.floor(len(b) * (2 - threshold) / threshold + 1e-9), b) for k, b in texts.items()]
    held = spark.createDataFrame(rows, "license_id string, size int, least int, most int, grams array<string>")
    by_word = spark.createDataFrame([(w, k) for k, b in texts.items() for w in anchors(b, threshold)], "anchor string, license_id string").join(held, "license_id")
    # a document without any anchor word is left at once, by one pass over its text
    some = docs.select("doc_id", "text").where(F.lower("text").rlike(r"(?<![a-z0-9])(?:" + "|".join(rare) + r")(?![a-z0-9])"))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(F.lit("line").alias("scope"), i.alias("k"), x.alias("t")))
    blocks = F.when(F.col("text").rlike(r"\n[ \t]*\n"), F.transform(F.split("text", r"\n[ \t]*\n"), lambda x, i: F.struct(F.lit("paragraph").alias("scope"), i.alias("k"), x.alias("t")))).otherwise(F.slice(lines, 1, 0))
    # filters on arrays, before rows are made of them: pushed below a projection, a filter would
    # compute the words anew for every bigram
    worded = some.select("doc_id", *[F.transform(x, lambda p: F.struct(p["scope"].alias("scope"), p["k"].alias("k"), _normal(p["t"]).alias("w"))).alias(n) for n, x in (("lines", lines), ("blocks", blocks))])
    # the words of the lines, one after the other, are those of the text; each line's first is marked
    marked = F.flatten(F.transform("lines", lambda p: F.transform(p["w"], lambda _, i: i == 0)))
    none = F.array().cast("array<int>")
    whole = F.array(F.struct(F.lit("document").alias("scope"), F.lit(0).alias("k"), F.flatten("lines.w").alias("w"), F.filter(F.transform(marked, lambda m, i: F.when(m, i)), lambda i: i.isNotNull()).alias("starts")))
    other = F.transform(F.concat("lines", "blocks"), lambda p: F.struct(p["scope"].alias("scope"), p["k"].alias("k"), p["w"].alias("w"), none.alias("starts")))
    cut = worded.select("doc_id", F.explode(F.filter(F.concat(whole, other), lambda p: (F.size(p["w"]) > 1) & F.arrays_overlap(p["w"], F.lit(rare)))).alias("p")).select("doc_id", "p.*")
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.slice("w", i, 2)))
    cut = cut.withColumn("g", grams).withColumn("stops", F.concat(F.slice("starts", F.lit(2), F.greatest(F.size("starts"), F.lit(1))), F.array(F.size("w"))))
    itself = F.struct("scope", "k", F.array_distinct("g").alias("own"), F.array_intersect("w", F.lit(rare)).alias("anchors"), F.lit(None).cast("string").alias("only"))
    sized = F.filter(F.array(itself), lambda x: F.size(x["own"]) <= most)
    windows = F.when(F.size("starts") > 1, _windows(texts, {k: len(split[k]) for k in texts}, threshold))
    own = cut.select("doc_id", F.explode(F.concat(sized, F.coalesce(windows, F.slice(sized, 1, 0)))).alias("x")).select("doc_id", "x.scope", "x.k", "x.own", "x.only", F.explode("x.anchors").alias("anchor"))
    fits = F.size("own").between(F.col("least"), F.col("most")) & (F.col("only").isNull() | (F.col("only") == F.col("license_id")))
    met = own.join(F.broadcast(by_word), "anchor").where(fits)  # templates are a parameter, a few kilobytes
    dice = 2.0 * F.size(F.array_intersect("own", "grams")) / (F.size("own") + F.col("size"))
    found = met.withColumn("dice", dice).where(F.col("dice") >= threshold - 1e-9)
    # one row per text and template: several anchors may lead to the same comparison
    done = found.groupBy("doc_id", "license_id", "scope").agg(F.array_sort(F.collect_set("k")).alias("at"), F.round(F.max("dice"), 6).alias("best_dice"))
    runs = F.filter(F.transform("at", lambda k, i: (i == 0) | (F.col("scope") != "window") | (k - F.get("at", i - 1) > 1)), lambda first: first)
    return done.select("doc_id", "license_id", "scope", F.size(runs).cast("long").alias("n_matches"), "best_dice")


def sql(templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> str:
    rows = ", ".join(f"('{k}', {b!r}, {len(w)})" for k, v in (templates or TEMPLATES).items() for w in [_words(v)] for b in [_bigrams(w)])
    words = "list_filter(string_split(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"
    return rf"""
WITH t AS (SELECT col0 AS license_id, col1 AS grams, col2 AS n FROM (VALUES {rows})),
d AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, 'document' AS scope, 0 AS k, text AS t FROM d
  UNION ALL SELECT doc_id, 'line', unnest(range(len(l))), unnest(l) FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM d)
  UNION ALL SELECT doc_id, 'paragraph', unnest(range(len(l))), unnest(l) FROM (SELECT doc_id, string_split_regex(text, '\n[ \t]*\n') AS l FROM d) WHERE len(l) > 1),
w AS (SELECT doc_id, scope, k, {words.format('t')} AS w FROM c),
g AS (SELECT doc_id, scope, k, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS own FROM w WHERE len(w) > 1),
m AS (SELECT doc_id, scope, k, license_id, 2.0 * len(list_intersect(own, grams)) / (len(own) + len(grams)) AS dice FROM g, t
  WHERE len(own) * (2 - {threshold}) >= len(grams) * {threshold} - 1e-6 AND len(own) * {threshold} <= len(grams) * (2 - {threshold}) + 1e-6),
dl AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda y: {words.format('y')}), lambda x: len(x) > 0) AS l FROM d),
dw AS (SELECT doc_id, flatten(l) AS w, list_transform(l, lambda x: len(x)) AS sizes FROM dl WHERE len(l) > 1),
dg AS (SELECT *, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM dw),
dt AS (SELECT * FROM dg, t WHERE len(list_intersect(list_distinct(g), grams)) * (2 - {threshold}) >= len(grams) * {threshold} - 1e-6),
st AS (SELECT *, unnest(range(len(sizes))) AS k FROM dt),
pr AS (SELECT *, coalesce(list_sum(sizes[1:k]), 0) AS b, unnest(range(k + 2, least(len(sizes), k + n + 1) + 1)) AS j FROM st),
en AS (SELECT doc_id, license_id, k, b, g, grams, n, list_sum(sizes[1:j]) AS e FROM pr),
wn AS (SELECT doc_id, license_id, k, b, any_value(g) AS g, any_value(grams) AS grams, any_value(n) AS n, unnest([max(e) FILTER (e < b + n), min(e) FILTER (e >= b + n)]) AS e FROM en GROUP BY doc_id, license_id, k, b),
wd AS (SELECT doc_id, license_id, k, list_distinct(g[b + 1:e - 1]) AS own, grams FROM wn WHERE e IS NOT NULL AND (e - b) * {threshold} <= n * (2 - {threshold}) + 1e-6),
wm AS (SELECT doc_id, license_id, k, max(2.0 * len(list_intersect(own, grams)) / (len(own) + len(grams))) AS dice FROM wd GROUP BY ALL HAVING dice >= {threshold} - 1e-9),
wr AS (SELECT *, lag(k) OVER (PARTITION BY doc_id, license_id ORDER BY k) AS before FROM wm)
SELECT doc_id, license_id, scope, count(DISTINCT k) AS n_matches, round(max(dice), 6) AS best_dice FROM m WHERE dice >= {threshold} - 1e-9 GROUP BY ALL
UNION ALL SELECT doc_id, license_id, 'window', count(*) FILTER (before IS NULL OR k - before > 1), round(max(dice), 6) FROM wr GROUP BY ALL"""
