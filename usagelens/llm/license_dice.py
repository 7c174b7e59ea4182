"""Licence notices and texts in documents, by the Dice coefficient of word
bigrams (built-in expressions only).

A text is normalised as a whole (lower case; anything but a-z and 0-9 is a
gap), so line ends, comment marks and what shares a line with a notice do
not matter.  Windows of each template's number of words slide over it; a
window's distinct bigrams are compared with the template's.

For sets of a and b bigrams, 2 c / (a + b) >= t needs a and c of at least
t b / (2 - t).  So a text of fewer bigrams is no candidate (the size bound),
and a window lacks at most ``b - ceil(t b / (2 - t))`` bigrams of the template:
of any one more, the template's *anchors*, it holds one.  Only windows that
hold an anchor are compared, and only texts with a word of an anchor (a
plain substring search) are normalised at all.

Of windows that share more than half of the shorter one's words the best
counts: the highest coefficient, then the longest template, then the first in
the list, then the first place.  So a place names one licence, and a full
licence text is not also the notice it begins with.

Defined cases: null text has no windows; a text shorter than a template is one
window; a text of one word has that word as its only bigram; every place
counts; documents of one ``doc_id`` are counted together; a null ``doc_id`` is
reported as null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.shared import let, stored

THRESHOLD = 0.8

#: The wording by which the licences are announced.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
            "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
            "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
            "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
            "IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
            "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
            "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
            "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain "
                     "the above copyright notice, this list of conditions and the following disclaimer. "
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
                     "conditions and the following disclaimer in the documentation and/or other materials provided "
                     "with the distribution. " + (DISCLAIMER := (
                         "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
                         "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
                         "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
                         "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
                         "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
                         "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
                         "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
                         "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
                         "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."))),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain "
                     "the above copyright notice, this list of conditions and the following disclaimer. "
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
                     "conditions and the following disclaimer in the documentation and/or other materials provided "
                     "with the distribution. 3. Neither the name of the copyright holder nor the names of its "
                     "contributors may be used to endorse or promote products derived from this software without "
                     "specific prior written permission. " + DISCLAIMER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
             "use this software for any purpose, including commercial applications, and to alter it and redistribute "
             "it freely, subject to the following restrictions: 1. The origin of this software must not be "
             "misrepresented; you must not claim that you wrote the original software. If you use this software in a "
             "product, an acknowledgment in the product documentation would be appreciated but is not required. "
             "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
             "original software. 3. This notice may not be removed or altered from any source distribution."),
]

#: Parts of words that licences have and other texts have little of.
#: Anchors are chosen among the bigrams that hold one, as far as there are enough.
MARKS = ["licens", "redistribut", "copyright", "permi", "software", "warrant", "rights", "under"]


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def plain_words(text: str) -> list[str]:
    return "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in text.lower()).split()


def plain_bigrams(text: str) -> list[str]:
    """The distinct bigrams of a template."""
    words = plain_words(text)
    return list(dict.fromkeys([f"{a} {b}" for a, b in zip(words, words[1:])] or words))


def anchors(bigrams: list[str], threshold: float = THRESHOLD) -> list[str]:
    """Bigrams of which every window that reaches the threshold holds one."""
    need = math.ceil(threshold * len(bigrams) / (2 - threshold) - 1e-9)
    marked = lambda b: next((i for i, m in enumerate(MARKS) if m in b), len(MARKS))
    return sorted(bigrams, key=lambda b: (marked(b), -len(b), b))[:len(bigrams) - need + 1]


def mark_of(anchor: str) -> str:
    """What a text with the anchor holds, whatever stands between its words."""
    return next((m for w in anchor.split() for m in MARKS if m in w), max(anchor.split(), key=len))


def spans(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """Documents (doc_id, text) -> (row, doc_id, template, license, start,
    words, similarity): the places that name a licence, ``start`` being a word
    of the normalised text; ``row`` numbers the documents."""
    templates = [(name, plain_bigrams(text), max(1, len(plain_words(text)) - 1)) for name, text in notices]
    of_anchor: dict[str, list[int]] = {}
    for i, (_, own, _) in enumerate(templates):
        for anchor in anchors(own, threshold):
            of_anchor.setdefault(anchor, []).append(i)
    marks = sorted({mark_of(a) for a in of_anchor})
    marks = [m for m in marks if not any(o != m and o in m for o in marks)]
    holds = F.lit(False)
    for mark in marks:
        holds = holds | F.contains(F.lower("text"), F.lit(mark))
    named = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(m).alias("pairs"), F.array(*[F.lit(b) for b in own]).alias("own"))
                      for i, (_, own, m) in enumerate(templates)])
    by_anchor = F.create_map(*[x for a, ids in of_anchor.items() for x in (F.lit(a), F.array(*[F.lit(i) for i in ids]))])

    def windows(pairs: Column, at: Column, t: Column) -> Column:
        """The windows of template ``t`` around the anchor at ``at`` that reach the threshold."""
        last = F.greatest(F.size(pairs) - t["pairs"], F.lit(0))
        low = F.least(F.greatest(at - t["pairs"] + 1, F.lit(0)), last)
        high = F.greatest(low, F.least(at, last))

        def window(start: Column) -> Column:
            own = F.array_distinct(F.slice(pairs, start + 1, t["pairs"]))
            return let(own, lambda d: F.struct(
                t["template"].alias("template"), start.alias("start"),
                (F.least(t["pairs"], F.size(pairs)) + 1).alias("words"),
                (2.0 * F.size(F.array_intersect(d, t["own"])) / (F.size(d) + F.size(t["own"]))).alias("similarity")))
        fits = 2.0 * F.least(F.size(pairs), t["pairs"]) >= threshold / (2 - threshold) * F.size(t["own"])
        every = F.transform(F.sequence(low, high), window)
        return F.when(fits, F.filter(every, lambda w: w["similarity"] >= threshold))

    def hits(pairs: Column) -> Column:
        places = F.filter(F.transform(pairs, lambda x, i: F.struct(x.alias("pair"), i.alias("at"))),
                          lambda x: x["pair"].isin(list(of_anchor)))
        found = F.transform(places, lambda x: F.flatten(F.array_compact(F.transform(
            F.element_at(by_anchor, x["pair"]), lambda i: windows(pairs, x["at"], F.get(named, i))))))
        return F.array_distinct(F.flatten(found))

    def pairs_of(words: Column) -> Column:
        return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))),
                           lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    found = rows.where(holds).select("row", "doc_id", F.inline(let(F.split(normalised(F.col("text")), " "), lambda words: let(
        pairs_of(words), hits))))
    found = stored(found, "license-windows")
    license_ = F.element_at(F.array(*[F.lit(name) for name, _, _ in templates]), F.col("template") + 1)
    reach = max(m for *_, m in templates) + 1  # windows that overlap begin in the same or in neighbouring stretches
    own = found.withColumn("stretch", F.floor(F.col("start") / reach))
    other = own.select(*[F.col(c).alias(f"o_{c}") for c in own.columns if c != "stretch"],
                       F.explode(F.array(*[F.col("stretch") + d for d in (-1, 0, 1)])).alias("o_stretch"))
    rank = lambda p: F.struct(F.col(f"{p}similarity").alias("a"), F.col(f"{p}words").alias("b"),
                              (-F.col(f"{p}template")).alias("c"), (-F.col(f"{p}start")).alias("d"))
    common = (F.least(F.col("start") + F.col("words"), F.col("o_start") + F.col("o_words"))
              - F.greatest("start", "o_start"))
    beaten = ((F.col("row") == F.col("o_row")) & (F.col("stretch") == F.col("o_stretch")) & (rank("o_") > rank(""))
              & (2 * common > F.least("words", "o_words")))
    return own.join(other, beaten, "left_anti").select("row", "doc_id", "template", license_.alias("license"), "start", "words",
                                                       "similarity")


def scan(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """Documents (doc_id, text) -> (doc_id, license, n_units, similarity):
    the licences named, the places that do, and the best Dice coefficient."""
    return spans(docs, notices, threshold).groupBy("doc_id", "license").agg(
        F.count(F.lit(1)).alias("n_units"), F.max("similarity").alias("similarity"))
