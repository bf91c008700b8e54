"""License scans: Dice coefficient over word bigrams against licence templates.

Texts and templates are normalised alike (ASCII lower case; every run of
characters other than a-z and 0-9 parts two words). A text is cut into
segments at its line ends and behind ``. ; : ! ?`` followed by blanks; a unit
is a run of one or more neighbouring segments, so a notice is found on a line
of its own, beside other sentences of its line, or wrapped over lines, and a
licence's body among other text. Units and templates are compared as bags of
word bigrams: dice = 2 |A n B| / (|A| + |B|), where a bigram counts as often as
it stands in both. A threshold t bounds the sizes that can reach it,
t / (2 - t) <= |A| / |B| <= (2 - t) / t, so a template meets only runs whose
word count fits. The same bounds say how many of a template's different bigrams
must occur anywhere in a text; templates that miss this (looked up by 64-bit
hashes, which can only let more through) meet no run of that text at all.
Everything is one projection of built-in functions over the scan: no shuffle,
no join, no Python.

Matching runs overlap (one with a sentence more still matches), so matches are
counted from the left: a match counts if it begins behind the last one counted;
of runs that begin at one segment the best does.

Defined cases: a null or empty text has no unit that matches; runs of one word
have no bigram and never match; the best match has the greatest Dice, of equal
ones the first start, then the shortest run, then the first name; a template
inside a text of any length is found, as whole texts are cut; repeated rows
give repeated results, an empty table an empty one; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# The usual public notices by which a text states its licence, headers and bodies of short licences.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Reserved": "All rights reserved.",
    "Apache-2.0-header": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause-text": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
        "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
        OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED
        OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "GPL-3.0-header": """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
        GNU General Public License for more details. You should have received a copy of the GNU General Public License
        along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "ISC-text": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
        ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
        PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
        WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT-text": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
        and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions
        of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
        NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN
        AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "MPL-2.0-header": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense-text": """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the
        author or authors of this software dedicate any and all copyright interest in the software to the public domain.
        We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.
        We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to
        this software under copyright law.""",
    "Zlib-text": """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject
        to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim
        that you wrote the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as
        such, and must not be misrepresented as being the original software. 3. This notice may not be removed or
        altered from any source distribution.""",
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_words(text: str) -> list[str]:
    low = text.translate(str.maketrans(_UPPER, _LOWER))
    return "".join(c if c in _LOWER or c.isascii() and c.isdigit() else " " for c in low).split()


def template_bigrams(templates: dict[str, str]) -> list[tuple[str, dict[str, int]]]:
    """(name, bag of bigrams) by name; a template needs two words."""
    out = []
    for name in sorted(templates):
        w = template_words(templates[name])
        if len(w) < 2:
            raise ValueError(f"template {name!r} has no word bigram")
        out.append((name, dict(Counter(f"{a} {b}" for a, b in zip(w, w[1:])))))
    return out


def fitting_sizes(size: int, t: float) -> range:
    """The bigram counts that can reach t against ``size`` ones: 2 min(a, b) / (a + b) >= t."""
    fit = [n for n in range(1, int(2 * size / t) + 1) if 2.0 * min(n, size) / (n + size) >= t]
    return range(fit[0], fit[-1] + 1)


def needed_bigrams(bag: dict[str, int], t: float) -> int:
    """How many different bigrams of a template a text must hold for some run of it to reach t."""
    size = sum(bag.values())
    fit = fitting_sizes(size, t)
    overlap = next(o for o in range(1, size + 1) if 2.0 * o / (max(o, fit[0]) + size) >= t)
    return max(1, len(bag) - (size - overlap))  # each bigram that is absent takes one or more from the overlap


def _template_table(known: list[tuple[str, dict[str, int]]], t: float) -> Column:
    """The templates as one constant array of structs, parsed at once: a call for each word would take seconds."""
    texts = lambda bag: f"array({', '.join(map(repr, bag))})"  # noqa: E731 - words are letters and digits: nothing to quote
    rows = []
    for name, bag in known:
        size = sum(bag.values())
        fit = fitting_sizes(size, t)
        hashes = ", ".join("xxhash64(%r, %r)" % tuple(pair.split(" ")) for pair in bag)
        more = ", ".join(f"named_struct('pair', {pair!r}, 'm', {m})" for pair, m in bag.items() if m > 1)
        rows.append(f"""named_struct('size', {size}, 'least', {fit[0]}, 'most', {fit[-1]}, 'need', {needed_bigrams(bag, t)},
            'hashes', array({hashes}), 'pairs', {texts(bag)}, 'more', cast(array({more}) as array<struct<pair:string,m:int>>))""")
    return F.expr(f"array({', '.join(rows)})")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, n_matches, license_id and dice of the best match, its first line and its last_line."""
    known = template_bigrams(templates)
    table, names = _template_table(known, threshold), F.array(*(F.lit(name) for name, _ in known))
    col = lambda name: F.col(f"__{name}")

    def words(text: Column) -> Column:
        return F.filter(F.split(F.regexp_replace(text, "[^a-z0-9]+", " "), " "), lambda w: w != "")

    # Which bigrams of all templates the text holds anywhere. Steps of their own: each is read more than once below.
    df = docs.select(F.col(id_col), F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _LOWER).alias("__low"))
    df = df.select(id_col, "__low", words(col("low")).alias("__words"))
    rest = F.slice(col("words"), 2, F.greatest(F.size(col("words")) - 1, F.lit(0)))
    held = F.zip_with(col("words"), rest, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    seen = F.array_intersect(held, F.array_distinct(F.flatten(F.transform(table, lambda t: t["hashes"]))))
    df = df.select(id_col, "__low", seen.alias("__seen"))
    fewest = min(needed_bigrams(bag, threshold) for _, bag in known)
    possible = F.transform(table, lambda t, k: F.when(
        F.size(F.array_intersect(col("seen"), t["hashes"])) >= t["need"], k))
    none = F.array().cast("array<int>")
    df = df.select(id_col, "__low", F.when(F.size(col("seen")) >= fewest, F.array_compact(possible)).otherwise(none).alias("__possible"))

    # Words of texts with a possible template: each with its line, and whether it begins a segment.
    def segment(text: Column, line: Column) -> Column:
        return F.transform(words(text), lambda w, i: F.struct(w.alias("w"), line.alias("line"), (i == 0).alias("first")))

    def segments(line: Column, i: Column) -> Column:
        cut = F.split(F.regexp_replace(line, "([.;:!?])[ \\t\\r]+", "$1\n"), "\n")
        return F.flatten(F.transform(cut, lambda s: segment(s, i + 1)))

    low = F.when(F.size(col("possible")) > 0, col("low")).otherwise(F.lit(""))
    df = df.select(id_col, "__possible", F.flatten(F.transform(F.split(low, "\n"), segments)).alias("__tokens"))
    starts = F.array_compact(F.transform(col("tokens"), lambda t, i: F.when(t["first"], i)))
    pairs = F.transform(F.slice(col("tokens"), 2, F.greatest(F.size(col("tokens")) - 1, F.lit(0))),
                        lambda t, i: F.concat(col("tokens")[i]["w"], F.lit(" "), t["w"]))
    df = df.select(id_col, "__possible", "__tokens", pairs.alias("__pairs"),
                   F.concat(starts, F.array(F.size(col("tokens")))).alias("__starts"))
    n_segments = F.size(col("starts")) - 1

    def run(k: Column, t: Column, i: Column, j: Column) -> Column:
        own = F.slice(col("pairs"), col("starts")[i] + 1, col("starts")[j + 1] - col("starts")[i] - 1)
        # What the bags share: each different bigram once, and of repeated ones what both have beyond that.
        times = lambda x: F.size(F.filter(own, lambda p: p == x["pair"]))
        shared = F.aggregate(t["more"], F.size(F.array_intersect(t["pairs"], own)),
                             lambda n, x: n + F.greatest(F.least(times(x), x["m"]) - 1, F.lit(0)))
        dice = 2.0 * shared / (F.size(own) + t["size"])
        return F.struct(i.alias("first"), (-dice).alias("order"), j.alias("last"), k.alias("template"), dice.alias("dice"))

    def runs(k: Column, t: Column, i: Column) -> Column:
        """Runs from segment i on that fit: each segment has a word, so there are at most ``most`` + 1 segments."""
        ends = F.filter(F.sequence(i, F.least(n_segments - 1, i + t["most"])), lambda j: (
            col("starts")[j + 1] - col("starts")[i] - 1).between(t["least"], t["most"]))
        return F.filter(F.transform(ends, lambda j: run(k, t, i, j)), lambda r: r["dice"] >= threshold)

    firsts = F.when(n_segments > 0, F.sequence(F.lit(0), n_segments - 1)).otherwise(none)
    matches = F.flatten(F.transform(col("possible"), lambda k: F.flatten(F.transform(
        firsts, lambda i: runs(k, F.element_at(table, k + 1), i)))))
    df = df.select(id_col, "__tokens", "__starts", F.array_sort(matches).alias("__found"))
    start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("upto"), F.lit(0.0).alias("dice"), F.lit(0).alias("template"),
                     F.lit(0).alias("first"), F.lit(0).alias("last"))
    total = F.aggregate(col("found"), start, lambda a, m: F.struct(
        (a["n"] + (m["first"] > a["upto"]).cast("int")).alias("n"),
        F.when(m["first"] > a["upto"], m["last"]).otherwise(a["upto"]).alias("upto"),
        *(F.when(m["dice"] > a["dice"], m[c]).otherwise(a[c]).alias(c) for c in ("dice", "template", "first", "last"))))
    m, got = col("m"), col("m")["n"] > 0
    line = lambda token: F.when(got, col("tokens")[token]["line"].cast("long"))
    return df.select(id_col, "__tokens", "__starts", total.alias("__m")).select(
        F.col(id_col), m["n"].cast("long").alias("n_matches"), F.when(got, names[m["template"]]).alias("license_id"),
        F.when(got, m["dice"]).alias("dice"), line(col("starts")[m["first"]]).alias("line"),
        line(col("starts")[m["last"] + 1] - 1).alias("last_line"))
