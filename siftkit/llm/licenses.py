"""Operator 5: licence texts by Dice similarity of word bigrams over windows of the whole text, in SQL functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MIN_DICE_PCT = 60

# Public licence notices, titles, file headers and whole texts, as published; a parameter.
_WARRANTY = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
             "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. ")
_REDISTRIBUTE = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
_ENDORSE = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission. ")
_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu(name: str, version: int, lesser: str = "") -> str:
    """The file header of the GNU licences."""
    subject = "library" if lesser else "program"
    return (f"This {subject} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
            f"General Public License as published by the Free Software Foundation, either version {version} of the License, "
            f"or (at your option) any later version. This {subject} is distributed in the hope that it will be useful, but "
            "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
            f"See the GNU {name} General Public License for more details.")


TEMPLATES = {
    "AGPL-3.0": (_gnu("Affero", 3), "GNU Affero General Public License, version 3"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Apache License, Version 2.0, January 2004",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        'required by applicable law or agreed to in writing, software distributed under the License is distributed on an '
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."),
    "BSD-2-Clause": ("Released under the 2-Clause BSD License.", _REDISTRIBUTE + _DISCLAIMER),
    "BSD-3-Clause": ("Released under the 3-Clause BSD License.", _REDISTRIBUTE + _ENDORSE + _DISCLAIMER),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.", "CC0 1.0 Universal Public Domain Dedication"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", _gnu("", 2)),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", _gnu("", 3)),
    "ISC": ("Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
            'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
            "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
            "USE OR PERFORMANCE OF THIS SOFTWARE."),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", _gnu("Lesser", 3, "lesser")),
    "MIT": ("Released under the MIT License.", "The MIT License (MIT)",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software. " + _WARRANTY + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
            "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
            "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:",),
}
_WORD = r"[a-z0-9]+(?:\.[0-9]+)*"


def pairs_of(text: str) -> list[str]:
    """The word bigrams of a normalised text in their order."""
    words = re.findall(_WORD, text.lower())
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def forms(templates: dict[str, tuple[str, ...]] | None = None) -> list[tuple[str, int, list[str]]]:
    """(licence, window length in pairs, sorted pair set) of each template; each licence's SPDX tag is one more."""
    given = TEMPLATES if templates is None else templates
    out = []
    for name, texts in sorted(given.items()):
        for text in (*texts, f"Identifier: {name}"):
            p = pairs_of(text)
            out.append((name, len(p), sorted(set(p))))
    return out


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def scan_licenses(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, min_dice_pct: int = MIN_DICE_PCT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The best licence template of each document, over windows of the whole normalised text.

    A text is normalised to lower-case words of ASCII letters and digits, so line
    breaks and punctuation do not matter. For each template, with pair set B
    and as many pairs as its text has, a window of that many pairs starts
    wherever a run of pairs of B starts in the document; A is the window's
    pair set, and Dice = 2 |A and B| / (|A| + |B|). It can reach the
    threshold t only if |A| lies between |B| t / (2 - t) and
    |B| (2 - t) / t, and if the whole document holds |B| t / (2 - t) pairs of B; other
    templates have no window looked at. The best template of a document has the
    highest Dice, ties by name. No shuffle, SQL functions only.

    Null and empty texts and those of one word: no licence (nulls, 0 windows). Long texts are read
    whole. Rows are judged one by one, so repeated rows and ties repeat the result. Extra
    columns are ignored. No rows: no rows.

    Returns doc_id, license, dice (per cent, rounded down), n_windows (windows
    that reach the threshold, of any template).
    """
    fixed, t = forms(templates), min_dice_pct
    known = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(n).alias("n"), F.array(*[F.lit(x) for x in b]).alias("b"))
                      for name, n, b in fixed])
    every = F.array(*[F.lit(x) for x in sorted({x for _, _, b in fixed for x in b})])

    def dice(a: Column, b: Column) -> Column:
        fits = (F.size(a) * (200 - t) >= F.size(b) * t) & (F.size(a) * t <= F.size(b) * (200 - t))
        value = F.floor(F.lit(200) * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))).cast("int")
        return F.when(fits, value).otherwise(0)

    def of_template(pairs: Column, x: Column) -> Column:
        starts = _let(F.transform(pairs, lambda p: F.array_contains(x["b"], p)), lambda held: F.filter(
            F.transform(held, lambda h, i: F.when(h & ~F.coalesce(F.get(held, i - 1), F.lit(False)), i + 1)),
            lambda s: s.isNotNull()))
        found = F.transform(starts, lambda s: dice(F.array_distinct(F.slice(pairs, s, x["n"])), x["b"]))
        return F.transform(F.filter(found, lambda d: d >= t), lambda d: F.struct((-d).alias("rank"), x["name"].alias("name")))

    def of_pairs(pairs: Column) -> Column:
        # one pass leaves the pairs that any template has; most documents end here
        possible = _let(F.array_intersect(pairs, every), lambda seen: F.filter(
            known, lambda x: (F.size(seen) * (200 - t) >= F.size(x["b"]) * t)
            & (F.size(F.array_intersect(seen, x["b"])) * (200 - t) >= F.size(x["b"]) * t)))
        return F.flatten(F.transform(possible, lambda x: of_template(pairs, x)))

    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(f"({_WORD})"), F.lit(1))
    hits = _let(words, lambda w: F.when(F.size(w) > 1, _let(
        F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda x, y: F.concat(x, F.lit(" "), y)),
        of_pairs)))
    out = docs.select(F.col(id_col).alias("doc_id"), _let(hits, lambda r: F.struct(
        F.array_min(r).alias("top"), F.coalesce(F.size(r), F.lit(0)).cast("long").alias("n"))).alias("r"))
    return out.select("doc_id", F.col("r.top.name").alias("license"), (-F.col("r.top.rank")).alias("dice"),
                      F.greatest(F.col("r.n"), F.lit(0)).cast("long").alias("n_windows"))


def op5_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
