"""Licence scan: Dice coefficient over word bigrams against licence templates.

A text is normalised to its lower-case runs of ASCII letters and digits, line
ends included, so a notice is found in the middle of a line or across lines.  A
window of words matches a template when ``2 |x & y| / (|x| + |y|)`` of their
bags of bigrams reaches ``least``.  A matching window then has ``|y| * least /
(2 - least)`` to ``|y| * (2 - least) / least`` bigrams and shares at least the
smaller number with the template.  So every match holds one of the template's
*anchors*, its least common bigrams that together are one more than a match may
lack; a text without them is compared with no template, and other windows start
and end at bigrams of the template, within those sizes.  All of it is built-in
expressions within one row: no shuffle, no Python on the executors.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The public wording of licences and of the notices that name them.
_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
          "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. ")
_BSD_HEAD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
             "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
             "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
             "documentation and/or other materials provided with the distribution. ")
_BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission. ")
_BSD_TAIL = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
             "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
             "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
             "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
             "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
             "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
             "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
             "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as "
        "published by the Free Software Foundation, either version {1} of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more "
        "details.")

#: Licence texts and notices by which works name their licence, by SPDX-like identifier.
TEMPLATES: Mapping[str, Sequence[str]] = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.",
                 _GNU.format("Affero General Public License", 3)],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Released under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0",
                   'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", _BSD_HEAD + _BSD_TAIL],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL,
                     "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met:"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "This work is dedicated to the public domain."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                _GNU.format("General Public License", 2)],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "SPDX-License-Identifier: GPL-3.0-or-later", _GNU.format("General Public License", 3)],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
            'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
            "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
            "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
            "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.",
                 _GNU.format("Lesser General Public License", 3)],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
            'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
            'associated documentation files (the "Software"), to deal in the Software without restriction, including '
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software. " + _AS_IS +
            "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
            "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
            "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
             "use this software for any purpose, including commercial applications, and to alter it and redistribute "
             "it freely, subject to the following restrictions: 1. The origin of this software must not be "
             "misrepresented; you must not claim that you wrote the original software. If you use this software in a "
             "product, an acknowledgment in the product documentation would be appreciated but is not required. 2. "
             "Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
             "original software. 3. This notice may not be removed or altered from any source distribution."],
    "reserved": ["All rights reserved."],
}

#: Words that make a bigram a poor anchor.
_COMMON = set("a all an and any are as at be by can for from if in is it may no not of on or that the this to use was "
              "which will with you".split())


class Template(NamedTuple):
    name: str
    grams: list[str]    # distinct bigrams
    times: list[int]    # how often each occurs
    anchors: list[str]  # one of them is in every match
    size: int           # bigrams, repeats included
    least: int          # fewest bigrams of a matching window, and fewest shared ones
    most: int           # most bigrams of a matching window


def compiled(templates: Mapping[str, Sequence[str]], least: float) -> list[Template]:
    out = []
    for name, texts in sorted(templates.items()):
        for text in texts:
            w = [x.lower() for x in re.findall("[A-Za-z0-9]+", text)]
            bag = Counter(f"{a} {b}" for a, b in zip(w, w[1:]))
            size = sum(bag.values())
            if not size:
                continue
            lo = math.ceil(size * least / (2 - least) - 1e-9)
            anchors, held = [], 0
            for gram in sorted(bag, key=lambda g: (len(_COMMON & set(g.split())), -len(g), g)):
                if held > size - lo:
                    break
                anchors.append(gram)
                held += bag[gram]
            out.append(Template(name, list(bag), list(bag.values()), anchors, size, lo,
                                math.floor(size * (2 - least) / least + 1e-9)))
    return out


def _best_window(g: Column, t: Column, least: float) -> Column:
    """The best window of the bigrams ``g`` that matches template ``t``:
    struct(less, start, n, shared), ``less`` the negative coefficient (0: none).

    A bigram counts in a window unless as many equal ones as the template holds
    lie between the window's start and it; ``prior`` is the place of the first
    of these, so one pass per start scores all its windows.
    """
    at = F.filter(F.sequence(F.lit(1), F.size(g)), lambda p: F.array_contains(t["grams"], F.get(g, p - 1)))

    def with_prior(at: Column) -> Column:
        def prior(x: Column) -> Column:
            gram = F.get(g, F.get(at, x - 1) - 1)
            back = F.least(x - 1, t["most"])
            same = F.filter(F.slice(at, x - back, back), lambda p: F.get(g, p - 1) == gram)
            times = F.get(t["times"], (F.array_position(t["grams"], gram) - 1).cast("int"))
            return F.coalesce(F.get(same, F.size(same) - times), F.lit(0))

        return F.transform(at, lambda p, x: F.struct(p.alias("p"), prior(x + 1).alias("prior")))

    def best(k: Column) -> Column:
        starts = F.when(F.size(k) >= t["least"], F.filter(
            F.sequence(F.lit(1), F.size(k) - t["least"] + 1),
            lambda i: F.get(k, i + t["least"] - 2)["p"] - F.get(k, i - 1)["p"] < t["most"]))

        def from_start(i: Column) -> Column:
            start = F.get(k, i - 1)["p"]

            def step(acc: Column, e: Column) -> Column:
                shared, n = acc["shared"] + (e["prior"] < start).cast("int"), e["p"] - start + 1
                less = F.lit(-2.0) * shared / (n + t["size"])
                return F.struct(shared.alias("shared"), F.least(acc["best"], F.when(
                    n.between(t["least"], t["most"]) & (less <= -least),
                    F.struct(less.alias("less"), start.alias("start"), n.alias("n"), shared.alias("shared")))).alias("best"))

            none = F.struct(F.lit(0.0).alias("less"), F.lit(0).alias("start"), F.lit(0).alias("n"), F.lit(0).alias("shared"))
            return F.aggregate(F.slice(k, i, t["most"]), F.struct(F.lit(0).alias("shared"), none.alias("best")),
                               step, lambda acc: acc["best"])

        return F.array_min(F.transform(starts, from_start))

    # Arrays of one, so that places and priors are worked out once
    return F.transform(F.transform(F.array(at), with_prior), best)[0]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: Mapping[str, Sequence[str]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: id and ``found``, the licences of the text in
    text order: ``license``, ``start`` (its first word, from 0), ``n_words``,
    ``shared`` (bigrams shared with the template) and ``dice``.

    A template's window is the one of the highest coefficient, then the first,
    then the shortest.  Of windows that overlap and of windows of one licence
    the one that shares most bigrams stays (then the higher coefficient, the
    earlier, the shorter, the smaller name), so each licence is named once, where
    the text is closest to it.  Null and empty texts hold none; null ids and
    repeated rows are kept; other columns are ignored; an empty table gives an
    empty result; templates of one word match nothing.
    """
    known = compiled(templates, least)
    texts = F.from_json(F.lit(json.dumps([t._asdict() | {"distinct": t.least - t.size + len(t.grams)} for t in known])),
                        "array<struct<name: string, grams: array<string>, times: array<int>, anchors: array<string>, "
                        "size: int, least: int, most: int, distinct: int>>")
    anchors = F.from_json(F.lit(json.dumps(sorted({a for t in known for a in t.anchors}))), "array<string>")

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = docs.select(F.col(id_col).alias("id"), F.transform(
        F.regexp_extract_all(text, F.lit("[A-Za-z0-9]+"), F.lit(0)), lambda w: F.lower(w)).alias("w"))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    grams = words.select("id", F.zip_with(F.slice("w", 1, n), F.slice("w", 2, n),
                                          lambda a, b: F.concat(a, F.lit(" "), b)).alias("g"))
    held = grams.select("id", "g", F.array_intersect("g", anchors).alias("held"))
    near = held.select("id", "g", F.when(F.size("held") > 0, F.filter(
        texts, lambda t: F.arrays_overlap(t["anchors"], F.col("held"))
        & (F.size(F.array_intersect(F.col("g"), t["grams"])) >= t["distinct"]))).alias("near"))
    best = near.select("id", F.transform("near", lambda t: F.struct(
        _best_window(F.col("g"), t, least).alias("m"), t["name"].alias("name"))).alias("best"))
    best = best.select("id", F.array_distinct(F.transform(
        F.filter("best", lambda b: b["m"]["n"] > 0), lambda b: F.struct(
            (-b["m"]["shared"]).alias("less_shared"), b["m"]["less"].alias("less"), b["m"]["start"].alias("start"),
            b["m"]["n"].alias("n"), b["name"].alias("name")))).alias("hits"))

    def beaten(x: Column) -> Column:
        return F.exists("hits", lambda y: (y < x) & (
            (y["name"] == x["name"]) | ((y["start"] <= x["start"] + x["n"]) & (x["start"] <= y["start"] + y["n"]))))

    found = F.array_sort(F.transform(F.filter("hits", lambda x: ~beaten(x)), lambda x: F.struct(
        (x["start"] - 1).alias("start"), (x["n"] + 1).alias("n_words"), x["name"].alias("license"),
        (-x["less_shared"]).alias("shared"), (-x["less"]).alias("dice"))))
    return best.select(F.col("id").alias(id_col), F.coalesce(found, F.array().cast(
        "array<struct<start: int, n_words: int, license: string, shared: int, dice: double>>")).alias("found"))


def summary(found: Column) -> list[Column]:
    """``n_licenses``, ``licenses`` (``name:start:n_words`` joined by commas) and the highest ``dice`` (null if none)."""
    each = F.transform(found, lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["n_words"].cast("string")))
    return [F.size(found).cast("bigint").alias("n_licenses"), F.array_join(each, ",").alias("licenses"),
            F.array_max(F.transform(found, lambda x: x["dice"])).alias("dice")]


def scan_sql(templates: Mapping[str, Sequence[str]] = TEMPLATES, least: float = 0.8) -> str:
    """The summary of the same scan of ``documents(doc_id, text)`` in DuckDB SQL."""
    known = compiled(templates, least)
    sizes = ", ".join(f"({i}, '{t.name}', {t.size}, {t.least}, {t.most})" for i, t in enumerate(known))
    grams = ", ".join(f"({i}, '{g}', {c})" for i, t in enumerate(known) for g, c in zip(t.grams, t.times))
    return f"""
WITH known(t, name, size, lo, hi) AS (VALUES {sizes}),
bag(t, gram, times) AS (VALUES {grams}),
rows AS MATERIALIZED (
  SELECT row_number() OVER () AS u, doc_id,
         list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+'), lambda x: lower(x)) AS w FROM documents),
places AS (SELECT u, w, unnest(range(1, len(w))) AS p FROM rows),
hits AS (SELECT u, t, p, gram, times FROM (SELECT u, p, w[p] || ' ' || w[p + 1] AS gram FROM places) JOIN bag USING (gram)),
enough AS (SELECT u, t FROM hits JOIN known USING (t) GROUP BY u, t, lo HAVING count(*) >= lo),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY u, t ORDER BY p) AS i FROM hits SEMI JOIN enough USING (u, t)),
windows AS (
  SELECT a.u, a.t, a.p AS s, b.p AS e, name, size FROM numbered a JOIN known k ON k.t = a.t
  JOIN numbered b ON b.u = a.u AND b.t = a.t AND b.i >= a.i + lo - 1 AND b.p BETWEEN a.p + lo - 1 AND a.p + hi - 1
   AND 2 * (b.i - a.i + 1) >= {least}::DOUBLE * (b.p - a.p + 1 + size)),
shares AS (
  SELECT x.u, x.t, s, e, name, size, least(count(*), any_value(times)) AS c
  FROM windows x JOIN numbered n ON n.u = x.u AND n.t = x.t AND n.p BETWEEN s AND e
  GROUP BY x.u, x.t, s, e, name, size, gram),
scored AS (
  SELECT u, t, name, s, e - s + 1 AS n, sum(c)::BIGINT AS shared, 2.0::DOUBLE * sum(c) / (e - s + 1 + size) AS dice
  FROM shares GROUP BY u, t, name, s, e, size),
best AS (
  SELECT * FROM scored WHERE dice >= {least}::DOUBLE
  QUALIFY row_number() OVER (PARTITION BY u, t ORDER BY dice DESC, s, n) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY shared DESC, dice DESC, s, n, name) AS r FROM best),
kept AS (
  SELECT x.* FROM ranked x ANTI JOIN ranked y
  ON y.u = x.u AND y.r < x.r AND (y.name = x.name OR (y.s <= x.s + x.n AND x.s <= y.s + y.n))),
per_row AS (
  SELECT u, count(*) AS n_licenses, string_agg(name || ':' || (s - 1) || ':' || (n + 1), ',' ORDER BY s, n) AS licenses,
         max(dice) AS dice FROM kept GROUP BY u)
SELECT doc_id, coalesce(n_licenses, 0) AS n_licenses, coalesce(licenses, '') AS licenses, dice
FROM rows LEFT JOIN per_row USING (u)
"""
