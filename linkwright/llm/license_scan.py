"""Licence templates found in texts by word bigrams (operator 2)."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import only, table

#: Public licence texts and the notices that refer to them.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES
OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
under the License.""",
    "mit-notice": "Released under the MIT License.",
    "mit-notice-licensed": "Licensed under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a
copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.""",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-3-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright
holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior
written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "apache-2.0-grant": """Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants
to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative
Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.
3. Grant of Patent License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual,
worldwide, non-exclusive, no-charge, royalty-free, irrevocable (except as stated in this section) patent license to make, have made,
use, offer to sell, sell, import, and otherwise transfer the Work, where such license applies only to those patent claims licensable by
such Contributor that are necessarily infringed by their Contribution(s) alone or by combination of their Contribution(s) with the Work
to which such Contribution(s) was submitted.""",
    "gpl-3.0-preamble": """The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses
for most software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU
General Public License is intended to guarantee your freedom to share and change all versions of a program--to make sure it remains free
software for all its users.""",
    "gpl-2.0-preamble": """The licenses for most software are designed to take away your freedom to share and change it. By contrast, the
GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for
all its users. This General Public License applies to most of the Free Software Foundation's software and to any other program whose
authors commit to using it.""",
    "gpl-2.0-header": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This
program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy
of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth
Floor, Boston, MA 02110-1301, USA.""",
    "lgpl-2.1-header": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.
This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received
a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin
Street, Fifth Floor, Boston, MA 02110-1301 USA""",
    "agpl-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received
a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/.""",
    "mpl-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this
software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an
acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked
as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source
distribution.""",
    "bsl-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the
Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all
subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this
restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works
of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source
language processor.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and
all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and
future rights to this software under copyright law.""",
    "bsd-3-clause-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "unlicense-notice": "This is free and unencumbered software released into the public domain.",
}
MIN_DICE = 0.8
#: A token: letters and digits, with single dots or hyphens inside.  A-Z are lower-cased.
TOKEN = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def tokens(text: str) -> list[str]:
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes.lower() maps A-Z only
    return ["license" if t == "licence" else t for t in TOKEN.findall(lowered)]


def bigrams(toks: list[str]) -> set[tuple[str, str]]:
    return set(zip(toks, toks[1:], strict=False))


#: Windows have so many tokens as parts of a template's own number.
PARTS = ((4, 5), (1, 1), (5, 4))


class Templates:
    """Templates as sets of word bigrams, and the windows of a text that are like them."""

    def __init__(self, texts: dict[str, str], least: float):
        self.least, self.names = least, sorted(texts)
        toks = {t: tokens(texts[t]) for t in self.names}
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for ws in toks.values() for w in ws}))}
        self.base = len(self.vocabulary) + 1
        sets = [np.unique(self.pairs(self.numbered(toks[t]))) for t in self.names]
        self.sizes = np.array([len(x) for x in sets], np.int64)
        self.spans = [sorted({max(2, len(toks[t]) * a // b) for a, b in PARTS}) for t in self.names]
        self.keys = np.unique(np.concatenate([np.empty(0, np.int64), *sets]))
        self.has = np.column_stack([np.isin(self.keys, x) for x in sets]) if sets else np.zeros((0, 0), bool)
        # 2 * common / (a + b) >= least and common <= a bound the common bigrams from below by b
        self.fewest = least / (2 - least) * self.sizes - 1e-9

    def numbered(self, toks: list[str]) -> np.ndarray:
        """Each word's number; 0 for words of no template."""
        get = self.vocabulary.get
        return np.fromiter([get(t, 0) for t in toks], np.int64, len(toks))

    def pairs(self, numbers: np.ndarray) -> np.ndarray:
        """Each bigram's number; less than ``base`` or a multiple of it if a word is of no template."""
        return numbers[:-1] * self.base + numbers[1:]

    def matches(self, text: str) -> list[tuple[float, int, str, int, int]]:
        """(Dice, template's size, template, first token, tokens) of the best window of every template that has one.

        A template is tried only where so many of its bigrams are in the text as any
        window needs.  Ties go to the earliest, then the shortest window.
        """
        toks = tokens(text)
        if len(toks) < 2:
            return []
        found = self.pairs(self.numbered(toks))
        at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        known = self.keys[at] == found
        if not known.any():
            return []
        tried = np.flatnonzero(self.has[np.unique(at[known])].sum(axis=0) >= self.fewest)
        if not len(tried):
            return []
        order = {w: i for i, w in enumerate(set(toks))}
        own = np.fromiter(map(order.__getitem__, toks), np.int64, len(toks))
        before = earlier(own[:-1] * len(order) + own[1:])
        out = []
        for t in tried:
            of_template = known & self.has[at, t]
            best = None
            for span in self.spans[t]:
                span = min(span, len(toks))
                dice = 2 * unlike(before, of_template, span - 1) / (unlike(before, None, span - 1) + self.sizes[t])
                first = int(np.argmax(dice))
                here = (-float(dice[first]), first, span)
                best = here if best is None else min(best, here)
            if -best[0] >= self.least:
                out.append((-best[0], int(self.sizes[t]), self.names[t], best[1], best[2]))
        return out


def earlier(values: np.ndarray) -> np.ndarray:
    """Where each value last stood before, -1 if it didn't."""
    order = np.argsort(values, kind="stable")
    out = np.full(len(values), -1, np.int64)
    same = values[order[1:]] == values[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def unlike(before: np.ndarray, only: np.ndarray | None, span: int) -> np.ndarray:
    """How many unlike values (of those in ``only``) each window of ``span`` places holds.

    A value counts once in a window: at its first place in it, so for the windows that
    begin after its place before.
    """
    n = len(before)
    at = np.arange(n) if only is None else np.flatnonzero(only)
    first, last = np.maximum(before[at] + 1, at - span + 1), np.minimum(at, n - span)
    first, last = first[keep := np.maximum(first, 0) <= last], last[keep]
    change = np.bincount(np.maximum(first, 0), minlength=n + 2) - np.bincount(last + 1, minlength=n + 2)
    return np.cumsum(change)[: n - span + 1]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, min_dice: float = MIN_DICE) -> DataFrame:
    """One row per document: the licence it matches best, and all that it matches.

    The text becomes normalised words.  Every window of as many words as a template
    has, of four fifths and of five fourths of that (the whole text if it has fewer),
    is compared with the template by the Dice coefficient over the sets of word
    bigrams.  Set sizes bound the bigrams that a window must share, so a template is
    tried on the few texts only that hold so many of its bigrams; no match is lost by
    it.  ``license`` is the template of highest ``dice`` (ties: the larger, then the
    first by name), ``first_token`` and ``n_tokens`` where its best window stands
    (ties: the earliest, then the shortest), ``licenses`` all matched ones by name.

    Null, blank and unmatched texts have a null licence and an empty list; texts of any
    length are scanned whole, in time linear in their words; repeated rows are judged
    alike; an empty table gives no rows; extra columns are ignored.
    """
    made = Templates(TEMPLATES if templates is None else templates, min_dice)

    def scanned(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                hits = made.matches(text or "")
                d, _, t, i, n = min(hits, key=lambda h: (-h[0], -h[1], h[2]), default=(None, None, None, None, None))
                rows.append((t, d, i, n, sorted(h[2] for h in hits)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                ["doc_id", "license", "dice", "first_token", "n_tokens", "licenses"],
            )

    docs = only(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(scanned, f"doc_id {kind}, license string, dice double, first_token int, n_tokens int, licenses array<string>")


def op2_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents"))
    return out.withColumn("licenses", F.array_join("licenses", ","))


def _tokens_sql(text: str) -> str:
    lowered = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"list_transform(regexp_extract_all({lowered}, '[a-z0-9]+(?:[.-][a-z0-9]+)*'), lambda t: CASE t WHEN 'licence' THEN 'license' ELSE t END)"


_PAIRS = "list_transform(range(1, len(ts)), lambda i: ts[i] || ' ' || ts[i + 1])"
_VALUES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
OP2_SQL = f"""
WITH templates AS (
  SELECT name, list_distinct(bs) AS bs, len(list_distinct(bs)) AS size, m
  FROM (SELECT name, {_PAIRS} AS bs, len(ts) AS m FROM (SELECT name, {_tokens_sql("body")} AS ts FROM (VALUES {_VALUES}) v(name, body)))),
texts AS (SELECT doc_id, {_PAIRS} AS bs, len(ts) AS n FROM (SELECT doc_id, {_tokens_sql("coalesce(text, '')")} AS ts FROM documents) WHERE len(ts) > 1),
tried AS (
  SELECT doc_id, name FROM (SELECT doc_id, unnest(list_distinct(bs)) AS b FROM texts) JOIN (SELECT name, size, unnest(bs) AS b FROM templates) USING (b)
  GROUP BY doc_id, name HAVING count(*) >= {MIN_DICE} / (2 - {MIN_DICE}) * any_value(size) - 1e-9),
spans AS (SELECT DISTINCT name, greatest(2, {{}}) AS span FROM templates),
windows AS (
  SELECT doc_id, name, first, tokens, list_distinct(x.bs[first + 1 : first + tokens - 1]) AS got, t.bs, size
  FROM (SELECT doc_id, name, least(span, n) AS tokens, unnest(range(0, n - least(span, n) + 1)) AS first, texts.bs FROM tried JOIN texts USING (doc_id) JOIN spans USING (name)) x
  JOIN templates t USING (name)),
hits AS (
  SELECT doc_id, name, size, first, tokens, 2 * len(list_intersect(got, bs)) / (len(got) + size) AS dice FROM windows WHERE dice >= {MIN_DICE}),
best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, size DESC, name, first, tokens) = 1),
named AS (SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM hits GROUP BY doc_id)
SELECT doc_id, name AS license, dice, first::INT AS first_token, tokens::INT AS n_tokens, coalesce(names, '') AS licenses
FROM documents LEFT JOIN best USING (doc_id) LEFT JOIN named USING (doc_id)
""".replace("{}", "unnest([" + ", ".join(f"m * {a} // {b}" for a, b in PARTS) + "])")
