"""License scans: patience alignment of texts with license templates."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile("[a-z0-9]+")
# Notices that files carry, and the public texts they stand for.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."),
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details."),
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
}
MATCH = "doc_id long, license string, coverage double, matched long, start_word long, end_word long, start long, end long"


def _increasing(points: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of points, in order of the first value, with rising second values."""
    tops, last, before = [], [], [-1] * len(points)
    for i, (_, y) in enumerate(points):
        at = bisect_left(tops, y)
        before[i] = last[at - 1] if at else -1
        tops[at:at + 1] = [y]
        last[at:at + 1] = [i]
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(points[i])
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matching places of two word lists, rising in both.

    Equal words at either end are matched first. Words that occur once in each are anchors, as many
    as rise in both; the gaps between anchors are aligned in the same way until none is found.
    """
    out, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and in_a.get(w) == 1}
        anchors = _increasing([(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if w in place])
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        gaps += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


class Scanner:
    """Finds stretches of a text that cover a template."""

    def __init__(self, templates: dict[str, str], least: float, max_gap: int):
        self.least, self.max_gap = least, max_gap
        self.templates = {name: WORD.findall(t.lower()) for name, t in templates.items()}
        self.counts = {name: Counter(t) for name, t in self.templates.items()}

    @staticmethod
    def _spans(part: list[str], template: list[str], have: Counter, need: float) -> list[tuple[int, int]]:
        """Places where a match may lie, from each occurrence of the template's rarest words.

        A match lacks fewer words than the places chosen, so it holds one of them at least. Around
        each lie a span of the template's length and one with a quarter of it more on both sides.
        """
        lacking = len(template) - math.ceil(need)
        chosen = sorted(range(len(template)), key=lambda p: have[template[p]])[:lacking + 1]
        at = defaultdict(list)
        for p in chosen:
            at[template[p]].append(p)
        starts = sorted({i - p for i, w in enumerate(part) for p in at.get(w, ())})
        slack, n = len(template) // 4 + 1, len(template)
        spans = {(max(s - x, 0), min(s + n + x, len(part))) for s in starts for x in (0, slack)}
        return sorted(spans)

    def _matches(self, part: list[str], template: list[str], counts: Counter, need: float) -> list[tuple[int, int, int]]:
        """(words, first, last) of the matches in a list of template words, in their order.

        Each span is aligned; the best match comes first, then what does not overlap it. What lies
        between matches is searched again, and aligned as a whole if no span of it matches.
        Parts whose words can't reach the coverage, each counted as often as in both, are passed over.
        """
        out, parts = [], [(0, len(part))]

        def aligned(a, b):
            here = part[a:b]
            if len(here) < need or sum((Counter(here) & counts).values()) < need:
                return None
            pairs = align(here, template)
            return (len(pairs), a + pairs[0][0], a + pairs[-1][0]) if len(pairs) >= need else None

        while parts:
            a, b = parts.pop()
            have = Counter(part[a:b])
            if sum((have & counts).values()) < need:
                continue
            spans = [(a + x, a + y) for x, y in self._spans(part[a:b], template, have, need)]
            found = {m for span in spans if (m := aligned(*span))} or {m for m in [aligned(a, b)] if m}
            taken = []
            for m in sorted(found, key=lambda m: (-m[0], m[2] - m[1], m[1])):
                k = bisect_left(taken, (m[1],))
                if (k == 0 or taken[k - 1][1] < m[1]) and (k == len(taken) or taken[k][0] > m[2]):
                    taken.insert(k, (m[1], m[2]))
                    out.append(m)
            if taken:
                edges = [(None, a - 1), *taken, (b, None)]
                parts += [(x + 1, y) for (_, x), (y, _) in zip(edges, edges[1:], strict=False) if y > x + 1]
        return sorted(out, key=lambda m: m[1])

    def scan(self, text: str) -> list[tuple]:
        """(license, coverage, matched, start_word, end_word, start, end), ends exclusive.

        Places of a template's words that stand no more than ``max_gap`` words apart form a stretch,
        in which every match counts (``_matches``). Offsets are in code points of the text, words in its words.
        """
        lower = text.lower()
        if len(lower) != len(text):  # a letter whose lower case is longer would shift the offsets
            lower = "".join(x if len(x := c.lower()) == 1 else c for c in text)
        found = WORD.findall(lower)
        present, spots, out = set(found), None, []
        for name, template in self.templates.items():
            counts, need = self.counts[name], self.least * len(template)
            if sum(n for w, n in counts.items() if w in present) < need:
                continue
            stretch = []
            places = [i for i, w in enumerate(found) if w in counts]
            for i, after in zip(places, [*places[1:], None], strict=True):
                stretch.append(i)
                if after is not None and after - i <= self.max_gap:
                    continue
                here, stretch = stretch, []
                for n, first, last in self._matches([found[i] for i in here], template, counts, need):
                    spots = spots or [m.span() for m in WORD.finditer(lower)]
                    first, last = here[first], here[last]
                    out.append((name, n / len(template), n, first, last + 1, spots[first][0], spots[last][1]))
        return out


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, max_gap: int = 8, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per part of a text that covers at least ``least`` of a template: doc_id, license,
    coverage (aligned words / words of the template), matched, start_word, end_word, start, end.

    A null or empty text has no match. Repeated rows give their matches each; rows without
    doc_id keep a null. An empty table, or no template, gives no rows.
    """
    scanner = Scanner(TEMPLATES if templates is None else templates, least, max_gap)
    schema = pa.schema([(n, {"long": pa.int64(), "double": pa.float64()}.get(t, pa.string())) for n, t in (x.split() for x in MATCH.split(", "))])

    def run(batches):
        for batch in batches:
            rows = [(name, *m) for name, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in scanner.scan(t.as_py() or "")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, MATCH)


def op3_query(spark, sf_dir: str) -> DataFrame:
    """License stretches of all documents."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
