"""License scans: templates with optional and replaceable regions as automata over words.

A template is license wording with markup: ``[[ ... ]]`` may be absent, ``{{a-b}}`` stands for any a
to b words, everything else is mandatory and must match exactly, word by word.  It is compiled into
a set of places with steps between them; reading a text advances all live places at once, so optional
regions cost no backtracking.  A text is read only from where a template's first mandatory words
stand, which a substring search finds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from armlift.llm.common import texts

# Phrases of the base labels, and license wording as published.
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

_TORT = """IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN
AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE."""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: [[1.]] Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. [[2.]] Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY {{1-12}} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL {{1-14}} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND {{1-8}} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {{1-8}} BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions: [[1.]] The origin of this software must not be
misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an
acknowledgment [[(see the following)]] in the product documentation would be appreciated but is not required. [[2.]]
Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
[[3.]] This notice may not be removed or altered from any source distribution."""
_APACHE = """you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 [[Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License.]]"""
_FSF = "as published by the Free Software Foundation[[,]] [[; either]]"

TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice "
            f"[[(including the next paragraph)]] shall be included in all copies or substantial portions of the Software. {_AS_IS} {_TORT}"),
    ("mit", "released under the MIT License"),
    ("isc", "Permission to use, copy, modify, and[[/or]] distribute this software for any purpose with or without fee "
            f"is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_AS_IS}"),
    ("bsd-2", f"{_BSD} {_BSD_AS_IS}"),
    ("bsd-3", f"{_BSD} [[3.]] Neither the name of {{{{1-12}}}} nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission. " + _BSD_AS_IS),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the "
             "{{1-1}} be held liable for any damages arising from the use of this software. " + _ZLIB),
    ("boost-1", "Distributed under the Boost Software License, Version 1.0"),
    ("apache-2", f"Licensed under the Apache License, Version 2.0 [[(the \"License\"); {_APACHE}]]"),
    ("gpl-2", f"under the [[terms of the]] GNU General Public License [[{_FSF}]] version 2"),
    ("gpl-2", "GNU General Public License v2 [[0]] [[only]] [[or later]]"),
    ("gpl-3", f"under the [[terms of the]] GNU General Public License [[{_FSF}]] version 3"),
    ("gpl-3", "GNU General Public License v3 [[0]] [[only]] [[or later]]"),
    ("lgpl-2.1", f"under the [[terms of the]] GNU Lesser General Public License [[{_FSF}]] version 2.1"),
    ("lgpl-2.1", "GNU Lesser General Public License v2.1 [[only]] [[or later]]"),
    ("lgpl-3", f"under the [[terms of the]] GNU Lesser General Public License [[{_FSF}]] version 3"),
    ("lgpl-3", "GNU Lesser General Public License v3 [[0]] [[only]] [[or later]]"),
    ("agpl-3", f"under the [[terms of the]] GNU Affero General Public License [[{_FSF}]] version 3"),
    ("agpl-3", "GNU Affero General Public License v3 [[0]] [[only]] [[or later]]"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. [[If a copy of the MPL was not "
              "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.]]"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                  "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                  "purpose, commercial or non-commercial, and by any means."),
    ("cc0", "[[This work is]] dedicated to the public domain under CC0 [[1.0]]"),
    ("cc0", "[[Creative Commons]] CC0 {{0-2}} Universal"),
    ("cc-by", "licensed under [[a]] Creative Commons Attribution {{0-2}} International License"),
    ("cc-by-sa", "licensed under [[a]] Creative Commons Attribution ShareAlike {{0-2}} International License"),
    ("cc-by-nc", "licensed under [[a]] Creative Commons Attribution NonCommercial {{0-2}} International License"),
    ("cc-by-nc-sa", "licensed under [[a]] Creative Commons Attribution NonCommercial ShareAlike {{0-2}} International License"),
    ("cc-by-nd", "licensed under [[a]] Creative Commons Attribution NoDerivatives {{0-2}} International License"),
    ("cc-by-nc-nd", "licensed under [[a]] Creative Commons Attribution NonCommercial NoDerivatives {{0-2}} International License"),
    ("cc-by-nc", "licensed under CC BY-NC"),
)

_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_MARKUP = re.compile(r"\[\[|\]\]|\{\{(\d+)-(\d+)\}\}")


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.lower().translate(_WORDS).split()


class Automaton(NamedTuple):
    """Place 0 starts.  ``steps[place]``: (word or None for any, mandatory, next); ``skips``: free moves."""

    label: str
    anchor: bytes
    mandatory: int
    steps: tuple[tuple[tuple[bytes | None, bool, int], ...], ...]
    skips: tuple[tuple[int, ...], ...]

    def closed(self, live: dict[int, int]) -> dict[int, int]:
        """Live places with those reached by free moves; each with the mandatory words it has read."""
        todo = list(live)
        while todo:
            at = todo.pop()
            for to in self.skips[at]:
                if live.get(to, -1) < live[at]:
                    live[to] = live[at]
                    todo.append(to)
        return live

    def read(self, words: list[bytes]) -> tuple[bool, float]:
        """Whether a beginning of ``words`` is accepted, and the largest share of mandatory words read."""
        final, best = len(self.steps) - 1, 0
        live = self.closed({0: 0})
        for word in words:
            ahead: dict[int, int] = {}
            for at, read in live.items():
                for want, counts, to in self.steps[at]:
                    if want is None or want == word:
                        ahead[to] = max(ahead.get(to, 0), read + counts)
            if not ahead:
                break
            live = self.closed(ahead)
            best = max(best, *live.values())
            if final in live:
                return True, 1.0
        return False, best / self.mandatory


def compile_template(label: str, template: str) -> Automaton:
    """The automaton of a template, whose anchor is the first run of at most five mandatory words."""
    steps: list[list] = [[]]
    skips: list[list[int]] = [[]]
    opened: list[int] = []
    anchor: list[bytes] = []
    closed, at, mandatory = False, 0, 0

    def place() -> int:
        steps.append([])
        skips.append([])
        return len(steps) - 1

    pieces, end = [], 0
    for found in _MARKUP.finditer(template):
        pieces += [template[end : found.start()], found]
        end = found.end()
    for piece in [*pieces, template[end:]]:
        if isinstance(piece, str):
            for word in words_of(piece.encode()):
                to = place()
                steps[at].append((word, not opened, to))
                at = to
                if not opened:
                    mandatory += 1
                    if not closed and len(anchor) < 5:
                        anchor.append(word)
            continue
        closed |= bool(anchor)
        if piece[0] == "[[":
            opened.append(at)
            inner = place()
            skips[at].append(inner)
            at = inner
        elif piece[0] == "]]":
            to = place()
            skips[at].append(to)
            skips[opened.pop()].append(to)
            at = to
        else:
            least, most = int(piece[1]), int(piece[2])
            exits = []
            for k in range(most):
                if k >= least:
                    exits.append(at)
                to = place()
                steps[at].append((None, False, to))
                at = to
            for one in exits:
                skips[one].append(at)
    if opened or not anchor:
        raise ValueError(f"template of {label}: open region or no mandatory word")
    return Automaton(label, b" ".join(anchor), mandatory, tuple(map(tuple, steps)), tuple(map(tuple, skips)))


def _places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Word numbers where ``phrase`` stands in words joined, led and followed by one space."""
    wanted, at, counted, number = b" " + phrase + b" ", -1, 0, 0
    while (at := joined.find(wanted, at + 1)) >= 0:
        number += joined.count(b" ", counted, at)
        counted = at
        yield number


def scan_text(text: bytes, automata: list[Automaton]) -> tuple:
    """(n_words, n_base, first_word, last_word, base labels, all labels, score) of a text."""
    found = words_of(text)
    joined = b" " + b" ".join(found) + b" "
    starts, base = [], set()
    for label, phrase in PHRASES.items():
        places = list(_places(joined, phrase.encode()))
        starts += places
        base.update([label] if places else [])
    labels, score = set(base), float(bool(base))
    for automaton in automata:
        for begin in _places(joined, automaton.anchor):
            accepted, share = automaton.read(found[begin : begin + len(automaton.steps)])
            score = max(score, share)
            if accepted:
                labels.add(automaton.label)
                break
    listed = (",".join(sorted(x)) for x in (base, labels))
    return len(found), len(starts), min(starts, default=None), max(starts, default=None), *listed, score


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """License labels of every row of ``docs``.

    ``n_base``, ``first_word`` and ``last_word`` are the places of the base phrases.  ``labels`` adds
    the label of every template some place of the text is accepted by; optional regions that open a
    template need not be there.  ``score`` is 1 for a base phrase or an accepted template, else the
    largest share of a template's mandatory words read from its anchor on.  A NULL or empty text has
    no words, no labels and score 0; NULL ids and equal rows are returned as they are, an empty table
    gives none, and further columns are ignored.
    """
    automata = [compile_template(*t) for t in templates]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [
                (doc_id.as_py(), *scan_text(text.as_py(), automata))
                for doc_id, text in zip(part.column(0), part.column(1))
            ]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    rows = texts(docs).select("_id", F.col("_text").cast("binary").alias("_text"))
    return rows.mapInArrow(each, SCHEMA)
