"""License scans by conditional compression.

Candidate blocks are the stretches around words that the templates themselves
name (of every run of words that a fitting place must keep, one).  A block's
windows are compressed alone and with each template as a raw zstandard
dictionary, under the same parameters, and the bytes a template saves rank the
templates.  Down that list, templates that save at least ``LEAST_SAVED`` are
aligned with the words around the window and confirmed by their exact wording
differences: none for a short notice, a tenth of the words for a long one, but no
word that tells licenses apart.  Each confirmed place is compressed once more on
its own; where places overlap, the template that saves most bytes wins.

Nothing that fits is lost by the bound: a window is as long as a short notice, or
a run that a long notice must keep, and the step to the next one, so one window
holds it whole, and such a window saves more than the bound (tests measure it).

Defined results: null and empty texts have no licenses; case, punctuation and
white space between words do not count as differences; of templates that save the
same on overlapping places the one with the fewest differences wins, then the
first by name, then the first place; repeated rows are scanned each; ids are
passed through.  Spans are byte ranges of the UTF-8 text, end exclusive.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.textops import LOWER_ASCII, text_chunks

def gnu(subject: str, name: str, version: str) -> str:
    return (f"This {subject} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published "
            f"by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.")


def gnu_only(subject: str, name: str, version: str) -> list[str]:
    start = f"This {subject} is free software; you can redistribute it and/or modify it under the terms of the GNU {name}"
    return [f"{start} as published by the Free Software Foundation; version {version} of the License.",
            f"{start} version {version} as published by the Free Software Foundation."]


BSD_1 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
         "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
         "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
         "disclaimer in the documentation and/or other materials provided with the distribution.")
BSD_AD = ("All advertising materials mentioning features or use of this software must display the following acknowledgement: "
          "This product includes software developed by the copyright holder.")
BSD_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
             "this software without specific prior written permission.")
LESSER = "Lesser General Public License"
BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
           "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
           "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
           "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
           "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
           "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
ISC_1 = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
         "the above copyright notice and this permission notice appear in all copies.")
ISC_END = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
           "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
           "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
           "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
MIT_1 = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
         "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
         "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
         "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
         "substantial portions of the Software.")
UNLICENSE_1 = ("Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
               "compiled binary, for any purpose, commercial or non-commercial, and by any means.")
AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
         "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
         "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
         "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")

# Notices and, of the short licenses, whole texts as their licenses word them.
TEMPLATES = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.",
                 gnu("program", "Affero General Public License", "3"), *gnu_only("program", "Affero General Public License", "3")],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", BSD_1, f"{BSD_1} {BSD_END}"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license.",
                     f"{BSD_1} 3. {BSD_NAMES}", f"{BSD_1} 3. {BSD_NAMES} {BSD_END}"],
    "BSD-4-Clause": [f"{BSD_1} 3. {BSD_AD} 4. {BSD_NAMES}"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
                "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring "
                "rights to this work."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                gnu("program", "General Public License", "2"), *gnu_only("program", "General Public License", "2")],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                gnu("program", "General Public License", "3"), *gnu_only("program", "General Public License", "3")],
    "ISC": [ISC_1, f"{ISC_1} {ISC_END}"],
    "LGPL-2.0": [gnu("library", "Library General Public License", "2"), *gnu_only("library", "Library General Public License", "2")],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1.", gnu("library", LESSER, "2.1"), *gnu_only("library", LESSER, "2.1")],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", gnu("library", LESSER, "3"), *gnu_only("library", LESSER, "3")],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", MIT_1, f"{MIT_1} {AS_IS}"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  UNLICENSE_1,
                  f"This is free and unencumbered software released into the public domain. {UNLICENSE_1} In jurisdictions that recognize copyright laws, "
                  "the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this "
                  "dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be "
                  "an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
                  f"{AS_IS.replace('AUTHORS OR COPYRIGHT HOLDERS', 'AUTHORS')}"],
}
for _name, _notices in TEMPLATES.items():
    _notices += [f"SPDX-License-Identifier: {_name}{end}" for end in (("", "-only", "-or-later") if "GPL" in _name else ("",))]
#: The licenses of an SPDX line: names joined by operators.
SPDX = re.compile(rb"spdx-license-identifier:([( \t]*[a-z0-9.+-]+[) \t]*(?:(?<=[) \t])(?:and|or|with)[( \t]+[a-z0-9.+-]+[) \t]*)*)")
#: Words from the start of a window to the next one's.
STEP = 32
#: Windows of a template that are aligned together, in words.
PIECE = 256
#: Bytes that a template must save on a window to be aligned, and words up to which a template must
#: match exactly.  A window that holds a short notice or a kept run whole saves more (see the tests).
LEAST_SAVED, SHORT = 2, 25
#: Share of the words of a longer template that may differ.
MAY_DIFFER = 0.1
LEVEL = 16
#: Words that tell licenses apart, which never may differ (see ``telling``).
TELLING = re.compile(rb"(?:.*-)?(?:affero|lesser|nc|sa|nd|noncommercial|sharealike|noderivatives|noderivs|endorse|advertising)(?:-.*)?|v?\d+(?:\.\d+)+|v\d+")
#: Clauses that follow a notice in a license of another name: words that do not stand within so many words after it.
FURTHER, FURTHER_WORDS = {"BSD-2-Clause": {b"endorse", b"advertising"}}, 80
WORD = re.compile(rb"[a-z0-9]+(?:[.+-][a-z0-9]+)*")


@dataclass(frozen=True)
class Template:
    license: str
    text: bytes
    words: tuple[bytes, ...]

    @property
    def may_differ(self) -> int:
        return 0 if len(self.words) <= SHORT else int(MAY_DIFFER * len(self.words))

    @cached_property
    def runs(self) -> list[tuple[bytes, ...]]:
        """Runs of words of which every place that fits keeps one: one more than words may differ."""
        n, parts = len(self.words), self.may_differ + 1
        return [self.words[n * i // parts:n * (i + 1) // parts] for i in range(parts)]


def templates(texts: dict[str, list[str]]) -> list[Template]:
    out = []
    for name, notices in sorted(texts.items()):
        for notice in notices:
            words = tuple(WORD.findall(notice.lower().encode()))
            if words:
                out.append(Template(name, b" ".join(words), words))
    return out


def cue_words(known: list[Template]) -> list[bytes]:
    """Words of which every run of every template has one: again and again the word of most weight
    in the runs left.  Long words, which are rare in other texts, weigh more (letters squared)."""
    left = [set(run) for t in known for run in t.runs]
    cues = []
    while left:
        weight: dict[bytes, int] = {}
        for run in left:
            for word in run:
                weight[word] = weight.get(word, 0) + len(word) ** 2
        cue = max(sorted(weight), key=weight.get)
        cues.append(cue)
        left = [run for run in left if cue not in run]
    return cues


def reach(low: bytes, a: int, b: int, start: int, end: int, n: int) -> tuple[int, int]:
    """The stretch a..b of a row (start..end) and at least ``n`` words (or all) on each side of it."""
    size = 8 * n
    while a - size > start and sum(1 for _ in WORD.finditer(low, a - size, a)) < n:
        size *= 2
    first, size = max(start, a - size), 8 * n
    while b + size < end and sum(1 for _ in WORD.finditer(low, b, b + size)) < n:
        size *= 2
    return first, min(end, b + size)


def blocks(low: bytes, offsets: np.ndarray, cues: list[bytes], n: int) -> list[tuple[int, int, int]]:
    """(row, start, end) of the merged stretches of ``n`` words around cues, within their rows."""
    at = []
    for cue in cues:
        place = low.find(cue)
        while place >= 0:
            at.append((place, place + len(cue)))
            place = low.find(cue, place + 1)
    near: list[tuple[int, int, int]] = []
    for start, end in sorted(at):
        row = int(np.searchsorted(offsets, start, side="right")) - 1
        if end > offsets[row + 1]:
            continue
        if near and near[-1][0] == row and start <= near[-1][2] + 8 * n:
            near[-1] = (row, near[-1][1], max(end, near[-1][2]))
        else:
            near.append((row, start, end))
    out: list[tuple[int, int, int]] = []
    for row, start, end in near:
        a, b = reach(low, start, end, int(offsets[row]), int(offsets[row + 1]), n)
        if out and out[-1][0] == row and a <= out[-1][2]:
            out[-1] = (row, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((row, a, b))
    return out


def telling(words, first: int, end: int) -> list[bytes]:
    """Of some words those that tell licenses apart, versions and the name of the Library GPL by the words beside them."""
    def tells(i: int) -> bool:
        word, last = words[i], words[i - 1] if i else b""
        following = words[i + 1] if i + 1 < len(words) else b""
        return (TELLING.fullmatch(word) is not None or word.isdigit() and last in (b"version", b"v")
                or word == b"library" and following == b"general")

    return [words[i] for i in range(first, end) if tells(i)]


def occurrences(words: list[bytes], template: Template) -> list[tuple[int, int, list[str]]]:
    """(first word, end word, differences) of each place where the template's wording
    is kept closely enough."""
    found, todo = [], [(0, len(words))]
    wanted = list(template.words)
    spare = template.may_differ
    while todo:
        low, high = todo.pop()
        if high - low < len(wanted) - spare:
            continue
        own = words[low:high]
        match = difflib.SequenceMatcher(None, own, wanted, autojunk=False).find_longest_match()
        # with so few differences, some run of words is this long
        if match.size < max(1, (len(wanted) - spare) // (spare + 1)):
            continue
        a = max(0, match.a - match.b - spare)
        b = min(len(own), match.a - match.b + len(wanted) + spare)
        codes = [c for c in difflib.SequenceMatcher(None, own[a:b], wanted, autojunk=False).get_opcodes()]
        while codes and codes[0][0] == "delete":
            codes.pop(0)
        while codes and codes[-1][0] == "delete":
            codes.pop()
        differing = [(c, own[a + c[1]:a + c[2]], wanted[c[3]:c[4]]) for c in codes if c[0] != "equal"]
        first, end = low + a + codes[0][1], low + a + codes[-1][2]
        same = telling(words, first, end) == telling(wanted, 0, len(wanted))
        if sum(max(len(x), len(y)) for _, x, y in differing) <= spare and (same or not differing):
            found.append((first, end, [f"{b' '.join(y).decode()} > {b' '.join(x).decode()}" for _, x, y in differing]))
        else:
            first, end = low + match.a, low + match.a + match.size
        todo += [(low, first), (end, high)]
    return found


class Scanner:
    """Compressors of the templates (made in the task)."""

    def __init__(self, texts: dict[str, list[str]]):
        self.templates = templates(texts)
        self.cues = cue_words(self.templates)
        # words around a window: the longest place that fits, and as many words as its alignment looks beyond it
        self.around = max((len(t.words) + 3 * t.may_differ for t in self.templates), default=0)
        # words of a window: the longest run that must stand in one, wherever it begins
        self.window = STEP + max((len(run) for t in self.templates for run in t.runs), default=0)
        # one set of parameters, whether a dictionary is given or not
        size = max((len(t.text) for t in self.templates), default=0)
        options = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=16 * self.window, dict_size=size, strategy=zstandard.STRATEGY_BTOPT, min_match=5, hash_log=11, chain_log=11,
            write_content_size=False, write_dict_id=False)
        self.plain = zstandard.ZstdCompressor(compression_params=options)
        self.given = [zstandard.ZstdCompressor(compression_params=options, dict_data=zstandard.ZstdCompressionDict(
            t.text, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) if len(t.text) >= 8 else self.plain for t in self.templates]

    def saves(self, text: bytes, which: int, alone: int) -> int:
        """Bytes by which a template shortens a text that takes ``alone`` bytes."""
        return alone - len(self.given[which].compress(text))

    def ranked(self, text: bytes) -> list[tuple[int, int]]:
        """Bytes saved and number of all templates by the bytes that they save on a text, most first."""
        alone = len(self.plain.compress(text))
        return sorted(((self.saves(text, i, alone), i) for i in range(len(self.templates))), key=lambda r: (-r[0], r[1]))

    def candidates(self, words: list[bytes]) -> dict[int, list[tuple[int, int]]]:
        """By template, the stretches of windows on which it saves enough, in groups of up to ``PIECE`` words."""
        cues, out = set(self.cues), {}
        for low in range(0, len(words), STEP):
            own = words[low:low + self.window]
            if cues.isdisjoint(own):
                continue
            for saved, which in self.ranked(b" ".join(own)):
                if saved < LEAST_SAVED:
                    break
                stretches = out.setdefault(which, [])
                if stretches and low <= stretches[-1][1] and low - stretches[-1][0] < PIECE:
                    stretches[-1] = (stretches[-1][0], low + len(own))
                else:
                    stretches.append((low, low + len(own)))
        return out

    def goes_on(self, words: list[bytes], end: int, template: Template) -> bool:
        """Whether clauses of another license follow a long notice (before its disclaimer or the next notice)."""
        further = FURTHER.get(template.license)
        if not further or len(template.words) <= SHORT or BSD_END.lower().encode()[:25] in template.text:
            return False
        for i, word in enumerate(words[end:end + FURTHER_WORDS], end):
            if word in further:
                return True
            if word == b"redistribution" or words[i:i + 4] == [b"this", b"software", b"is", b"provided"]:
                return False
        return False

    def spdx(self, block: bytes) -> list[tuple[int, int, list[str], int, int]]:
        """Places of the known names of SPDX lines after the first, which a template has with its line: each
        is read as a line of its own, and the first template by bytes saved that words it alike names it."""
        found = []
        for line in SPDX.finditer(block):
            for m in list(re.finditer(rb"[a-z0-9.+-]+", line[1]))[1:]:
                if m[0] in (b"and", b"or", b"with"):
                    continue
                own = b"spdx-license-identifier " + m[0].rstrip(b"+.")
                for saved, which in self.ranked(own):
                    if saved < LEAST_SAVED:
                        break
                    if self.templates[which].text == own:
                        found.append((saved, which, [], line.start(1) + m.start(), line.start(1) + m.end()))
                        break
        return found

    def scan(self, block: bytes) -> list[dict]:
        """Confirmed licenses of a block: license, byte range in it, differences, bytes saved."""
        places = [(m.start(), m.end()) for m in WORD.finditer(block)]
        words = [block[a:b] for a, b in places]
        confirmed: dict[tuple[int, int, int], list[str]] = {}
        for which, stretches in self.candidates(words).items():
            for low, high in stretches:
                start = max(0, low - self.around)
                for first, end, differing in occurrences(words[start:high + self.around], self.templates[which]):
                    first, end = start + first, start + end
                    # places beside the stretch may be cut; they have windows of their own
                    if first < high and end > low and not self.goes_on(words, end, self.templates[which]):
                        confirmed[which, first, end] = differing
        found, alone = [], {}
        for (which, first, end), differing in confirmed.items():
            text = b" ".join(words[first:end])
            if text not in alone:
                alone[text] = len(self.plain.compress(text))
            found.append((self.saves(text, which, alone[text]), which, differing, places[first][0], places[end - 1][1]))
        found += self.spdx(block)
        out: list[dict] = []
        starts: list[int] = []
        for saved, which, differing, a, b in sorted(found, key=lambda f: (-f[0], len(f[2]), f[1], f[3])):
            at = bisect_left(starts, a)
            if (at == 0 or out[at - 1]["end"] <= a) and (at == len(out) or b <= starts[at]):
                starts.insert(at, a)
                out.insert(at, {"license": self.templates[which].license, "start": a, "end": b, "differences": differing, "saved": saved})
        return out


SPAN = T.StructType([T.StructField("license", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                     T.StructField("differences", T.ArrayType(T.StringType())), T.StructField("saved", T.IntegerType())])
ARROW_SPAN = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                 ("differences", pa.list_(pa.string())), ("saved", pa.int32())]))


def scan_licenses(docs: DataFrame, texts: dict[str, list[str]] | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``spans`` (license, start, end, differences, saved bytes) of every document."""
    texts = TEMPLATES if texts is None else texts
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    schema = T.StructType([source.schema.fields[0], T.StructField("spans", T.ArrayType(SPAN))])

    def run(batches):
        scanner = Scanner(texts)
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                low = LOWER_ASCII[data].tobytes()
                spans: list[list[dict]] = [[] for _ in range(hi - lo)]
                for row, a, b in blocks(low, offsets, scanner.cues, scanner.around):
                    shift = a - int(offsets[row])
                    spans[row] += [{**s, "start": s["start"] + shift, "end": s["end"] + shift} for s in scanner.scan(low[a:b])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(spans, ARROW_SPAN)], names=["doc_id", "spans"])

    return source.mapInArrow(run, schema)


def license_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, licenses (different ones, sorted, comma-joined), n_licenses (places), spans."""
    found = scan_licenses(docs, **options)
    return found.select("doc_id", F.array_join(F.array_sort(F.array_distinct("spans.license")), ",").alias("licenses"),
                        F.size("spans").cast("long").alias("n_licenses"), "spans")
