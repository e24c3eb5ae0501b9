"""Licence scan: matching statistics against a suffix automaton of licence texts.

All templates go into one generalised suffix automaton over words. A text is streamed
through it: the state after each word is the longest run of words ending there that occurs
in some template. Runs that cannot be extended and are long enough become matches; per
template, matches in the same order in text and template are chained into a span. Words of
the text that stand between chained matches count against it. Where spans overlap, the one
with most covered less foreign words stays, so a variant of a licence gets its own label
and not that of the licence it varies. Fixed phrases are looked up besides, at every place
where their words stand consecutively.

Templates are the paragraphs of short licences, whole, and the notices that long licences
ask to be put into files; a caller may pass others. Any one paragraph gives the label. Spans
that give a label stand before others; those of equal worth go by coverage, then the
earlier, then the label's name.

Each row is scanned on its own, without a shuffle. Null and empty texts have no words, no
labels and score 0.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import Column

from docketlake.llm.common import text_udf

# Fixed: phrases and the labels they give.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Fixed: paragraphs of common public licences, or the notice that a long licence asks for, and
# one-line statements.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Released under the MIT License", "Licensed under the MIT License"),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License "
        "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
        "or implied. See the License for the specific language governing permissions and limitations under "
        "the License.",
        "Licensed under the Apache License, Version 2.0"),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
        "and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
        "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
        "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
        "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        "Licensed under the BSD License"),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "This work is licensed under the GNU General Public License, version 3"),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 "
        "of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "This work is licensed under the GNU Lesser General Public License, version 3"),
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU Affero General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Affero General Public License for more details.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "This work is licensed under the GNU Affero General Public License, version 3"),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at",),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License 2.0 which is available at",),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
        "OF THIS SOFTWARE."),
    "bsl-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of "
        "the software and accompanying documentation covered by this license (the Software) to use, "
        "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative "
        "works of the Software, and to permit third-parties to whom the Software is furnished to do so, "
        "all subject to the following:",
        "Distributed under the Boost Software License, Version 1.0"),
    "busl-1.1": ("Use of this software is governed by the Business Source License included in the file",),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the "
        "original software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software.",
        "This notice may not be removed or altered from any source distribution."),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License",
              "Licensed under CC BY 4.0"),
    "cc-by-sa": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
                 "Licensed under CC BY-SA 4.0"),
    "cc-by-nc": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
                 "Licensed under CC BY-NC 4.0"),
    "cc-by-nd": ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
                 "Licensed under CC BY-ND 4.0"),
    "cc-by-nc-sa": ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                    "International License", "Licensed under CC BY-NC-SA 4.0"),
    "cc-by-nc-nd": ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                    "International License", "Licensed under CC BY-NC-ND 4.0"),
    "cc0": ("To the extent possible under law, the author has waived all copyright and related or neighboring "
            "rights to this work", "This work is dedicated to the public domain under CC0 1.0 Universal"),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means."),
}
#: Shortest run of words that counts as a match.
RUN = 4
#: Words of the text that may lie between two chained matches.
GAP = 40
#: Share of a template and of the foreign words in its span that must be covered to give its label.
COVERED = 0.5

# A-Z become a-z; ASCII other than letters and digits separates; bytes of other letters stay.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton; each state knows where its longest word run ends."""

    def __init__(self, texts: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for k, words in enumerate(texts):
            last = 0
            for at, w in enumerate(words):
                last = self._extend(last, w)
                self.ends[last].append((k, at + 1))
        # An occurrence of a run is one of each of its suffixes.
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                known = set(self.ends[self.link[s]])
                self.ends[self.link[s]] += [e for e in self.ends[s] if e not in known]

    def _state(self, length: int, link: int, nxt: dict[bytes, int]) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.link) - 1

    def _extend(self, last: int, w: bytes) -> int:
        there = self.next[last].get(w)
        if there is not None:
            if self.length[there] == self.length[last] + 1:
                return there
            return self._split(last, w, there)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: bytes, q: int) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def matches(self, words: list[bytes], shortest: int) -> list[tuple[int, int, int]]:
        """Runs (start, end, state) of at least ``shortest`` words that cannot be extended."""
        nxt, link, length = self.next, self.link, self.length
        out, state, size = [], 0, 0
        for at, w in enumerate(words):
            if w in nxt[state]:
                state = nxt[state][w]
                size += 1
                continue
            if size >= shortest:
                out.append((at - size, at, state))
            while state >= 0 and w not in nxt[state]:
                state = link[state]
            if state < 0:
                state, size = 0, 0
            else:
                size = length[state] + 1
                state = nxt[state][w]
        if size >= shortest:
            out.append((len(words) - size, len(words), state))
        return out


class LicenseScanner:
    def __init__(self, templates: dict[str, tuple[str, ...]], phrases: dict[str, str]):
        self.labels = [label for label, texts in templates.items() for _ in texts]
        texts = [words_of(t) for found in templates.values() for t in found]
        self.sizes = [len(t) for t in texts]
        self.automaton = Automaton(texts)
        self.known = set().union(*texts) if texts else set()
        self.phrases = [(b" " + b" ".join(words_of(p)) + b" ", label) for p, label in phrases.items()]

    def scan(self, text: str) -> dict:
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        places, labels = [], set()
        for phrase, label in self.phrases:
            at, counted, before = line.find(phrase), 0, 0
            while at >= 0:
                before += line.count(b" ", counted, at)
                counted = at
                places.append(before)
                labels.add(label)
                at = line.find(phrase, at + 1)
        spans = self._spans(words)
        best = max([s["coverage"] for s in spans], default=0.0)
        return {
            "n_words": len(words), "n_base": len(places),
            "first_word": min(places, default=None), "last_word": max(places, default=None),
            "base_labels": sorted(labels), "spans": spans,
            "labels": sorted(labels | {s["label"] for s in spans if s["coverage"] >= COVERED}),
            "score": 1 - (1 - best) * (0.5 if places else 1.0),
        }

    def _spans(self, words: list[bytes]) -> list[dict]:
        """Chained spans of the templates; of overlapping ones the one that explains most words."""
        known = np.fromiter(map(self.known.__contains__, words), np.bool_, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        out: dict[int, list[tuple[int, int, int, int]]] = {}
        for start, end in edges.reshape(-1, 2).tolist():
            if end - start < RUN:
                continue
            for a, b, state in self.automaton.matches(words[start:end], RUN):
                for k, stop in self.automaton.ends[state]:
                    out.setdefault(k, []).append((start + a, start + b, stop - (b - a), stop))
        found = sorted((s for k, matches in out.items() for s in self._chain(k, matches)),
                       key=lambda s: (s["coverage"] < COVERED, -s["net"], -s["coverage"], s["start"], s["label"]))
        starts, kept = [], []                 # disjoint, in the order of the text
        for s in found:
            at = bisect.bisect_left(starts, s["end"])
            if at == 0 or kept[at - 1]["end"] <= s["start"]:
                starts.insert(at, s["start"])
                kept.insert(at, s)
        return [{name: s[name] for name in ("label", "start", "end", "coverage")} for s in kept]

    def _chain(self, k: int, found: list[tuple[int, int, int, int]]) -> list[dict]:
        """Best chains of one template; a match joins the chain that then has most, less foreign words."""
        found.sort()
        best: list[tuple[int, int, int]] = []      # covered less foreign words, covered words, first match
        low = 0
        for at, (a, b, u, v) in enumerate(found):
            while found[low][1] < a - GAP:
                low += 1
            top = (b - a, b - a, at)
            for j in range(low, at):
                c, d, x, y = found[j]
                net = best[j][0] - (a - d) + b - a
                if d <= a and y <= u and net > top[0]:
                    top = (net, best[j][1] + b - a, best[j][2])
            best.append(top)
        spans: dict[int, tuple[int, int, int]] = {}
        for at, (net, covered, first) in enumerate(best):
            if net > spans.get(first, (0, 0, 0))[0]:
                spans[first] = (net, covered, found[at][1])
        return [{"label": self.labels[k], "start": found[first][0], "end": end, "net": net,
                 "coverage": covered / (self.sizes[k] + covered - net)}
                for first, (net, covered, end) in spans.items()]


RESULT = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:array<string>,"
          "labels:array<string>,score:double,"
          "spans:array<struct<label:string,start:bigint,end:bigint,coverage:double>>>")


def license_scan(text: str | Column, templates: dict[str, tuple[str, ...]] | None = None,
                 phrases: dict[str, str] | None = None) -> Column:
    """Counts, labels, score and covered template spans (in words) of each whole text."""
    kind = pa.struct([
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                      ("coverage", pa.float64())])))])
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases

    def make():
        scanner = LicenseScanner(templates, phrases)
        return lambda texts: pa.array([scanner.scan(t) for t in texts], kind)

    return text_udf(make, RESULT)(text)
