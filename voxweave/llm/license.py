"""License scans by sentences and rules.

``scan(docs)`` gives (doc_id, license, rule, first_sentence, last_sentence, sentences) of
every match of a licence rule in every document.

How. Texts are cut to sentences at line ends and after . ! ? ; : that blanks follow. A sentence is
normalised to its words (lower case, signs and blanks dropped) and looked up, by a hash of
them, among the known licence sentences, which gives its identifier, or none. A rule is a
licence's sentence identifiers in order; it matches where they occur in a row, with at most
``gap`` unknown sentences between two of them. A known sentence that is wrapped is found too: words
of several lines in a row, of which none but the last ends in an end sign or before a blank line, are those
of the sentence (comment signs aren't words). In a gap, wrapped lines are one sentence. Rules are tried in their order, longest and most
specific first; a sentence that has been used by one isn't used by a later one.

Sentences are found, hashed and looked up for many rows at once; Python looks only at rows
with a known sentence. No shuffle.

``rules`` may be given: (license, rule name, sentences). RULES holds the texts and notices of common
licences, those of the most sentences first.

Defined cases. Null and empty texts: no match. Very long texts are scanned whole. Repeated rows and null doc_id are scanned row by
row. An empty table gives no rows. A rule that occurs several times in a text matches several times. Ties: of rules that fit the same sentences the first in their order is given;
of known sentences that begin at one place, the longest. Only doc_id and text are read, so other columns can't clash. Sentence numbers count from 0
over sentences that have words; each line of a wrapped sentence has a number.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from .util import keyed, map_batches

GAP = 2

_MIT = [
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
]
_APACHE = [
    "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "you may not use this file except in compliance with the License.",
    "You may obtain a copy of the License at",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
]
_APACHE_END = "See the License for the specific language governing permissions and limitations under the License."
_APACHE_TEXT = ["TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION", "Definitions.", "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document."]
_APACHE_GRANT = "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."


def _gnu(name: str, version: str, what: str = "program") -> list[str]:
    """The notice of a licence of the GNU family: grant, no warranty, where to find it."""
    article = "library" if what == "library" else "program"
    return [
        f"This {article} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
        f"This {article} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        f"See the GNU {name} for more details.",
        f"You should have received a copy of the GNU {name} along with this {article}.",
    ]


_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
]
_BSD_NAMES = [
    f"Neither the name of {holder} may be used to endorse or promote products derived from this software without specific prior written permission."
    for holder in ("the copyright holder nor the names of its contributors", "the copyright holders nor the names of its contributors", "the copyright owner nor the names of its contributors", "the University nor the names of its contributors", "the author nor the names of its contributors", "the organization nor the names of its contributors", "Google Inc. nor the names of its contributors")
]
_BSD_WARRANTY = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
_BSD_LIABLE = [
    f"IN NO EVENT SHALL THE COPYRIGHT {who} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    for who in ("HOLDER", "HOLDERS", "OWNER")
]
_ISC = [
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
]
_ISC_OLD = "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ZERO_BSD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
_MPL = ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "If a copy of the MPL was not distributed with this file, You can obtain one at"]
_ZLIB = [
    "This software is provided 'as-is', without any express or implied warranty.",
    "In no event will the authors be held liable for any damages arising from the use of this software.",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "The origin of this software must not be misrepresented;",
    "you must not claim that you wrote the original software.",
]
_BOOST = [
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
]
_UNLICENSE = [
    "This is free and unencumbered software released into the public domain.",
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
]
_EPL = ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at"]
_CC0 = "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."


def _gnu_rules() -> list[tuple[str, str, list[str]]]:
    out: list[tuple[str, str, list[str]]] = []
    for code, name, versions, whats in (("AGPL", _AGPL, ("3",), ("program",)), ("LGPL", _LGPL, ("3", "2.1"), ("library", "program")), ("GPL", _GPL, ("3", "2"), ("program",))):
        for version in versions:
            spdx = f"{code}-{version if '.' in version else version + '.0'}-or-later"
            for what in whats:
                own = _gnu(name, version, what)
                semi = [own[0].replace("free software: you", "free software; you"), *own[1:]]
                out += [(spdx, "notice-full", own), (spdx, "notice-full", semi), (spdx, "notice", own[:1]), (spdx, "notice", semi[:1])]
    return out


def _spdx(name: str, *more: str) -> list[tuple[str, str, list[str]]]:
    return [(name, "line", [s]) for s in (f"SPDX-License-Identifier: {name}", *more)]


_FULL: list[tuple[str, str, list[str]]] = [
    ("Apache-2.0", "notice-full", [*_APACHE, _APACHE_END]),
    ("Apache-2.0", "notice-full", _APACHE),
    ("Apache-2.0", "text", [*_APACHE_TEXT]),
    ("Apache-2.0", "text-grant", [_APACHE_GRANT]),
    ("MIT", "text-full", _MIT),
    ("MIT", "text-full", _MIT[:3]),
    *(("BSD-3-Clause", "text-full", [*_BSD, names, _BSD_WARRANTY, liable]) for names in _BSD_NAMES for liable in _BSD_LIABLE),
    *(("BSD-3-Clause", "text-full", [*_BSD, names]) for names in _BSD_NAMES),
    *(("BSD-2-Clause", "text-full", [*_BSD, _BSD_WARRANTY, liable]) for liable in _BSD_LIABLE),
    ("BSD-2-Clause", "text-full", _BSD),
    *_gnu_rules(),
    ("ISC", "text-full", _ISC),
    ("ISC", "text-full", [_ISC_OLD, *_ISC[1:]]),
    ("0BSD", "text-full", [_ZERO_BSD, *_ISC[1:]]),
    ("BSL-1.0", "text-full", _BOOST),
    ("Zlib", "text-full", _ZLIB),
    ("Unlicense", "text-full", _UNLICENSE),
    ("MPL-2.0", "notice-full", _MPL),
    *(("EPL-2.0", "notice", [s]) for s in _EPL),
    ("AGPL-3.0-only", "text", ["GNU AFFERO GENERAL PUBLIC LICENSE", "Version 3, 19 November 2007"]),
    ("LGPL-3.0-only", "text", ["GNU LESSER GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007"]),
    ("LGPL-2.1-only", "text", ["GNU LESSER GENERAL PUBLIC LICENSE", "Version 2.1, February 1999"]),
    ("GPL-3.0-only", "text", ["GNU GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007"]),
    ("GPL-2.0-only", "text", ["GNU GENERAL PUBLIC LICENSE", "Version 2, June 1991"]),
    ("MPL-2.0", "text", ["Mozilla Public License Version 2.0"]),
    ("Apache-2.0", "text-head", ["Apache License", "Version 2.0, January 2004"]),
    ("MIT", "grant", _MIT[:1]),
    ("Apache-2.0", "notice-head", _APACHE[:2]),
    ("BSD-2-Clause", "grant", _BSD[:1]),
    ("ISC", "grant", _ISC[:1]),
    ("ISC", "grant", [_ISC_OLD]),
    ("MPL-2.0", "notice", _MPL[:1]),
    ("Unlicense", "head", _UNLICENSE[:1]),
    ("BSL-1.0", "line", ["Distributed under the Boost Software License, Version 1.0."]),
    ("CC0-1.0", "notice", [_CC0]),
    *_spdx("Apache-2.0", "Licensed under the Apache License, Version 2.0.", _APACHE[0], "Released under the Apache License 2.0.", "This work is licensed under the Apache License, Version 2.0."),
    *_spdx("MIT", "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.", "This work is licensed under the MIT License."),
    *_spdx("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "Released under the GNU GPL v3."),
    *_spdx("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."),
    *_spdx("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    *_spdx("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    *_spdx("CC-BY-4.0", "Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    *_spdx("BSD-3-Clause", "Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."),
    *_spdx("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    *(r for name in ("GPL-3.0-or-later", "GPL-2.0-or-later", "LGPL-3.0-or-later", "LGPL-2.1-or-later", "AGPL-3.0-or-later", "AGPL-3.0-only", "MPL-2.0", "ISC", "Unlicense", "Zlib", "BSL-1.0", "EPL-2.0", "0BSD") for r in _spdx(name)),
    *_spdx("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("LicenseRef-Proprietary", "line", ["All rights reserved."]),
]
#: (license, rule, sentences), in the order in which they are tried: those of the most sentences first, of equals as they are listed.
RULES: list[tuple[str, str, list[str]]] = sorted(_FULL, key=lambda r: -len(r[2]))

_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".!?;:"]] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Sentences:
    hash: np.ndarray
    splits: np.ndarray  # by row
    words: K.Words
    first: np.ndarray  # word that each begins with


def _goes_on(between: bytes) -> bool:
    """Whether a sentence goes on over what stands between two words: one line end, and before it no end sign that a blank follows."""
    return len(re.findall(rb"\r\n|[\r\n]", between)) == 1 and not re.search(rb"[.!?;:][\t-\r ]", between[: re.search(rb"[\r\n]", between).end()])


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return K.mix(a * np.uint64(0xD1342543DE82EF95) + b)


def sentences(raw: np.ndarray, offsets: np.ndarray) -> Sentences:
    """A hash of the words of each sentence that has any."""
    w = K.words(raw, offsets)
    if not len(w.hash):
        return Sentences(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), w, np.zeros(0, np.int64))
    # a cut before a byte: after a line end, or where a blank follows an end sign
    cut = np.zeros(len(raw) + 1, np.int64)
    cut[1:] = (raw == 10) | (raw == 13)
    cut[1:-1] |= _END[raw[:-1]] & _BLANK[raw[1:]]
    cut[offsets[:-1]] = 1
    number = np.cumsum(cut)[w.starts]
    first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    # order-sensitive sum: each word's hash is mixed with its place in the sentence
    place = np.arange(len(number)) - np.repeat(first, np.diff(np.concatenate([first, [len(number)]])))
    total = np.add.reduceat(K.mix(w.hash + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first)
    return Sentences(total, np.searchsorted(w.starts[first], offsets), w, first)


class Matcher:
    def __init__(self, rules: list[tuple[str, str, list[str]]] | None = None):
        self.rules: list[tuple[str, str, list[int]]] = []
        known: dict[int, int] = {}
        self.whole: dict[int, list[tuple[np.ndarray, int]]] = {}  # words of the known sentences and their identifier, by the first two
        for name, rule, lines in RULES if rules is None else rules:
            ids = []
            for line in lines:
                raw, off = K.buffers(pa.array([line]))
                s = sentences(raw, off)
                for h, a, z in zip(s.hash.tolist(), s.first.tolist(), [*s.first[1:].tolist(), len(s.words.hash)]):
                    if h not in known and z - a > 1:
                        own = s.words.hash[a:z]
                        self.whole.setdefault(int(_pairs(own[:1], own[1:2])[0]), []).append((own, len(known)))
                    ids.append(known.setdefault(h, len(known)))
            if ids:
                self.rules.append((name, rule, ids))
        keys = np.array(list(known), np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.arange(len(keys))[order]
        self.begins = np.array(list(self.whole), np.uint64)
        for some in self.whole.values():
            some.sort(key=lambda x: -len(x[0]))

    def identify(self, hashes: np.ndarray) -> np.ndarray:
        """Identifier of each known sentence, or -1."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.ids[at], -1)

    def wrapped(self, s: Sentences, raw: np.ndarray) -> list[tuple[int, int, int]]:
        """(first line, last line, identifier) of known sentences over several lines, of one place the longest."""
        w, out = s.words, []
        at = s.first[s.first + 1 < len(w.hash)]
        for p in np.flatnonzero(np.isin(_pairs(w.hash[at], w.hash[at + 1]), self.begins)).tolist():
            a = int(s.first[p])
            if out and p <= out[-1][1]:
                continue
            end = int(w.splits[np.searchsorted(w.splits, a, side="right")])
            for own, k in self.whole[int(_pairs(w.hash[a : a + 1], w.hash[a + 1 : a + 2])[0])]:
                z = a + len(own)
                if z > end or not np.array_equal(w.hash[a:z], own):
                    continue
                q = int(np.searchsorted(s.first, z))
                if q > p + 1 and (z == end or s.first[q] == z) and all(self.soft(s, raw, i) for i in range(p + 1, q)):
                    out.append((p, q - 1, k))
                    break
        return out

    @staticmethod
    def soft(s: Sentences, raw: np.ndarray, i: int) -> bool:
        """Whether the line of this number goes on with the sentence of the one before in its row."""
        k = int(s.first[i])
        return k > 0 and _goes_on(raw[s.words.ends[k - 1] : s.words.starts[k]].tobytes())

    def match(self, places: list[tuple[int, int]], ids: list[int], gap: int, soft: Callable[[int], bool]) -> list[tuple[str, str, int, int, int]]:
        """(license, rule, first, last, sentences) from the known sentences of a text, by place; soft tells of a line whether it goes on with the one before."""

        def far(last: int, first: int) -> bool:
            if first - last <= gap + 1:
                return False
            unknown = 1
            for i in range(last + 2, first):
                if unknown > gap:
                    break
                unknown += not soft(i)
            return unknown > gap

        used, out = [False] * len(ids), []
        for name, rule, wanted in self.rules:
            start = 0
            while start < len(ids):
                took, at = [], start
                while at < len(ids) and len(took) < len(wanted):
                    if took and far(places[took[-1]][1], places[at][0]):
                        break
                    if not used[at] and ids[at] == wanted[len(took)]:
                        took.append(at)
                    elif not took:
                        break
                    at += 1
                if len(took) == len(wanted):
                    for k in took:
                        used[k] = True
                    out.append((name, rule, places[took[0]][0], places[took[-1]][1], len(took)))
                start += 1
        return sorted(out, key=lambda m: (m[2], m[3], m[0], m[1]))

    def scan(self, column: pa.Array, gap: int) -> list[tuple]:
        """(row, license, rule, first, last, sentences)."""
        raw, offsets = K.buffers(column)
        out = []
        for i, _, part, off in K.slices(raw, offsets):
            s = sentences(part, off)
            ids = self.identify(s.hash)
            joined = self.wrapped(s, part)
            inside = {k for a, z, _ in joined for k in range(a, z + 1)}
            hits = sorted(joined + [(k, k, int(ids[k])) for k in np.flatnonzero(ids >= 0).tolist() if k not in inside])
            if not hits:
                continue
            row = np.searchsorted(s.splits, [a for a, _, _ in hits], side="right") - 1
            edges = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]])).tolist()
            for a, z in zip(edges, edges[1:]):
                r, own = int(row[a]), hits[a:z]
                base = int(s.splits[r])
                out += [(i + r, *m) for m in self.match([(x - base, y - base) for x, y, _ in own], [k for _, _, k in own], gap, lambda n, s=s, base=base: self.soft(s, part, base + n))]
        return out


def scan(docs: DataFrame, rules: list[tuple[str, str, list[str]]] | None = None, gap: int = GAP) -> DataFrame:
    """(doc_id, license, rule, first_sentence, last_sentence, sentences)."""
    matcher = Matcher(rules)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = matcher.scan(batch.column(1), gap)
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([f[0] for f in found], pa.int64())), *(pa.array([f[k] for f in found], t) for k, t in ((1, pa.string()), (2, pa.string()), (3, pa.int32()), (4, pa.int32()), (5, pa.int32())))], names=["doc_id", "license", "rule", "first_sentence", "last_sentence", "sentences"])

    return map_batches(keyed(docs), "doc_id long, license string, rule string, first_sentence int, last_sentence int, sentences int", one)
