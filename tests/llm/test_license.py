import random
import re
import textwrap

import pyarrow as pa
import pyarrow.parquet as pq
from common import ODD, odd

from voxweave.llm import kernels as K
from oracle import of_spark, of_sql
from voxweave.llm import license as L
from voxweave.llm import oracles

SF = "/root/testdata/sf0.01"


def plain_sentences(text):
    out = []
    for line in re.split(r"[\n\r]", text):
        for s in re.split(r"(?<=[.!?;:])(?=[\t\n\x0b\x0c\r ])", line):
            if w := K.words_of(s):
                out.append(tuple(w))
    return out


def brute(text, gap=L.GAP):
    """Single-sentence rules alone."""
    known = {}
    for name, rule, lines in L.RULES:
        if len(lines) == 1 and len(plain_sentences(lines[0])) == 1:
            known.setdefault(plain_sentences(lines[0])[0], (name, rule))
    return [(known[s][0], known[s][1], k, k, 1) for k, s in enumerate(plain_sentences(text)) if s in known]


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(tuple(r) for r in L.scan(docs).collect())
    want = sorted((r["doc_id"], *m) for r in docs.collect() for m in brute(r["text"]))
    assert got == want and want


def test_rules_in_order():
    m = L.Matcher()
    full = "Intro.\n" + " ".join(L._MIT[:2]) + "\nCopyright someone\n" + L._MIT[2] + "\nReleased under the MIT License."
    found = m.scan(pa.array([full]), L.GAP)
    assert [f[1:3] for f in found] == [("MIT", "text-full"), ("MIT", "line")]
    far = L._MIT[0] + "\nx.\ny.\nz.\n" + "\n".join(L._MIT[1:])
    assert [f[1:3] for f in m.scan(pa.array([far]), L.GAP)] == [("MIT", "grant")]
    assert [f[1:3] for f in m.scan(pa.array([L._MIT[1] + "\n" + L._MIT[0]]), L.GAP)] == [("MIT", "grant")]


def test_normalisation_and_own_rules():
    m = L.Matcher([("Own", "r", ["Keep   this NOTICE"]), ("Own", "none", ["..."])])
    texts = ["keep this notice", "KEEP\tTHIS - NOTICE!", "keep this, notice. keep this notice", "keep that notice", "keep this notice here", "", None]
    assert [(f[0], f[3]) for f in m.scan(pa.array(texts), 0)] == [(0, 0), (1, 0), (2, 0), (2, 1)]
    assert L.Matcher([]).scan(pa.array(texts), 0) == []


def test_odd_rows(spark):
    line = "Released under the MIT License."
    df = odd(spark, [*ODD, (40, line, "en"), (40, line, "en"), (None, line, "en"), (41, L.RULES[0][2][0] * 3000, "en")])
    got = L.scan(df).collect()
    assert sum(r["doc_id"] == 40 for r in got) == 2 and sum(r["doc_id"] is None for r in got) == 1
    assert L.scan(df.limit(0)).count() == 0


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_wrapped_notices():
    m, want = L.Matcher(), [("Apache-2.0", "notice-full"), ("MIT", "text-full"), ("GPL-3.0-or-later", "notice"), ("BSD-2-Clause", "text-full"), ("BSD-3-Clause", "text-full")]
    texts = [APACHE, MIT, GPL, BSD2, BSD3]
    forms = [lambda t: t, lambda t: t.replace("\n", "\r\n"), *(lambda t, sign=sign: "\n".join(sign + x for x in t.split("\n")) for sign in ("# ", " * ", "// ", "-- ")), lambda t: "The notice\n" + t]
    for form in forms:
        assert [f[:3] for f in m.scan(pa.array([form(t) for t in texts]), L.GAP)] == [(k, *w) for k, w in enumerate(want)]
    flat = [re.sub(r"(?<![.:;])\n\s*(?!\n)", " ", t) for t in (GPL, BSD3)]
    assert [f[1:3] for f in m.scan(pa.array(flat), L.GAP)] == [want[2], want[4]]


def test_wrapped_lines_end_at_signs_and_blank_lines():
    m = L.Matcher([("Own", "r", ["one two three four"]), ("Two", "r", ["first known here", "second known here"])])
    texts = ["one two\nthree four", "one two.\nthree four", "one two\n\nthree four", "one two\n# \n# three four", "one two\nthree four five", "zero\n// one\n// two three\n// four\nfive", "one two", "three four"]
    assert [(f[0], f[3], f[4]) for f in m.scan(pa.array(texts), 0)] == [(0, 0, 1), (5, 1, 3)]
    gap = ["first known\nhere.\na\nb\nc.\nd.\nsecond\nknown here", "first known here.\na.\nb.\nc.\nsecond known here"]
    assert [(f[0], f[1], f[3], f[4], f[5]) for f in m.scan(pa.array(gap), 2)] == [(0, "Two", 0, 7, 2)]


def filled(lines, width, prefix):
    """A text as files hold it: paragraphs of wrapped lines behind a comment sign; what has no end sign stands by itself."""
    parts, now = [], ""
    for line in lines:
        now = f"{now} {line}".strip()
        if line[-1] in ".!?;:":
            continue
        parts, now = [*parts, now], ""
    parts += [now] if now else []
    text = "\n\n".join(textwrap.fill(p, width) for p in ["Copyright (c) 2020 Someone", *parts])
    return "\n".join(prefix + x for x in text.split("\n"))


def test_every_rule_in_every_form():
    """Each text or notice of the rules, wrapped at several widths behind several comment signs, gives its name and nothing else."""
    m = L.Matcher()
    for width in (40, 60, 78, 10_000):
        for prefix in ("", "# ", " * ", "// ", "-- ", ";; "):
            got = m.scan(pa.array([filled(lines, width, prefix) for _, _, lines in L.RULES]), L.GAP)
            assert [f[:3] for f in got] == [(k, name, rule) for k, (name, rule, _) in enumerate(L.RULES)]


def test_several_licences_in_one_text():
    """Rules of several sentences, in any order with other text between, against what they were put together from."""
    m, rng = L.Matcher(), random.Random(1)
    full = [r for r in L.RULES if len(r[2]) > 1]
    texts, want = [], []
    for k in range(60):
        chosen = rng.sample(full, 4)
        other = "\n\nThis has nothing to do with it. Nor has this. Nor this. Nor that.\n\n"
        texts.append(other.join(filled(r[2], rng.choice((50, 72)), "# ") for r in chosen))
        want += [(k, *r[:2]) for r in chosen]
    assert [f[:3] for f in m.scan(pa.array(texts), L.GAP)] == want


def test_ties():
    m = L.Matcher([("First", "r", ["same words here"]), ("Second", "r", ["same words here"]), ("Long", "r", ["same words here and more"])])
    assert [f[1] for f in m.scan(pa.array(["same words here", "same words\nhere and more"]), 0)] == ["First", "Long"]


def test_sql_of_wrapped_texts(spark, tmp_path):
    """The SQL joins lines in another way: by what they say together."""
    rng = random.Random(2)
    texts = [T for T in (APACHE, MIT, GPL, BSD2, BSD3)] + [filled(r[2], rng.choice((50, 72)), p) for r in L.RULES for p in ("", "# ", ";; ")]
    texts += ["\n\nOther words. And more.\n\n".join(filled(r[2], 60, " * ") for r in rng.sample(L.RULES, 3)) for _ in range(40)]
    pq.write_table(pa.table({"doc_id": range(len(texts)), "text": texts}), f"{tmp_path}/documents.parquet")
    assert of_spark(L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))) == of_sql(oracles.LICENSE, str(tmp_path))
