"""Cases of the review: full ranks, shared ids, real licences, page wrappers."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import llm_spark, make_docs  # noqa: F401

from wakeline.llm import repeats
from wakeline.llm.extraction import main_text
from wakeline.llm.licence_forms import licence_texts
from wakeline.llm.licenses import TEMPLATES, Templates, license_scan, terms


def contexts_of(rows):
    """Sorted (rank, doc_id, first, context) as a batch of contexts."""
    rank, doc_id, first, context = zip(*rows, strict=True)
    size = np.array([len(c) - 99 for c in context], np.int32)
    names = ["rank", "doc_id", "first", "size", "context"]
    columns = [pa.array(np.array(c, np.int64)) for c in (rank, doc_id, first)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(size), pa.array(context)], names)


def compared(parts):
    """Places of the strings that repeat an earlier one, and the number of single ones."""
    repeated, single = set(), []
    for out in repeats._compared(iter(parts)):
        for row in out.to_pylist():
            at = (row["doc_id"], row["first"])
            if row["kind"] == repeats.REPEATED:
                repeated |= {(at[0], at[1] + n) for n in range(row["size"])}
            else:
                single.append((row["rank"], *at))
    earliest = {}
    for key, *at in sorted(single):
        if earliest.setdefault(key, tuple(at)) != tuple(at):
            repeated.add(tuple(at))
    return repeated, len(single)


def compared_by_hand(rows):
    earliest, places = {}, set()
    for rank, doc_id, first, context in rows:
        for n in range(len(context) - 99):
            key, at = (rank, context[n : n + 100]), (doc_id, first + n)
            places.add((key, at))
            earliest[key] = min(at, earliest.get(key, at))
    return {at for key, at in places if at != earliest[key]}


def test_strings_of_a_full_rank_before_another_rank(monkeypatch):
    """A slice may begin with the end of a full rank and end with a second rank."""
    shared = b"The same thirty-two bytes again, and again."
    rows = []
    for n in range(40):
        side = bytes(65 + (n // 2 * 7 + k) % 26 for k in range(100))
        rows.append((0 if n < 29 else 5, n, 0, side + shared + side))
    for n in (27, 28):  # Equal to spared strings of slices before, from the ending rank.
        rows[n] = (0, n, 0, rows[n - 5][3])
    monkeypatch.setattr(repeats, "COMPARED_STRINGS", 100)
    batch = contexts_of(rows)
    for width in (1, 3, 5, 7, 9, 40):
        found, single = compared([batch.slice(n, width) for n in range(0, 40, width)])
        assert found == compared_by_hand(rows)
        assert single > 0 or width > 9


def test_rows_that_share_a_doc_id_across_slices():
    """The same place is no earlier start, however the copies fall into batches."""
    text = bytes(33 + n * n % 89 for n in range(240))
    rows = [(0, 1, 0, text), (0, 1, 0, text), (0, 1, 30, text[10:150]), (0, 1, 5, text[60:200]),
            (0, 2, 0, text[:180]), (4, 3, 0, text), (4, 3, 0, text)]
    batch = contexts_of(rows)
    for width in (1, 2, 3, 7):
        found, single = compared([batch.slice(n, width) for n in range(0, 7, width)])
        assert single == 0 and found == compared_by_hand(rows)


def test_texts_of_a_shared_doc_id_may_be_shorter(llm_spark, make_docs):
    """A run is read in every row of its doc_id, as far as the text goes."""
    side = [bytes(65 + (n * 7 + k * k) % 26 for k in range(120)).decode() for n in range(4)]
    shared = "The same thirty-two bytes again, and again."
    long = side[0] + shared + side[1]
    rows = [(1, long), (1, long), (1, long[:130]), (1, ""), (2, side[2] + shared + side[1])]
    found = {(r.doc_id, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(make_docs(rows)).collect()}
    assert {(i, n) for i, n, _ in found} == {(1, 283), (1, 130), (1, 0), (2, 283)}
    assert all(n_removed == 0 for i, _, n_removed in found if i == 1)
    assert next(r for i, _, r in found if i == 2) >= 163


def window_by_hand(words, template, df, count):
    def weight(w):
        return math.log((1 + count) / (1 + df.get(w, 0))) + 1

    def norm(v):
        return math.sqrt(sum((n * weight(w)) ** 2 for w, n in v.items()))

    b, best = Counter(terms(template)), 0.0
    size = min(len(terms(template)), len(words))
    for n in range(len(words) - size + 1):
        a = Counter(words[n : n + size])
        best = max(best, sum(a[w] * b[w] * weight(w) ** 2 for w in b) / norm(a) / norm(b))
    return best


def test_windows_equal_all_runs():
    rng = random.Random(3)
    df = {"the": 90, "license": 5, "version": 7, "mit": 3, "x": 40, "of": 80}
    templates = Templates(TEMPLATES, df, 100)
    others = {w: templates.weight(n) for w, n in df.items()}
    vocabulary = [*sorted(templates.place), "x", "of", "zebra", "the", "the", "license"]
    for length in (1, 3, 8, 40, 200):
        words = rng.choices(vocabulary, k=length)
        for n, cosines in templates.windows(words, others, range(len(templates.names))):
            by_hand = window_by_hand(words, TEMPLATES[templates.names[n]], df, 100)
            assert cosines.max() == pytest.approx(by_hand, abs=1e-8)


def test_notices_among_other_words_whatever_the_size_of_the_corpus(llm_spark):
    """A notice counts by itself, and the other words by their frequency."""
    notices = {
        "Copyright 2020 Foo. Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "(c) 2021 Jane. Released under the MIT License.": "MIT",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file': "Apache-2.0",
        "# Use of this source code is governed\n# by a BSD 3-Clause license of Foo.": "BSD-3-Clause",
    }
    for more in (5, 3000):
        rows = [(f"a/{n}", f"quite other words {n} the of") for n in range(more)]
        rows += [(f"b/{n}", f"Words zz{n} before {x} And of after, odd words.") for n, x in enumerate(notices)]
        files = llm_spark.createDataFrame(rows, "path string, text string")
        found = {r.path: r.license for r in license_scan(files).collect() if r.found != "none"}
        assert found == {f"b/{n}": x for n, x in enumerate(notices.values())}


def test_weights_of_other_terms_come_from_the_corpus(llm_spark):
    """Many of the files have the odd word, so it weighs little: the notice still counts."""
    odd = "Released under qq the qq MIT qq terms"
    for more, license in ((0, None), (60, "MIT")):
        rows = [("a", odd), *((f"t{n}", "released under the terms") for n in range(40))]
        rows += [(f"x{n}", "qq") for n in range(more)]
        files = llm_spark.createDataFrame(rows, "path string, text string")
        assert {r.path: r.license for r in license_scan(files).collect()}["a"] == license


MIT_FILE = """MIT License

Copyright (c) 2019 Some People and others

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
BSD_FILE = """Copyright (c) 2009 The Example Authors. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:

   * Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.
   * Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the
distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR
A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
OWNER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
BSD_THIRD = """   * Neither the name of Example nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""
GNU_HEADER = """# This file is part of Example.
#
# {0} is free software: you can redistribute it and/or modify
# it under the terms of the GNU {1}General Public License as
# published by the Free Software Foundation, either version {2} of the
# License, or (at your option) any later version.
#
# {0} is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""


def test_licence_files_and_headers(llm_spark):
    code = "\nimport numpy as np\n\ndef run(values):\n    return np.sort(values)[::-1]\n" * 30
    stated = {
        "m/LICENSE": (MIT_FILE, "MIT", "file"),
        "m/notes.txt": (code + MIT_FILE + code, "MIT", "header"),
        "b/x.c": ("/*\n * " + BSD_FILE.format(third="").replace("\n", "\n * ") + code, "BSD-2-Clause", "header"),
        "b3/COPYING": (BSD_FILE.format(third=BSD_THIRD), "BSD-3-Clause", "file"),
        "g/a.py": (GNU_HEADER.format("Example", "", 3) + code, "GPL-3.0", "header"),
        "g/b.py": (GNU_HEADER.format("Example", "", 2) + code, "GPL-2.0", "header"),
        "g/c.py": (GNU_HEADER.format("Example", "Affero ", 3) + code, "AGPL-3.0", "header"),
        "g/d.py": (GNU_HEADER.format("Example", "Lesser ", "2.1") + code, "LGPL-2.1", "header"),
        "t/readme": (code + "\nMIT License\n" + code, "MIT", "header"),
        "t/other": (code + "\nApache License\n" + code, "Apache-2.0", "header"),
        "s/x.rs": ("// SPDX-License-Identifier: MIT\n" + code, "MIT", "header"),
        "s/y.rs": ("/* SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause) */\n" + code,
                   "(GPL-2.0-only OR BSD-3-Clause)", "header"),
        "r/x": (code + "Copyright Foo. All rights reserved.\n" + code, "Proprietary", "header"),
        "w/x": (code + "# This work is licensed under a Creative Commons\n# Attribution-NoDerivatives"
                " 4.0 International License.\n" + code, "CC-BY-ND-4.0", "header"),
        "n/x": (code + "\nLicense\n\nIt has a license.\n", None, "none"),
        "n/y": ("SPDX-License-Identifier: <the id>\n" + code, None, "none"),
    }
    for name, text in licence_texts().items():
        stated[f"whole-{name}/LICENSE"] = (" ".join(text.split()), name, "file")
    rows = [(path, x[0]) for path, x in stated.items()]
    files = llm_spark.createDataFrame(rows, "path string, text string")
    found = {r.path: (r.license, r.found) for r in license_scan(files).collect()}
    assert found == {path: x[1:] for path, x in stated.items()}


PROSE = "<p>The first part of the text is in this block, and it has the words of a sentence.</p>" * 3
PLAIN = "\n".join(["The first part of the text is in this block, and it has the words of a sentence."] * 3)


@pytest.mark.parametrize(
    "wrap",
    [
        "<div class='content has-sidebar'>{}</div>", "<div class='layout-with-sidebar'>{}</div>",
        "<div class='page no-sidebar'>{}</div>", "<form action='/' id='aspnet'>{}</form>",
        "<div class='sidebar-layout'>{}</div>", "<div role='form'>{}</div>",
        "<div class='header-page'><form class='widget-form'>{}</form></div>",
        "<div aria-hidden='true' id='root'>{}</div>", "<nav>Menu<p>{}",
    ],
)
@pytest.mark.parametrize("inner", ["<main>{}</main>", "<article>{}</article>", "<div>{}</div>"])
def test_wrappers_of_a_page_stay(wrap, inner):
    if wrap.startswith("<nav") and "main" not in inner:
        return
    menu = "<nav><a href='/'>Home</a></nav><div class='sidebar'>More of the things to see.</div>"
    page = f"<body>{menu}{wrap.format(inner.format(PROSE))}<div class='cookie-note'>{PROSE}</div></body>"
    menu_of_nav = "Menu\n" if wrap.startswith("<nav") else ""
    assert main_text(page).removeprefix(menu_of_nav) == PLAIN


def test_named_elements_that_are_no_wrapper_go():
    comments = f"<div id='comments'>{PROSE * 9}<article class='comment'>{PROSE}</article></div>"
    related = "<div class='related-posts'><article><p>A story that is of the other kind.</p></article></div>"
    page = f"<body><article>{PROSE}</article>{comments}{related}<form><p>Your name</p></form></body>"
    assert main_text(page) == PLAIN
    assert main_text(f"<div class='consent'>{PROSE}</div><p>x</p>") == ""


def test_headings_and_links_of_an_article_stay():
    page = (
        "<article><h1 class='entry-header'>The title</h1><h2 class='header-two'><a href='#x'>"
        "Its own permalink</a></h2><p>See <a href='/l'>a long reference to the work of an author"
        f"</a> here.</p>{PROSE}<ul><li>One point of the text that has <a href='/y'>a link</a> in it"
        "</li><li><a href='/z'>Second</a></li><li>And the third point of the text, without any."
        "</li></ul><ul><li><a href='/a'>more</a></li><li><a href='/b'>links</a></li></ul></article>"
    )
    assert main_text(page).split("\n") == [
        "The title", "Its own permalink", "See a long reference to the work of an author here.",
        *PLAIN.split("\n"), "One point of the text that has a link in it", "Second",
        "And the third point of the text, without any.",
    ]


def test_texts_come_only_to_members_with_a_pair_left(llm_spark, make_docs, monkeypatch):
    """Copies of a template that are near, but not near enough, move no texts between blocks."""
    from wakeline.llm import near_dedup

    moved = []

    def kept(df, name, whole=near_dedup.written):
        out = whole(df, name)
        if name == "blocks":
            moved.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    monkeypatch.setattr(near_dedup, "CLUSTER", 10)
    monkeypatch.setattr(near_dedup, "written", kept)
    template = [f"w{n}" for n in range(600)]
    rows = [(n, " ".join([*template, *(f"x{n}y{m}" for m in range(330))])) for n in range(60)]
    rows += [(100, rows[0][1]), (101, rows[7][1] + " z")]
    found = near_dedup.near_duplicates(make_docs(rows), 85).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {
        *((n, n) for n in range(60)), (100, 0), (101, 7),
    }
    (columns, count), = moved
    assert "text" not in columns and count < 60


def test_repeated_strings_take_little_memory_at_a_time():
    """Two tasks of an executor fold runs and compare strings side by side."""
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 113, 8_000, np.uint8).tobytes().decode() for _ in range(500)]
    docs = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"]
    )
    rows = len(texts)
    contexts = pa.RecordBatch.from_arrays(
        [
            pa.array(np.sort(np.arange(rows) % 7)), pa.array(range(rows), pa.int64()),
            pa.array(np.zeros(rows, np.int64)), pa.array(np.full(rows, 7_901, np.int32)),
            pa.array([t.encode() for t in texts], pa.binary()),
        ],
        ["rank", "doc_id", "first", "size", "context"],
    )
    limits = ((repeats._folded, docs, 64), (repeats._compared, contexts, 100))
    for step, batch, most_mb in limits:
        tracemalloc.start()
        assert sum(x.num_rows for x in step(iter([batch]))) >= 0
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert peak < most_mb
