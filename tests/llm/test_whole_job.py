"""Cases that earlier versions of the operators covered only in part."""

from __future__ import annotations

import textwrap

import numpy as np
import pytest
from helpers import components, documents

from earshot.llm import embedding_links, html_text, licenses, secrets

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated \
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the \
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit \
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the \
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE \
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR \
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR \
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that \
the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following \
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following \
disclaimer in the documentation and/or other materials provided with the distribution."""
BSD3 = BSD2 + """
3. Neither the name of the University nor the names of its contributors may be used to endorse or promote products \
derived from this software without specific prior written permission."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in \
compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the \
specific language governing permissions and limitations under the License."""
GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General \
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any \
later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied \
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program."""
GPL2 = GPL3.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2")
FOOBAR = GPL3.replace("This program is free", "This file is part of Foo Bar.\n\nFoo Bar is free")


@pytest.mark.parametrize("mark", ["", "# ", "// ", " * ", ";; ", "! ", "dnl "])
@pytest.mark.parametrize("width", [60, 72, 80])
def test_wrapped_licence_headers(spark, mark, width):
    cases = {
        MIT: "MIT",
        BSD2: "BSD-2-Clause",
        BSD3: "BSD-3-Clause",
        APACHE: "Apache-2.0",
        GPL3: "GPL-3.0-or-later",
        GPL2: "GPL-2.0-or-later",
        FOOBAR: "GPL-3.0-or-later",
    }
    texts = []
    for text in cases:
        lines = [part for line in text.split("\n") for part in textwrap.wrap(line, width) or [""]]
        texts.append("int before;\n" + "\n".join(mark + line for line in lines) + "\n\nint after;\n")
    rows = licenses.scan_licenses(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r["licenses"] for r in rows] == list(cases.values())


def test_spdx_lines(spark):
    cases = {
        "// SPDX-License-Identifier: MIT\nint x;": "MIT",
        "/* SPDX-License-Identifier: Apache-2.0 */\r\nint x;": "Apache-2.0",
        "# SPDX-License-Identifier: GPL-3.0-or-later": "GPL-3.0-or-later",
        "# SPDX-License-Identifier: MITNFA": "",
        "Code is not all\n\nreleased under the\n\nMIT license": "",
        "It is not\nreleased under the MIT license, we think.": "",
    }
    rows = licenses.scan_licenses(documents(spark, list(cases))).orderBy("doc_id").collect()
    assert [r["licenses"] for r in rows] == list(cases.values())


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ('<article><h2 id="related-work">Related work</h2><p class="social-science">a</p></article>', "Related work\na"),
        ('<article><section id="search-algorithms"><p>Binary</p></section></article>', "Binary"),
        ('<article><h2 id="search">Search</h2><p id="notice">b</p><section id="menu"><p>c</p></section></article>', "Search\nb\nc"),
        ('<article><p>see <a href="/item?id=search">this item</a> now</p></article>', "see this item now"),
        ('<article><p>see <a data-id="ad-5" data-class="ad">this</a> now</p></article>', "see this now"),
        ('<article><p title=\'class="ad"\'>text</p><div class="header-files">stdio</div></article>', "text\nstdio"),
        ("<article><p>a</p><div class='x Ad_Slot'>buy</div><div CLASS = related-posts>b</div></article>", "a"),
        ('<article><p>a</p><ul role=navigation><li>b</ul><div id="cookie-notice">c</div></article>', "a"),
        ('<article><p>a</p><div class="post ad">b</div><p class="ad">c</p></article>', "a"),
    ],
)
def test_common_words_in_names_are_no_noise(html, expected):
    assert "\n".join(text for text, _ in html_text.parse_page(html)[0]) == expected


@pytest.mark.parametrize(("leaf_rows", "block"), [(1000, 2000), (30, 20)])
def test_embeddings_of_several_lengths(spark, leaf_rows, block):
    draw = np.random.default_rng(4)
    found = []
    for dims, n in ((16, 60), (8, 40), (3, 1)):
        base = draw.normal(size=(n, dims))
        found += [*base, *(base + 0.02 * draw.normal(size=base.shape)), *base]
    found = [found[i] for i in draw.permutation(len(found))]
    expected = [
        [
            j
            for j, y in enumerate(found)
            if i != j and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9
        ]
        for i, x in enumerate(found)
    ]
    rows = [(i, [float(c) for c in x]) for i, x in enumerate(found)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = embedding_links.link_vectors(table, leaf_rows=leaf_rows, block=block).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == {i: len(x) for i, x in enumerate(expected)}
    pairs = [(i, j) for i, x in enumerate(expected) for j in x]
    assert {r["vec_id"]: r["component_id"] for r in got} == components(range(len(found)), pairs)


# Put together here, so that no scanner takes this file for a leak.
PUBLISHED = {
    "jwt": ".".join(
        [
            "eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9",
            "eyJzdWIiOiIxMjM0NTY3ODkwIiwibmFtZSI6IkpvaG4gRG9lIiwiaWF0IjoxNTE2MjM5MDIyfQ",
            "SflKxwRJSMeKKF2QT4fwpMeJf36POk6yJV_adQssw5c",
        ]
    ),
    "sendgrid": "SG." + "ngeVfQFYQlKU0ufo8x5d1A" + "." + "TwL2iGABf9DHoTf-09kqeF8tAmbihYzrnopKc-1s5cr",
    "slack": "xoxb-" + "123456789012-1234567890123-" + "AbCdEfGhIjKlMnOpQrStUvWx",
    "github": "ghp_" + "16C7e42F292c6912E7710c838347Ae178B4a",
}


@pytest.fixture(scope="module")
def automata():
    return secrets.learn_all(secrets.labelled_examples())


@pytest.mark.parametrize("kind", list(PUBLISHED))
@pytest.mark.parametrize("frame", ["see {} there", "{}.", "https://{}@github.com/a", "https://x:{}@h/a", "a/{}/path", "a={}&b"])
def test_published_tokens_also_in_urls(automata, kind, frame):
    token = PUBLISHED[kind]
    text = frame.format(token)
    assert secrets.added_spans(text, automata) == [(kind, text.index(token), text.index(token) + len(token))]
