from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from earshot.llm import html_text

SCHEMA = "page_id long, url string, html string"


def text_of(html):
    return "\n".join(text for text, _ in html_text.parse_page(html)[0])


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("a < b &lt;p&gt; &copy 2024 &#233;&#xe9; &amp;lt;", "a < b <p> © 2024 éé &lt;"),
        ("<article><h1>T</h1><p>one\n  two<p><b>three<br>four<p>five</article>tail", "T\none two\nthree four\nfive"),
        ("<nav>menu</nav><p>text</p><footer>foot</footer><aside>side</aside>", "text"),
        ('<article><p>a</p><div class="ad">buy</div><div id="comments"><p>c</p></div><p>b</article>', "a\nb"),
        ("<script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes", "yes"),
        ("<form><p>field</p></form><p>text</p><template><p>no</p></template>", "text"),
        ("<p>cut <a href='x", "cut"),
        ('<p title="a > b">ok</p>', "ok"),
        ("<p>one<p>one<p>one", "one\none\none"),
        ("<ul><li>x<li>y</ul><table><tr><td>1<td>2</table>", "x\ny\n1\n2"),
        ("<div class=cookie-notice>accept</div><main><p>main</p></main><p>outside", "main"),
        ("<p>&am", "&am"),
        ("<title>title</title><p>text", "text"),
        ("<p>" + "w " * 30_000, ("w " * 30_000).strip()),
    ],
)
def test_main_text_of_one_page(html, expected):
    assert text_of(html) == expected


def site(n, host="https://a.example.org"):
    return [
        (i, f"{host}/{i}", f"<body><div><p>Welcome to our site</p></div><p>Story {i} is told</p><div>Imprint</div></body>")
        for i in range(n)
    ]


def test_recurring_subtrees_of_a_host_are_deleted(spark):
    rows = site(30) + [(100, "https://b.example.org/1", site(1)[0][2])]
    got = {r["page_id"]: r for r in html_text.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i]["text"] == f"Story {i} is told" for i in range(30))
    assert got[5]["n_template_subtrees"] == 3
    # The other host has one page only, so nothing recurs there.
    assert got[100]["text"] == "Welcome to our site\nStory 0 is told\nImprint"
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_copies_of_a_page_are_no_template(spark):
    rows = [(i, "https://a.example.org/x", "<body><p>Same page</p></body>") for i in range(50)]
    got = html_text.extract_text(spark.createDataFrame(rows, SCHEMA)).select("text").distinct().collect()
    assert [r["text"] for r in got] == ["Same page"]


def test_an_article_is_never_a_template(spark):
    rows = [
        (i, "https://a.example.org/x", f"<div>Top</div><article><p>All rights reserved.</p><p>{i}</p></article>")
        for i in range(50)
    ]
    got = html_text.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r["text"] == f"All rights reserved.\n{r['page_id']}" for r in got)


def test_awkward_rows(spark):
    rows = [(1, None, None), (None, "no url", ""), (2, "HTTP://A.example.ORG", "<p>x"), (2, "HTTP://A.example.ORG", "<p>x")]
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("host", F.lit(3)).withColumn("text", F.lit("t"))
    got = html_text.extract_text(pages)
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got.collect()) == [
        (0, "", 0),
        (1, "", 0),
        (2, "x", 1),
        (2, "x", 1),
    ]
    assert html_text.extract_text(pages.limit(0)).count() == 0
