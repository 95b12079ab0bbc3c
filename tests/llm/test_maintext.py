"""Main text of pages: hand-made pages, and an independent reading of the given ones."""

from html.parser import HTMLParser

import pytest

from navspark.llm.maintext import blocks_of, classify, extract_text, main_text
from tests.conftest import SF_SMALL

P1="The quick fox that was in the house ran to the river and then it went on to the sea for all of us to look at it as we were there."
P2="It is known that the people of the city have not been in the habit of going to the market on the day that was set by the king."
P3="Nobody in the town would say what they had seen, and it was for this that she left with her son in the night."
CASES = {
'plain div': (f"<html><body><div id='header'><h1>Site</h1><ul><li><a href=/>Home</a><li><a href=/b>About</a></ul></div><div class=content><h2>Title here</h2><p>{P1}<p>Short one.</p><p>{P2}</p></div><div class='sidebar'><h3>More</h3><p>{P3}</p></div><div id=footer>&copy; 2020 Foo. All rights reserved.</div></body>", f"Title here {P1} Short one. {P2}"),
'comments in article': (f"<article><header><h1>T &amp; U</h1><p class=byline>By <a href=x>Ann Bo</a></p></header><p>{P1}</p><p>ok.</p><aside><p>{P2}</p></aside><p>{P3}</p><section class='comments'><h3>3 comments</h3><article class='comment'><p>{P2}</p></article></section></article><footer>f</footer>", f"T & U By Ann Bo {P1} ok. {P3}"),
'main+cookie': (f"<div class='cookie-notice'><p>{P2}</p><button>OK</button></div><main><p>{P1}</p><form><label>Name</label><input><p>{P2}</p></form><p>{P3}</p><div class='share-buttons'><a>Tweet</a></div></main>", f"{P1} {P3}"),
'no containers no class': (f"<body><table><tr><td><a href=1>One</a> <a href=2>Two</a></td><td><p>{P1}</p><p>{P1} {P2}</p>Short tail.<p>{P2} {P1}</p></td></tr></table><p>Copyright © 2001 by the people of the city and all of the others in it.</p>", f"{P1} {P1} {P2} Short tail. {P2} {P1}"),
'unclosed nav': (f"<nav><ul><li><a href=1>x</a><article><p>{P1}</p></article>", P1),
'div comments id': (f"<div class='post-content'><p>{P1}</p></div><div id='comments'><p>{P2}</p></div>", P1),
'article with-sidebar': (f"<div class='layout with-sidebar'><div class='post'><p>{P1} {P2}</p></div></div>", f"{P1} {P2}"),
'li': (f"<article><p>{P1}</p><ul><li>one thing</li><li>two things</li></ul><p>{P2}</p><ul><li><a href=1>rel one</a></li><li><a href=2>rel two</a></li></ul></article>", f"{P1} one thing two things {P2}"),
'script str': ("<article><p>a b</p><script>if(a<b){document.write('<p>x</p>')}</script><style>p{}</style><p>c&nbsp;d &lt;e&gt; &#65;&#x42;</p><!-- <p>no</p> --></article>", "a b c d <e> AB"),
'only short': ("<html><body><nav><a href=1>m</a></nav><p>Hello there.</p></body></html>", "Hello there."),
'pre': (f"<article><h2>Code</h2><pre>x = 1\n  y</pre><p>{P1}</p></article>", f"Code x = 1 y {P1}"),
'empty':("",""),
'inline':(f"<article><p>a<b>b</b>c <i>d</i>e<br>f</p></article>","abc de f"),
'role':(f"<div role=main><p>{P1}</p></div><div role=complementary><p>{P2}</p></div>",P1),
'lt':("<article><p>1 < 2 and 3 > 2</p></article>","1 < 2 and 3 > 2"),
'quote':("<article><p title='a>b'>x</p><p class=\"u>y</p></article>","x y"),
'trunc':("<article><p>x y</p><p>z <a hre","x y z"),
'section':(f"<body><div class='wrapper'><section><h1>Head line</h1><div>{P1} {P2}</div><div>{P3} {P1}</div></section><section class='related-posts'><h2>Related</h2><div>{P2} {P1}</div></section></div>", f"Head line {P1} {P2} {P3} {P1}"),
'de':("<body><div><p>"+"Der Hund ist in dem Haus und die Katze war auch nicht auf der Straße, als es zu regnen begann. "*3+"</p><p>Kurz.</p></div><div><a href=x>Impressum</a> | <a href=y>Datenschutz</a></div>", ("Der Hund ist in dem Haus und die Katze war auch nicht auf der Straße, als es zu regnen begann. "*3).strip()+" Kurz."),
}


@pytest.mark.parametrize("name", CASES)
def test_hand_made_pages(name):
    page, expected = CASES[name]
    assert main_text(page) == expected


def test_second_pass_labels():
    # A short block between prose stays, one between menus goes.
    menu = "<ul><li><a href=1>first entry</a></li><li><a href=2>second entry</a></li></ul>"
    page = f"<div>{menu}<div>Our town</div>{menu}<div>{P1} {P2}</div><div>Yes.</div><div>{P2} {P3}</div></div>"
    blocks = blocks_of(page)
    labels = dict(zip([b.text for b in blocks], classify(blocks)))
    assert not labels["Our town"] and labels["Yes."] and not labels["first entry"]


class Plain(HTMLParser):
    """Text inside ``article``, with a space at every block tag."""

    def __init__(self):
        super().__init__()
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in ("p", "h1", "br", "article"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.handle_starttag("p", [])

    def handle_data(self, data):
        if self.depth:
            self.out.append(data)


def test_given_pages_equal_the_article(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    found = {r["page_id"]: r for r in extract_text(pages).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:
        p = Plain()
        p.feed(r["html"] or "")
        expected = " ".join("".join(p.out).split())
        got = found[r["page_id"]]
        assert (got["url"], got["text"], got["n_chars"]) == (r["url"], expected, len(expected))


def test_odd_rows_and_extra_columns(spark):
    long = "<article>" + f"<p>{P1}</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (None, None, ""), (2, "v", "<article><p>é 😀</p></article>"), (2, "v", "<article><p>é 😀</p></article>"), (3, "w", long), (4, "x", "<" * 50_000), (5, "y", "<a href='" * 20_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS id", "'t' AS text", "map(1, 2) AS n_chars")
    got = sorted((r["page_id"] or 0, r["url"] or "", r["text"], r["n_chars"]) for r in extract_text(df).collect())
    assert got[:4] == [(0, "", "", 0), (1, "u", "", 0), (2, "v", "é 😀", 3), (2, "v", "é 😀", 3)]
    assert got[4][2] == " ".join([P1] * 20_000) and got[4][3] == len(got[4][2])
    assert extract_text(spark.createDataFrame([], df.schema)).collect() == []
    assert extract_text(df).columns == ["page_id", "url", "text", "n_chars"]
