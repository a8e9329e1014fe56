"""Main texts against hand-made pages and against the standard library's parser on the given pages."""

import random
from html.parser import HTMLParser

import pytest

from pricelab.llm import html_wrappers as hw

SCHEMA = "page_id long, url string, html string, host string, wrapper string, text string, part int"


def make(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z", 1) for i, u, h in rows], SCHEMA).repartition(3)


def texts(html):
    return "\n".join(hw.main_texts(hw.read_page(html)))


class Article(HTMLParser):
    """Blocks of the article element of the generated pages, by the standard library's tokenizer."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in hw.extract_text(pages).collect()}
    rows = pages.collect()
    assert len(rows) == len(got)
    for r in rows:
        parser = Article()
        parser.feed(r["html"])
        parser.close()
        want = "\n".join(b for b in (" ".join(x.split()) for x in parser.blocks) if b)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want) and got[r["page_id"]]["url"] == r["url"]


@pytest.mark.parametrize("html, want", [
    ("", ""),
    ("plain &lt;text&gt; &amp;amp; &#233;&eacute;\n\t x", "plain <text> &amp; éé x"),
    ("<p>a<br>b<p>c <b>d</b>e<div>f</div>g</p>h", "a b\nc de\nf\ng\nh"),
    ("<main><ul><li>1<li>2</ul></main><p>out", "1\n2"),
    ("<body><header><h1>Site</h1></header><article><header><h1>Title</h1><p>by me</p></header><p>Body.</p><aside>ad</aside><form><p>f</p></form>"
     "<section class='comments'><article><p>reader</p></article></section></article><footer>x</footer>", "Title\nBody."),
    ("<div id=cookieNotice>We use</div><div class='main-content'><p>One</p><p>Two</p><div class=share-links>s</div></div><div class='sidebar2'>x</div>", "One\nTwo"),
    ("<div class='layout with-sidebar'><div class=post><p>Kept</p></div><div class=sidebar>no</div></div>", "Kept"),
    ("<article><p title=\"a>b\" data-x='<p>'>x<!-- <p>no</p> --><script>var a='</p>';</script><style>p{}</style>y</p><p hidden>no</p><p style='display: none'>no</p>", "xy"),
    ("<article><p>cut <a href='x", "cut"),
    ("<article><p>3 < 4 & 5 > 2</p><table><tr><td>a<td>b</table></article>", "3 < 4 & 5 > 2\na\nb"),
    ("<nav><a href=/>Home</a></nav>", ""),
    ("<div>" * 500 + "deep" + "</div>" * 500, "deep"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\nd\nu\ne"),
])
def test_single_pages(html, want):
    assert texts(html) == want


def bare(i, middle, extra="", k="k"):
    """A page without any telling name: the host's frame has fixed texts."""
    return f"<div class={k}1>Example site of many things</div>{extra}<div class={k}2><h2>Title {i}</h2>{middle}</div><div class={k}3>All rights kept by the example site</div>"


@pytest.mark.parametrize("k", ["k", "k123"])
def test_fixed_texts_of_a_host_go(spark, monkeypatch, k):
    """Also where the elements of the frame have the same name (numbers are left out of names)."""
    monkeypatch.setattr(hw, "FOLD", 2)
    paragraphs = lambda i: "".join(f"<p>Paragraph {j} of page {i} is about something else.</p>" for j in range(i % 4 + 1))
    rows = [(i, f"http://Frame.example.com/{i}", bare(i, paragraphs(i), "<div class=k9>Try our app</div>" if i % 2 else "", k)) for i in range(12)]
    rows += [(100, "https://single.example.org/", bare(7, paragraphs(3))), (None, None, None), (101, "no host", "<p>x</p>"), (102, "http://e.example.org", ""), (3, rows[3][1], rows[3][2])]
    copies = [(200 + i, "http://copies.example.com/", bare(1, paragraphs(2))) for i in range(5)]
    got = {}
    for r in hw.extract_text(make(spark, rows + copies)).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    for i in range(12):
        want = "\n".join([f"Title {i}"] + [f"Paragraph {j} of page {i} is about something else." for j in range(i % 4 + 1)])
        assert got[i] == [want] * (2 if i == 3 else 1)
    assert got[None] == [""] and got[101] == ["x"] and got[102] == [""]
    assert "Paragraph 0 of page 3" in got[100][0]  # a host of one page has no fixed texts
    assert all("Paragraph 1 of page 2" in got[200 + i][0] for i in range(5))  # copies of one page lose nothing


def test_wrappers_have_optional_and_repeated_groups():
    pages = ["<h1>a</h1>" + "<h2>x</h2><p>y</p>" * n + extra for n, extra in [(1, ""), (3, ""), (2, "<ul><li>1<li>2</ul>"), (0, "")]]
    wrapper = hw.fold_all([hw.stream_of(hw.read_page(p)) for p in pages])
    assert [hw.name(x) for x in wrapper] == ["h1", "(h2 p)", "ul"]
    assert wrapper[1]["r"] and wrapper[1]["o"] and wrapper[2]["o"] and "o" not in wrapper[0]
    assert wrapper[0]["c"] == [{"t": hw.stream_of(hw.read_page("a"))[0]["t"], "n": 4}]


def test_empty_table(spark):
    assert hw.extract_text(make(spark, [])).collect() == []


@pytest.mark.parametrize("kinds", [2, 5, 60])
def test_long_sequences_are_aligned_as_short_ones(monkeypatch, kinds):
    rng = random.Random(kinds)
    for size in (1, 7, 30, 120):
        for _ in range(6):
            a, b = ([str(rng.randrange(kinds)) for _ in range(rng.randint(0, size))] for _ in range(2))
            b = b + a[: len(a) // 2] if rng.random() < 0.5 else b
            monkeypatch.setattr(hw, "ALIGN_CELLS", 10**9)
            want = hw.matches(a, b)
            monkeypatch.setattr(hw, "ALIGN_CELLS", 0)
            assert hw.matches(a, b) == want
