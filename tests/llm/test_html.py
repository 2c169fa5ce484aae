from __future__ import annotations

import time

import pytest

from shelfcast.llm.html import STARTER, Node, blocks_of, decode, elements, extract_text, fit_pages_trees, main_texts, parse

import numpy as np

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/a'>Home</a></li>"
    "<li><a href='/b'>News</a></li></ul></nav><!-- x --><div class='ad'>Buy these shoes\nnow.</div><article><h1>{t}</h1><p><b>{t}, it was said.<br><p>{a}</p>"
    "<p>{b}</p></article><footer>&copy; {t}</footer></body></html>"
)
LINE = "The {n} day began with rain, and the road to the {n} village was long &amp; empty. Nobody came."


@pytest.fixture(scope="module")
def trees():
    return fit_pages_trees([PAGE.format(t=f"Story {n}", a=LINE.format(n=n), b=LINE.format(n=n + 1) * (1 + n % 4)) for n in range(60)])


def test_given_layout(trees):
    page = PAGE.format(t="One  &lt;b&gt;", a=LINE.format(n=3), b="Short.")
    assert main_texts([page], trees) == ["One <b>\n\nOne <b>, it was said.\n\n" + LINE.format(n=3).replace("&amp;", "&") + "\n\nShort."]


def test_other_layouts(trees):
    page = (
        "<body><div class='site-header'><a href=/>Home</a><a>News</a></div><div id=wrapper><div class='cookie-notice'>We use cookies here. <button>OK</button></div>"
        "<div class='post'><h1>By the sea</h1><p>We went down to the sea in the morning, and it was cold and grey. Nobody spoke.</p><div class='ad'>Cheap shoes</div>"
        "<p>Later the sun came out, and we had tea in the small house. It was a good day.</p></div><div id='sidebar'><ul><li><a>Other trip</a></li></ul></div>"
        "<section class='comments'><div class='comment'><p>Great post, I loved reading this, thanks a lot for writing it down.</p></div></section>"
        "<form><label>Search</label><input></form></div><footer>Copyright</footer></body>"
    )
    assert main_texts([page], trees) == [
        "By the sea\n\nWe went down to the sea in the morning, and it was cold and grey. Nobody spoke.\n\nLater the sun came out, and we had tea in the small house. It was a good day."
    ]


def test_markup():
    texts = {
        "a<br>b": ["a b"], "<p>a<p>b": ["a", "b"], "<ul><li>a<li>b</ul>c": ["a", "b", "c"], "<b>a</b> <i>b</i>c": ["a bc"], "x<script>1<2</script>y": ["xy"],
        "<p>a</div>b</p>": ["ab"], "a<!-- <p>z -->b": ["ab"], "a < b": ["a < b"], "&eacute;&#233;&#xe9;&nbsp;&amp;amp;": ["ééé &amp;"], "<p title='a>b'>c": ["c"], "<p>a\n\t b  </p>\n<p> </p>": ["a b"],
        "<p data-x=it's>a, don't</p><p>b</p>": ["a, don't", "b"], '<a href="x>link</a>': ["link"], '<a href="x>a</a><b id="y">c</b>': ["c"], "<p title='it": ["<p title='it"],
        "a<a href=x/>b</a>c<br/>d": ["abc d"], "<p a='1'b=\"2\">c": ["c"], "a</>b</ x>c": ["abc"], "<!-->a<!--->b": ["ab"], "a<![CDATA[b]]>c": ["ac"], "<svg><path d='z'/></svg>a": ["a"],
        "a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> b": ["a x=1 b"], "<p a='>'>b<p a='>c": ["b", "c"],
        "<textarea>z</textarea>a": ["a"], "<table><tr><td>a<td>b<tr><td>c</table>": ["a", "b", "c"], "a<script>unended": ["a"], "<!-- unended": [],
    }
    assert {t: blocks_of(parse(t)) for t in texts} == texts


def test_hostile_pages_take_linear_time():
    """Twice the page takes about twice the time; anything that grows with the square would take four times."""
    kinds = ["<div>", "<ul><li>", "<table><tr><td>", "<a href='x>t", "<a b='>' ", "<![CDATA[", "<!x", "<a x "]
    for kind in kinds:
        spent = []
        for n in (20_000, 80_000):
            start = time.process_time()
            nodes = elements(parse("<p><table><tr><td>" + kind * n + "deep"))
            decode(nodes, np.zeros(len(nodes)))
            blocks_of(nodes[0])
            spent.append(time.process_time() - start)
        assert spent[1] < 9 * spent[0] + 0.3, kind


def test_decoding_never_contradicts():
    draw = np.random.Generator(np.random.PCG64(4))
    nodes = [Node("div", (), None)]
    for _ in range(200):
        child = Node("div", (), nodes[draw.integers(len(nodes))])
        child.parent.children.append(child)
        nodes.append(child)
    nodes = elements(nodes[0])
    odds = draw.normal(0, 3, len(nodes))
    decode(nodes, odds)
    assert all(n.parent is None or n.parent.keep or not n.keep for n in nodes)
    small = elements(parse("<div><p>a</p><p>b</p></div>"))
    decode(small, np.array([9.0, -1.0, 0.4, 0.4]))
    assert [n.keep for n in small] == [True, False, False, False]
    decode(small, np.array([9.0, -1.0, 0.7, 0.7]))
    assert [n.keep for n in small] == [True, True, True, True]


def test_odd_rows(spark, trees):
    assert main_texts([None, "", "just text &amp; more", "<p>", "<" * 3000, "<div>" * 3000 + "deep", STARTER], trees)[:4] == ["", "", "just text & more", ""]
    rows = [(1, None, None, 5), (None, "u", "", 6), (2, "u", STARTER, 7), (2, "u", STARTER, 7), (3, "u", "x " * 100_000, 8)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")  # a column with the result's name is replaced
    got = extract_text(pages).collect()
    assert len(got) == 5 and sorted(len(r["text"]) for r in got)[:2] == [0, 0] and max(len(r["text"]) for r in got) == 199_999
    assert len({r["text"] for r in got if r["page_id"] == 2}) == 1
    assert extract_text(pages.where("false")).count() == 0
