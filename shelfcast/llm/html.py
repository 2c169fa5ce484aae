"""Main text of web pages: boosted trees over DOM-node features with hierarchical decoding.

Every element of a page gets features: its depth, the text, links and tags below it, the tokens of its tag and of its class,
id and role attributes, those of its ancestors, and how it compares with its siblings. Boosted trees turn them into the odds
that the element holds main text. The elements to keep are then the most likely choice in which everything below a dropped
element is dropped and everything above a kept one is kept, so that ancestor and descendants never contradict each other.

The trees are fitted to at most ``fit_pages`` pages which name their article by an element, drawn by hash. So that they do not
lean on that name, each page is also used in variants: elements are renamed to plain ones with telling attributes, or without
any, and boxes of every common kind are put around and into the article. A table without such pages is read with the trees
of a built-in page.

Text: character references decoded, white space inside a block made one space, blocks joined by a blank line. Scripts,
styles, forms' controls and comments are no text; formulas are, without their annotations.

Defined results: null or empty html gives an empty text; html without any tag is one block; broken markup is read as browsers
do, as far as it matters here: paragraphs and list items end where the next begins, ends without begin are skipped, quotes
inside names and unquoted values of attributes open nothing, a quoted value runs to the next such quote. Where a tag would so
run to the end of the page, it and all later ones end at their first ``>`` instead, so that no text is lost; a tag without
any is text. Pages are read whole, in time in proportion to their length however deep they are nested; equal pages give equal
texts, elements as likely dropped as kept are kept; an empty table stays empty; other columns are carried along, one that has
the name of the result is replaced by it.
"""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.boosting import Trees, fit_trees
from shelfcast.llm.store import arrow_rows

MARKUP = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*+)|[!?]|/[^a-zA-Z])")
#: What follows a tag's name: its end, or an attribute with an unquoted value, the quote that opens one, or none.
ATTRIBUTE = re.compile(r"[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:([\"'])|([^\s>]*+)))?+)")
COMMENT_END = re.compile("--!?>")
TOKEN = re.compile(r"[a-z]+")
SPACE = re.compile(r"[ \t\n\r\f\v ]+")
#: Element names by role.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
NO_TEXT = RAW | frozenset("head template svg annotation annotation-xml button select option optgroup object canvas audio video map datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul hr".split()
)
ENDS_BEFORE = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
}
TAGS = "p div section article main nav header footer aside form ul li a h1 h2 table td blockquote figure pre body".split()
#: Attribute tokens that tell what a box is for.
GOOD = frozenset("article articlebody content contents entry post story text body main page blog news paragraph prose".split())
BAD = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs skip topbar toolbar",
    "edge": "header masthead footer foot bottom colophon copyright legal banner logo branding",
    "side": "sidebar side aside rail widget related recommended recommendations trending popular more promo teaser tags author bio meta",
    "ad": "ad ads advert adverts advertisement sponsor sponsored sponsors dfp adsense outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup paywall message",
    "talk": "comment comments commentlist commentform reply replies respond discussion disqus thread reader readers feedback review reviews",
    "form": "form search login register contact poll survey share sharing social",
}
BAD_TOKENS = {t: i for i, words in enumerate(BAD.values()) for t in words.split()}
BASIC = 15
FEATURES = BASIC + len(TAGS) + 2 * (1 + len(BAD)) + 8


class Node:
    __slots__ = ("tag", "tokens", "children", "parent", "keep", "main")

    def __init__(self, tag: str, tokens: tuple[str, ...], parent: Node | None):
        self.tag, self.tokens, self.parent = tag, tokens, parent
        self.children: list[Node | str] = []
        self.keep = True
        self.main = False


NAMING = frozenset("class id role itemprop aria-label".split())


def _tokens(attributes: list[tuple[str, str]]) -> tuple[str, ...]:
    found: list[str] = []
    for name, value in attributes:
        if name.lower() in NAMING:
            found += TOKEN.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
    return tuple(found)


class _Markup:
    """Reads the tags of a page. ``loose``: a tag ran to the end of the page, so all end at their first ``>`` from there on."""

    def __init__(self, page: str):
        self.page, self.loose = page, False

    def tag(self, at: int) -> tuple[int, list[tuple[str, str]], bool]:
        """From the end of a tag's name: where the tag ends (-1: nowhere), its attributes, and whether it closes itself."""
        page, found, to = self.page, [], at
        if page.startswith(">", at):
            return at + 1, found, False
        while not self.loose:
            m = ATTRIBUTE.match(page, to)
            if m is None:
                self.loose = True
            elif m[1]:
                return m.end(), found, m.end() - m.start() > 1 and page[m.end() - 2] == "/"
            elif m[3]:
                to = page.find(m[3], m.end()) + 1
                self.loose = to == 0
                found.append((m[2], page[m.end() : to - 1]))
            else:
                to = m.end()
                found.append((m[2], m[4] or ""))
        end = page.find(">", at)
        return end + 1 if end >= 0 else -1, [], end >= 0 and page[end - 1] == "/"

    def comment(self, at: int) -> int:
        """Where the comment or declaration ends that starts at ``at``; -1 if nowhere."""
        page = self.page
        if page.startswith("<!--", at):
            m = COMMENT_END.search(page, at + 2)
            return m.end() if m else len(page)
        if page.startswith("<![CDATA[", at):
            end = page.find("]]>", at)
            return end + 3 if end >= 0 else len(page)
        return page.find(">", at) + 1 or -1


class _Open:
    """The open elements, and where those of each name lie among them."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], {}

    def open(self, tag: str, tokens: tuple[str, ...]) -> Node:
        node = Node(tag, tokens, self.nodes[-1])
        self.nodes[-1].children.append(node)
        self.places.setdefault(tag, []).append(len(self.nodes))
        self.nodes.append(node)
        return node

    def innermost(self, tag: str) -> int:
        """0 if no element of that name is open."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def close(self, tag: str, limits: tuple[str, ...] = ()) -> None:
        """End the innermost open element of that name, unless one of the limits is open inside it."""
        place = self.innermost(tag)
        if place and all(self.innermost(limit) < place for limit in limits):
            while len(self.nodes) > place:
                self.places[self.nodes.pop().tag].pop()


def parse(page: str) -> Node:
    """The page's elements as a tree, texts undecoded."""
    root = Node("html", (), None)
    stack, markup = _Open(root), _Markup(page)
    at, end = 0, len(page)
    search = MARKUP.search
    while at < end:
        m = search(page, at)
        if m is None:
            stack.nodes[-1].children.append(page[at:])
            break
        attributes, selfclosed = [], False
        if m[2] is None:
            to = markup.comment(m.start())
        else:
            to, attributes, selfclosed = markup.tag(m.end())
        if to < 0:  # no ">" follows anywhere
            stack.nodes[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack.nodes[-1].children.append(page[at : m.start()])
        at = to
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            stack.close(tag)
            continue
        if tag in ("html", "body"):
            if tag == "body" and not stack.innermost("body"):
                stack.close("head")
                stack.open(tag, _tokens(attributes))
            continue
        if tag in BLOCKS:
            stack.close("head")
            stack.close("p", ("table", "td", "th", "button"))
            if tag in ENDS_BEFORE:
                names, limits = ENDS_BEFORE[tag]
                for name in names.split():
                    stack.close(name, limits)
        node = stack.open(tag, _tokens(attributes))
        if tag in VOID or selfclosed and tag not in BLOCKS and tag not in RAW:
            stack.close(tag)
        elif tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            node.children.append(page[at : close.start()] if close else page[at:])
            stack.close(tag)
            shut = page.find(">", close.end()) if close else -1
            at = shut + 1 if shut >= 0 else end
    return root


def elements(root: Node) -> list[Node]:
    """All elements that can hold text, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.children) if not isinstance(c, str) and c.tag not in NO_TEXT]
    return out


def _kinds(node: Node) -> list[int]:
    """Which kinds of tokens the element has: 0 good, 1.. bad kinds. A semantic element counts like its token."""
    kinds = [0] * (1 + len(BAD))
    name = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "menu": "menu", "dialog": "modal", "article": "article", "main": "main"}.get(node.tag)
    for t in (*node.tokens, name) if name else node.tokens:
        if t in BAD_TOKENS:
            kinds[1 + BAD_TOKENS[t]] = 1
        elif t in GOOD:
            kinds[0] = 1
    return kinds


def features(nodes: list[Node]) -> np.ndarray:
    """One row for each element, in the order of ``elements``."""
    n = len(nodes)
    place = {id(x): i for i, x in enumerate(nodes)}
    parent = [place[id(x.parent)] if x.parent is not None else 0 for x in nodes]
    text, links, tags, words, depth, stops = ([0] * n for _ in range(6))
    paragraphs, own = [0] * n, [0] * n
    kinds = [_kinds(x) for x in nodes]
    above = [[0] * (1 + len(BAD))] * n
    for i, x in enumerate(nodes):
        if i:
            depth[i] = depth[parent[i]] + 1
            above[i] = [a | b for a, b in zip(above[parent[i]], kinds[parent[i]])] if any(kinds[parent[i]]) else above[parent[i]]
        for c in x.children:
            if isinstance(c, str):
                length = len(c.strip())
                own[i] += length
                if length:
                    words[i] += c.count(" ") + 1
                    stops[i] += c.count(". ") + c.count(", ")
        text[i] = own[i]
    for i in range(n - 1, 0, -1):
        p, x = parent[i], nodes[i]
        if x.tag == "a":
            links[i] = text[i]
        text[p] += text[i]
        links[p] += links[i]
        words[p] += words[i]
        stops[p] += stops[i]
        tags[p] += tags[i] + 1
        paragraphs[p] += paragraphs[i] + (x.tag == "p" and text[i] > 40)
    whole = max(1, text[0])
    inner: dict[int, list[int]] = {}
    for i in range(1, n):
        inner.setdefault(parent[i], []).append(i)
    rows = np.zeros((n, FEATURES))
    tag_place = {t: k for k, t in enumerate(TAGS)}
    for p, group in inner.items():
        size = len(group)
        mean = sum(text[i] for i in group) / size
        linky = sum(2 * links[i] > text[i] for i in group) / size
        most = max(text[i] for i in group)
        same: dict[str, int] = {}
        for i in group:
            same[nodes[i].tag] = same.get(nodes[i].tag, 0) + 1
        for k, i in enumerate(group):
            rows[i, -8:] = (size, same[nodes[i].tag] / size, k / size, mean, text[i] / (mean + 1), linky, text[i] == most, text[p])
    for i, x in enumerate(nodes):
        t = text[i]
        good, bad = kinds[i][0] or above[i][0], any(kinds[i][1:]) or any(above[i][1:])
        rows[i, :BASIC] = (
            depth[i], t, links[i] / (t + 1), t / (tags[i] + 1), words[i], stops[i] / (words[i] + 1), tags[i], paragraphs[i], t / whole, own[i], own[i] / (t + 1), len(x.tokens), t / (words[i] + 1), bad, good and not bad,
        )
        if x.tag in tag_place:
            rows[i, BASIC + tag_place[x.tag]] = 1
        at = BASIC + len(TAGS)
        rows[i, at : at + 1 + len(BAD)] = kinds[i]
        rows[i, at + 1 + len(BAD) : at + 2 + 2 * len(BAD)] = above[i]
    return rows


def decode(nodes: list[Node], odds: np.ndarray) -> None:
    """Set ``keep`` on every element: the likeliest choice without a kept element below a dropped one."""
    n = len(nodes)
    place = {id(x): i for i, x in enumerate(nodes)}
    keep = -np.logaddexp(0, -odds)
    drop = -np.logaddexp(0, odds)
    best_kept, best_dropped = keep.tolist(), drop.tolist()
    for i in range(n - 1, 0, -1):
        p = place[id(nodes[i].parent)]
        best_kept[p] += max(best_kept[i], best_dropped[i])
        best_dropped[p] += best_dropped[i]
    for i, x in enumerate(nodes):
        x.keep = i == 0 or x.parent.keep and best_kept[i] >= best_dropped[i]


def blocks_of(root: Node) -> list[str]:
    """The kept texts in page order, one for each block."""
    done: list[str] = []
    run: list[str] = []

    def flush() -> None:
        joined = SPACE.sub(" ", html.unescape("".join(run))).strip(" ")
        if joined:
            done.append(joined)
        run.clear()

    todo: list[Node | str | None] = [root]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag == "br":
            run.append(" ")
        elif x.tag not in NO_TEXT and x.keep:
            if x.tag in BLOCKS:
                flush()
                todo.append(None)
            todo += reversed(x.children)
    flush()
    return done


# Training pages


#: Boxes of boilerplate, as the kinds and names that pages use for them.
BOXES = [
    ("nav", "menu main-nav navbar navigation breadcrumbs"), ("div", "menu top-menu navbar breadcrumb pagination"),
    ("header", "site-header masthead banner"), ("div", "header masthead banner site-header"),
    ("footer", "site-footer footer"), ("div", "footer page-footer copyright bottom legal"),
    ("aside", "sidebar widget related"), ("div", "sidebar side-bar widget right-rail related related-posts recommended popular trending"),
    ("div", "ad ads advert advertisement ad-slot sponsored promo"), ("section", "ad advertisement promo sponsored"),
    ("div", "cookie cookie-notice consent gdpr-banner notice alert newsletter subscribe popup modal"),
    ("section", "comments comment-list discussion replies reader-comments"), ("div", "comments comment-thread disqus reviews replies"),
    ("ul", "comments commentlist comment-list"), ("ol", "commentlist comments"),
    ("form", "search login contact newsletter-form comment-form"), ("div", "search-form login share share-buttons social poll"),
    ("p", "notice ad legal copyright"),
]
ARTICLE_NAMES = [("div", "article post-content"), ("div", "content entry-content"), ("div", "story main"), ("section", "post"), ("main", ""), ("article", ""), ("div", ""), ("article", "post")]
STARTER = (
    "<html><body><header><a href='/'>Home</a></header><nav><ul><li><a>News</a></li><li><a>About us</a></li></ul></nav><article><h1>A day by the "
    "lake</h1><p>We left early, before the fog had gone, and walked along the shore. Nobody was out yet, and the water lay still.</p><p>At noon "
    "the wind came up. We ate in the shade of the trees, talked about the week behind us, and watched the boats.</p><p>It was late, and dark, "
    "when we were home again.</p></article><footer>&copy; All rights reserved.</footer></body></html>"
)


def _strings(node: Node) -> list[str]:
    out = []
    for x in elements(node):
        out += [c.strip() for c in x.children if isinstance(c, str) and len(c.strip()) > 3]
    return out


def _box(draw: random.Random, boiler: list[str], prose: list[str]) -> Node:
    tag, names = draw.choice(BOXES)
    kind = names.split()
    box = Node(tag, tuple(TOKEN.findall(draw.choice(kind))) if tag in ("div", "section", "p", "ul", "ol") or draw.random() < 0.5 else (), None)
    talk = any(t in BAD["talk"].split() for t in box.tokens)
    for _ in range(1 if tag == "p" else draw.randint(1, 6)):
        inner = draw.choice(["p", "div", "li"] if talk else ["a", "p", "div", "li", "span"])
        child = Node(inner, ("comment",) if talk and draw.random() < 0.6 else (), box)
        words = draw.choice(prose if prose and (talk or draw.random() < 0.3) else boiler or prose or ["More"])
        start = draw.randrange(max(1, len(words) // 2))
        part = words[start : start + draw.choice([20, 60, 200] if talk else [12, 40, 120])]
        if not talk and inner in ("li", "div", "a") and draw.random() < 0.7:
            link = Node("a", (), child)
            link.children.append(part)
            child.children.append(link)
        else:
            child.children.append(part)
        box.children.append(child)
    return box


def _insert(into: Node, box: Node, at: int) -> None:
    box.parent = into
    into.children.insert(at, box)


def _main_element(root: Node) -> Node | None:
    for name in ("article", "main"):
        found = [x for x in elements(root) if x.tag == name]
        if found:
            return max(found, key=lambda x: sum(map(len, _strings(x))))
    return None


def _variant(page: str, draw: random.Random, plain: bool) -> tuple[np.ndarray, np.ndarray] | None:
    root = parse(page)
    main = _main_element(root)
    if main is None or not _strings(main):
        return None
    inside = elements(main)
    within = {id(x) for x in inside}
    boiler = [s for x in elements(root) if id(x) not in within for s in [c.strip() for c in x.children if isinstance(c, str)] if len(s) > 3]
    prose = [s for s in _strings(main) if len(s) > 40]
    for x in inside:
        if x is main or x.tag not in ("nav", "menu", "footer", "aside", "form") and not any(t in BAD_TOKENS for t in x.tokens):
            x.main = x.parent.main if x is not main else True
    up = main.parent
    while up is not None:
        up.main = True
        up = up.parent
    if not plain:
        main.tag, names = draw.choice(ARTICLE_NAMES)
        main.tokens = tuple(TOKEN.findall(names))
        for x in elements(root):
            if not x.main and x.tag in ("nav", "header", "footer", "aside") and draw.random() < 0.4:
                x.tokens = (x.tag,) if draw.random() < 0.7 else ()
                x.tag = "div"
            elif x.main and x is not main and x.tag == "p" and draw.random() < 0.15:
                x.tag = draw.choice(["div", "blockquote", "pre", "h2", "h3", "li", "td", "figcaption", "section"])
            elif x.main and x.tag == "h1" and x.parent is main and draw.random() < 0.3:
                head = Node(draw.choice(["header", "div"]), draw.choice([(), ("title",), ("entry", "header")]), main)
                head.main = True
                main.children[[c is x for c in main.children].index(True)] = head
                head.children, x.parent = [x], head
        around = main.parent or main
        if draw.random() < 0.1:  # nothing but the article, or the start of it
            keep = main.children[: draw.choice([1, 2, 4, len(main.children)])]
            main.children = keep
            if draw.random() < 0.5 and around is not main:
                around.children = list(keep)
                for c in keep:
                    if not isinstance(c, str):
                        c.parent = around
            else:
                around.children = [main] if around is not main else keep
        elif around is not main:
            if draw.random() < 0.4:  # a wrapper of the whole page, or of the article alone
                wrapper = Node("div", draw.choice([(), ("container",), ("wrapper",), ("page",)]), around)
                wrapper.main = True
                if draw.random() < 0.5:
                    wrapper.children, around.children = around.children, [wrapper]
                    for c in wrapper.children:
                        if not isinstance(c, str):
                            c.parent = wrapper
                else:
                    around.children[[c is main for c in around.children].index(True)] = wrapper
                    wrapper.children, main.parent = [main], wrapper
                around = wrapper
            for _ in range(draw.randint(0, 5)):
                _insert(around, _box(draw, boiler, prose), draw.randint(0, len(around.children)))
        for _ in range(draw.choice([0, 0, 1, 2]) if main.children else 0):
            _insert(main, _box(draw, boiler, prose), draw.choice([len(main.children), draw.randint(0, len(main.children))]))
    nodes = elements(root)
    return features(nodes), np.array([x.main for x in nodes], float)


def fit_pages_trees(pages: list[str], *, variants: int = 4, seed: int = 3) -> Trees:
    draw = random.Random(seed)
    found = [v for page in pages for k in range(variants) if (v := _variant(page, draw, plain=k == 0))]
    if len(found) < 40:
        found += [v for k in range(160) if (v := _variant(STARTER, draw, plain=k == 0))]
    x, y = np.vstack([v[0] for v in found]), np.concatenate([v[1] for v in found])
    return fit_trees(x, y, rounds=80, depth=4)


def main_texts(pages: list[str | None], trees: Trees) -> list[str]:
    """The main text of each page; the trees score the elements of all pages at once."""
    parsed = [elements(parse(p)) if p else [] for p in pages]
    rows = [features(nodes) for nodes in parsed if nodes]
    odds = trees.margin(np.vstack(rows)) if rows else np.empty(0)
    out, at = [], 0
    for nodes in parsed:
        if not nodes:
            out.append("")
            continue
        decode(nodes, odds[at : at + len(nodes)])
        at += len(nodes)
        out.append("\n\n".join(blocks_of(nodes[0])))
    return out


def learn_pages(pages: DataFrame, *, fit_pages: int = 250, page_chars: int = 20_000) -> Trees:
    """Fit the trees to at most ``fit_pages`` different pages of less than ``page_chars`` characters with an article element.

    They are drawn by hash, equal ones once. Longer pages are read like any other; where all are longer, the built-in page
    stands in.
    """
    drawn = F.pmod(F.xxhash64(F.lit(7), "html"), F.lit(1 << 20))
    named = pages.where(F.length("html") < page_chars).where(F.col("html").rlike("(?i)<(article|main)[\\s>]")).select("html", drawn.alias("drawn"))
    n = named.agg(F.approx_count_distinct(F.xxhash64("html"))).first()[0]
    if n > 2 * fit_pages:
        named = named.where(F.col("drawn") < int((1 << 20) * 2 * fit_pages / n))
    return fit_pages_trees(sorted(r["html"] for r in named.distinct().orderBy("drawn", "html").limit(fit_pages).collect()))


def extract_text(pages: DataFrame, *, fit_pages: int = 250, to: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html``."""
    trees = learn_pages(pages, fit_pages=fit_pages)
    arrow_rows(pages.sparkSession, 200)

    @F.arrow_udf("string")
    def extract(htmls: pa.Array) -> pa.Array:
        return pa.array(main_texts(htmls.to_pylist(), trees), pa.string())

    return pages.withColumn(to, extract(F.col("html")))
