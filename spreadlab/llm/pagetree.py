"""HTML extraction with a tree-structured graphical model.

Every element and every text run of a page is a binary variable (content or
not); potentials join each node with its parent and tie each node to features of
its tag, its class and id words, its text and links, and its place.  Sum-product
messages go up and down the tree once; text runs whose content marginal is at
least 0.5 are kept.  Parameters are fitted by gradient steps on the exact
likelihood of labelled pages.

The tables hold no page labels, so the labelled pages are composed
(``labelled_pages``): ``TRAINING_PAGES`` pages of an article among menus, headers,
side columns, notices, adverts, forms, comments and footers with varied tags and
class names, each block labelled by what it is.

Text rules: character references are decoded; scripts, styles, templates, comments
and markup are never text; white space inside a block becomes one space; blocks are
trimmed and joined by one space in page order; inline tags don't split a word.

Cases: null or empty html gives an empty text; a page cut off anywhere is read as
far as it goes (a tag without its end is dropped); a quote in a tag counts only at
the start of an attribute's value, and only if it is closed; raw elements without an
end tag are empty (scripts and styles reach to the page's end), as is svg
ended by "/>"; svg with an end tag is dropped, formulas (math) are inline text; nesting of any depth is handled
without recursion; repeated rows are extracted row by row; extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAINING_PAGES = 1500
EPOCHS = 15
SLOTS = 1 << 16

# Fixed values of the HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp svg".split())
FOREIGN = frozenset("svg".split())
CODE = frozenset("script style".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr "
                   "math mfrac mi mn mo mover mroot mrow ms msqrt mstyle msub msubsup msup mtext munder munderover "
                   "semantics".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure figcaption footer form h1 h2 h3 h4 "
                     "h5 h6 header hr main menu nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
STOP = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
        "th": {"tr", "table"}, "option": {"select"}}

_TAG = re.compile(r"""<(?:
    !--(?P<comment>.*?)(?:--!?>|\Z)
  | (?P<decl>[!?])[^>]*(?:>|\Z)
  | /(?P<close>[a-zA-Z][^\s/>]*)[^>]*(?P<cend>>|\Z)
  | (?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=\s*+[^\s>"'][^\s>]*+|=)*+)(?P<oend>>|\Z)
)""", re.S | re.X)
_ATTR = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")

ROOT, TEXT = "#root", "#text"


class Node:
    __slots__ = ("tag", "parent", "words", "text", "block")

    def __init__(self, tag, parent, words=(), text=None, block=0):
        self.tag, self.parent, self.words, self.text, self.block = tag, parent, words, text, block


def parse(html: str) -> list[Node]:
    """Nodes in page order (a parent before its children); text runs are leaves."""
    nodes = [Node(ROOT, -1)]
    stack = [0]
    opened = Counter()                                # open elements by tag: an end tag without one scans nothing
    block = 0
    unended = set()                                   # raw tags without an end tag in the rest of the page
    pos, n = 0, len(html)

    def text(lo, hi):
        if lo < hi:
            run = html_lib.unescape(html[lo:hi])
            if run.strip():
                nodes.append(Node(TEXT, stack[-1], text=run, block=block))
            elif run and nodes[-1].tag == TEXT and nodes[-1].block == block:
                nodes[-1].text += " "
            elif run:
                nodes.append(Node(TEXT, stack[-1], text=" ", block=block))

    while pos < n:
        lt = html.find("<", pos)
        if lt < 0:
            text(pos, n)
            break
        m = _TAG.match(html, lt)
        if m is None:                                 # a bare "<" is text
            nxt = html.find("<", lt + 1)
            nxt = n if nxt < 0 else nxt
            text(pos, nxt)
            pos = nxt
            continue
        text(pos, lt)
        pos = m.end()
        if m["close"]:
            tag = m["close"].lower()
            if not m["cend"]:
                break
            if tag not in INLINE:
                block += 1
            _pop(nodes, stack, opened, HEADINGS if tag in HEADINGS else {tag})
        elif m["open"]:
            tag = m["open"].lower()
            if m["oend"] != ">":
                break
            if tag not in INLINE:
                block += 1
            if tag in CLOSES_P:
                _pop(nodes, stack, opened, {"p"}, {"button", "td", "th", "table"})
            if tag in SAME:
                _pop(nodes, stack, opened, SAME[tag], STOP[tag])
            words = []
            for a in _ATTR.finditer(m["attrs"]):
                words += _WORD.findall((a[2] or a[3] or a[4] or "").lower())
            nodes.append(Node(tag, stack[-1], tuple(words)))
            if tag in RAW:
                if tag in FOREIGN and m["attrs"].endswith("/") or tag in unended:
                    continue
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, pos)
                if end is None and tag not in CODE:
                    unended.add(tag)
                    continue
                pos = end.end() if end else n
                block += 1
            elif tag not in VOID and not m["attrs"].endswith("/"):
                stack.append(len(nodes) - 1)
                opened[tag] += 1
    return nodes


def _pop(nodes, stack, opened, tags, bounds=()) -> None:
    """Close the nearest open element of ``tags`` unless one of ``bounds`` is nearer.
    Only a stack that holds one is searched."""
    if not any(opened[t] for t in tags):
        return
    for d in range(len(stack) - 1, 0, -1):
        tag = nodes[stack[d]].tag
        if tag in tags:
            opened.subtract(nodes[i].tag for i in stack[d:])
            del stack[d:]
            return
        if tag in bounds:
            return


def _slot(*key) -> int:
    h = 2166136261
    for c in "|".join(map(str, key)).encode():
        h = (h ^ c) * 16777619 % 4294967296
    return h % SLOTS


_SLOTS: dict = {}


def _cached(*key) -> int:
    s = _SLOTS.get(key)
    if s is None:
        s = _slot(*key)
        if len(_SLOTS) < 50_000:
            _SLOTS[key] = s
    return s


def features(nodes: list[Node]) -> list[list[int]]:
    """Slots of every node."""
    n = len(nodes)
    length, linked, runs = [0] * n, [0] * n, [0] * n
    in_link, in_article = [False] * n, [False] * n
    article = False
    for i in range(1, n):
        x = nodes[i]
        in_link[i] = in_link[x.parent] or x.tag == "a"
        in_article[i] = in_article[x.parent] or x.tag in ("article", "main")
        article = article or x.tag in ("article", "main")
        if x.text is not None:
            length[i] = len(x.text)
            runs[i] = 1
            linked[i] = len(x.text) if in_link[i] else 0
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        length[p] += length[i]
        linked[p] += linked[i]
        runs[p] += runs[i]
    out = [[_cached("root", article)]]
    for i in range(1, n):
        x = nodes[i]
        place = "in" if in_article[i] else ("out" if article else "none")
        f = [_cached("place", place, x.tag == TEXT)]
        if x.text is not None:
            size = min(int(math.log2(length[i] + 1)), 10)
            f += [_cached("size", size), _cached("link", in_link[i], place), _cached("up", nodes[x.parent].tag, place)]
        else:
            share = int(4 * linked[i] / length[i]) if length[i] else 5
            f += [_cached("tag", x.tag), _cached("tagplace", x.tag, place), _cached("share", share, runs[i] > 3)]
            f += [_cached("word", w) for w in x.words]
            f += [_cached("begin", w[:5]) for w in x.words if len(w) > 5]
        out.append(f)
    return out


class Model:
    """Weights of node slots and the parent-child potential (2 x 2)."""

    def __init__(self):
        self.w = [0.0] * SLOTS
        self.edge = [[0.0, 0.0], [0.0, 0.0]]

    def messages(self, nodes, feats):
        """Log-odds from below and from above (its own evidence left out) of every node."""
        n = len(nodes)
        w, ((e00, e01), (e10, e11)) = self.w, self.edge
        below = [sum([w[s] for s in f]) for f in feats]
        up = [0.0] * n
        for i in range(n - 1, 0, -1):                   # upward
            b = below[i]
            m = _log_add(e10, e11 + b) - _log_add(e00, e01 + b)
            up[i] = m
            below[nodes[i].parent] += m
        above = [0.0] * n
        for i in range(1, n):                           # downward
            p = nodes[i].parent
            rest = below[p] + above[p] - up[i]
            above[i] = _log_add(rest + e11, e01) - _log_add(rest + e10, e00)
        return below, above, up

    def marginals(self, nodes, feats=None):
        feats = features(nodes) if feats is None else feats
        below, above, _ = self.messages(nodes, feats)
        return [_sigmoid(b + a) for b, a in zip(below, above)]


def _log_add(a, b):
    return max(a, b) + math.log1p(math.exp(-min(abs(a - b), 700.0)))


def _sigmoid(x):
    return 1.0 / (1.0 + math.exp(-max(min(x, 60.0), -60.0)))


def fit(pages: list[tuple[str, list[str]]], epochs: int = EPOCHS, seed: int = 5) -> Model:
    """Gradient ascent on the likelihood of labelled pages [(html, content marks)].

    A text run is content if it holds one of the page's content marks; an element
    is content if there is content below it."""
    model = Model()
    data = []
    for source, marks in pages:
        nodes = parse(source)
        y = [0] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            x = nodes[i]
            if x.text is not None:
                y[i] = int(any(m in x.text for m in marks))
            y[x.parent] |= y[i]
        y[0] = 1
        data.append((nodes, features(nodes), y))
    rng = random.Random(seed)
    sq = [1e-3] * SLOTS
    esq = [[1e-3, 1e-3], [1e-3, 1e-3]]
    for _ in range(epochs):
        rng.shuffle(data)
        for nodes, feats, y in data:
            below, above, up = model.messages(nodes, feats)
            grad: dict = {}
            eg = [[0.0, 0.0], [0.0, 0.0]]
            for i, f in enumerate(feats):
                err = y[i] - _sigmoid(below[i] + above[i])
                for s in f:
                    grad[s] = grad.get(s, 0.0) + err
                if i:
                    p = nodes[i].parent
                    rest = below[p] + above[p] - up[i]
                    e = model.edge
                    scores = [e[0][0], e[0][1] + below[i], rest + e[1][0], rest + e[1][1] + below[i]]
                    top = max(scores)
                    z = [math.exp(v - top) for v in scores]
                    t = sum(z)
                    for j in range(4):
                        eg[j // 2][j % 2] -= z[j] / t
                    eg[y[p]][y[i]] += 1.0
            for s, g in grad.items():
                sq[s] += g * g
                model.w[s] += 1.0 * g / math.sqrt(sq[s]) - 2e-5 * model.w[s]
            for a in (0, 1):
                for b in (0, 1):
                    esq[a][b] += eg[a][b] ** 2
                    model.edge[a][b] += 0.1 * eg[a][b] / math.sqrt(esq[a][b])
    return model


def extract(source: str | None, model: Model) -> str:
    """Main text of one page."""
    if not source:
        return ""
    nodes = parse(source)
    marg = model.marginals(nodes)
    parts, last = [], None
    for x, p in zip(nodes, marg):
        if x.text is not None and (p >= 0.5 or not x.text.strip()):
            if x.block != last:
                parts.append(" ")
                last = x.block
            parts.append(x.text)
    return " ".join("".join(parts).split())


# Names that page authors give to parts of a page.
NAMES = {
    "nav": "nav menu navbar navigation topnav breadcrumb breadcrumbs sitemap tabs pagination pager skip toc links",
    "header": "header masthead site-header topbar banner branding logo page-header",
    "footer": "footer site-footer bottom colophon copyright legal page-footer credits",
    "side": "sidebar aside widget related recommended trending popular sidecol rail more-stories newsletter social "
            "share sharing follow subscribe tags author-box teaser",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay paywall disclaimer toast message",
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner-ad dfp outbrain taboola",
    "form": "form search searchbox login signup contact-form poll survey register feedback",
    "comments": "comments comment comment-list replies reply responses discussion disqus thread user-comments "
                "reader-comments guestbook",
    "content": "content article post entry story main body text article-body entry-content post-content page-content "
               "prose markdown rich-text wrapper container column",
}
_KINDS = {"nav": ("nav", "div", "ul", "menu"), "header": ("header", "div"), "footer": ("footer", "div"),
          "side": ("aside", "div", "section"), "notice": ("div", "section", "p", "aside"),
          "ad": ("div", "aside", "section", "ins", "p"), "form": ("form", "div"),
          "comments": ("section", "div", "ol", "ul", "aside")}


def labelled_pages(count: int = TRAINING_PAGES, seed: int = 11) -> list[tuple[str, list[str]]]:
    """Composed pages with their content marks (words that only content holds)."""
    rng = random.Random(seed)
    syllables = "an be do er fi ga ho in ke lu mo ne or pa re sa ti un ve wo".split()

    def words(k):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(k))

    def attr(kind):
        name = rng.choice(NAMES[kind].split())
        style = rng.random()
        if style < 0.55:
            return f' class="{name}"'
        if style < 0.75:
            return f' id="{name}"'
        return f' class="{rng.choice(syllables)}-{name} {rng.choice(syllables)}"'

    def plain(kind):
        tag = rng.choice(_KINDS[kind])
        semantic = tag in ("nav", "header", "footer", "aside", "form")
        a = attr(kind) if not semantic or rng.random() < 0.5 else ""
        if kind == "nav":
            items = "".join(f'<li><a href="/x">{words(rng.randint(1, 3))}</a></li>' for _ in range(rng.randint(2, 8)))
            inner = items if tag in ("ul", "menu") else f"<ul>{items}</ul>"
        elif kind == "form":
            inner = (f"<label>{words(2)}</label><input name=q><select><option>{words(1)}<option>{words(1)}</select>"
                     f"<button>{words(1)}</button><p>{words(rng.randint(2, 12))}</p>")
        elif kind == "comments":
            one = "li" if tag in ("ol", "ul") else "div"
            inner = "".join(f"<{one}{attr('comments') if rng.random() < .5 else ''}><b>{words(1)}</b>"
                            f"<p>{words(rng.randint(3, 45))}</p></{one}>" for _ in range(rng.randint(1, 5)))
            inner = (f"<h{rng.randint(2, 4)}>{words(2)}</h3>" if rng.random() < .4 and one == "div" else "") + inner
        else:
            inner = "".join(rng.choice([f"<p>{words(rng.randint(2, 30))}</p>", f'<a href="/y">{words(3)}</a>',
                                        words(rng.randint(2, 14)), f"<h3>{words(3)}</h3>",
                                        f"<ul><li><a href=/z>{words(4)}</a></li></ul>"]) for _ in range(rng.randint(1, 4)))
            if tag == "p":
                inner = words(rng.randint(3, 20))
            if kind == "header":
                inner = rng.choice([f"<h1>{words(2)}</h1>", f"<a href=/>{words(2)}</a>", f"<div>{words(3)}</div>"]) + inner
            if kind == "footer":
                inner = "&copy; " + inner
        return f"<{tag}{a}>{inner}</{tag}>"

    pages = []
    for i in range(count):
        mark = f"q{i}z"
        fill = lambda k: f"{mark} {words(k)}".strip()

        def body():
            kind = rng.random()
            if kind < 0.6:
                t = fill(rng.choice([0, 1, 2, rng.randint(1, 30), rng.randint(1, 90)]))
                if rng.random() < 0.3:
                    t = f"<b>{t}" + ("</b>" if rng.random() < 0.5 else "<br>")
                elif rng.random() < 0.3:
                    t += f' <a href="/r">{mark} {words(2)}</a> {fill(4)}'
                return f"<p>{t}" + ("</p>" if rng.random() < 0.9 else "")
            if kind < 0.7:
                return f"<h{rng.randint(2, 4)}>{fill(4)}</h2>"
            if kind < 0.78:
                return "<ul>" + "".join(f"<li>{fill(rng.randint(1, 20))}</li>" for _ in range(3)) + "</ul>"
            if kind < 0.84:
                return f"<blockquote><p>{fill(15)}</p></blockquote>"
            if kind < 0.89:
                return f"<table><tr><td>{fill(2)}<td>{fill(3)}</tr></table>"
            if kind < 0.93:
                return f"<figure><img src=a><figcaption>{fill(6)}</figcaption></figure>"
            if kind < 0.96:
                return f"<div>{fill(25)}</div>"
            return f"<pre><code>{fill(8)}</code></pre>"

        parts = [f"<h1>{fill(6)}</h1>"] if rng.random() < 0.8 else []
        if parts and rng.random() < 0.1:
            parts = [f"<header>{parts[0]}</header>"]
        parts += [body() for _ in range(rng.randint(0, 12))]
        for kind in ("ad", "side", "notice", "form", "comments", "nav", "footer"):
            if rng.random() < 0.35:
                parts.insert(rng.randint(1, len(parts)) if parts else 0, plain(kind))
        style = rng.random()
        inner = "".join(parts)
        if style < 0.5:
            core = f"<article{attr('content') if rng.random() < .3 else ''}>{inner}</article>"
        elif style < 0.7:
            core = f"<main>{inner}</main>"
        else:
            core = f"<div{attr('content')}>{inner}</div>"
        if rng.random() < 0.2:
            core = f"<div{attr('content')}>{core}</div>"
        if rng.random() < 0.15:
            core = f"<main><article>{inner}</article></main>"
        around = [plain(k) for k in ("nav", "header", "notice", "ad") if rng.random() < 0.55]
        after = [plain(k) for k in ("side", "ad", "form", "comments", "footer", "nav", "notice") if rng.random() < 0.45]
        rng.shuffle(after)
        pages.append((f"<html><head><title>{words(3)}</title><script>var a='<p>';</script></head><body>"
                      + "".join(around) + core + "".join(after) + "</body></html>", [mark]))
    return pages


def extract_pages(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    model = fit(labelled_pages()) if model is None else model
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = [extract(h, shared.value) for h in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(out, pa.string()),
                                   pa.array(np.array([len(t) for t in out], dtype=np.int64))],
                                  names=["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
            .mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint"))
