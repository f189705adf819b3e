"""Main text of HTML pages by a tree-structured graphical model over the DOM.

A page becomes a tree of the block elements that hold text, its leaves being the runs of text. Every node is content or not; a node's own evidence (element,
words in class, id and role, link density, length) gives its potential, and parent and child share a
potential that depends on the child's kind of element. The tree has no cycles, so sum-product message
passing upward and downward yields exact marginals. Weights are fitted by maximum likelihood, whose
gradient uses the same messages, on the labelled pages of ``labelled_pages``: ``TRAINING_PAGES`` of
them, made here from templates, since the corpus has no labels for pages.

A text block belongs to its nearest block element; blocks of nodes with a marginal above one half are
joined in page order by one ``\\n``. White space inside a block, ``<br>`` included, becomes one space.

Pages are read in one pass over their characters, whatever is left open in them: an unclosed comment, tag or quoted value
ends the page, as in browsers.

Defined results: null html is an empty page; a page without content has the text ``""``; unclosed and
stray elements are closed or ignored as browsers do for paragraphs, items and cells; marked sections are comments;
nesting may be of any depth; repeated rows are each extracted; extra columns are left out;
an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from kinfold.llm.text import steps
from kinfold.workers import map_arrow

TRAINING_PAGES = 420

#: Kinds of block elements; elements in none of these are inline.
KINDS = {
    "root": ("html", "body"),
    "nav": ("nav", "menu"),
    "header": ("header",),
    "footer": ("footer", "address"),
    "aside": ("aside", "dialog"),
    "form": ("form", "fieldset", "button", "label", "legend", "textarea", "select", "option"),
    "article": ("article", "main"),
    "heading": ("h1", "h2", "h3", "h4", "h5", "h6"),
    "paragraph": ("p", "blockquote", "pre", "hr"),
    "list": ("ul", "ol", "dl"),
    "item": ("li", "dt", "dd"),
    "table": ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"),
    "box": ("div", "section", "center", "hgroup", "details", "summary"),
    "figure": ("figure", "figcaption"),
}
KIND = {tag: i for i, tags in enumerate(KINDS.values()) for tag in tags}
#: The kind of a run of text, which is a leaf of its own below the element that it stands in.
TEXT = len(KINDS)
N_KINDS = TEXT + 1
#: Elements whose text is never shown.
HIDDEN = ("script", "style", "head", "title", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "datalist", "noembed", "noframes")
#: Words of notices at the edge of a page.
NOTICE = re.compile(r"(?i)\u00a9|\bcopyright\b|\ball rights reserved\b|\bcookies?\b")
#: What may stand in the head; any other element ends it.
HEAD = ("head", "title", "meta", "link", "style", "script", "base", "noscript", "template")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
#: A start tag on the left closes open elements on the right, up to the nearest of the last group.
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)), "option": (("option",), ("select",))}
#: Words in class, id and role by what they hint at.
HINTS = {
    "ad": "ad ads advert advertisement adverts banner sponsor sponsored promo promotion",
    "nav": "nav navigation menu breadcrumb breadcrumbs navbar pagination pager toc tabs",
    "head": "header masthead topbar branding logo site-title banner-top",
    "foot": "footer colophon copyright legal imprint bottom",
    "side": "sidebar aside related widget complementary recommended trending popular",
    "comment": "comment comments reply replies disqus respond discussion reader",
    "form": "form search login signup newsletter subscribe subscription",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay message warning",
    "share": "share sharing social tags meta byline",
    "content": "article content post entry story main text body prose",
}
HINT_OF = {w: i for i, words in enumerate(HINTS.values()) for w in words.split()}
N_FEATURES = 2 * N_KINDS + len(HINTS) + 11


@dataclass
class Tree:
    """One page: nodes in page order; blocks are (node, text)."""

    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    kind: list[int] = field(default_factory=lambda: [0])
    hints: list[set[int]] = field(default_factory=lambda: [set()])
    label: list[int] = field(default_factory=lambda: [0])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)

    def with_text(self) -> Tree:
        """The tree without elements that hold no text."""
        holds = [False] * len(self.parent)
        for node, _, _ in self.blocks:
            holds[node] = True
        for node in range(len(holds) - 1, 0, -1):
            if holds[node]:
                holds[self.parent[node]] = True
        holds[0] = True
        kept = [node for node, held in enumerate(holds) if held]
        new = dict(zip(kept, range(len(kept))))
        pick = lambda x: [x[node] for node in kept]
        return Tree([new.get(p, -1) for p in pick(self.parent)], pick(self.depth), pick(self.kind), pick(self.hints), pick(self.label), [(new[node], text, n) for node, text, n in self.blocks])


#: A tag's name, and one attribute behind it: name, then a quoted or bare value. Possessive, so that no character is read twice.
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_ATTRIBUTE = re.compile(r"[\s/]*+(?:([^\s/>=][^\s/>=]*+|=[^\s/>=]*+)(?:(\s*+=\s*+)(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+))?+)?+)?+")
_COMMENT_END = re.compile("--!?>")
#: Characters up to which a document type may start; later ones are read like comments.
FRONT = 1024
#: Elements whose inside is text up to their own end tag.
RAW = ("script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes")
_RAW_END = {tag: re.compile(rf"(?i)</{tag}(?=[\s/>])") for tag in RAW}


def tokens(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """("start" | "end" | "text", name or text, attributes) of a page, in one pass over its characters.

    What is never closed ends the page, as in browsers: a comment, a tag, a quoted value. A ``<`` that opens nothing is text.
    """
    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        # Text up to the next "<" that opens something.
        while 0 <= lt < size - 1 and not (page[lt + 1].isascii() and page[lt + 1].isalpha()) and page[lt + 1] not in "/!?":
            lt = page.find("<", lt + 1)
        if lt < 0 or lt == size - 1:
            yield "text", unescape(page[at:]), {}
            return
        if lt > at:
            yield "text", unescape(page[at:lt]), {}
        after = page[lt + 1]
        if after in "!?" or (after == "/" and not page[lt + 2 : lt + 3].isalpha()):
            at = _end_of_comment(page, lt)
            if at < 0:
                return
            continue
        name = _NAME.match(page, lt + 1 + (after == "/"))
        if name is None:
            at = _end_of_comment(page, lt)
            if at < 0:
                return
            continue
        tag, given, at = name[0].lower(), {}, name.end()
        while True:
            found = _ATTRIBUTE.match(page, at)
            at = found.end()
            if found[1]:
                given.setdefault(found[1].lower(), unescape(found[3] or found[4] or found[5] or ""))
            if at >= size or (found[2] and found[3] is found[4] is found[5] is None and page[at] in "\"'"):
                return  # the tag, or a value in it, has no end
            if page[at] == ">":
                break
            if found.end() == found.start():
                at += 1
        at += 1
        yield ("end" if after == "/" else "start"), tag, given
        if after != "/" and tag in RAW:
            end = _RAW_END[tag].search(page, at)
            stop = end.start() if end else size
            yield "text", (unescape(page[at:stop]) if tag in ("title", "textarea") else page[at:stop]), {}
            at = stop


def _end_of_comment(page: str, lt: int) -> int:
    """Where a comment, a document type or a marked section is over, or -1."""
    if page.startswith("<!--", lt):
        if page.startswith((">", "->"), lt + 4):
            return page.index(">", lt + 4) + 1
        end = _COMMENT_END.search(page, lt + 4)
        return end.end() if end else -1
    end = page.find(">", lt)
    # A document type at the front may have declarations of its own, in brackets.
    if end >= 0 and page[lt + 2 : lt + 9].lower() == "doctype" and lt <= FRONT and (bracket := page.find("[", lt, end)) >= 0:
        close = page.find("]", bracket)
        end = page.find(">", close) if close >= 0 else end
    return end + 1 if end >= 0 else -1


class _Reader:
    """Builds the tree; with ``labelled``, elements that carry ``data-content="1"`` are content (training pages only)."""

    def __init__(self, labelled: bool = False):
        self.tree = Tree()
        self.labelled = labelled
        # Open elements with their nodes, and where in that stack each tag stands.
        self.open: list[tuple[str, int]] = [("", 0)]
        self.places: dict[str, list[int]] = {}
        self.hidden, self.nested = "", 0
        # How many elements were open where the open link began; 0 outside links.
        self.link = 0
        self.buffer: list[str] = []
        self.linked = 0

    def feed(self, page: str) -> None:
        step = {"start": self.handle_starttag, "end": lambda tag, _: self.handle_endtag(tag), "text": lambda text, _: self.handle_data(text)}
        for kind, what, given in tokens(page):
            step[kind](what, given)
        self.flush()

    def flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        if text:
            t, above = self.tree, self.open[-1][1]
            t.parent.append(above)
            t.depth.append(t.depth[above] + 1)
            t.kind.append(TEXT)
            t.hints.append(set())
            t.label.append(t.label[above])
            t.blocks.append((len(t.parent) - 1, text, self.linked))
        self.buffer, self.linked = [], 0

    def cut(self, size: int) -> None:
        """Close elements until ``size`` are open."""
        while len(self.open) > size:
            self.places[self.open.pop()[0]].pop()
        if size < self.link:
            self.link = 0

    def last(self, *tags: str) -> int:
        """Where the innermost open element of these tags stands, or 0."""
        return max(self.places[t][-1] if self.places.get(t) else 0 for t in tags)

    def handle_starttag(self, tag, given):
        if self.hidden == "head" and tag not in HEAD:
            self.hidden = ""
        if self.hidden:
            self.nested += tag == self.hidden
            return
        if tag in HIDDEN:
            self.hidden, self.nested = tag, 1
            return
        if tag == "br":
            self.buffer.append(" ")
            return
        if tag == "a":
            self.link = len(self.open)
            return
        if tag not in KIND:
            return
        self.flush()
        self._close_before(tag)
        if tag in VOID:
            return
        t, node = self.tree, self.open[-1][1]
        values = " ".join(given.get(k) or "" for k in ("class", "id", "role")).lower()
        t.parent.append(node)
        t.depth.append(t.depth[node] + 1)
        t.kind.append(KIND[tag])
        t.hints.append({HINT_OF[w] for part in re.split(r"[\s_]+", values) for w in (part, *part.split("-")) if w in HINT_OF})
        t.label.append(int(self.labelled and given.get("data-content") == "1"))
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, len(t.parent) - 1))

    def _close_before(self, tag):
        if tag in CLOSES:
            closed, stop = CLOSES[tag]
            at = self.last(*closed)
            if at > self.last(*stop):
                self.cut(at)
        elif tag not in ("td", "th", "tr") and (at := self.last("p")):
            self.cut(at)

    def handle_endtag(self, tag):
        if self.hidden:
            self.nested -= tag == self.hidden
            if not self.nested or (self.hidden == "title" and tag == "head"):
                self.hidden = ""
            return
        if tag == "a":
            self.link = 0
        if tag not in KIND:
            return
        self.flush()
        if at := self.last(tag):
            self.cut(at)

    def handle_data(self, data):
        if not self.hidden:
            self.buffer.append(data)
            self.linked += bool(self.link) * len(data)


def read_page(html: str, labelled: bool = False) -> Tree:
    reader = _Reader(labelled)
    reader.feed(html)
    return reader.tree.with_text()


@dataclass
class Forest:
    """Nodes of many pages; parents stand before their children."""

    parent: np.ndarray
    depth: np.ndarray
    kind: np.ndarray
    features: np.ndarray
    first: np.ndarray


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    """The nodes of each depth, from the roots."""
    return np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []


def forest(trees: list[Tree]) -> Forest:
    sizes = [len(t.parent) for t in trees]
    first = np.concatenate(([0], np.cumsum(sizes)))
    parent = np.concatenate([np.where(np.array(t.parent) < 0, -1, np.array(t.parent) + f) for t, f in zip(trees, first)]) if trees else np.zeros(0, int)
    depth = np.array([d for t in trees for d in t.depth], int)
    kind = np.array([k for t in trees for k in t.kind], int)
    chars, linked = np.zeros(len(parent)), np.zeros(len(parent))
    for t, f in zip(trees, first):
        for node, text, n in t.blocks:
            chars[f + node] += len(text)
            linked[f + node] += min(n, len(text))
    own, notice = chars.copy(), np.zeros(len(parent), bool)
    for t, f in zip(trees, first):
        for node, text, _ in t.blocks:
            notice[f + node] = len(text) < 300 and NOTICE.search(text) is not None
    for at in _levels(depth)[:0:-1]:
        np.add.at(chars, parent[at], chars[at])
        np.add.at(linked, parent[at], linked[at])
    x = np.zeros((len(parent), N_FEATURES))
    x[np.arange(len(parent)), kind] = 1
    node = 0
    for t in trees:
        for hints in t.hints:
            for h in hints:
                x[node, N_KINDS + h] = 1
            node += 1
    # A run of text also has the kind of the element that it stands in.
    leaf, k = np.flatnonzero(kind == TEXT), N_KINDS + len(HINTS)
    x[leaf, k + kind[parent[leaf]]] = 1
    k += N_KINDS
    density = linked / np.maximum(chars, 1)
    plain = chars - linked
    share = plain / np.maximum(np.repeat(plain[first[:-1]], sizes), 1) if len(parent) else plain
    shape = (np.ones(len(parent)), density > 0.5, (density > 0.2) & (density <= 0.5), chars == 0, (chars > 0) & (chars < 25), chars > 200, own > 80, depth <= 1, share > 0.5, (share > 0.15) & (share <= 0.5), notice)
    for i, column in enumerate(shape):
        x[:, k + i] = column
    return Forest(parent, depth, kind, x, first)


@dataclass(frozen=True)
class Weights:
    unary: np.ndarray  # N_FEATURES: log odds of content
    pair: np.ndarray  # kinds x 2 x 2: parent's and child's label


def sum_product(f: Forest, w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (nodes x 2), and of each edge to the parent (nodes x 2 x 2; zero at roots)."""
    n = len(f.parent)
    up = np.zeros((n, 2))
    up[:, 1] = f.features @ w.unary
    psi, message = w.pair[f.kind], np.zeros((n, 2))
    levels = _levels(f.depth)
    for at in levels[:0:-1]:
        message[at] = np.logaddexp.reduce(up[at][:, None, :] + psi[at], axis=2)
        np.add.at(up, f.parent[at], message[at])
    down = np.zeros((n, 2))
    edge = np.zeros((n, 2, 2))
    for at in levels[1:]:
        p = f.parent[at]
        cavity = down[p] + up[p] - message[at]
        down[at] = np.logaddexp.reduce(cavity[:, :, None] + psi[at], axis=1)
        down[at] -= down[at].max(axis=1, keepdims=True)
        joint = cavity[:, :, None] + psi[at] + up[at][:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        edge[at] = joint / joint.sum(axis=(1, 2), keepdims=True)
    both = down + up
    both = np.exp(both - both.max(axis=1, keepdims=True))
    return both / both.sum(axis=1, keepdims=True), edge


def fit(trees: list[Tree], rounds: int = 120, rate: float = 0.15, decay: float = 1e-3) -> Weights:
    """Maximum likelihood with a Gaussian prior, by Adam on the exact gradient."""
    f = forest(trees)
    y = np.array([label for t in trees for label in t.label])
    inner = np.flatnonzero(f.parent >= 0)
    seen = np.zeros((N_KINDS, 2, 2))
    np.add.at(seen, (f.kind[inner], y[f.parent[inner]], y[inner]), 1)
    x = np.zeros(N_FEATURES + seen.size)
    m, v = np.zeros_like(x), np.zeros_like(x)
    unpack = lambda x: Weights(x[:N_FEATURES], x[N_FEATURES:].reshape(seen.shape))
    for i in range(1, rounds + 1):
        marginal, edge = sum_product(f, unpack(x))
        expected = np.zeros_like(seen)
        np.add.at(expected, f.kind[inner], edge[inner])
        g = np.concatenate((f.features.T @ (y - marginal[:, 1]), (seen - expected).ravel())) / len(trees) - decay * x
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x + rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return unpack(x)


def labelled_pages(n: int, seed: int = 0) -> list[str]:
    """Pages of many shapes; elements of the article carry ``data-content="1"``."""
    r = random.Random(seed)
    say = lambda a, b: " ".join("".join(r.choice("aeioustrnlmd") for _ in range(r.randint(2, 9))) for _ in range(r.randint(a, b)))
    link = lambda: f'<a href="/{say(1, 1)}">{say(1, 3)}</a>'
    cls = lambda *names: f' {r.choice(["class", "id"])}="{r.choice(names)}"' if r.random() < 0.85 else ""

    def para() -> str:
        text = say(*r.choice([(1, 2), (3, 12), (15, 60), (60, 150)]))
        if r.random() < 0.2:
            text += f" {link()} {say(2, 9)}"
        return r.choice([f'<p data-content="1">{text}</p>'] * 4 + [f'<p data-content="1"><b>{text}<br>', f'<p data-content="1"><em>{text}</em>.', f'<blockquote data-content="1">{text}</blockquote>', f'<h2 data-content="1">{text[:60]}</h2>', f'<div data-content="1">{text}</div>'])

    def items(k: int, c: int) -> str:
        return "".join(f'<li data-content="{c}">{say(3, 14) if c else link()}</li>' for _ in range(k))

    def boiler() -> str:
        kind = r.randrange(15)
        if kind >= 10:
            # Without a name: links one after the other, or a notice.
            links = r.choice([" ", " | ", "<br>", " &middot; "]).join(link() for _ in range(r.randint(2, 9)))
            some = r.choice(["&copy; 2020", "Copyright", "All rights reserved"])
            return [f"<div>{links}</div>", f"<p>{links}</p>", f"<ul>{items(r.randint(2, 8), 0)}</ul>", f"<table><tr><td>{links}</td></tr></table>", r.choice([f"<p>{some} {say(1, 9)}</p>", f"<div>{some} {say(1, 9)}</div>", f"<hr>{links}<hr>"])][kind - 10]
        if kind == 0:
            return f"<nav{cls('menu', 'nav', 'topnav')}><ul>{items(r.randint(2, 9), 0)}</ul></nav>"
        if kind == 1:
            return f"<div{cls('ad', 'ads', 'advert', 'sponsored', 'banner-ad', 'promo')}>{say(3, 40)}</div>"
        if kind == 2:
            return f"<aside{cls('sidebar', 'related', 'widget')}><h3>{say(1, 4)}</h3><p>{say(5, 50)}</p><ul>{items(3, 0)}</ul></aside>"
        if kind == 3:
            return f"<form{cls('search', 'newsletter', 'login')}><label>{say(1, 3)}</label><button>{say(1, 1)}</button></form>"
        if kind == 4:
            return f"<div{cls('cookie-notice', 'notice', 'consent', 'alert', 'popup')}><p>{say(5, 40)}</p><button>{say(1, 1)}</button></div>"
        if kind == 5:
            return f"<section{cls('comments', 'comment-list', 'replies')}><h3>{say(1, 3)}</h3>" + "".join(f'<div class="comment"><p>{say(3, 60)}</p></div>' for _ in range(r.randint(1, 5))) + "</section>"
        if kind == 6:
            return f"<div class=\"{r.choice(['sidebar', 'related', 'widget', 'menu', 'breadcrumb', 'share', 'social'])}\">{say(1, 20)} {link()}</div>"
        if kind == 7:
            return f"<div class=\"{r.choice(['comments', 'reader-comments', 'disqus'])}\"><ol>" + "".join(f"<li><p>{say(3, 60)}</p></li>" for _ in range(r.randint(1, 4))) + "</ol></div>"
        if kind == 8:
            return f"<header{cls('masthead', 'site-header', 'header')}><h1>{say(1, 4)}</h1>{link()}<p>{say(2, 8)}</p></header>"
        return f"<footer{cls('footer', 'site-footer', 'legal')}><p>&copy; {say(2, 12)}</p>{link()}</footer>"

    pages = []
    for _ in range(n):
        body = [f'<h1 data-content="1">{say(2, 12)}</h1>'] if r.random() < 0.85 else []
        if body and r.random() < 0.2:
            body = [f'<header data-content="1">{body[0]}</header>']
        body += [para() for _ in range(r.randint(1, 14))]
        if r.random() < 0.3:
            body.insert(r.randint(1, len(body)), f'<ul data-content="1">{items(r.randint(2, 6), 1)}</ul>')
        if r.random() < 0.2:
            body.insert(r.randint(1, len(body)), f'<table data-content="1"><tr data-content="1"><td data-content="1">{say(1, 5)}</td><td data-content="1">{say(1, 9)}</td></tr></table>')
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            body.insert(r.randint(0, len(body)), boiler())
        if r.random() < 0.15:
            body.append(f'<{r.choice(["button", "figure"])}>{say(1, 3)}</{"button" if r.random() < 0.5 else "figure"}>')
        if r.random() < 0.4:
            # Pages without a named container: none at all, plain boxes, cells, or text between line breaks.
            if r.random() < 0.4:
                body = [r.choice(["<br>", "<br><br>", "<hr>"]).join(say(*r.choice([(3, 12), (15, 60), (60, 150)])) for _ in range(r.randint(1, 6)))]
                body.insert(0, f'<h1 data-content="1">{say(2, 9)}</h1>' if r.random() < 0.5 else "")
            inside = "".join(body)
            before, after = ("".join(boiler() for _ in range(r.randint(0, 3))) for _ in range(2))
            shape = r.randrange(4)
            if shape == 0:
                page = f'<body data-content="1">{before}{inside}{after}</body>'
            elif shape == 1:
                deep = r.randint(1, 3)
                page = f'<body>{before}{"<div>" * (deep - 1)}<div data-content="1">{inside}</div>{"</div>" * (deep - 1)}{after}</body>'
            elif shape == 2:
                page = f'<body><table><tr><td>{before}</td><td data-content="1">{inside}</td></tr></table>{after}</body>'
            else:
                page = f'<body><center>{before}</center><table data-content="1"><tr data-content="1"><td data-content="1">{inside}</td></tr></table>{after}</body>'
            pages.append(f"<html><head><title>{say(2, 6)}</title></head>{page}</html>")
            continue
        for _ in range(r.choice([0, 0, 1, 2])):
            # Inside an article the words of a notice are text like any other.
            body.insert(r.randint(len(body) // 2, len(body)), f'<p data-content="1">{r.choice(["All rights reserved.", "Copyright 2019 " + say(1, 4), say(2, 9) + " cookies " + say(2, 9), "&copy; " + say(1, 5)])}</p>')
        tag, names = r.choice([("article", ("post", "story")), ("article", ("",)), ("main", ("content",)), ("div", ("content", "article-body", "post-content", "entry")), ("section", ("content", "story", "article"))])
        named = f' class="{r.choice(names)}"' if tag in ("div", "section") else cls(*names)
        main = f'<{tag}{named} data-content="1">{"".join(body)}</{tag}>'
        if r.random() < 0.25:
            main = f'<div class="{r.choice(["wrapper", "page", "container", "row"])}">{boiler() if r.random() < 0.5 else ""}{main}</div>'
        page = [boiler() for _ in range(r.randint(0, 4))] + [main] + [boiler() for _ in range(r.randint(0, 4))]
        pages.append(f"<!DOCTYPE html><html><head><title>{say(2, 6)}</title><style>p{{}}</style></head><body>{''.join(page)}" + ("</body></html>" if r.random() < 0.8 else ""))
    return pages


@lru_cache(maxsize=1)
def trained() -> Weights:
    return fit([read_page(x, labelled=True) for x in labelled_pages(TRAINING_PAGES)])


def content(pages: list[str], w: Weights) -> list[str]:
    trees = [read_page(x) for x in pages]
    f = forest(trees)
    keep = sum_product(f, w)[0][:, 1] > 0.5
    return ["\n".join(text for node, text, _ in t.blocks if keep[first + node]) for t, first in zip(trees, f.first)]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    w = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "html"):
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = content([x or "" for x in part.column("html").to_pylist()], w)
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return map_arrow(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
