"""Main text of web pages from a tree-structured graphical model over the DOM.

Every block element is a node with two states, boilerplate and content; so is a run of text directly in the body, which
no element holds. Its own evidence (tag, names in class, id
and role, lengths, share of link text) is a unary potential; a pairwise potential ties it to its parent, one table
per kind of element. Sum-product messages, first from the leaves upward and then from the root downward, give the
exact content marginal of every node. The weights are fitted by gradient ascent on the likelihood of labelled pages
(``labelled_pages``: layouts with a label on their elements), where the expected counts come from the same messages.

Trees of a whole batch form one forest, and one numpy step per depth passes all messages of that depth.
"""

from __future__ import annotations

import html as references
import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.llm.common import map_texts, table, use_text_batches

#: Elements whose inside is never running text.
_SKIPPED = ("script|style|noscript|template|title|textarea|iframe|object|svg|math|canvas|audio|video|select|button|datalist")
_TO_THE_END = frozenset(["script", "style", "title", "textarea"])
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|itemprop|data-label|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SKIP_TAGS = frozenset(_SKIPPED.split("|"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var label".split())
#: What ``labelled_pages`` writes on elements; read in training alone.
_LABELS = {"0": 0, "1": 1}
_RUN_LABEL = re.compile(r"data-label=([01])")
#: An opening tag ends the open element of the same family, up to the family's container.
_ENDS = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
         "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
_BARRIER = frozenset("ul ol dl table div section article aside nav header footer main form body html".split())

_GROUPS = ["html body", "nav menu", "header", "footer", "aside", "form fieldset input", "article main", "section", "div center", "p",
           "h1 h2", "h3 h4 h5 h6", "ul ol dl", "li dt dd", "table thead tbody tfoot tr", "td th", "figure figcaption", "blockquote pre",
           "dialog details summary", "#text"]
_GROUP = {tag: n for n, tags in enumerate(_GROUPS) for tag in tags.split()}
OTHER = len(_GROUPS)
#: Text directly in these is a node of its own for each run between block elements; "" is the page itself.
_OUTSIDE = frozenset(["", "html", "body"])

#: Name parts of classes, ids and roles that tell what an element is for.
_NAMES = [
    r"nav|menu|breadcrumb|crumbs|pager|pagination|toc|tabs?\b|skip",
    r"header|masthead|banner|topbar|branding|logo",
    r"footer|colophon|copyright|contentinfo|legal|imprint",
    r"side|aside|rail|complementary|widget|related|recommend|popular|trending|more-|tags|author-bio|promo",
    r"\bads?\b|\bads?[-_]|[-_]ads?\b|advert|sponsor|banner|promo|dfp|commercial",
    r"cookie|consent|gdpr|notice|alert|popup|modal|overlay|subscribe|newsletter|paywall|signup|login|form|search|share|social|dialog|toolbar",
    r"comment|respon|reply|replies|disqus|discussion|reader|feedback|review",
    r"article|content|post\b|post-|entry|main|story|body|text|prose|hentry|page\b",
]
_NAME = [re.compile(x, re.I) for x in _NAMES]
MEASURES = 11
INHERITED = MEASURES + OTHER + 1 + len(_NAMES) + 1
FEATURES = INHERITED + len(_NAMES)


def _names(text: str) -> tuple[int, ...]:
    """The patterns that a whole text of names matches; short texts are remembered."""
    return _remembered(text) if len(text) <= 200 else _matching(text)


def _matching(text: str) -> tuple[int, ...]:
    return tuple(n for n, pattern in enumerate(_NAME) if pattern.search(text))


_remembered = lru_cache(maxsize=65536)(_matching)


class Page:
    """Block elements of one page in opening order, and its text blocks in page order."""

    __slots__ = ("parent", "depth", "group", "named", "own", "linked", "label", "blocks")

    def __init__(self, source: str):
        self.parent, self.depth, self.group, self.named = [-1], [0], [0], [()]
        self.own, self.linked, self.label = [0], [0], [None]
        self.blocks: list[tuple[int, str]] = []
        self._parse(source)

    def _node(self, tag: str, attributes: str, parent: int) -> int:
        names, label = (), None
        if "=" in attributes or "hidden" in attributes:
            words = []
            for m in _ATTRIBUTE.finditer(attributes):
                value = m[2] or m[3] or m[4] or ""
                if m[1] == "data-label":
                    label = _LABELS.get(value)
                elif m[1] == "hidden":
                    words.append("popup")
                else:
                    words.append(value)
            names = _names(" ".join(words)) if words else ()
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.group.append(_GROUP.get(tag, OTHER))
        self.named.append(names)
        self.own.append(0)
        self.linked.append(0)
        self.label.append(label)
        return len(self.parent) - 1

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]
        text: list[str] = []
        links = linked = at = 0
        label = None

        def flush() -> None:
            nonlocal linked, label
            if text:
                words = " ".join("".join(text).split())
                text.clear()
                if words:
                    tag, node = stack[-1]
                    if tag in _OUTSIDE:
                        node = self._node("#text", "", node)
                        self.label[node] = label
                    self.blocks.append((node, words))
                    self.own[node] += len(words)
                    self.linked[node] += linked
            linked, label = 0, None

        def hold(chunk: str) -> None:
            nonlocal linked
            if chunk:
                chunk = references.unescape(chunk) if "&" in chunk else chunk
                text.append(chunk)
                if links:
                    linked += len(chunk.strip())

        while True:
            m = _TOKEN.search(source, at)
            if m is None:
                hold(source[at:])
                break
            hold(source[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag == "a":
                    links = max(0, links - 1)
                elif tag not in _INLINE and tag not in _VOID and any(tag == open_ for open_, _ in stack):
                    flush()
                    while stack[-1][0] != tag:
                        stack.pop()
                    stack.pop()
                continue
            if tag in _SKIP_TAGS:
                if not m[3].endswith("/"):
                    end = _closing(tag).search(source, at)
                    if end:
                        at = end.end()
                    elif tag in _TO_THE_END:
                        at = len(source)
                text.append(" ")
                continue
            if tag == "a":
                links += 1
                continue
            if tag in _VOID:
                text.append(" ")
                continue
            if tag in _INLINE:
                run = _RUN_LABEL.search(m[3])
                if run:
                    label = int(run[1])
                continue
            flush()
            links = 0
            ends = _ENDS.get(tag, ("p",))
            while stack[-1][0] in ends:
                stack.pop()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in ends and tag in _ENDS:
                    del stack[depth:]
                    break
                if stack[depth][0] in _BARRIER:
                    break
            stack.append((tag, self._node(tag, m[3], stack[-1][1])))
        flush()


@lru_cache(maxsize=64)
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\s*>", re.I)


def _added(keys: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Rows added up by key: what ``np.add.at`` does, by column."""
    flat = rows.reshape(len(rows), -1)
    sums = np.column_stack([np.bincount(keys, weights=flat[:, k], minlength=size) for k in range(flat.shape[1])])
    return sums.reshape(size, *rows.shape[1:])


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    """log(exp(a) + exp(b)) over an axis of two."""
    a, b = np.take(x, 0, axis), np.take(x, 1, axis)
    return np.maximum(a, b) + np.log1p(np.exp(-np.abs(a - b)))


class Forest:
    """The trees of several pages with their features, ready for messages."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.parent) for p in pages], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(pages) else np.zeros(0, np.int64)
        start = np.repeat(self.first, sizes)
        parent = np.fromiter((x for p in pages for x in p.parent), np.int64, int(sizes.sum()))
        self.parent = np.where(parent < 0, -1, parent + start)
        self.depth = np.fromiter((x for p in pages for x in p.depth), np.int64, len(parent))
        self.group = np.fromiter((x for p in pages for x in p.group), np.int64, len(parent))
        own = np.fromiter((x for p in pages for x in p.own), np.float64, len(parent))
        linked = np.fromiter((x for p in pages for x in p.linked), np.float64, len(parent))
        # nodes of one depth are in page order, so those of one parent are consecutive
        self.levels = [np.flatnonzero(self.depth == d) for d in range(1, int(self.depth.max(initial=0)) + 1)]
        run = self.group == _GROUP["#text"]
        plain = own - np.minimum(own, linked)
        below, below_linked, prose = own.copy(), linked.copy(), np.where(self.group == _GROUP["p"], plain, 0.0)
        direct = np.bincount(self.parent[run], weights=plain[run], minlength=len(parent))
        for level in reversed(self.levels):
            for sums in (below, below_linked, prose):
                sums += np.bincount(self.parent[level], weights=sums[level], minlength=len(sums))
        whole = np.maximum(below[start], 1)
        x = np.zeros((len(parent), FEATURES))
        x[:, 0] = 1
        x[:, 1] = np.log1p(own) / 5
        x[:, 2] = np.log1p(below) / 7
        x[:, 3] = np.minimum(1, linked / np.maximum(own, 1))
        x[:, 4] = np.minimum(1, below_linked / np.maximum(below, 1))
        x[:, 5] = below / whole
        x[:, 6] = np.log1p(prose) / 7
        x[:, 7] = own > 120
        x[:, 8] = prose / np.maximum(below, 1)
        x[:, 9] = prose / np.maximum(prose[start], 1)
        x[:, 10] = direct / np.maximum(below, 1)
        x[np.arange(len(parent)), MEASURES + self.group] = 1
        at = [(n + f, MEASURES + OTHER + 1 + k) for f, p in zip(self.first, pages) for n, names in enumerate(p.named) for k in names]
        if at:
            rows, columns = np.array(at).T
            x[rows, columns] = 1
            x[np.unique(rows), INHERITED - 1] = 1
        named = slice(MEASURES + OTHER + 1, INHERITED - 1)
        for level in self.levels:  # names of the elements around a node
            around = self.parent[level]
            x[level, INHERITED:] = np.maximum(x[around, named], x[around, INHERITED:])
        self.x = x

    def messages(self, unary: np.ndarray, pair: np.ndarray):
        """(marginals of content, pair marginals per node with its parent) by one pass up and one pass down."""
        theta = np.column_stack([np.zeros(len(self.x)), self.x @ unary])
        psi = pair[self.group]
        up, down = np.zeros_like(theta), np.zeros_like(theta)
        sent = np.zeros_like(theta)
        for level in reversed(self.levels):
            sent[level] = _lse(psi[level] + (theta[level] + up[level])[:, None, :], 2)
            above, first = np.unique(self.parent[level], return_index=True)
            up[above] += np.add.reduceat(sent[level], first)
        joint = np.zeros((len(theta), 2, 2))
        for level in self.levels:
            above = self.parent[level]
            rest = theta[above] + up[above] + down[above] - sent[level]
            both = rest[:, :, None] + psi[level]
            down[level] = _lse(both, 1)
            both = both + (theta[level] + up[level])[:, None, :]
            joint[level] = np.exp(both - _lse(_lse(both, 2), 1)[:, None, None])
        belief = theta + up + down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), joint


def labels_of(page: Page) -> np.ndarray:
    """Labels as written on the elements; elements without one take their parent's, the root is boilerplate.

    The body, or the page itself, is content where the article's text stands directly in it.
    """
    holds = {page.parent[n] for n, group in enumerate(page.group) if group == _GROUP["#text"] and page.label[n] == 1}
    labels = []
    for node, (parent, label) in enumerate(zip(page.parent, page.label)):
        inherited = labels[parent] if parent >= 0 else 0
        labels.append(1 if node in holds else label if label is not None else inherited)
    return np.array(labels)


def train(sources: list[str], steps: int = 200, rate: float = 0.08, ridge: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Unary and pairwise weights with the largest penalised likelihood of the labels (Adam on the exact gradient)."""
    pages = [Page(s) for s in sources]
    forest = Forest(pages)
    y = np.concatenate([labels_of(p) for p in pages])
    inner = np.flatnonzero(forest.parent >= 0)
    held = np.zeros((len(inner), 2, 2))
    held[np.arange(len(inner)), y[forest.parent[inner]], y[inner]] = 1
    seen = _added(forest.group[inner], held, OTHER + 1)
    weights = np.zeros(FEATURES + seen.size)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        p, joint = forest.messages(weights[:FEATURES], weights[FEATURES:].reshape(seen.shape))
        expected = _added(forest.group[inner], joint[inner], OTHER + 1)
        gradient = np.concatenate([forest.x.T @ (y - p), (seen - expected).ravel()]) / len(pages) - ridge * weights
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient ** 2
        weights = weights + rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return weights[:FEATURES], weights[FEATURES:].reshape(seen.shape)


def labelled_pages(count: int = 400, seed: int = 3) -> list[str]:
    """Layouts with labels: content 1, all else 0, on the outermost element of each part."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(2000)]
    pick = lambda *options: options[rng.randrange(len(options))]
    chance = lambda p: rng.random() < p

    def words(low: int, high: int) -> str:
        return " ".join(rng.choices(vocabulary, k=rng.randint(low, high))) + pick(".", "", "!")

    def links(low: int, high: int, item: str = "li") -> str:
        return "".join(f"<{item}><a href='/{words(1, 1)}'>{words(1, 4)}</a></{item}>" for _ in range(rng.randint(low, high)))

    def named(*options: str) -> str:
        return "" if chance(0.25) else f' {pick("class", "id")}="{pick(*options)}"'

    def nav() -> str:
        return pick(f"<nav data-label=0><ul>{links(3, 9)}</ul></nav>", f'<div data-label=0{named("menu", "navbar", "topnav", "breadcrumb")}><ul>{links(3, 9)}</ul></div>',
                    f'<ul data-label=0{named("menu", "nav")}>{links(4, 9)}</ul>')

    def head() -> str:
        return pick(f"<header data-label=0><h1>{words(1, 4)}</h1><p>{words(2, 9)}</p></header>",
                    f'<div data-label=0{named("header", "masthead", "site-header")}><a href="/">{words(1, 3)}</a> {words(1, 8)}</div>')

    def foot() -> str:
        inside = pick(f"&copy; {words(2, 30)}", f"<p>{words(4, 40)}</p><ul>{links(2, 5)}</ul>", f"<div>{words(3, 20)}</div>")
        return pick(f"<footer data-label=0>{inside}</footer>", f'<div data-label=0{named("footer", "copyright", "legal")}>{inside}</div>')

    def side() -> str:
        inside = f"<h3>{words(1, 4)}</h3>" + pick(f"<ul>{links(3, 8)}</ul>", f"<p>{words(5, 50)}</p>", f"<p>{words(10, 40)}</p><ul>{links(2, 4)}</ul>")
        return pick(f"<aside data-label=0>{inside}</aside>", f'<div data-label=0{named("sidebar", "related", "widget", "rail")}>{inside}</div>',
                    f'<section data-label=0 class="{pick("related", "more-stories", "recommended", "promo")}">{inside}</section>')

    def advert() -> str:
        return f'<div data-label=0 class="{pick("ad", "ads", "advert", "ad-slot", "sponsored", "banner-ad", "promo")}">{pick(words(3, 60), f"<p>{words(4, 40)}</p>")}</div>'

    def notice() -> str:
        tag, name = pick("div", "section", "dialog"), pick("cookie-notice", "consent", "notice", "newsletter", "subscribe", "alert", "popup")
        return f'<{tag} data-label=0 class="{name}"><p>{words(4, 40)}</p></{tag}>'

    def form() -> str:
        return f'<form data-label=0{named("search", "login", "signup")}><p>{words(1, 12)}</p><input name="q"> <label>{words(1, 4)}</label></form>'

    def comments() -> str:
        each = "".join(pick(f'<div class="comment"><p>{words(3, 70)}</p></div>', f"<li><b>{words(1, 2)}</b><p>{words(3, 60)}</p></li>",
                            f"<article class='comment'><h4>{words(1, 2)}</h4><p>{words(4, 60)}</p></article>",
                            f"<article><p>{words(4, 60)}</p></article>") for _ in range(rng.randint(1, 5)))
        tag, title = pick("section", "div", "ol"), pick("", f"<h3>{words(1, 3)}</h3>")
        name = pick("comments", "comment-list", "responses", "discussion", "reader-comments")
        return f'<{tag} data-label=0 {pick("class", "id")}="{name}">{title}{each}</{tag}>'

    def block() -> str:
        return pick(f"<p>{words(20, 140)}</p>", f"<p>{words(5, 60)}</p>", f"<p>{words(1, 6)}</p>", f"<p>{words(15, 80)} <a href='/x'>{words(1, 3)}</a> {words(3, 30)}",
                    f"<h2>{words(1, 8)}</h2>", f"<p><b>{words(1, 20)}<br>{words(3, 50)}", f"<ul><li>{words(2, 20)}</li><li>{words(2, 20)}</li></ul>",
                    f"<blockquote>{words(5, 40)}</blockquote>", f"<table><tr><td>{words(1, 6)}</td><td>{words(1, 6)}</td></tr></table>", f"<pre>{words(3, 20)}</pre>",
                    f"<div>{words(10, 80)}</div>", f"<h3>{words(1, 6)}</h3>", f"<figure><img src=x><figcaption>{words(3, 14)}</figcaption></figure>")

    def article() -> str:
        title = f"<h1>{words(2, 12)}</h1>"
        parts = [pick(title, title, f"<header>{title}</header>")] if chance(0.65) else []
        for _ in range(rng.choice([1, 1, 2, 3, 5, 9, 14])):
            parts.append(block() if chance(0.92) else f"<section><h2>{words(1, 8)}</h2>{block()}{block()}</section>")
            if chance(0.06):
                parts.append(pick(advert, side, notice, form)())
        if chance(0.08):
            parts.append(comments())
        if chance(0.06):
            parts.append(f"<footer data-label=0><p>{words(2, 20)}</p></footer>")
        inside = "".join(parts)
        return pick(f"<article data-label=1>{inside}</article>", f"<article data-label=1{named('post', 'entry', 'hentry')}>{inside}</article>",
                    f"<main data-label=1>{inside}</main>", f'<div data-label=1 {pick("class", "id")}="{pick("content", "post", "entry-content", "article-body", "main", "story")}">{inside}</div>',
                    f'<section data-label=1 class="{pick("content", "text", "story")}">{inside}</section>', f"<div data-label=1>{inside}</div>",
                    f"<td data-label=1>{inside}</td>",
                    f"<table><tr><td data-label=0>{links(2, 7, pick('div', 'span'))}</td><td data-label=1>{inside}</td></tr></table>")

    def bare() -> str:
        """An article whose text stands directly in the body, alone or between its elements."""
        run = lambda: f"<span data-label=1>{pick(words(20, 140), words(5, 60), words(40, 300), words(9, 60) + f' <a href=x>{words(1, 3)}</a> ' + words(3, 40))}</span>"
        part = lambda: pick(run() + pick("<br>", "<br><br>", " "), run() + "<br><br>" + run(), run(), f"<p data-label=1>{words(10, 120)}</p>")
        title = pick("", f"<h1 data-label=1>{words(2, 10)}</h1>")
        return title + "".join(part() + (f"<h2 data-label=1>{words(1, 8)}</h2>" if chance(0.1) else "") for _ in range(rng.choice([1, 1, 2, 3, 5])))

    def loose() -> str:
        """Text of no article directly in the body."""
        some = pick(words(1, 6), f"&copy; {words(2, 20)}", " | ".join(f"<a href='/{words(1, 1)}'>{words(1, 3)}</a>" for _ in range(rng.randint(2, 8))),
                    f"<a href='#main'>{words(2, 4)}</a>")
        return f"<span data-label=0>{some}</span>"

    pages = []
    for _ in range(count):
        before = [part for p, part in ((0.5, notice), (0.6, head), (0.8, nav), (0.4, advert), (0.2, side), (0.2, form)) if chance(p)]
        after = [part for p, part in ((0.3, side), (0.3, advert), (0.45, comments), (0.2, form), (0.2, nav), (0.8, foot)) if chance(p)]
        unheld = chance(0.08)
        main = bare() if unheld else article()
        for _ in range(0 if unheld else rng.randint(0, 2)):
            wrap = pick("div", "div", "section", "main")
            extra = pick("", "", side(), comments(), advert())
            main = f'<{wrap}{named("wrapper", "container", "layout", "row", "page", "col")}>{main}{extra}</{wrap}>'
        # loose text stays apart from the article's by an element
        first, last = (loose() if parts and chance(0.2) else "" for parts in (before, after))
        body = first + "".join(part() for part in before) + main + "".join(part() for part in after) + last
        if chance(0.15):  # nothing but the article
            body = main
        pages.append(body if chance(0.15) else f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title></head><body>{body}{pick('</body></html>', '')}")
    return pages


@lru_cache(maxsize=1)
def trained() -> tuple[np.ndarray, np.ndarray]:
    return train(labelled_pages())


def main_texts(sources: list[str | None], unary: np.ndarray, pair: np.ndarray) -> list[str]:
    """The content blocks of each page, joined by one space."""
    pages = [Page(s or "") for s in sources]
    if not pages:
        return []
    forest = Forest(pages)
    content = forest.messages(unary, pair)[0] > 0.5
    return [" ".join(words for node, words in page.blocks if content[first + node]) for first, page in zip(forest.first, pages)]


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(keep.., text, n_chars) of every row: the main text of the whole html.

    Null, empty and blank pages give an empty text. Nulls in the kept columns and repeated rows are carried through.
    Unclosed, stray and truncated tags are tolerated, unknown references stay as they are. Other columns are not
    read; an empty table gives an empty result. The model is fitted in the driver on ``labelled_pages``, never on
    ``pages``, and is a few hundred numbers.
    """
    use_text_batches(pages.sparkSession, 128)
    unary, pair = trained()

    def make():
        def work(batch):
            texts = main_texts(batch["html"], unary, pair)
            return {**{c: batch[c] for c in keep}, "text": texts, "n_chars": [len(t) for t in texts]}

        return work

    named = pages.select(*keep, F.col(html_col).alias("html"))
    return map_texts(named, [*keep, "html"], [*((c, pages.schema[c].dataType) for c in keep), ("text", T.StringType()), ("n_chars", T.LongType())], make)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
