"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, with their open ancestors. Each
block has ancestor features (tags, and the words of class, id and role) and text features; two labels
(main text, other) form a chain with learned transitions, and Viterbi decoding picks the labels of all
blocks together.

The field is trained on labelled pages: layouts whose parts carry their label (articles in many
containers; menus, headers, footers, sidebars, notices, adverts, forms, reader comments), filled with
sentences of at most ``SAMPLE_PAGES`` pages of the table (lowest hash of page_id). The fit is the only
bounded step; extraction covers every whole page.

NULL and empty html give an empty text. Unclosed tags, stray end tags and unquoted attributes are
accepted; a page without main text gives an empty text. Repeated rows are treated alike.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 64
SAMPLE_CHARS = 20_000
LAYOUTS = 800
STEPS = 200
SEED = 11

# Elements of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr "
                   "object svg g text tspan math semantics annotation mi mn mo ms mtext mrow mfrac msqrt mroot mstyle mspace "
                   "msub msup msubsup munder mover munderover mpadded mphantom menclose mtable mtr mtd".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title select".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
# These keep an implied end tag from closing elements outside them.
FENCES = frozenset("article aside body blockquote div footer form header main nav section table ul ol dl figure".split())
_OPENS_PARAGRAPH = FENCES | frozenset("p h1 h2 h3 h4 h5 h6 pre hr address".split())

_TAG = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
_SAYS = re.compile(r"©|copyright|all rights reserved|cookie|subscribe|newsletter|sign in|log in|advert|sponsored|comment|repl(?:y|ies)", re.I)


@dataclass(eq=False)
class _Open:
    """An open element; its ancestors' features are reached through ``parent``, not copied."""
    tag: str
    own: list[str]
    parent: _Open | None = None


@dataclass
class Block:
    text: str
    above: _Open | None
    own: list[str]

    @property
    def features(self) -> list[str]:
        out, node = list(self.own), self.above
        while node is not None:
            out += node.own
            node = node.parent
        return out


@dataclass
class Field:
    """Weights of the field: a score of label main for each feature, and transitions."""
    weights: dict[str, float] = field(default_factory=dict)
    start: tuple[float, float] = (0.0, 0.0)
    moves: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))

    def labels(self, blocks: list[Block]) -> list[int]:
        """The best label sequence (1: main)."""
        if not blocks:
            return []
        (a00, a01), (a10, a11) = self.moves
        back: list[tuple[int, int]] = []
        other, main = self.start
        known: dict[_Open | None, float] = {None: 0.0}  # an element's and its ancestors' weight
        for k, block in enumerate(blocks):
            path, node = [], block.above
            while node not in known:
                path.append(node)
                node = node.parent
            score = known[node]
            for node in reversed(path):
                score = known[node] = score + sum(self.weights.get(f, 0.0) for f in node.own)
            score += sum(self.weights.get(f, 0.0) for f in block.own)
            if k:
                to_other, to_main = (other + a00, main + a10), (other + a01, main + a11)
                back.append((int(to_other[1] > to_other[0]), int(to_main[1] > to_main[0])))
                other, main = max(to_other), max(to_main)
            main += score
        out = [int(main > other)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]


def _ancestor_features(tag: str, attributes: str) -> list[str]:
    out = ["in=" + tag]
    for m in _NAMED.finditer(attributes):
        out += ["name=" + w[:7] for w in _WORDS.findall((m[1] or m[2] or m[3] or "").lower())]
    if re.search(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*.?true", attributes, re.I):
        out.append("hidden")
    return out


def _text_features(text: str, linked: int, tag: str) -> list[str]:
    n = text.count(" ") + 1
    share = linked / len(text)
    return [f"tag={tag}", f"words={min(n, 64).bit_length()}", f"links={0 if not linked else 1 + (share > 0.5) + (share > 0.9)}",
            f"stop={text[-1] in '.!?…:;'}", f"says={bool(_SAYS.search(text))}", "bias"]


def leaf_blocks(page: str) -> list[Block]:
    """The page's leaf blocks in order, character references decoded and white space made one space."""
    stack: list[_Open] = []
    open_at: dict[str, list[int]] = {}  # depths of the open elements of a tag, of those that are no inline ones, and of fences
    outer: list[int] = []
    fences: list[int] = []
    blocks: list[Block] = []
    held: list[str] = []
    linked = at = 0
    unclosed: set[str] = set()  # tags without an end in the rest of the page
    last = page.rfind(">") + 1  # no tag ends after it

    def end_block() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(held)).split()) if held else ""
        held.clear()
        if text:
            tag = stack[outer[-1]].tag if outer else ""
            blocks.append(Block(text, stack[-1] if stack else None, _text_features(text, min(linked, len(text)), tag)))
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            held.append(text)
            if open_at.get("a"):
                linked += len(text)

    def close_from(depth: int) -> None:
        for o in stack[depth:]:
            open_at[o.tag].pop()
        for depths in (outer, fences):
            while depths and depths[-1] >= depth:
                depths.pop()
        del stack[depth:]

    while True:
        m = _TAG.search(page, at, last)
        if m is None:
            rest = re.compile("<[!?]").search(page, max(at, last))  # a declaration without an end
            take(page[at:rest.start() if rest else len(page)])
            break
        take(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            cdata = m[0].startswith("<![CDATA[")
            if cdata and not m[0].endswith("]]>") or m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(page)
            if cdata:
                take(entities.escape(page[m.start() + 9:at].removesuffix("]]>")))
            continue
        tag = m[2].lower()
        if m[1]:
            depths = open_at.get(tag)
            if tag not in INLINE:
                end_block()
            # the end of an inline element does not reach beyond the element that it is in
            if depths and (tag not in INLINE or not outer or outer[-1] < depths[-1]):
                close_from(depths[-1])
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/") and tag not in unclosed:
                close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                if close:
                    at = close.end()
                elif tag in ("script", "style"):
                    at = len(page)
                else:  # its parent's end is its own: what follows is read as text
                    unclosed.add(tag)
            end_block()
            continue
        if tag not in INLINE:
            end_block()
            gone = CLOSES.get(tag, {"p"} if tag in _OPENS_PARAGRAPH else ())
            fence = fences[-1] if fences else -1
            ends = []
            for name in gone:
                depths = open_at.get(name, [])
                k = bisect_right(depths, fence)
                if k < len(depths):
                    ends.append(depths[k])
            if ends:
                close_from(min(ends))
        if tag not in VOID and not m[3].endswith("/"):
            for depths, fits in ((open_at.setdefault(tag, []), True), (outer, tag not in INLINE), (fences, tag in FENCES)):
                if fits:
                    depths.append(len(stack))
            stack.append(_Open(tag, _ancestor_features(tag, m[3]), stack[-1] if stack else None))
    end_block()
    return blocks


def main_text(page: str, crf: Field) -> str:
    blocks = leaf_blocks(page)
    return "\n\n".join([b.text for b, y in zip(blocks, crf.labels(blocks)) if y])


# Labelled layouts. Words that class and id attributes of such parts use.
_NAMES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topnav toc pagination pager tabs",
    "header": "header masthead topbar branding logo banner toolbar site-header page-header",
    "footer": "footer copyright legal colophon credits site-footer bottom imprint",
    "sidebar": "sidebar aside widget related recommended trending popular more-stories teaser tags",
    "notice": "notice cookie consent alert gdpr message newsletter subscribe popup modal paywall warning disclaimer",
    "advert": "ad ads advert advertisement sponsored sponsor promo promotion adsense banner-ad commercial",
    "form": "form search login signup contact feedback survey poll",
    "comments": "comments comment comment-list discussion replies responses disqus reader-comments thread",
    "share": "share social sharing follow buttons byline meta author",
}
_MAIN_NAMES = "content post entry article story body main text article-body post-content entry-content page-content prose"


_MAIN_MARK = "\x01"  # begins the main texts of a rendered layout


def _labelled_pages(sentences: list[str], count: int, seed: int) -> list[str]:
    """Pages of random layouts, whose main texts carry the mark."""
    rng = np.random.default_rng(seed)
    pick = lambda items: items[int(rng.integers(len(items)))]
    chance = lambda p: rng.random() < p

    def text(label: int, low: int, high: int) -> str:
        high = max(low, int(high * rng.random() ** 2))  # short and long texts of either label
        words = [w for _ in range(3) for w in pick(sentences).split()[:high]][:int(rng.integers(low, high + 1))]
        stop = "." if chance(0.7) else ""
        return (_MAIN_MARK if label else "") + entities.escape(" ".join(words) or "text") + stop

    def named(kind: str) -> str:
        name = pick(_NAMES[kind].split())
        return pick([f' class="{name}"', f' id="{name}"', f' class="{name} box{rng.integers(9)}"', f" class='site-{name}'"])

    def link(label: int = 0) -> str:
        return f'<a href="/x{rng.integers(99)}">{text(label, 1, 4)}</a>'

    def other(kind: str) -> str:
        if kind == "menu":
            inside = "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.integers(2, 7))) + "</ul>"
            return pick([f"<nav>{inside}</nav>", f"<nav{named(kind)}>{inside}</nav>", f"<div{named(kind)}>{inside}</div>"])
        if kind == "header":
            inside = pick([f"<h1>{link()}</h1>", f"<p>{text(0, 1, 30)}</p>", f"<div>{text(0, 1, 4)}</div><p>{text(0, 3, 30)}</p>"])
            return pick([f"<header>{inside}</header>", f"<header{named(kind)}>{inside}</header>", f"<div{named(kind)}>{inside}</div>"])
        if kind == "footer":
            inside = pick([f"&copy; {text(0, 2, 40)}", f"<p>{text(0, 1, 60)}</p><p>{link()}</p>", f"<ul><li>{link()}</li><li>{link()}</li></ul>"])
            return pick([f"<footer>{inside}</footer>", f"<footer{named(kind)}>{inside}</footer>", f"<div{named(kind)}>{inside}</div>"])
        if kind == "sidebar":
            inside = pick([f"<h3>{text(0, 1, 5)}</h3><p>{text(0, 1, 60)}</p>", f"<h2>{text(0, 1, 4)}</h2><ul><li>{link()}</li><li>{link()}</li></ul>"])
            return pick([f"<aside>{inside}</aside>", f"<aside{named(kind)}>{inside}</aside>", f"<div{named(kind)}>{inside}</div>"])
        if kind == "form":
            inside = f"<label>{text(0, 1, 4)}</label> <input type=text><p>{text(0, 1, 40)}</p><button>{text(0, 1, 2)}</button>"
            return pick([f"<form action='/s'>{inside}</form>", f"<form{named(kind)}>{inside}</form>", f"<div{named(kind)}><form>{inside}</form></div>"])
        if kind == "comments":
            one = lambda: pick([f"<li><b>{text(0, 1, 60)}</b></li>", f"<div class=\"comment\"><p>{text(0, 1, 80)}</p></div>", f"<p>{text(0, 1, 80)}</p>"])
            inside = (f"<h3>{text(0, 1, 3)}</h3>" if chance(0.5) else "") + "".join(one() for _ in range(rng.integers(1, 5)))
            return pick([f"<section{named(kind)}>{inside}</section>", f"<div{named(kind)}>{inside}</div>", f"<ol{named(kind)}>{inside}</ol>"])
        inside = pick([f"<p>{text(0, 1, 60)}</p>", text(0, 1, 60), f"{text(0, 1, 20)} <a href='#'>more</a>"])
        return pick([f"<div{named(kind)}>{inside}</div>", f"<section{named(kind)}>{inside}</section>", f"<p{named(kind)}>{text(0, 3, 20)}</p>"])

    def paragraph() -> str:
        return pick([lambda: f"<p>{text(1, 1, 90)}</p>", lambda: f"<p>{text(1, 1, 90)}", lambda: f"<p><b>{text(1, 1, 60)}<br>",
                     lambda: f"<h{rng.integers(2, 5)}>{text(1, 1, 12)}</h2>", lambda: f"<ul><li>{text(1, 1, 30)}</li><li>{text(1, 1, 30)}</li></ul>",
                     lambda: f"<blockquote>{text(1, 1, 60)}</blockquote>", lambda: f"<pre>{text(1, 1, 30)}</pre>",
                     lambda: f"<p>{text(1, 1, 60)}</p>", lambda: f"<div>{text(1, 1, 90)}</div>", lambda: f"<p>{text(1, 1, 8)}</p>",
                     lambda: f"<table><tr><td>{text(1, 1, 12)}</td><td>{text(1, 1, 12)}</td></tr></table>",
                     lambda: f"<p>{text(1, 1, 60)} <a href='/r'>link</a> {text(0, 1, 20)}</p>"])()

    out = []
    inner = ["advert", "share", "notice", "sidebar", "form", "menu", "comments"]
    for _ in range(count):
        parts = ["<html><head><title>t</title></head><body>"]
        for kind, p in (("notice", 0.3), ("header", 0.5), ("menu", 0.7), ("advert", 0.5), ("sidebar", 0.2), ("form", 0.2)):
            if chance(p):
                parts.append(other(kind))
        tag = pick(["article", "article", "main", "div", "div", "section"])
        name = f' {pick(["class", "id"])}="{pick(_MAIN_NAMES.split())}"' if tag in ("div", "section") or chance(0.3) else ""
        kind = rng.random()
        if kind > 0.03:  # else a page without main text
            parts.append(f"<{tag}{name}>" if kind > 0.12 else "")  # or one without a container
            if chance(0.8):
                title = f"<h1>{text(1, 2, 12)}</h1>"
                parts.append(f"<header>{title}</header>" if tag == "article" and chance(0.1) else title)
            for _ in range(int(rng.integers(1, 12))):
                parts.append(paragraph())
                if chance(0.1):
                    parts.append(other(pick(inner)))
            parts.append(f"</{tag}>" if kind > 0.12 else "")
        for kind, p in (("share", 0.2), ("comments", 0.5), ("form", 0.3), ("sidebar", 0.4), ("advert", 0.3), ("menu", 0.2), ("notice", 0.2), ("footer", 0.8)):
            if chance(p):
                parts.append(other(kind))
        out.append("".join(parts) + "</body></html>")
    return out


def train(labelled: list[tuple[list[Block], list[int]]], steps: int = STEPS, penalty: float = 0.005) -> Field:
    """Maximum likelihood with an L2 penalty: forward-backward over all pages at once, Adam steps."""
    names = {f: k for k, f in enumerate(sorted({f for blocks, _ in labelled for b in blocks for f in b.features}))}
    rows, columns, n = [], [], 0
    for blocks, _ in labelled:
        for b in blocks:
            columns += [names[f] for f in b.features]
            rows += [n] * len(b.features)
            n += 1
    rows, columns = np.array(rows), np.array(columns)
    lengths = np.array([len(y) for _, y in labelled])
    longest, pages = int(lengths.max()), len(labelled)
    y = np.concatenate([y for _, y in labelled])
    page, step = np.repeat(np.arange(pages), lengths), np.concatenate([np.arange(k) for k in lengths])
    gold = np.full((pages, longest), -1)
    gold[page, step] = y
    inside = gold >= 0
    w = np.zeros(len(names) + 6)  # feature weights, start (2), moves (4)
    moved = (gold[:, :-1] * 2 + gold[:, 1:])[inside[:, 1:]]
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        unary = np.zeros((pages, longest, 2))
        unary[page, step, 1] = np.bincount(rows, w[columns], n)
        start, moves = w[-6:-4], w[-4:].reshape(2, 2)
        ahead = np.zeros((pages, longest, 2))
        ahead[:, 0] = unary[:, 0] + start
        for k in range(1, longest):
            ahead[:, k] = np.logaddexp.reduce(ahead[:, k - 1, :, None] + moves, axis=1) + unary[:, k]
        behind = np.zeros((pages, longest, 2))
        for k in range(longest - 2, -1, -1):
            nxt = np.logaddexp.reduce(moves + (unary[:, k + 1] + behind[:, k + 1])[:, None, :], axis=2)
            behind[:, k] = np.where(inside[:, k + 1, None], nxt, 0.0)
        total = np.logaddexp.reduce(ahead[np.arange(pages), lengths - 1], axis=1)
        main = np.exp(ahead + behind - total[:, None, None])
        g = np.zeros_like(w)
        g[:len(names)] = np.bincount(columns, (y - main[page, step, 1])[rows], len(names))
        g[-6:-4] = np.bincount(gold[:, 0], minlength=2) - main[:, 0].sum(0)
        pairs = np.exp(ahead[:, :-1, :, None] + moves + (unary + behind)[:, 1:, None, :] - total[:, None, None, None])
        g[-4:] = np.bincount(moved, minlength=4) - pairs[inside[:, 1:]].sum(0).ravel()
        g = g / pages - penalty / pages * 10 * w
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w + 0.1 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    return Field({f: float(w[k]) for f, k in names.items()}, tuple(w[-6:-4].tolist()),
                 tuple(tuple(r) for r in w[-4:].reshape(2, 2).tolist()))


def labelled_blocks(sentences: list[str], count: int = LAYOUTS, seed: int = SEED) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels (1: main) of rendered layouts."""
    pages = [leaf_blocks(page) for page in _labelled_pages(sentences, count, seed)]
    return [(blocks, [int(_MAIN_MARK in b.text) for b in blocks]) for blocks in pages if blocks]


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Field:
    """The field for ``pages(page_id, html)``."""
    ids = [r.page_id for r in pages.filter("page_id is not null").select("page_id").distinct()
           .orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages).collect()]
    sample = pages.filter(F.col("page_id").isin(ids)).select(F.substring("html", 1, SAMPLE_CHARS).alias("html")).collect() if ids else []
    sentences = sorted({b.text for r in sample for b in leaf_blocks(r.html or "")})
    return train(labelled_blocks(sentences or ["Some words of a text", "Another line", "A last one"]))


def _extract(crf: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", crf) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return run


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return pages.mapInArrow(_extract(fit(pages)), "page_id long, url string, text string, n_chars long")
