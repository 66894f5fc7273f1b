"""Main text of web pages: boosted trees over DOM elements and a hierarchical decoding.

Each element that is not inline gets a row of features: its kind, the words of its class, id and
role, its depth, the density of text and links in it and below it, and how it compares with its
siblings. Boosted trees give the log-odds that it belongs to the main text or holds some of it.
Decoding picks the best consistent set: an element can be kept only if its parent is, so each
subtree is kept as a whole decision, worth its own log-odds and its children's best values, or left
out for nothing. The text of kept elements is the result.

The trees are learned from layouts that are put together at random from the words of a bounded
sample of the pages, in which it is known what is main text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dom import Element, read
from .trees import boost, predict

SAMPLE_PAGES = 64
LAYOUTS = 400
TREES, DEPTH, RATE = 60, 4, 0.25

_GROUPS = (
    ("p",), ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("li", "dd", "dt"), ("ul", "ol", "dl", "menu"), ("blockquote", "pre", "figure", "figcaption"), ("table", "tbody", "thead", "tr", "td", "th"),
    ("article",), ("main",), ("section",), ("div", "center"), ("nav",), ("header",), ("footer",), ("aside",), ("form", "fieldset", "button", "dialog"), ("body", "html", "#root"),
)
_GROUP = {t: k for k, g in enumerate(_GROUPS) for t in g}
# Words that class, id and role attributes of web pages commonly hold.
GOOD = "article body content entry main post story text blog page prose"
BAD = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs tabs toolbar pagination pager skip toc",
    "head": "header head masthead top logo brand topbar",
    "foot": "footer foot bottom copyright legal colophon",
    "side": "sidebar side aside widget rail related recommended more popular trending tags share social author bio meta byline",
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner dfp adsense outbrain taboola",
    "note": "cookie cookies consent notice alert gdpr popup modal overlay warning message subscribe newsletter signup login",
    "talk": "comment comments reply replies respond disqus discussion feedback reviews",
    "form": "form search input contact",
}
_WORD_KIND = {w: 0 for w in GOOD.split()} | {w: k for k, words in enumerate(BAD.values(), 1) for w in words.split()}
_TOKENS = re.compile(r"[a-z]+")
_KINDS = 1 + len(BAD)
_KNOWN: dict[str, tuple] = {}


def _kinds(element: Element) -> tuple:
    """How many attribute words of each kind an element has."""
    key = element.attributes
    if not key or ("class" not in key and "id" not in key and "role" not in key):
        return (0,) * _KINDS
    if (known := _KNOWN.get(key)) is not None:
        return known
    out = [0] * _KINDS
    for name in ("class", "id", "role"):
        for word in _TOKENS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", element.attribute(name)).lower()):
            if (k := _WORD_KIND.get(word)) is not None:
                out[k] = 1
    if len(_KNOWN) < 10_000:
        _KNOWN[key] = tuple(out)
    return tuple(out)


def features(elements: list[Element], blocks: list[tuple[Element, str]]) -> list[tuple]:
    """One row of numbers for each element."""
    n = len(elements)
    stops, words = [0] * n, [0] * n
    for e, text in blocks:
        stops[e.index] += text.count(".") + text.count("!") + text.count("?") + text.count(",")
        words[e.index] += text.count(" ") + 1
    chars, links, tags, items, sums = ([0] * n for _ in range(5))
    for e in reversed(elements):
        i = e.index
        chars[i] += e.chars
        links[i] += e.link_chars
        tags[i] += 1 + e.inline
        sums[i] += stops[i]
        items[i] += e.tag == "p"
        if e.parent is not None:
            p = e.parent.index
            chars[p] += chars[i]
            links[p] += links[i]
            tags[p] += tags[i]
            sums[p] += sums[i]
            items[p] += items[i]
            words[p] += words[i]
    total, rows, above, inherited = max(1, chars[0]), [], {}, {}
    for e in elements:
        i, parent = e.index, e.parent
        kinds = _kinds(e)
        group = _GROUP.get(e.tag, len(_GROUPS))
        up = inherited[parent.index] if parent is not None else (0,) * _KINDS
        semantic = above[parent.index] if parent is not None else (0, 0)
        inherited[i] = tuple(map(max, up, kinds))
        above[i] = (semantic[0] or e.tag in ("article", "main"), semantic[1] or e.tag in ("nav", "footer", "aside", "form", "header"))
        k = len(parent.children) if parent is not None else 1
        around = (chars[parent.index] - (parent.chars if parent is not None else 0) - chars[i]) / max(1, k - 1) if parent is not None and k > 1 else 0
        rows.append(
            (
                group, e.depth, _log(chars[i]), _log(e.chars), links[i] / max(1, chars[i]), e.links, chars[i] / tags[i], sums[i] / max(1, words[i]), words[i], chars[i] / max(1, words[i]),
                items[i], len(e.children), k, e.place / k, chars[i] / total, _log(around), chars[i] / (chars[i] + around + 1), _GROUP.get(parent.tag, 17) if parent is not None else -1, i / n,
                *semantic, *kinds, *up,
                *(float(group == g) for g in (0, 1, 3, 4, 7, 8, 9, 10, 11, 12, 13, 14, 15)),
            )
        )
    return rows


def _log(x: float) -> float:
    return float(np.log1p(max(0.0, x)))


def keep(elements: list[Element], odds: np.ndarray) -> list[bool]:
    """The consistent choice of elements with the largest sum of log-odds; the parents of kept ones are kept."""
    best = odds.tolist()
    for e in reversed(elements):
        if e.parent is not None and best[e.index] > 0:
            best[e.parent.index] += best[e.index]
    kept = [False] * len(elements)
    for e in elements:
        kept[e.index] = best[e.index] > 0 and (e.parent is None or kept[e.parent.index])
    return kept


def texts_of(pages: list[str | None], model: tuple[float, list]) -> list[str]:
    """The main text of each page."""
    read_pages = [read(p) for p in pages]
    rows = [r for elements, blocks in read_pages for r in features(elements, blocks)]
    if not rows:
        return []
    x = np.array(rows, float)
    start, trees = model
    odds = np.full(len(x), start)
    for tree in trees:
        odds += RATE * predict(tree, x)
    out, at = [], 0
    for elements, blocks in read_pages:
        kept = keep(elements, odds[at : at + len(elements)])
        at += len(elements)
        out.append("\n".join(text for e, text in blocks if kept[e.index]))
    return out


def layout(rng: np.random.Generator, words: list[str]) -> str:
    """A made-up page; elements of the main text carry data-main."""
    pick = lambda *xs: xs[rng.integers(len(xs))]
    some = lambda a, b: " ".join(words[i] for i in rng.integers(0, len(words), rng.integers(a, b)))
    chance = lambda p: rng.random() < p
    sentence = lambda a=4, b=25: some(a, b).capitalize() + "."
    prose = lambda a=1, b=7: " ".join(sentence() for _ in range(rng.integers(a, b)))
    linked = lambda n: "".join(f'<li><a href="/{k}">{some(1, 3)}</a></li>' for k in range(n))

    def named(kind: str) -> str:
        word = pick(*(BAD[kind].split() if kind in BAD else GOOD.split()))
        return pick(f' class="{word}"', f' id="{word}"', f' class="{word} {pick("wide", "x1", "block", "box")}"', f' class="{pick("site", "page", "the", "c")}-{word}"')

    def menu() -> str:
        inner = f"<ul>{linked(rng.integers(2, 9))}</ul>"
        return pick(f"<nav>{inner}</nav>", f"<div{named('menu')}>{inner}</div>", f"<nav{named('menu')}>{inner}</nav>", f"<ul{named('menu')}>{linked(rng.integers(2, 9))}</ul>")

    def head() -> str:
        inner = pick(f"<div>{some(1, 4)}</div>", f"<h1><a href='/'>{some(1, 3)}</a></h1>", f"<p>{some(2, 7)}</p>", f"{some(1, 5)}") + (menu() if chance(0.5) else "")
        return pick(f"<header>{inner}</header>", f"<div{named('head')}>{inner}</div>", f"<header{named('head')}>{inner}</header>")

    def foot() -> str:
        inner = pick(f"&copy; {some(1, 4)} &middot; {sentence(3, 10)}", f"<p>&copy; {some(2, 8)}</p>", f"<ul>{linked(rng.integers(2, 6))}</ul><p>{some(3, 9)}</p>", prose(1, 3))
        return pick(f"<footer>{inner}</footer>", f"<div{named('foot')}>{inner}</div>", f"<footer{named('foot')}>{inner}</footer>")

    def side() -> str:
        inner = pick(f"<h3>{some(1, 4)}</h3><ul>{linked(rng.integers(2, 7))}</ul>", f"<p>{prose(1, 3)}</p>", f"<h2>{some(1, 4)}</h2><p>{sentence()}</p><p>{sentence()}</p>")
        return pick(f"<aside>{inner}</aside>", f"<div{named('side')}>{inner}</div>", f"<aside{named('side')}>{inner}</aside>", f"<section{named('side')}>{inner}</section>")

    def small(kind: str) -> str:
        inner = pick(sentence(3, 18), f"<p>{sentence(3, 18)}</p>", f"<p>{prose(1, 3)}</p>", f"<a href='/x'>{some(2, 8)}</a>")
        return pick(f"<div{named(kind)}>{inner}</div>", f"<section{named(kind)}>{inner}</section>", f"<p{named(kind)}>{sentence(3, 18)}</p>", f"<div{named(kind)}><div>{inner}</div></div>")

    def form() -> str:
        inner = f"<label>{some(1, 3)}</label><input name=q><button>{some(1, 3)}</button>" + (f"<p>{sentence()}</p>" if chance(0.5) else "")
        return pick(f"<form>{inner}</form>", f"<form{named('form')}>{inner}</form>", f"<div{named('form')}><form>{inner}</form></div>")

    def talk() -> str:
        one = lambda: pick(f"<p>{prose(1, 4)}</p>", f"<div{named('talk')}><p>{some(1, 3)}</p><p>{prose(1, 4)}</p></div>", f"<article{named('talk')}><p>{prose(1, 4)}</p></article>", f"<li>{prose(1, 3)}</li>")
        inner = (f"<h2>{some(1, 3)}</h2>" if chance(0.5) else "") + "".join(one() for _ in range(rng.integers(1, 6)))
        return pick(f"<div{named('talk')}>{inner}</div>", f"<section{named('talk')}>{inner}</section>", f"<ol{named('talk')}>{inner}</ol>")

    junk = (lambda: small("ad"), lambda: small("ad"), lambda: small("note"), side, form, menu)

    def piece() -> str:
        m = " data-main"
        text = sentence(2, 8) if chance(0.2) else prose()
        if chance(0.1):
            text = f"<b>{sentence()}</b> {text} <a href='/y'>{some(1, 3)}</a>"
        roll = rng.random()
        if roll < 0.72:
            return f"<p{m}>{text}</p>" if chance(0.9) else f"<p{m}><b>{text}<br>"
        if roll < 0.82:
            return f"<{(h := pick('h2', 'h3'))}{m}>{some(1, 8)}</{h}>"
        if roll < 0.9:
            return f"<ul{m}>" + "".join(f"<li{m}>{sentence(2, 14)}</li>" for _ in range(rng.integers(2, 6))) + "</ul>"
        if roll < 0.94:
            return f"<blockquote{m}><p{m}>{text}</p></blockquote>"
        if roll < 0.97:
            return f"<table{m}>" + "".join(f"<tr{m}><td{m}>{some(1, 4)}</td><td{m}>{some(1, 6)}</td></tr>" for _ in range(rng.integers(1, 4))) + "</table>"
        return f"<div{m}>{text}</div>"

    def article() -> str:
        title = f"<h1 data-main>{some(1, 10)}</h1>" if chance(0.85) else ""
        title = f"<header data-main>{title}</header>" if title and chance(0.1) else title
        parts = [piece() for _ in range(rng.integers(1, 18))]
        if chance(0.35):
            parts.insert(int(rng.integers(0, len(parts) + 1)), pick(*junk)())
        if chance(0.15):
            parts.append(talk())
        inner = title + "".join(parts)
        if chance(0.15):  # right in the body
            return inner
        tag = pick("article", "article", "article", "main", "div", "section")
        names = named("good") if tag == "div" or chance(0.4) else ""
        if tag == "div" and chance(0.25):
            names = ""
        out = f"<{tag}{names} data-main>{inner}</{tag}>"
        return f"<{(w := pick('main', 'div', 'section', 'div'))}{pick('', named('good'))} data-main>{out}</{w}>" if chance(0.4) else out

    before = [f() for f in (head, menu, lambda: small("ad"), lambda: small("note"), side, form) if chance(0.4)]
    after = [f() for f in (side, talk, lambda: small("ad"), form, foot, lambda: small("note")) if chance(0.45)]
    if chance(0.15):  # nothing else on the page
        before, after = [], []
    middle = "".join(before) + (article() if chance(0.97) else "") + "".join(after)
    if chance(0.3):
        middle = f"<div{pick('', ' id=wrap', ' class=container')} data-main>{middle}</div>"
    return f"<html><head><title>{some(1, 8)}</title></head><body data-main>{middle}</body></html>"


def fit(pages: list[str | None], layouts: int = LAYOUTS, seed: int = 11) -> tuple[float, list]:
    """Learn the trees from layouts made of the pages' words; without any words, from placeholder ones."""
    words = sorted({w for p in pages for _, text in read(p)[1] for w in text.split()}) or ["word"]
    rng = np.random.default_rng(seed)
    x, y = [], []
    for _ in range(layouts):
        elements, blocks = read(layout(rng, words))
        x += features(elements, blocks)
        y += [float("data-main" in e.attributes or e.tag in ("html", "#root")) for e in elements]
    return boost(np.array(x, float), np.array(y), trees=TREES, depth=DEPTH, rate=RATE)


def learn(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> tuple[float, list]:
    """Fit on the pages whose ids have the smallest hashes, sample_pages at most."""
    ids = [r[0] for r in pages.where("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages).collect()]
    rows = pages.where(F.col("page_id").isin(ids)).select("html").orderBy(F.xxhash64("html")).limit(sample_pages).collect() if ids else []
    return fit([r[0] for r in rows])


def extracted(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    text holds the blocks of the main text in page order, joined by line feeds; character
    references are decoded and white space inside a block is one space. It is empty if there is
    none, and for a null page. Pages of any length are read whole. Repeated rows give repeated rows
    and an empty table none; other columns are not read.
    """
    model = learn(pages, sample_pages)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = texts_of(part.column("html").to_pylist(), model)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(texts, "page_id bigint, url string, text string, n_chars bigint")
