"""Main text of HTML pages by a tree-structured graphical model over the DOM.

Every element is a binary variable: does it hold content? Its own potential is log-linear in its tag, its class, id and role
words, its share of link text and its length; a potential per kind of child couples it to its parent. Messages go from the leaves
upward and from the root downward (sum-product), for all pages of a batch at once, one depth at a time; the text of elements
whose content marginal is above one half is kept. The weights are trained by gradient ascent on the likelihood of labelled pages,
whose expectations come from the same message passing; the labelled pages are laid out by rule in labelled_pages().

An article's own header, its headline and byline, and its details, open or not, belong to it; hidden elements do not, wherever they stand,
nor do notes that are as short as notices under a notice's name. A form that holds the whole page is only its wrapper. A menu that is a bare list of links
in a cell of a layout table may be taken for content.

Null and empty html, and pages without content, give an empty text. Broken markup is read as far as it goes; no page is dropped
and no text is capped. Repeated rows give equal texts. An empty table gives none. Only page_id, url and html are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of elements, by tag. The last kind is any other tag.
KINDS = [
    "article", "main", "section", "div center", "p", "h1", "h2 h3 h4 h5 h6", "ul ol dl menu", "li dt dd", "a", "nav", "header", "footer", "aside", "form fieldset input button select option textarea label",
    "script style noscript template iframe svg object canvas", "table tbody thead tr td th caption", "figure figcaption picture img video audio", "blockquote pre", "b i em strong span u small sup sub code q cite mark abbr time font s del ins kbd var br wbr",
    "body", "html", "head", "title meta link base", "dialog", "details summary",
]
KIND = {tag: k for k, tags in enumerate(KINDS) for tag in tags.split()}
#: Groups of words in class, id and role. The last four groups stand on parts of articles as well as on clutter.
WORDS = [
    "content article post entry story main text prose maincontent articlebody",
    "nav navigation menu navbar breadcrumb breadcrumbs pagination pager toc tabs topbar menubar sitemap skip",
    "header masthead banner hero logo branding",
    "footer copyright legal contentinfo colophon imprint",
    "sidebar aside widget widgets recommended recommendations teaser teasers rail",
    "cookie cookies consent gdpr popup modal overlay dialog newsletter subscribe subscription signup paywall toast",
    "ad ads adv advert adverts advertisement sponsor sponsored sponsors promo promotion promoted affiliate dfp adsense",
    "comment comments commentlist disqus respond",
    "share sharing social follow toolbar",
    "form search login searchbox register",
    "related more popular trending complementary",
    "notice alert disclaimer warning announcement",
    "discussion feedback reviews responses reply replies",
    "tags meta byline author print tools",
]
#: The groups that stand on clutter only.
CLUTTER = range(1, 10)
WORD = {w: k for k, words in enumerate(WORDS) for w in words.split()}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(KINDS[19].split() + ["a", "label", "img"])
#: Open elements that a start tag ends, and where the search for them stops.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = set("html body table ul ol dl td th article section div main aside nav header footer form blockquote select".split())
FEATURES = len(KINDS) + 1 + len(WORDS) + 17
EDGES = len(KINDS) + 1
#: The kinds of lists and their items, of elements that name a page's main part, and of those whose text no reader sees.
LISTS, NAMED, UNSEEN = [KIND["ul"], KIND["li"]], [KIND["article"], KIND["main"], KIND["h1"]], [KIND["script"], KIND["meta"], KIND["head"]]
#: Full stops and commas from which a part is longer than clutter mostly is.
LONG_STOPS = 6
SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")


def wall(tag: str) -> bool:
    return tag not in INLINE and tag != "p"


class Dom(HTMLParser):
    """Elements of a page: parent, tag, words, and its texts in page order with the element they stand in; None is a block's edge."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parents, self.tags, self.words, self.depths, self.labels, self.hidden = [-1], ["html"], [()], [0], [None], [False]
        self.runs: list[tuple[int, str] | None] = []
        self.stack = [0]
        # places in the stack: of each tag's open elements, and of those that no inline end tag reaches across
        self.places: dict[str, list[int]] = defaultdict(list)
        self.walls: list[int] = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html" and len(self.tags) == 1:
            return
        block = tag not in INLINE
        if block:
            self.runs.append(None)
            if tag in ENDS:
                self.end_open(ENDS[tag], SCOPE - {"td", "th"} if tag == "tr" else SCOPE)
            else:
                self.end_open({"p"}, SCOPE)
        elif tag == "br":
            self.runs.append((self.stack[-1], " "))
        node = len(self.tags)
        words, label, hidden = (), None, False
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                words += tuple({WORD[w] for w in map(str.lower, SPLIT.split(value)) if w in WORD})
            elif name == "data-label":
                label = value
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and value and "display:none" in value.replace(" ", ""):
                hidden = True
        self.parents.append(self.stack[-1])
        self.tags.append(tag)
        self.words.append(words)
        self.depths.append(len(self.stack))
        self.labels.append(label)
        self.hidden.append(hidden)
        if tag not in VOID:
            self.places[tag].append(len(self.stack))
            if wall(tag):
                self.walls.append(len(self.stack))
            self.stack.append(node)

    def last(self, tags: set[str]) -> int:
        """The place of the innermost open element of the given tags, 0 for none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def shut(self, place: int) -> None:
        for node in self.stack[place:]:
            self.places[self.tags[node]].pop()
            if wall(self.tags[node]):
                self.walls.pop()
        del self.stack[place:]

    def end_open(self, tags: set[str], scope: set[str]) -> None:
        place = self.last(tags)
        if place and place >= self.last(scope):
            self.shut(place)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.runs.append(None)
        place = self.last({tag})
        if place and (tag not in INLINE or not self.walls or place > self.walls[-1]):
            self.shut(place)

    def handle_data(self, data: str) -> None:
        self.runs.append((self.stack[-1], data))


@dataclass
class Forest:
    """The elements of several pages, as arrays."""

    doms: list[Dom]
    starts: np.ndarray
    parent: np.ndarray
    depth: np.ndarray
    kind: np.ndarray
    x: np.ndarray


def forest(doms: list[Dom]) -> Forest:
    sizes = np.array([len(d.tags) for d in doms], np.int64)
    starts = np.cumsum(sizes) - sizes
    parent = np.concatenate([np.array(d.parents, np.int64) + s for d, s in zip(doms, starts)])
    depth = np.concatenate([np.array(d.depths, np.int64) for d in doms])
    parent[depth == 0] = -1
    kind = np.fromiter((KIND.get(t, len(KINDS)) for d in doms for t in d.tags), np.int64, int(sizes.sum()))
    n = len(kind)
    x = np.zeros((n, FEATURES), np.float32)
    x[np.arange(n), kind] = 1
    at = [(int(s) + i, len(KINDS) + 1 + w) for d, s in zip(doms, starts) for i, ws in enumerate(d.words) if ws for w in ws]
    if at:
        x[tuple(np.array(at).T)] = 1
    length, linked, stops, seen, named, around, clutter = (np.zeros(n) for _ in range(7))
    for d, s in zip(doms, starts):
        for run in d.runs:
            if run is not None and not run[1].isspace():
                length[s + run[0]] += len(run[1])
                stops[s + run[0]] += run[1].count(".") + run[1].count(",")
    linked[kind == KIND["a"]] = length[kind == KIND["a"]]
    seen[~np.isin(kind, UNSEEN)] = length[~np.isin(kind, UNSEEN)]
    named[np.isin(kind, NAMED)] = 1
    around[np.isin(kind, NAMED[:2])] = 1
    order = np.argsort(-depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    within = x[:, len(KINDS) + 1 + CLUTTER.start : len(KINDS) + 1 + CLUTTER.stop].any(1)
    inside = around > 0
    for level in levels[-2::-1]:
        within[level] |= within[parent[level]]
        inside[level] |= inside[parent[level]]
    clutter[within] = length[within]
    for level in levels:
        if depth[level[0]] > 0:
            for v in (length, linked, stops, seen, named, around, clutter):
                np.add.at(v, parent[level], v[level])
    base = len(KINDS) + 1 + len(WORDS)
    x[:, base] = 1
    share = np.minimum(linked / np.maximum(length, 1), 1)
    x[:, base + 1] = np.where(np.isin(kind, LISTS), 0, share)
    x[:, base + 7] = np.where(np.isin(kind, LISTS), share, 0)
    x[:, base + 8] = seen / np.maximum(np.repeat(seen[starts], sizes), 1)
    x[:, base + 9] = named > 0
    x[:, base + 10] = clutter / np.maximum(length, 1)
    # a word that stands on clutter as well as on parts of an article, within one; and how much of the text there is links
    either = x[:, len(KINDS) + 1 + CLUTTER.stop : base].any(1) & inside
    x[:, base + 12] = either
    x[:, base + 13] = either * share
    # a word of clutter on a part of an article that is as long as clutter seldom is, or that has a heading; and on what holds most of a page
    lone = x[:, len(KINDS) + 1 + CLUTTER.start : len(KINDS) + 1 + CLUTTER.stop].any(1)
    x[:, base + 14] = lone * inside * (stops >= LONG_STOPS) * (1 - share)
    x[:, base + 15] = (lone | (kind == KIND["form"])) * (x[:, base + 8] > 0.6)
    x[:, base + 16] = np.isin(kind, [KIND["details"], KIND["header"]]) * inside
    # beside the page's article or main part, if it has one
    x[:, base + 11] = (np.repeat(around[starts], sizes) > 0) & (around == 0) & ~inside
    x[:, base + 2] = np.log1p(length) / 8
    x[:, base + 3] = np.minimum(stops * 20 / np.maximum(length, 1), 1)
    x[:, base + 4] = length == 0
    x[:, base + 5] = np.concatenate([d.hidden for d in doms])
    x[:, base + 6] = np.minimum(depth, 10) / 10
    return Forest(doms, starts, parent, depth, kind, x)


def beliefs(f: Forest, w: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Content marginal of each element, and the joint marginals (elements, parent's state, own state) of each edge."""
    own = np.zeros((len(f.kind), 2))
    own[:, 1] = f.x @ w
    pair = theta[f.kind]
    up = np.zeros_like(own)
    order = np.argsort(f.depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(f.depth[order])) + 1)
    for level in levels[:0:-1]:
        up[level] = np.logaddexp.reduce(own[level][:, None, :] + pair[level], 2)
        for k in (0, 1):
            np.add.at(own[:, k], f.parent[level], up[level, k])
    full, joint = own.copy(), np.zeros((len(own), 2, 2))
    for level in levels[1:]:
        rest = full[f.parent[level]] - up[level]
        both = rest[:, :, None] + pair[level]
        joint[level] = both + own[level][:, None, :]
        full[level] += np.logaddexp.reduce(both, 1)
    p = 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -500, 500)))
    joint -= joint.max((1, 2), keepdims=True)
    joint = np.exp(joint)
    return p, joint / joint.sum((1, 2), keepdims=True)


@dataclass
class Model:
    w: np.ndarray
    theta: np.ndarray


def labels_of(f: Forest) -> np.ndarray:
    """1 for elements marked as content, all below them unless marked otherwise, and all above them."""
    y = np.zeros(len(f.kind), np.int64)
    for d, s in zip(f.doms, f.starts):
        for i, label in enumerate(d.labels):
            y[s + i] = {"content": 1, "other": 0}.get(label, y[f.parent[s + i]] if i else 0)
        for i in range(len(d.labels) - 1, 0, -1):
            if y[s + i]:
                y[f.parent[s + i]] = 1
    return y


@lru_cache
def train(pages: int = 300, steps: int = 300, seed: int = 11) -> Model:
    """Weights of highest penalised likelihood on labelled pages, and half as many odd ones (adaptive gradient ascent)."""
    f = forest([Dom(h) for h in labelled_pages(pages, seed) + labelled_pages(pages // 2, seed + 1, True)])
    f.x = f.x.astype(float)
    y = labels_of(f)
    child = f.depth > 0
    w, theta = np.zeros(FEATURES), np.zeros((EDGES, 2, 2))
    seen = np.zeros_like(theta)
    np.add.at(seen, (f.kind[child], y[f.parent[child]], y[child]), 1)
    moments = [np.zeros(w.size + theta.size) for _ in range(2)]
    for t in range(1, steps + 1):
        p, joint = beliefs(f, w, theta)
        expected = np.stack([np.bincount(f.kind[child], joint[child].reshape(-1, 4)[:, k], EDGES) for k in range(4)], 1).reshape(theta.shape)
        g = np.concatenate([f.x.T @ (y - p) - 0.3 * w, (seen - expected - 0.3 * theta).ravel()])
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.99 * moments[1] + 0.01 * g * g
        step = 0.08 * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.99**t)) + 1e-8)
        w = w + step[: w.size]
        theta = theta + step[w.size :].reshape(theta.shape)
    return Model(w, theta)


def texts(htmls: list[str | None], model: Model) -> list[str]:
    """The main text of each page: kept blocks in page order, joined by blank lines."""
    if not htmls:
        return []
    doms = [Dom(h or "") for h in htmls]
    f = forest(doms)
    p, _ = beliefs(f, model.w, model.theta)
    out = []
    for d, s in zip(doms, f.starts.tolist()):
        keep, blocks, now = (p[s : s + len(d.tags)] > 0.5).tolist(), [], []
        for run in d.runs:
            if run is None:
                if now:
                    blocks.append(" ".join("".join(now).split()))
                    now = []
            elif keep[run[0]]:
                now.append(run[1])
        blocks.append(" ".join("".join(now).split()))
        out.append("\n\n".join(b for b in blocks if b))
    return out


TEXT = "page_id bigint, url string, text string, n_chars bigint"


def extract(pages: DataFrame, model: Model | None = None, batch_pages: int = 100) -> DataFrame:
    """TEXT of every page."""
    model = model or train()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(2).to_pylist()
            got = [t for lo in range(0, len(html), batch_pages) for t in texts(html[lo : lo + batch_pages], model)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(work, TEXT)


def labelled_pages(n: int, seed: int, odd: bool = False) -> list[str]:
    """Pages of varied layout whose data-label attributes mark content and what is not content within it. odd: also with parts and boxes
    that have any word of clutter, details, hidden parts, headlines in headers, layouts by tables, and forms around a whole page."""
    rng = np.random.default_rng(seed)
    pick = lambda *options: options[rng.integers(len(options))]
    chance = lambda p: rng.random() < p

    def words(lo: int, hi: int) -> str:
        return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 9))) for _ in range(rng.integers(lo, hi + 1)))

    def sentences(lo: int, hi: int) -> str:
        return " ".join(words(2, 14).capitalize() + pick(".", ".", ".", "!", "?") for _ in range(rng.integers(lo, hi + 1)))

    def inline() -> str:
        return sentences(1, 6) + (f" <{(t := pick('b', 'a', 'em', 'span', 'strong', 'code'))}>{words(1, 3)}</{t}> {sentences(1, 2)}" if chance(0.4) else "")

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(1, 2)}</a></li>' for i in range(k))

    def remarks() -> str:
        each = lambda: pick(f"<div class='comment'><p>{sentences(1, 4)}</p></div>", f"<li class='comment'><b>{words(1, 1)}</b><p>{sentences(1, 3)}</p></li>", f"<article class='comment'><p>{sentences(1, 3)}</p></article>", f"<div><span>{words(1, 1)}</span><p>{sentences(1, 3)}</p></div>")
        body = "".join(each() for _ in range(rng.integers(1, 6)))
        marked = "".join(f"<{(t := pick('div', 'li', 'article'))} class='{pick('comment', 'comment reply')}'><p>{sentences(1, 3)}</p></{t}>" for _ in range(rng.integers(1, 4)))
        return pick(f"<section class='comments'><h3>{words(1, 2)}</h3>{body}</section>", f"<div id='comments'><h2>{words(1, 3)}</h2>{body}</div>", f"<ol class='commentlist'>{body}</ol>", f"<div class='reader-comments'>{body}</div>", f"<section id='{pick('discussion', 'responses', 'replies', 'feedback')}'>{marked}</section>")

    def box() -> str:
        """A short box with any word of clutter."""
        word = pick(*(w for k in CLUTTER for w in WORDS[k].split()))
        return f"<{(t := pick('div', 'div', 'section'))} {pick('class', 'class', 'id')}='{word}'>{pick('', f'<h3>{words(1, 4)}</h3>')}{pick(f'<p>{sentences(1, 2)}</p>', f'<p>{sentences(1, 1)}</p>', sentences(1, 1))}</{t}>"

    def unseen() -> str:
        return pick(f"<p hidden>{sentences(1, 3)}</p>", f"<p style='display:none'>{sentences(1, 3)}</p>", f"<div hidden><p>{sentences(1, 4)}</p></div>", f"<span aria-hidden='true'>{words(1, 6)}</span>", f"<section hidden id=x><h2>{words(1, 3)}</h2><p>{sentences(2, 5)}</p></section>")

    def other() -> str:
        if odd and chance(0.25):
            return (unseen() if chance(0.2) else box()).replace(">", " data-label='other'>", 1)
        return pick(
            lambda: f"<div class='{pick('ad', 'ads', 'advert', 'advertisement', 'ad-slot', 'sponsored', 'promo')}'>{pick(sentences(1, 3), f'<p>{sentences(1, 2)}</p>', f'<a href=x>{words(2, 6)}</a>')}</div>",
            lambda: f"<aside{pick('', ' class=sidebar', ' class=related')}><h3>{words(1, 3)}</h3>{pick(f'<ul>{links(4)}</ul>', f'<p>{sentences(1, 4)}</p>')}</aside>",
            lambda: f"<form{pick('', ' class=newsletter', ' class=search')}><label>{words(1, 3)}</label><input name=q><button>{words(1, 2)}</button>{pick('', f'<p>{sentences(1, 2)}</p>')}</form>",
            lambda: f"<div class='{pick('notice', 'cookie-notice', 'cookie-banner', 'consent', 'alert', 'newsletter', 'popup', 'site-notice', 'disclaimer')}'>{pick('', f'<h3>{words(1, 3)}</h3>')}<p>{sentences(1, 3)}</p></div>",
            lambda: f"<div class='{pick('sidebar', 'widget', 'recommended', 'side-bar')}'><h3>{words(1, 3)}</h3>{pick(f'<ul>{links(5)}</ul>', f'<p>{sentences(1, 5)}</p>', f'<div><p>{sentences(1, 5)}</p></div>')}</div>",
            lambda: f"<div class='{pick('related-posts', 'more-stories', 'popular', 'trending')}'><h3>{words(1, 3)}</h3><ul>{links(5)}</ul></div>",
            lambda: f"<section class='{pick('related', 'more-stories', 'popular', 'trending', 'related-posts')}'><h3>{words(1, 3)}</h3><ul>{links(int(rng.integers(1, 6)))}</ul></section>",
            lambda: f"<section class='{pick('notice', 'alert', 'site-notice', 'disclaimer', 'warning')}'><p>{sentences(1, 3)}</p></section>",
            lambda: f"<nav{pick('', ' class=breadcrumb', ' class=menu')}>{pick(f'<ul>{links(5)}</ul>', f'<a href=x>{words(1, 2)}</a> <a href=y>{words(1, 2)}</a>')}</nav>",
            lambda: f"<ul class='{pick('menu', 'nav', 'pagination', 'tabs')}'>{links(5)}</ul>",
            lambda: f"<div class='{pick('share', 'social-share', 'share-buttons', 'follow')}'><a href=x>{words(1, 1)}</a><a href=y>{words(1, 1)}</a></div>",
            lambda: f"<script>var a = '{words(1, 4)}';</script>",
            lambda: f"<style>.{words(1, 1)} {{ margin: 0 }}</style>",
            lambda: f"<noscript><p>{sentences(1, 1)}</p></noscript>",
            lambda: f"<div style='display: none'><p>{sentences(1, 2)}</p></div>",
            lambda: f"<dialog><p>{sentences(1, 2)}</p><button>{words(1, 1)}</button></dialog>",
            remarks,
            remarks,
        )().replace(">", " data-label='other'>", 1)

    def outside() -> str:
        """What stands beside an article, not in it."""
        box = f"<div class='{pick('related', 'popular', 'more', 'trending', 'related-posts', 'feedback', 'author')}' data-label='other'>{pick(f'<h3>{words(1, 3)}</h3>', '')}<p>{sentences(1, 4)}</p></div>"
        long = f"<{(t := pick('div', 'section', 'aside'))} class='{pick('sidebar', 'widget', 'promo', 'newsletter', 'site-notice', 'discussion', 'sidebar-box')}' data-label='other'>{pick(f'<h3>{words(1, 3)}</h3>', '')}{''.join(f'<p>{sentences(2, 6)}</p>' for _ in range(rng.integers(1, 5)))}</{t}>"
        return box if chance(0.15) else long if odd and chance(0.2) else other()

    def content() -> str:
        if odd and chance(0.1):
            return pick(chapter, lambda: f"<details{pick('', ' open', ' class=faq', ' class=note')}><summary>{words(1, 6)}</summary>{pick(f'<p>{inline()}</p>', inline())}</details>")()
        return pick(
            lambda: f"<p>{inline()}</p>", lambda: f"<p>{inline()}</p>", lambda: f"<p>{inline()}", lambda: f"<p>{words(1, 3)}.</p>", lambda: f"<p>{words(2, 6)}.</p>", lambda: f"<h2>{words(1, 6)}</h2>", lambda: f"<h3>{words(1, 6)}</h3>",
            lambda: "<ul>" + "".join(f"<li>{inline()}</li>" for _ in range(rng.integers(2, 5))) + "</ul>", lambda: "<ol>" + "".join(f"<li>{words(1, 6)}</li>" for _ in range(rng.integers(2, 5))) + "</ol>",
            lambda: f"<blockquote><p>{inline()}</p></blockquote>", lambda: f"<pre>{words(2, 20)}</pre>", lambda: f"<p><b>{words(1, 6)}.<br><p>{inline()}</p>",
            lambda: f"<figure><img src=x><figcaption>{sentences(1, 1)}</figcaption></figure>", lambda: f"<table><tr><th>{words(1, 2)}</th><td>{words(1, 3)}</td></tr></table>", lambda: f"<div><p>{inline()}</p></div>", lambda: f"<section><h2>{words(1, 4)}</h2><p>{inline()}</p></section>",
            lambda: f"<ul>{links(int(rng.integers(2, 9)))}</ul>", lambda: f"<p>{sentences(1, 1)}</p><ol>{links(int(rng.integers(2, 6)))}</ol>", lambda: f"<p>{inline()} <a href=x>{words(1, 4)}</a> {inline()}</p>", lambda: f"<div>{inline()}</div>",
            lambda: part("section"), lambda: part("div"), lambda: part("div"), lambda: part(pick("section", "div", "blockquote")),
            lambda: f"<p class='{pick('notice', 'alert', 'note', 'related', 'more', 'feedback', 'author', 'meta')}'>{inline()}</p>",
        )()

    def chapter() -> str:
        """A long part of an article, with a heading, whose name holds a word of clutter."""
        word, second = (pick(*(w for k in CLUTTER for w in WORDS[k].split())) for _ in range(2))
        name = pick(word, f"{word}-{words(1, 1)}", f"{words(1, 1)}-{word}", f"{word}-{second}")
        return f"<{(t := pick('section', 'section', 'div'))} {pick('id', 'id', 'class')}='{name}'><{(h := pick('h2', 'h3'))}>{words(1, 4)}</{h}>{''.join(f'<p>{sentences(3, 7)}</p>' for _ in range(rng.integers(2, 5)))}</{t}>"

    def part(tag: str) -> str:
        """A part of an article with a word in its class or id that clutter has too."""
        word = pick("related", "more", "popular", "notice", "alert", "warning", "disclaimer", "announcement", "discussion", "feedback", "reviews", "responses", "replies", "author", "tools", "print", "meta", "tags")
        name = pick(word, f"{word}-{words(1, 1)}", f"{words(1, 1)}-{word}")
        long = word in ("notice", "alert", "warning", "disclaimer", "announcement")  # a notice is short
        head = f"<h2>{words(1, 3)}</h2>" if long or chance(0.5) else ""
        return f"<{tag} {pick('class', 'class', 'id')}='{name}'>{head}{''.join(f'<p>{inline()}</p>' for _ in range(rng.integers(2 if long else 1, 5)))}</{tag}>"

    out = []
    for _ in range(n):
        body = [content() for _ in range(pick(1, 1, 1, 2, 3, 4, 5, 6, 8))]
        for _ in range(rng.integers(0, 4)):
            body.insert(int(rng.integers(len(body) + 1)), other())
        tag, attr = pick(("article", ""), ("article", ""), ("article", ""), ("article", " class=post"), ("main", ""), ("div", " class=content"), ("div", " id=main-content"), ("div", " class='post entry'"), ("section", " class=article"), ("div", " class=story"), ("div", ""), ("div", ""), ("body", ""))
        head = f"<h1>{words(1, 9)}</h1>"
        if odd and tag == "article" and chance(0.3):
            head = f"<header{pick('', ' class=entry-header')}><h1>{words(1, 9)}</h1>{pick('', f'<p>{words(2, 6)}</p>')}</header>"
        inner = f"<{tag}{attr} data-label=content>{pick(head, head, '')}{''.join(body)}</{tag}>"
        for _ in range(0 if tag == "body" else pick(0, 0, 1, 1, 2, 2, 3, 4, 5, 7)):
            inner = pick(f"<main>{inner}</main>", f"<div class=container>{inner}</div>", f"<div id=page>{other() if chance(0.3) else ''}{inner}</div>", f"<div>{inner}{other() if chance(0.3) else ''}</div>", f"<div>{inner}</div>", f"<section>{inner}</section>")
        if odd and tag != "body" and chance(0.1):
            inner = f"<div id={pick('header-wrapper', 'sidebar-layout', 'share-page', 'modal-root', 'widget-container')}>{inner}</div>"
        table = odd and tag != "body" and chance(0.25)
        if table:  # a layout by tables, without a menu of its own tag
            bar = pick("", " | ", " ").join(f"<a href={i}.html>{words(1, 2)}</a>" for i in range(rng.integers(2, 7)))
            inner = pick(f"<table><tr><td data-label=other>{bar}</td><td>{inner}</td></tr></table>", f"<table><tr><td colspan=2 data-label=other>{bar}</td></tr><tr><td>{inner}</td></tr></table>", f"<center data-label=other>{bar}</center><table><tr><td>{inner}</td></tr></table>")
        top = pick(f"<header><a href=/>{words(1, 2)}</a><h1>{words(1, 3)}</h1></header>", f"<header class=site-header><p>{words(1, 5)}</p><nav><ul>{links(4)}</ul></nav></header>", f"<div id=header><h1>{words(1, 3)}</h1></div>", f"<nav><ul>{links(6)}</ul></nav>", "")
        end = pick(f"<footer>&copy; {words(1, 3)} &middot; {sentences(1, 1)}</footer>", f"<footer><p>{sentences(1, 2)}</p><ul>{links(3)}</ul></footer>", f"<div class=footer><p>{sentences(1, 1)}</p></div>", "")
        top, end = (x.replace(">", " data-label=other>", 1) for x in (top, end))
        before, after = ("".join(outside() if tag in ("article", "main") else other() for _ in range(rng.integers(0, 4))) for _ in range(2))
        if odd and tag != "body" and chance(0.12):  # all of a page in one form
            top, before, inner, after, end = f"<form id={pick('aspnetForm', 'form1', 'mainform')} method=post action=x><input type=hidden name=v>{top}", before, inner, after, f"{end}{pick('', f'<button data-label=other>{words(1, 1)}</button>')}</form>"
        page = inner.replace("<body data-label=content>", f"<body data-label=content>{top}{before}").replace("</body>", f"{after}{end}") if tag == "body" else f"<body>{top}{before}{inner}{after}{end}"
        out.append(f"<!DOCTYPE html><html><head data-label=other><meta charset=utf-8><title>{words(1, 6)}</title><style>p {{ margin: 0 }}</style><script>var t = '</p>';</script></head>{page}{pick('</body></html>', '</body></html>', '')}")
    return out
