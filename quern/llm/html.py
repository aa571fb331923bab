"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page.

A block is the text between two block-level tags. Its features are the tags and the class, id and
role words of its ancestors, and plain facts about its text. The field has two labels, main text
and the rest; it is fitted by gradient ascent on the exact log-likelihood and decoded by Viterbi.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: Block-level elements of the HTML standard, and those that bound text like them (fixed values).
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead title tr ul button textarea".split()
)
#: Elements whose content is never text of the page.
HIDDEN_TAGS = ("script", "style", "template", "noscript", "iframe", "svg", "object", "title", "textarea", "select")
#: Elements without content (fixed values).
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag closes first: a paragraph, and items of its own kind.
SAME_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIST_ROOTS = frozenset("ul ol dl table menu select".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S)
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    """An open element, linked to its parent; ``fresh`` are the features that no ancestor has."""

    __slots__ = ("tag", "names", "parent", "fresh", "score")

    def __init__(self, tag: str, names: frozenset[str], parent: Element | None, fresh: tuple[str, ...]):
        self.tag, self.names, self.parent, self.fresh, self.score = tag, names, parent, fresh, None

    def chain(self) -> list[Element]:
        """The element and its ancestors, the outermost first."""
        out, at = [], self
        while at is not None:
            out.append(at)
            at = at.parent
        return out[::-1]


class Block:
    __slots__ = ("text", "element", "link_chars")

    def __init__(self, text: str, element: Element | None, link_chars: int):
        self.text, self.element, self.link_chars = text, element, link_chars

    @property
    def path(self) -> tuple[str, ...]:
        return tuple(e.tag for e in self.element.chain()) if self.element else ()

    @property
    def names(self) -> tuple[frozenset[str], ...]:
        return tuple(e.names for e in self.element.chain()) if self.element else ()


def _names(attributes: str) -> frozenset[str]:
    if not attributes or "=" not in attributes:
        return frozenset()
    return frozenset(p.lower() for m in NAMES.finditer(attributes) for p in NAME_PART.findall(entities.unescape(m[1])))


def leaf_blocks(page: str | None) -> list[Block]:
    """The page's blocks that have text, in page order. Broken, unclosed and cut-off markup is read
    as browsers do, as far as blocks go: a tag that never ends hides what follows it, and what can't
    stand in a head ends it.

    Elements are linked to their parents and each knows what it adds to them, so that deep nesting
    costs as much as shallow.
    """
    page = page or ""
    blocks: list[Block] = []
    stack: list[tuple[str, Element | None]] = []  # the tag and the innermost block element
    marks: list[int] = []  # places in the stack of items and of what bounds them
    open_tags: Counter[str] = Counter()
    open_features: set[str] = set()
    parts: list[str] = []
    linked = 0
    hidden_until = None
    last = page.rfind(">")

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, stack[-1][1] if stack else None, linked))
        parts.clear()
        linked = 0

    def push(tag: str, attributes: str) -> None:
        inner = stack[-1][1] if stack else None
        if tag in BLOCK_TAGS:
            names = _names(attributes)
            own = [f"in={tag}"] if tag not in ("html", "body") else []
            fresh = tuple(f for f in [*own, *(f"name={n}" for n in sorted(names))] if f not in open_features)
            open_features.update(fresh)
            inner = Element(tag, names, inner, fresh)
        if tag in SAME_KIND or tag in LIST_ROOTS:
            marks.append(len(stack))
        stack.append((tag, inner))
        open_tags[tag] += 1

    def pop() -> str:
        tag, element = stack.pop()
        open_tags[tag] -= 1
        if tag in BLOCK_TAGS:
            open_features.difference_update(element.fresh)
        if marks and marks[-1] == len(stack):
            marks.pop()
        return tag

    at = 0
    while at < len(page):
        if hidden_until:
            end = re.compile(rf"</{hidden_until}\b[^>]*>", re.I).search(page, at)
            at, hidden_until = (end.end() if end else len(page)), None
            continue
        k = page.find("<", at)
        if k < 0 or k > last:
            rest = page[at:]
            cut = re.search(r"<[a-zA-Z/!?]", rest)
            parts.append(entities.unescape(rest[: cut.start()] if cut else rest))
            break
        m = TOKEN.match(page, k)
        text = page[at : k if m else k + 1]
        if text:
            text = entities.unescape(text)
            parts.append(text)
            if open_tags["a"]:
                linked += len(text.strip())
        if not m:
            at = k + 1
            continue
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if tag in ("br", "wbr"):
            parts.append(" " if tag == "br" else "")
            continue
        if closing:
            if tag in BLOCK_TAGS:
                flush()
            if open_tags[tag] > 0:
                while pop() != tag:
                    pass
            continue
        if tag in BLOCK_TAGS:
            flush()
            while stack and stack[-1][0] not in BLOCK_TAGS:
                pop()
            if stack and stack[-1][0] == "p":
                pop()
            if tag in SAME_KIND:
                for i in reversed(marks):
                    if stack[i][0] in SAME_KIND[tag]:
                        while len(stack) > i:
                            pop()
                        break
                    if stack[i][0] in LIST_ROOTS:
                        break
        if tag in HIDDEN_TAGS and not attributes.rstrip().endswith("/"):
            hidden_until = tag
        elif tag not in VOID_TAGS and tag != "head":
            push(tag, attributes)
    flush()
    return blocks


def own_features(block: Block, place: int, total: int) -> list[str]:
    """Names of the features that hold for a block, but for those of its elements' tags and names."""
    element = block.element
    found = ["bias", f"tag={element.tag if element else 'none'}"]
    if element:
        found += [f"own={n}" for n in element.names]
    n, words = len(block.text), block.text.count(" ") + 1
    found.append(f"words={min(6, int(math.log2(words)))}")
    found.append(f"links={min(3, int(4 * block.link_chars / max(1, n)))}")
    found.append("stop" if block.text[-1] in ".!?:…»\"'" else "no-stop")
    if "©" in block.text or "all rights reserved" in block.text.lower():
        found.append("copyright")
    if place == 0:
        found.append("first")
    if place == total - 1:
        found.append("last")
    return found


def features(block: Block, place: int, total: int) -> list[str]:
    """Names of all features that hold for a block."""
    above = [f for e in block.element.chain() for f in e.fresh] if block.element else []
    return own_features(block, place, total) + above


class Field:
    """Weights of a two-label linear-chain field: main-text score per feature, and transitions."""

    def __init__(self, weights: dict[str, float], steps: np.ndarray):
        self.weights, self.steps = weights, steps

    def decode(self, rows: list[list[str]]) -> list[bool]:
        """The labels of blocks that are given by their features."""
        return self.path([sum(self.weights.get(f, 0.0) for f in row) for row in rows])

    def label(self, blocks: list[Block]) -> list[bool]:
        """The labels of a page's blocks. An element's score is its parent's and what it adds."""
        get, scores = self.weights.get, []
        for k, block in enumerate(blocks):
            waiting, at = [], block.element
            while at is not None and at.score is None:
                waiting.append(at)
                at = at.parent
            for e in reversed(waiting):
                e.score = (e.parent.score if e.parent else 0.0) + sum(get(f, 0.0) for f in e.fresh)
            above = block.element.score if block.element else 0.0
            scores.append(above + sum(get(f, 0.0) for f in own_features(block, k, len(blocks))))
        return self.path(scores)

    def path(self, scores: list[float]) -> list[bool]:
        """Viterbi over the blocks' main-text scores; of equal paths the one with main text."""
        (s00, s01), (s10, s11) = self.steps.tolist()
        back, a, b = [], 0.0, 0.0
        for k, own in enumerate(scores):
            if k == 0:
                a, b = 0.0, own
            else:
                from_b_to_a, from_b_to_b = b + s10 >= a + s00, b + s11 >= a + s01
                back.append((from_b_to_a, from_b_to_b))
                a, b = (b + s10 if from_b_to_a else a + s00), own + (b + s11 if from_b_to_b else a + s01)
        if not scores:
            return []
        label = b >= a
        out = [label]
        for to_a, to_b in reversed(back):
            label = to_b if label else to_a
            out.append(label)
        return out[::-1]


class Likelihood:
    """The penalised log-likelihood of labelled pages, and its exact gradient.

    The forward and backward passes go over block places, all pages at once; pages shorter than
    the longest are masked.
    """

    def __init__(self, pages: Iterable[tuple[list[list[str]], list[bool]]], l2: float = 2e-4):
        pages = [(rows, labels) for rows, labels in pages if rows]
        self.index = {f: i for i, f in enumerate(sorted({f for rows, _ in pages for row in rows for f in row}))}
        sizes = np.array([len(rows) for rows, _ in pages])
        self.n, self.most, self.l2 = len(pages), int(sizes.max(initial=1)), l2
        flat = [row for rows, _ in pages for row in rows]
        self.ids = np.array([self.index[f] for row in flat for f in row])
        self.counts = np.array([len(row) for row in flat])
        self.begins = np.cumsum(self.counts) - self.counts
        self.at = np.repeat(np.arange(self.n), sizes), np.concatenate([np.arange(k) for k in sizes])
        self.labels = np.zeros((self.n, self.most), dtype=int)
        self.labels[self.at] = [int(y) for _, ys in pages for y in ys]
        self.real = np.arange(self.most)[None, :] < sizes[:, None]
        both = self.real[:, 1:]
        self.seen = np.array([[(both & (self.labels[:, :-1] == a) & (self.labels[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], dtype=float)

    def __call__(self, w: np.ndarray, steps: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(value, gradient by feature, gradient by step)."""
        n, most, real, ridge = self.n, self.most, self.real, self.l2 * self.n
        own = np.zeros((n, most, 2))
        own[(*self.at, 1)] = np.add.reduceat(w[self.ids], self.begins)
        ahead, behind = np.zeros((n, most, 2)), np.zeros((n, most, 2))
        ahead[:, 0] = own[:, 0]
        for k in range(1, most):
            new = own[:, k] + np.logaddexp(ahead[:, k - 1, :1] + steps[0], ahead[:, k - 1, 1:] + steps[1])
            ahead[:, k] = np.where(real[:, k, None], new, ahead[:, k - 1])
        for k in range(most - 2, -1, -1):
            onward = own[:, k + 1] + behind[:, k + 1]
            new = np.logaddexp(steps[:, 0] + onward[:, :1], steps[:, 1] + onward[:, 1:])
            behind[:, k] = np.where(real[:, k + 1, None], new, 0.0)
        whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        main = np.exp(ahead[..., 1] + behind[..., 1] - whole[:, None])
        miss = (self.labels - main)[self.at]
        gw = np.bincount(self.ids, weights=np.repeat(miss, self.counts), minlength=len(w)) - ridge * w
        gs = self.seen - ridge * steps
        both = real[:, 1:]
        for a, b in ((0, 0), (0, 1), (1, 0), (1, 1)):
            both_on = np.exp(ahead[:, :-1, a] + steps[a, b] + own[:, 1:, b] + behind[:, 1:, b] - whole[:, None])
            gs[a, b] -= both_on[both].sum()
        value = (own[..., 1] * self.labels * real).sum() + (self.seen * steps).sum() - whole.sum() - ridge / 2 * ((w**2).sum() + (steps**2).sum())
        return float(value), gw, gs


def fit(pages: Iterable[tuple[list[list[str]], list[bool]]], rounds: int = 250, rate: float = 0.3) -> Field:
    """Maximise the penalised log-likelihood of labelled pages by AdaGrad on exact gradients."""
    target = Likelihood(pages)
    w, steps = np.zeros(len(target.index)), np.zeros((2, 2))
    sw, ss = np.full(len(w), 1e-8), np.full((2, 2), 1e-8)
    for _ in range(rounds):
        _, gw, gs = target(w, steps)
        sw += gw**2
        ss += gs**2
        w += rate * gw / np.sqrt(sw)
        steps += rate * gs / np.sqrt(ss)
    return Field({f: float(w[i]) for f, i in target.index.items()}, steps)


def labelled_pages(count: int = 600, seed: int = 7) -> list[tuple[str, list[str]]]:
    """Labelled pages: markup with the blocks that are its main text.

    Drawn from common page layouts: main text in an article, main, section or named div, or bare;
    around and inside it menus, headers, footers, sidebars, notices, adverts, forms and comments.
    """
    rng = random.Random(seed)
    say = lambda a, b: " ".join("".join(rng.choices("abcdefghiklmnoprstuvwz", k=rng.randint(2, 9))) for _ in range(rng.randint(a, b)))
    sentence = lambda: say(1, 30).capitalize() + rng.choice([".", ".", ".", "!", "?", "", " |"])
    pick = rng.choice

    def link() -> str:
        return f'<a href="/{say(1, 1)}">{say(1, 3)}</a>'

    def links() -> str:
        return f"<ul>{''.join(f'<li>{link()}</li>' for _ in range(rng.randint(2, 8)))}</ul>"

    def junk(kind: str) -> str:
        text = pick([lambda: f"<p>{sentence()}</p>", sentence, lambda: f"<span>{sentence()}</span>", lambda: f"<div>{sentence()}</div>", lambda: f"<h3>{say(1, 4)}</h3><p>{sentence()}</p>"])
        if kind == "menu":
            return pick([f"<nav>{links()}</nav>", f'<div class="{pick(["menu", "nav", "navbar", "navigation", "breadcrumbs"])}">{links()}</div>', f'<ul id="{pick(["menu", "nav", "main-menu"])}">{link()}{link()}</ul>', f'<div role="navigation">{link()} {link()}</div>'])
        if kind == "header":
            return pick([f"<header><h1>{say(1, 4)}</h1>{text()}</header>", f'<div class="{pick(["header", "masthead", "site-header", "top-bar", "banner"])}">{text()}{link()}</div>', f'<div id="header"><h2>{say(1, 3)}</h2></div>', f"<header>{text()}</header>"])
        if kind == "footer":
            return pick([f"<footer>&copy; {say(1, 3)} &middot; {sentence()}</footer>", f"<footer>{text()}{links()}</footer>", f'<div class="{pick(["footer", "site-footer", "bottom", "copyright", "legal"])}">{text()}</div>', f'<div id="footer">&copy; {sentence()}</div>'])
        if kind == "side":
            return pick([f"<aside>{text()}{links()}</aside>", f"<aside>{text()}</aside>", f'<div class="{pick(["sidebar", "related", "widget", "social", "share", "tags", "recommended", "popular"])}">{text()}{link()}</div>', f'<div id="sidebar">{text()}</div>', f'<section class="related">{links()}</section>'])
        if kind == "notice":
            return f'<{(t := pick(["div", "section", "p"]))} class="{pick(["cookie", "cookie-notice", "consent", "notice", "alert", "newsletter", "subscribe", "gdpr", "popup", "modal", "paywall", "message"])}">{sentence()} {pick(["", "<button>OK</button>"])}</{t}>'
        if kind == "ad":
            return pick([f'<div class="{pick(["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner-ad"])}">{text()}</div>', f'<div id="ad">{sentence()}</div>', f'<p class="ad">{sentence()}</p>', f'<aside class="promo">{text()}</aside>'])
        if kind == "form":
            return f'<form class="{pick(["search", "login", "contact", ""])}"><label>{say(1, 3)}</label><input name="q"><p>{sentence()}</p><button>{say(1, 1)}</button></form>'
        body = "".join(pick([f'<div class="comment"><p>{sentence()}</p></div>', f"<li><p>{sentence()}</p></li>", f'<article class="comment"><h4>{say(1, 2)}</h4><p>{sentence()}</p></article>']) for _ in range(rng.randint(1, 4)))
        return f'<{(t := pick(["section", "div"]))} {pick(["id", "class"])}="{pick(["comments", "comment-list", "discussion", "replies", "responses"])}"><h3>{say(1, 2)}</h3>{body}</{t}>'

    kinds = ["menu", "header", "footer", "side", "notice", "ad", "form", "comments"]
    pages = []
    for _ in range(count):
        wanted: list[str] = []

        def main_block(tag: str | None = None) -> str:
            text = sentence() if tag is None else say(1, 12).capitalize()
            wanted.append(text)
            if tag in ("li", "td"):
                text += "."
                wanted[-1] = text
                return f"<{tag}>{text}</{tag}>"
            tag = tag or pick(["p"] * 9 + ["blockquote", "pre", "div"])
            return pick([f"<{tag}>{text}</{tag}>"] * 6 + [f"<{tag}><b>{text}<br>", f"<{tag}>{text}"]) if tag == "p" else f"<{tag}>{text}</{tag}>"

        inner = pick([lambda: main_block("h1"), lambda: main_block("h2"), lambda: f"<header>{main_block('h1')}</header>", lambda: ""])()
        for _ in range(rng.randint(0 if inner else 1, 12)):
            draw = rng.random()
            if draw < 0.08:
                inner += junk(pick(["ad", "ad", "side", "form", "notice"]))
            elif draw < 0.14:
                inner += f"<ul>{main_block('li')}{main_block('li')}</ul>"
            elif draw < 0.17:
                inner += f"<table><tr>{main_block('td')}{main_block('td')}</tr></table>"
            elif draw < 0.25:
                inner += main_block(pick(["h2", "h3"]))
            else:
                inner += main_block()
        if rng.random() < 0.1:
            inner += junk("comments")
        name = pick(["content", "post", "entry", "article", "story", "main-content", "article-body", "text", "post-body", "page-content"])
        shell = pick(["<article>{}</article>"] * 5 + ["<main>{}</main>", "<main><article>{}</article></main>", f'<div class="{name}">{{}}</div>', f'<div id="{name}">{{}}</div>', f'<article class="{name}">{{}}</article>', "<section>{}</section>", "{}"])
        before = "".join(junk(pick(["menu", "menu", "header", "ad", "notice", "side", "form"])) for _ in range(rng.randint(0, 3)))
        after = "".join(junk(pick(kinds[2:])) for _ in range(rng.randint(0, 2))) + (junk("footer") if rng.random() < 0.8 else "")
        body = before + shell.format(inner) + after
        pages.append((f"<html><head><title>{say(1, 5)}</title></head><body>{body}</body></html>", [" ".join(t.split()) for t in wanted]))
    return pages


@lru_cache(maxsize=1)
def default_field() -> Field:
    """The field fitted on ``labelled_pages``."""
    return fit_pages(labelled_pages())


def fit_pages(pages: Iterable[tuple[str, list[str]]]) -> Field:
    """Fit on pages whose main blocks are known by their texts."""
    coded = []
    for page, wanted in pages:
        blocks, kept = leaf_blocks(page), set(wanted)
        coded.append(([features(b, k, len(blocks)) for k, b in enumerate(blocks)], [b.text in kept for b in blocks]))
    return fit(coded)


def main_text(page: str | None, field: Field) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, main in zip(blocks, field.label(blocks)) if main)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", field: Field | None = None) -> DataFrame:
    """(key, url, text, n_chars) for every row: the main blocks in page order, a line each.

    A null or empty page, or one without main text, gives an empty text. Repeated rows stay.
    """
    model = field or default_field()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), model) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[key, url, "text", "n_chars"],
            )

    out = T.StructType([T.StructField(key, pages.schema[key].dataType), T.StructField(url, T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(F.col(key), F.col(url), F.col(html)).mapInArrow(run, out)
