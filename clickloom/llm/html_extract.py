"""Main text of HTML pages by a recurrent block labeller.

A page is cut into leaf blocks, the stretches of text between block-level tags. A block's vector hashes its tag path
(names, classes, ids and roles of the open tags), the mean of all its words, and holds its length, share of links and place. A bidirectional
LSTM in numpy reads the whole sequence of a page's blocks in both directions and labels every block with what
the page before and after it shows. The text of a page is that of its content blocks.

The labeller is trained on a bounded sample of pages, whose text inside and outside their article is dealt anew into pages of
many layouts: with and without article tags, with menus, notices, adverts, sidebars, forms and comments under their usual
names. So the label of every block is known without anybody's markup.

Results for odd input: null or empty html, and pages without content blocks, give an empty text. Unclosed and stray tags, quotes
or comments do not fail; a tag that never ends is text. Repeated rows and null ids: one result per row. No pages, or none
with text, to train on: layouts are filled with neutral words. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import dataclasses
import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import sampled, small_batches

#: Fixed: tags that begin and end a block, tags without content, and tags whose content is not text.
BLOCK_TAGS = frozenset("""address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p
pre section select summary table tbody td tfoot th thead title tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template iframe object svg textarea select title".split())
SECTIONS = frozenset("ul ol dl table div section article aside nav main blockquote form".split())
CLOSES_P = BLOCK_TAGS - {"button", "caption", "option", "optgroup", "legend", "summary", "td", "th", "tr", "tbody", "thead", "tfoot"}

NAMED = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?(?:false|until))|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
PARTS = re.compile(r"[a-z]+|\d+")
SPACE = re.compile(r"\s+")
SPECIAL = re.compile(r"[\"'>]")
NAME_END = re.compile(r"[\s/>]")
ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in SKIPPED}

PATH, WORDS, EXTRA = 48, 16, 6
SIZE = PATH + WORDS + EXTRA


class Tag:
    """An open tag: what it is called, the tag around it, and the sum of the vectors of both."""

    __slots__ = ("name", "parts", "around", "total")

    def __init__(self, name: str, parts: tuple[str, ...], around: Tag | None) -> None:
        self.name, self.parts, self.around = name, parts, around
        own = _sum_of(tuple(t for t in parts if t not in PLAIN))
        self.total = own if around is None else around.total + own

    def path(self) -> tuple[str, ...]:
        """What the open tags are called, from the outside."""
        found, tag = [], self
        while tag:
            found.append(tag.parts)
            tag = tag.around
        return tuple(t for parts in reversed(found) for t in parts)

    def vector(self) -> np.ndarray:
        """The sum for all names but plain ones; the last two names count once more."""
        last, tag = self.parts[-2:], self.around
        while len(last) < 2 and tag:
            last, tag = (tag.parts + last)[-2:], tag.around
        return (self.total + _sum_of(last)) * np.float32(1.5 / np.sqrt(PATH))


@dataclasses.dataclass
class Block:
    text: str
    tag: Tag                   # the innermost open tag
    linked: int                # letters inside links

    @property
    def path(self) -> tuple[str, ...]:
        return self.tag.path()


class OpenTags:
    """The tags that are open, with the places of each name and kind, so that none is searched for."""

    def __init__(self) -> None:
        self.root = Tag("", (), None)
        self.tags: list[Tag] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.sections: list[int] = []
        self.links = 0

    def top(self) -> Tag:
        return self.tags[-1] if self.tags else self.root

    def place(self, name: str) -> int | None:
        found = self.places.get(name)
        return found[-1] if found else None

    def push(self, name: str, parts: tuple[str, ...]) -> None:
        at = len(self.tags)
        self.tags.append(Tag(name, parts, self.top()))
        self.places.setdefault(name, []).append(at)
        if name in BLOCK_TAGS:
            self.blocks.append(at)
        if name in SECTIONS:
            self.sections.append(at)
        self.links += name == "a"

    def close(self, place: int) -> None:
        """Close the tag at a place and all that were opened in it."""
        while len(self.tags) > place:
            name = self.tags.pop().name
            self.places[name].pop()
            if name in BLOCK_TAGS:
                self.blocks.pop()
            if name in SECTIONS:
                self.sections.pop()
            self.links -= name == "a"


class Search:
    """The next match of a pattern from places that only grow: text between one place and its match is read once."""

    def __init__(self, pattern: re.Pattern, page: str) -> None:
        self.pattern, self.page, self.begin, self.found = pattern, page, 0, -1

    def at(self, begin: int) -> int:
        """The place of the match, the length of the page if there is none."""
        if not self.begin <= begin <= self.found:
            match = self.pattern.search(self.page, begin)
            self.begin, self.found = begin, match.start() if match else len(self.page)
        return self.found


def tokens(page: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """Tags, comments and skipped content: begin, end, whether it is an end tag, name (None for what is no tag) and attributes.

    Linear in the page: places that no tag can end behind are remembered, so none is read again for every "<" before it.
    """
    last, size, at = page.rfind(">"), len(page), 0
    names, specials, hopeless = Search(NAME_END, page), Search(SPECIAL, page), set()

    def end_of(begin: int) -> int | None:
        """The place of the ">" that ends a tag, outside of quotes."""
        seen, place = [], specials.at(begin)
        while place < size and place not in hopeless:
            if page[place] == ">":
                return place
            seen.append(place)
            pair = page.find(page[place], place + 1)
            if pair < 0:
                break
            following = SPECIAL.search(page, pair + 1)
            place = following.start() if following else size
        hopeless.update(seen)
        return None

    while True:
        begin = page.find("<", at)
        if begin < 0:
            return
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = size if end < 0 else end + 3
            yield begin, at, False, None, ""
            continue
        if page.startswith("<![", begin) and page[begin + 3:begin + 9].lower() == "cdata[":
            end = page.find("]]>", begin + 9)
            at = size if end < 0 else end + 3
            yield begin, at, False, None, ""
            continue
        if begin > last:  # no tag ends any more, but a comment may begin
            at = begin + 1
            continue
        mark = page[begin + 1:begin + 2]
        if mark in ("!", "?") and mark:
            at = page.find(">", begin + 2) + 1
            yield begin, at, False, None, ""
            continue
        closing = mark == "/"
        first = begin + 1 + closing
        if not (page[first:first + 1].isascii() and page[first:first + 1].isalpha()):
            at = begin + 1
            continue
        after = names.at(first)
        end = end_of(after)
        if end is None:
            at = begin + 1
            continue
        name, at = page[first:after].lower(), end + 1
        if name in SKIPPED and not closing:
            if name != "svg" or page[end - 1] != "/":  # <svg/> has no content to skip
                stop = ENDS[name].search(page, at)
                at = stop.end() if stop else size
            yield begin, at, False, None, ""
            continue
        yield begin, at, closing, name, page[after:end]


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in page order, with decoded text."""
    out: list[Block] = []
    stack = OpenTags()
    text: list[str] = []
    linked = at = 0

    def flush():
        nonlocal linked
        if text:
            joined = SPACE.sub(" ", "".join(text)).strip()
            if joined:
                out.append(Block(joined, stack.top(), linked))
            text.clear()
        linked = 0

    for begin, end, closing, name, attributes in tokens(page):
        if begin > at:
            part = entities.unescape(page[at:begin])
            text.append(part)
            if stack.links:
                linked += len(part)
        at = end
        if name is None:
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in VOID_TAGS:
            if name == "hr":
                flush()
            continue
        if name == "math" and not closing and attributes.endswith("/"):
            continue
        block = name in BLOCK_TAGS
        if closing:
            if block:
                flush()
            place = stack.place(name)
            # An inline tag does not end the blocks that were opened in it.
            if place is not None and (block or not stack.blocks or stack.blocks[-1] < place):
                stack.close(place)
            continue
        if block:
            flush()
            if name in CLOSES_P or name in ("li", "dd", "dt", "option", "tr", "td", "th"):
                place = stack.place("p" if name in CLOSES_P and name != "li" else name)
                # Only as far as the tag's own list, table or page section.
                if place is not None and (not stack.sections or stack.sections[-1] <= place):
                    stack.close(place)
        names = [name]
        if attributes:
            for a, b, c in NAMED.findall(attributes):
                names += [f".{p}" for p in PARTS.findall((a or b or c).lower())]
            if HIDDEN.search(attributes):
                names.append(".hidden")
        stack.push(name, tuple(names))
    if at < len(page):
        text.append(entities.unescape(page[at:]))
    flush()
    return out


#: Fixed random signs; a token's vector is the row that its hash names.
_SIGNS = np.random.default_rng(11).choice(np.array([-1.0, 1.0], np.float32), (4096, PATH + WORDS))


def _row(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "ignore")) & 4095


#: Names that tell nothing about a block.
PLAIN = frozenset(("html", "body", "b", "i", "em", "strong", "span", "a", "p"))
_SUMS: dict[tuple[str, ...], np.ndarray] = {}


def _sum_of(names: tuple[str, ...]) -> np.ndarray:
    if names not in _SUMS:
        if len(_SUMS) > 50_000:
            _SUMS.clear()
        _SUMS[names] = _SIGNS[[_row(t) for t in names], :PATH].sum(axis=0)
    return _SUMS[names]


def _word_means(texts: list[str], most: int = 400_000) -> np.ndarray:
    """Per text the mean of the vectors of all its words; some `most` letters at a time are cut into words."""
    sums, counts = np.zeros((len(texts), WORDS), np.float32), np.zeros(len(texts), np.int64)
    rows, sizes, owners, letters = [], [], [], 0

    def add():
        nonlocal letters
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        np.add.at(sums, owners, np.add.reduceat(_SIGNS[rows, PATH:], begin, axis=0))
        np.add.at(counts, owners, sizes)
        rows.clear(), sizes.clear(), owners.clear()
        letters = 0

    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = text.find(" ", at + most)
            end = len(text) if end < 0 else end
            found = text[at:end].lower().split(" ")
            rows += map(_row, found)
            sizes.append(len(found))
            owners.append(i)
            letters += end - at
            at = end + 1
            if letters >= most:
                add()
    if rows:
        add()
    return sums / (np.sqrt(WORDS) * counts)[:, None]


def vectors(pages: list[list[Block]]) -> list[np.ndarray]:
    """Per page one row per block: hashed tag path, hashed words, and six numbers."""
    every = [b for page in pages for b in page]
    if not every:
        return [np.zeros((0, SIZE), np.float32) for _ in pages]
    out = np.empty((len(every), SIZE), np.float32)
    out[:, :PATH] = np.array([b.tag.vector() for b in every])
    out[:, PATH:PATH + WORDS] = _word_means([b.text for b in every])
    n = np.array([len(b.text) for b in every], np.float32)
    place = np.concatenate([np.arange(len(p)) for p in pages])
    size = np.repeat([len(p) for p in pages], [len(p) for p in pages])
    out[:, PATH + WORDS:] = np.column_stack([
        np.log1p(n) / 4, np.minimum(1, np.array([b.linked for b in every]) / n), place / size, (size - place) / size,
        [b.text[-1] in ".!?…\"”" for b in every], np.log1p([b.text.count(",") for b in every]) / 2])
    return np.split(out, np.cumsum([len(p) for p in pages])[:-1])


# Bidirectional LSTM ------------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w: dict, x: np.ndarray, mask: np.ndarray, keep: bool):
    """Hidden states of a batch (pages, steps, SIZE); past a page's end the state stays."""
    n, steps, _ = x.shape
    size = w["u"].shape[0]
    h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    pre = x @ w["w"] + w["b"]
    out, saved = np.zeros((n, steps, size), np.float32), []
    for t in range(steps):
        gates = pre[:, t] + h @ w["u"]
        i, f, o = (_sigmoid(gates[:, k * size:(k + 1) * size]) for k in range(3))
        g = np.tanh(gates[:, 3 * size:])
        m = mask[:, t, None]
        c_new = m * (f * c + i * g) + (1 - m) * c
        tanh_c = np.tanh(c_new)
        h_new = m * (o * tanh_c) + (1 - m) * h
        if keep:
            saved.append((i, f, o, g, c, tanh_c, h))
        h, c = h_new, c_new
        out[:, t] = h
    return out, saved


def _backward(w: dict, x: np.ndarray, mask: np.ndarray, saved: list, grad_out: np.ndarray) -> dict:
    n, steps, _ = x.shape
    size = w["u"].shape[0]
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    dh, dc = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, c, tanh_c, h = saved[t]
        m = mask[:, t, None]
        dh = dh + grad_out[:, t]
        step_c = m * (dc + dh * o * (1 - tanh_c ** 2))
        gates = np.concatenate([step_c * g * i * (1 - i), step_c * c * f * (1 - f), m * dh * tanh_c * o * (1 - o), step_c * i * (1 - g ** 2)], axis=1)
        grad["w"] += x[:, t].T @ gates
        grad["u"] += h.T @ gates
        grad["b"] += gates.sum(axis=0)
        dh = gates @ w["u"].T + (1 - m) * dh
        dc = step_c * f + (1 - m) * dc
    return grad


@dataclasses.dataclass
class Labeller:
    left: dict[str, np.ndarray]
    right: dict[str, np.ndarray]
    top: np.ndarray
    direct: np.ndarray
    bias: np.ndarray

    @staticmethod
    def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        steps = max(len(p) for p in pages)
        x, mask = np.zeros((len(pages), steps, SIZE), np.float32), np.zeros((len(pages), steps), np.float32)
        for i, p in enumerate(pages):
            x[i, :len(p)], mask[i, :len(p)] = p, 1
        return x, mask

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        # Read from the right, padding comes first and leaves the state at zero.
        a, saved_a = _forward(self.left, x, mask, keep)
        b, saved_b = _forward(self.right, x[:, ::-1], mask[:, ::-1], keep)
        both = np.concatenate([a, b[:, ::-1]], axis=2)
        return both @ self.top + x @ self.direct + self.bias, both, saved_a, saved_b

    def label(self, pages: list[np.ndarray], batch: int = 128) -> list[np.ndarray]:
        """Whether each block of each page is content; pages of like length are read side by side."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        begin = 0
        while begin < len(order):
            end = begin + 1
            while end < len(order) and end - begin < batch and (end - begin + 1) * len(pages[order[end]]) <= 60_000:
                end += 1
            x, mask = self.padded([pages[i] for i in order[begin:end]])
            found = self.logits(x, mask)[0] > 0
            for row, i in enumerate(order[begin:end]):
                out[i] = found[row, :len(pages[i])]
            begin = end
        return out


def train(pages: list[tuple[np.ndarray, np.ndarray]], hidden: int = 16, epochs: int = 24, seed: int = 3) -> Labeller:
    """Fit by Adam on (vectors, labels) of pages."""
    rng = np.random.default_rng(seed)

    def cell():
        scale = 1 / np.sqrt(SIZE)
        b = np.zeros(4 * hidden, np.float32)
        b[hidden:2 * hidden] = 1
        return {"w": rng.normal(0, scale, (SIZE, 4 * hidden)).astype(np.float32),
                "u": rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32), "b": b}

    model = Labeller(cell(), cell(), rng.normal(0, 0.3, 2 * hidden).astype(np.float32), np.zeros(SIZE, np.float32), np.zeros(1, np.float32))
    weights = [*model.left.values(), *model.right.values(), model.top, model.direct, model.bias]
    moment, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        order = rng.permutation(len(pages))
        rate = 0.02 * (0.85 ** epoch)
        for a in range(0, len(order), 24):
            chosen = [pages[i] for i in order[a:a + 24]]
            x, mask = Labeller.padded([v for v, _ in chosen])
            y = np.zeros(mask.shape, np.float32)
            for i, (_, labels) in enumerate(chosen):
                y[i, :len(labels)] = labels
            logit, both, saved_a, saved_b = model.logits(x, mask, keep=True)
            d = (_sigmoid(logit) - y) * mask / mask.sum()
            grad_both = d[:, :, None] * model.top
            ga = _backward(model.left, x, mask, saved_a, grad_both[:, :, :hidden])
            gb = _backward(model.right, x[:, ::-1], mask[:, ::-1], saved_b, grad_both[:, ::-1, hidden:])
            grads = [*ga.values(), *gb.values(), np.einsum("nt,nth->h", d, both), np.einsum("nt,nth->h", d, x), d.sum(keepdims=True).reshape(1)]
            step += 1
            for w, g, m, v in zip(weights, grads, moment, second, strict=True):
                g = g + 1e-4 * w
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


# Training pages ----------------------------------------------------------------------------------------------

#: What the parts of a page are usually called: (opening tags, closing tags) around content and around the rest.
CONTENT_FRAMES = [(t, "".join(f"</{x}>" for x in reversed(re.findall(r"<(\w+)", t)))) for t in (
    "<article>", "<main>", "<main><article>", '<div class="content">', '<div id="content">', '<div class="article-body">',
    '<div class="post-content">', '<div class="entry-content">', '<div id="main" class="main">', '<section class="story">',
    '<div role="main">', '<article class="post">', '<div class="wrapper"><div class="text">', "<main><div>", "<div><article><section>")]
REST_FRAMES = [(t, "".join(f"</{x}>" for x in reversed(re.findall(r"<(\w+)", t)))) for t in (
    "<header>", '<header class="site-header">', '<div id="header">', '<div class="header">', "<footer>", '<div class="footer">', '<div id="footer">',
    "<aside>", '<aside class="sidebar">', '<div class="sidebar">', '<div id="sidebar">', '<div class="widget">', '<div class="ad">', '<div class="ads">',
    '<div class="advert">', '<div class="advertisement">', '<div class="sponsored promo">', '<div class="banner">', '<div id="ad-top" class="ad-slot">',
    '<div class="cookie-notice">', '<div class="cookie-banner">', '<div class="notice">', '<div role="alert" class="consent">', '<div class="popup modal">',
    '<div class="comments">', '<section id="comments">', '<div class="comment">', '<ul class="comment-list">', '<ol class="comments">',
    '<section class="comments"><article class="comment">', '<div class="related">', '<div class="share social">', '<div class="newsletter subscribe">',
    '<div class="breadcrumb">', '<div class="copyright">', '<div class="legal">', '<div class="menu">', '<div id="menu">', '<div class="nav">')]
NEUTRAL = "the page has some words that say nothing much about what this text is and one more line".split()


def layouts(texts: list[str], rng: np.random.Generator, many: int) -> list[tuple[str, list[bool]]]:
    """Pages made of the given texts: html, and for each leaf block whether it is content."""
    texts = texts or [" ".join(NEUTRAL)]
    pick = lambda options: options[rng.integers(len(options))]
    words = lambda n: entities.escape(" ".join(pick(texts).split()[:n]) or "more")

    def rest() -> tuple[str, int]:
        kind = rng.integers(6)
        if kind == 0:
            n = int(rng.integers(2, 8))
            frame = pick([("<nav><ul>", "</ul></nav>"), ("<nav>", "</nav>"), ('<div class="menu"><ul>', "</ul></div>"), ('<nav class="navbar"><ul>', "</ul></nav>"), ("<ul class=\"nav\">", "</ul>")])
            return frame[0] + "".join(f'<li><a href="/x">{words(int(rng.integers(1, 4)))}</a></li>' for _ in range(n)) + frame[1], n
        if kind == 1:
            n = int(rng.integers(1, 4))
            return "<form>" + "".join(f"<label>{words(2)}</label><input name=q><p>{words(5)}</p>" for _ in range(n)) + f"<button>{words(1)}</button></form>", 2 * n + 1
        opened, closed = pick(REST_FRAMES)
        n = int(rng.integers(1, 4))
        if kind == 2:
            return opened + words(int(rng.integers(2, 30))) + closed, 1
        tag = pick(["p", "div", "li", "h3"])
        inner = "".join(f"<{tag}>" + (f'<a href="/y">{words(6)}</a>' if rng.random() < 0.4 else words(int(rng.integers(2, 40)))) + f"</{tag}>" for _ in range(n))
        return opened + inner + closed, n

    def content() -> tuple[str, list[bool]]:
        opened, closed = pick(CONTENT_FRAMES)
        parts, labels = [], []
        for _ in range(int(rng.integers(1, 16))):
            if rng.random() < 0.12:
                inner, n = rest()
                parts.append(inner)
                labels += [False] * n
            else:
                tag = pick(["p", "p", "p", "p", "h1", "h2", "li", "blockquote"])
                body = words(int(rng.integers(1, 120)))
                style = rng.integers(6)
                if style == 0:
                    body = f"<b>{body}</b>" if rng.random() < 0.5 else f"<b>{body}<br>"
                elif style == 1:
                    body = f'{words(8)} <a href="/z">{words(3)}</a> {body}'
                parts.append(f"<{tag}>{body}" + ("" if tag == "p" and rng.random() < 0.2 else f"</{tag}>"))
                labels.append(True)
        return opened + "".join(parts) + closed, labels

    pages = []
    for _ in range(many):
        page, labels = ["<html><head><title>t</title></head><body>"], []
        for _ in range(int(rng.integers(0, 5))):
            part, n = rest()
            page.append(part)
            labels += [False] * n
        part, own = content()
        page.append(part)
        labels += own
        for _ in range(int(rng.integers(0, 6))):
            part, n = rest()
            page.append(part)
            labels += [False] * n
        pages.append(("".join(page) + ("</body></html>" if rng.random() < 0.8 else ""), labels))
    return pages


def fitted(sample: list[str], many: int = 500, seed: int = 5) -> Labeller:
    """A labeller trained on layouts that hold the texts of sample pages."""
    rng = np.random.default_rng(seed)
    texts = sorted({b.text for page in sample for b in blocks(page)})
    made = []
    for page, labels in layouts(texts, rng, many):
        found = blocks(page)
        if len(found) == len(labels):
            made.append((found, np.array(labels, np.float32)))
    return train(list(zip(vectors([found for found, _ in made]), [y for _, y in made], strict=True)))


def extract(pages: DataFrame, sample: int = 200, most_bytes: int = 50_000) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_blocks, n_content.

    The labeller learns from the `sample` pages with the smallest hashes, of at most `most_bytes` bytes.
    """
    small_batches(pages.sparkSession)
    chosen = sampled(pages.where(F.octet_length("html").between(1, most_bytes)).select("page_id", "url", "html"), ["page_id", "url", "html"], sample)
    model = pages.sparkSession.sparkContext.broadcast(fitted([r.html for r in chosen.collect()]))

    @F.arrow_udf("struct<text: string, n_chars: long, n_blocks: int, n_content: int>")
    def extracted(column: pa.Array) -> pa.Array:
        out, begin = [], 0
        while begin < len(column):  # some hundred pages at a time
            end, size = begin, 0
            while end < len(column) and end - begin < 512 and size < 8_000_000:
                size += len(column[end].as_py() or "")
                end += 1
            cut = [blocks(page or "") for page in column.slice(begin, end - begin).to_pylist()]
            for page, content in zip(cut, model.value.label(vectors(cut)), strict=True):
                text = " ".join(b.text for b, yes in zip(page, content, strict=True) if yes)
                out.append((text, len(text), len(page), int(content.sum())))
            begin = end
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32()]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                          ["text", "n_chars", "n_blocks", "n_content"])

    return pages.select("page_id", "url", extracted("html").alias("_found")).select("page_id", "url", "_found.*")
