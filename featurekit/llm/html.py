"""Main text of web pages: a bidirectional LSTM in NumPy labels every block of a page in the context of all others.

A page becomes a sequence of leaf blocks. Each is read as a vector of its tag path (hashed tags and class words), a
vector of its hashed words and a few figures; the network runs over the sequence in both directions. It is trained on
pages of the corpus whose markup names its parts, and on pages made of their texts in many other layouts.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import sampled, small_batches

PATH_CELLS, WORD_CELLS, FIGURES = 96, 32, 8
HIDDEN = 16
MAIN = 0.5

# Bounds of the training sample: pages, and characters of a page that is looked at.
TRAINING_PAGES = 240
TRAINING_CHARS = 60_000
LAYOUTS = 1000

# Elements by what they do to the text, and words of tags, classes, ids and roles by what they hold.
BLOCKS = frozenset("address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_ELEMENTS = frozenset("script style template noscript svg math object audio video iframe".split())
CLOSES_P = BLOCKS - {"button", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head", "title"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol menu dl table select".split())
NOT_MAIN = frozenset("nav navigation navbar menu menubar header masthead topbar footer bottom aside sidebar side widget rail notice cookie consent gdpr banner alert popup modal overlay ad ads advert advertisement adsense sponsor sponsored promo promotion form search login signup subscribe newsletter button select textarea comment comments reply replies disqus discussion respondents share sharing social related recommended breadcrumb breadcrumbs pagination pager tags toc copyright legal disclaimer contentinfo complementary head title".split())
IS_MAIN = frozenset("article main content post entry story text body prose paragraph reader".split())

_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_INLINE_KEEP = {"a"}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: float


@lru_cache(maxsize=50_000)
def _names(tag: str, names: str) -> tuple[str, ...]:
    words = _SPLIT.split(_CAMEL.sub(" ", names).lower()) if names else ()
    return (f"<{tag}>", *(w for w in words if w))


class _Blocks(HTMLParser):
    """Collects the leaf blocks of a page; end tags may be missing, crossed or left over."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self._stack: list[tuple[str, tuple[str, ...]]] = []
        self._text: list[str] = []
        self._linked = self._links = self._hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self._text.append(" ")
        if tag in BLOCKS:
            self._flush()
            if tag in CLOSES_P:
                self._pop_while({"p"}, BLOCKS - {"p"})
            if tag in SAME:
                self._pop_while(SAME[tag], LISTS)
        if tag in VOID:
            return
        if tag in HIDDEN_ELEMENTS:
            self._hidden += 1
        found = dict(attrs)
        hidden = "hidden" in found or "display:none" in (found.get("style") or "").replace(" ", "").lower()
        if hidden:
            self._hidden += 1
        names = " ".join(v for k in ("class", "id", "role") if (v := found.get(k))) if attrs else ""
        self._stack.append((tag, (*_names(tag, names), *(("*hidden",) if hidden else ()))))
        self._links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._flush()
        for depth in range(len(self._stack) - 1, -1, -1):
            if self._stack[depth][0] == tag:
                self._drop(depth)
                return
            # A stray inline end tag does not close the blocks around it.
            if tag not in BLOCKS and self._stack[depth][0] in BLOCKS:
                return

    def handle_data(self, data):
        if not self._hidden:
            self._text.append(data)
            if self._links:
                self._linked += len(data)

    def finish(self) -> list[Block]:
        self.close()
        self._flush()
        return self.blocks

    def _pop_while(self, closing, until):
        for depth in range(len(self._stack) - 1, -1, -1):
            tag = self._stack[depth][0]
            if tag in closing:
                self._drop(depth)
                return
            if tag in until:
                return

    def _drop(self, depth):
        for tag, names in self._stack[depth:]:
            self._links -= tag == "a"
            self._hidden -= (tag in HIDDEN_ELEMENTS) + ("*hidden" in names)
        del self._stack[depth:]

    def _flush(self):
        if self._text:
            raw = "".join(self._text)
            text = " ".join(raw.split())
            if text:
                path = tuple(n for tag, names in self._stack if tag in BLOCKS or tag in _INLINE_KEEP or len(names) > 1 for n in names)
                self.blocks.append(Block(text, path, min(1.0, self._linked / max(1, len(raw)))))
        self._text, self._linked = [], 0


def page_blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a page in order, with decoded references and single spaces; null and empty pages have none."""
    if not html:
        return []
    parser = _Blocks()
    parser.feed(html)
    return parser.finish()


@lru_cache(maxsize=200_000)
def _cells(name: str, cells: int) -> tuple[int, int]:
    h = zlib.crc32(name.encode("utf-8", "replace"))
    return h % cells, (h >> 16) % cells


def vectors(blocks: list[Block]) -> np.ndarray:
    """One input row per block: tag path, words, figures."""
    out = np.zeros((len(blocks), PATH_CELLS + WORD_CELLS + FIGURES), np.float32)
    path_cells: dict[tuple, tuple[np.ndarray, float, float]] = {}
    for i, block in enumerate(blocks):
        known = path_cells.get(block.path)
        if known is None:
            known = path_cells[block.path] = _path_vector(block.path)
        out[i, :PATH_CELLS] = known[0]
        words = block.text.lower().split()
        held = np.bincount([_cells(w, WORD_CELLS)[0] for w in words] if len(words) < 5000 else _counted(words), minlength=WORD_CELLS)
        out[i, PATH_CELLS : PATH_CELLS + WORD_CELLS] = held / max(1, len(words))
        out[i, PATH_CELLS + WORD_CELLS :] = (
            np.log1p(len(block.text)) / 8, block.linked, len(block.path) / 16, i / len(blocks),
            block.text[-1] in ".!?:;\"'”…", np.log1p(len(words)) / 8, known[1], known[2],
        )
    return out


def _path_vector(path: tuple[str, ...]) -> tuple[np.ndarray, float, float]:
    """Hashed names of a path, what the innermost telling name says, and how many names speak against main text."""
    row = np.zeros(PATH_CELLS, np.float32)
    for name in set(path):
        a, b = _cells(name, PATH_CELLS)
        row[a] += 1.0
        row[b] -= 1.0
    bare = [n.strip("<>") for n in reversed(path) if n != "<body>"]
    told = next((-1.0 if n in NOT_MAIN else 1.0 for n in bare if n in NOT_MAIN or n in IS_MAIN), 0.0)
    return row, told, min(3, sum(n in NOT_MAIN for n in bare)) / 2


def _counted(words: list[str]) -> list[int]:
    return [zlib.crc32(w.encode("utf-8", "replace")) % WORD_CELLS for w in words]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Per direction the input, recurrent and bias weights of the four gates; then the output layer."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def start(seed: int = 2) -> Labeller:
        rng = np.random.default_rng(seed)
        width = PATH_CELLS + WORD_CELLS + FIGURES
        p = {}
        for d in "fb":
            p[f"x{d}"] = rng.normal(0, 0.1, (width, 4 * HIDDEN))
            p[f"h{d}"] = rng.normal(0, 0.1, (HIDDEN, 4 * HIDDEN))
            p[f"b{d}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # the forget gate starts open
        p["o"], p["c"] = rng.normal(0, 0.1, 2 * HIDDEN), np.zeros(1)
        return Labeller({k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (time, pages, HIDDEN) in one direction; past the end of a page the state stays zero."""
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        c, out = h, np.zeros((*x.shape[:2], HIDDEN), np.float32)
        inputs = x @ self.p[f"x{d}"] + self.p[f"b{d}"]
        for t in steps:
            z = inputs[t] + h @ self.p[f"h{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g, before, m = np.tanh(z[:, 3 * HIDDEN :]), c, mask[t][:, None]
            c = (f * before + i * g) * m
            squashed = np.tanh(c)
            if keep is not None:
                keep.append((t, i, f, o, g, before, squashed, h, m))
            h = o * squashed * m
            out[t] = h
        return out

    def predict(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """The probability of being main text for every block of every page."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            longest, end = len(pages[order[at]]), at + 1
            # Pages of like length go together, up to a bounded number of cells.
            while end < len(order) and len(pages[order[end]]) <= 1.5 * longest + 4 and (end - at) * len(pages[order[end]]) < 20_000:
                end += 1
            chosen = order[at:end]
            x, mask = _padded([pages[i] for i in chosen])
            both = np.concatenate([self._run(x, mask, "f"), self._run(x, mask, "b")], axis=2)
            p = _sigmoid(both @ self.p["o"] + self.p["c"])
            for k, i in enumerate(chosen):
                out[i] = p[: len(pages[i]), k]
            at = end
        return out

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self._run(x, mask, d, kept[d]) for d in "fb"], axis=2)
        error = (_sigmoid(both @ self.p["o"] + self.p["c"]) - y) * mask / mask.sum()
        grad = {"o": np.einsum("tb,tbh->h", error, both), "c": error.sum(keepdims=True)[0]}
        for n, d in enumerate("fb"):
            back = error[:, :, None] * self.p["o"][n * HIDDEN : (n + 1) * HIDDEN]
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            recurrent = np.zeros_like(self.p[f"h{d}"])
            dh_next = dc_next = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, i, f, o, g, before, squashed, h_before, m in reversed(kept[d]):
                dh = (back[t] + dh_next) * m
                dc = (dh * o * (1 - squashed**2) + dc_next) * m
                dz = np.concatenate([
                    dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
                dz_all[t] = dz
                recurrent += h_before.T @ dz
                dh_next, dc_next = dz @ self.p[f"h{d}"].T, dc * f
            grad[f"x{d}"] = x.reshape(-1, x.shape[2]).T @ dz_all.reshape(-1, 4 * HIDDEN)
            grad[f"h{d}"], grad[f"b{d}"] = recurrent, dz_all.sum(axis=(0, 1))
        return grad


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((longest, len(pages)), np.float32)
    for k, page in enumerate(pages):
        x[: len(page), k], mask[: len(page), k] = page, 1
    return x, mask


def train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 14, batch: int = 24, rate: float = 0.01, seed: int = 4) -> Labeller:
    model, rng = Labeller.start(), np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    order, step = sorted(range(len(pages)), key=lambda i: len(pages[i])), 0
    batches = [order[at : at + batch] for at in range(0, len(order), batch)]
    for epoch in range(epochs):
        for b in rng.permutation(len(batches)):
            x, mask = _padded([pages[i] for i in batches[b]])
            y = np.zeros(mask.shape, np.float32)
            for k, i in enumerate(batches[b]):
                y[: len(labels[i]), k] = labels[i]
            step += 1
            now = rate * (1.0 if epoch < epochs * 2 // 3 else 0.2)
            for name, g in model.gradients(x, mask, y).items():
                m, v = moments[name]
                m += 0.1 * (np.clip(g, -1, 1) - m)
                v += 0.01 * (g * g - v)
                model.p[name] = (model.p[name] - now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def named_label(block: Block) -> float:
    """What the markup says about a block: the names on its path, or its size where they say nothing."""
    names = {n.strip("<>") for n in block.path}
    if "*hidden" in names or names & NOT_MAIN:
        return 0.0
    if names & (IS_MAIN - {"body"}):
        return 1.0
    return float(len(block.text) > 80 and block.linked < 0.4)


# Marks that a made page carries in front of its texts; both are private-use characters.
_MAIN_MARK, _OTHER_MARK = "", ""


def made_page(rng: random.Random, texts: list[str]) -> str:
    """A page of the given texts in a random layout; every text starts with the mark of its truth."""
    text = lambda: rng.choice(texts)
    few = lambda: " ".join(text().split()[: rng.randint(1, 8)])
    named = lambda words: f'{rng.choice(("class", "class", "id"))}="{rng.choice(words)}"'
    other = _OTHER_MARK

    def links(tag="ul"):
        return f"<{tag}>" + "".join(f'<li><a href="/x">{other}{few()}</a></li>' for _ in range(rng.randint(2, 7))) + f"</{tag}>"

    def paragraph(mark):
        return f"<p>{mark}{text()}" + rng.choice(("</p>", "</p>", "<br></p>", ""))

    def extra():
        kind = rng.randrange(9)
        if kind == 0:
            return rng.choice((f"<nav>{links()}</nav>", f"<div {named(['menu', 'navbar', 'main-nav', 'topmenu', 'breadcrumb', 'site-navigation', 'navLinks'])}>{links()}</div>"))
        if kind == 1:
            return rng.choice((f"<header><div>{other}{few()}</div>{links()}</header>", f"<div {named(['header', 'site-header', 'masthead', 'top-banner', 'pageHeader', 'topbar'])}>{paragraph(other)}</div>"))
        if kind == 2:
            return rng.choice((f"<footer>{other}&copy; {text()}</footer>", f"<div {named(['footer', 'page-footer', 'copyright', 'site-footer', 'footerLinks', 'legal'])}>{paragraph(other)}</div>"))
        if kind == 3:
            return rng.choice((f"<aside>{paragraph(other)}{links()}</aside>", f"<div {named(['sidebar', 'side-bar', 'widget', 'right-rail', 'related-posts', 'sidebarRight', 'recommended', 'more-stories-side'])}><h3>{other}{few()}</h3>{paragraph(other)}{links()}</div>"))
        if kind == 4:
            return f"<div {named(['cookie-notice', 'consent', 'gdpr-banner', 'alert', 'notice', 'popup', 'modal', 'cookieBanner', 'site-notice', 'overlay'])}>{paragraph(other)}<button>{other}{few()}</button></div>"
        if kind == 5 and rng.random() < 0.2:
            return f"<table><tr><td {named(['sidebar', 'nav', 'ad', 'menu', 'footer'])}>{paragraph(other)}</td></tr></table>"
        if kind == 5:
            return f"<{(t := rng.choice(('div', 'section', 'aside')))} {named(['ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'ad-slot', 'banner-ad', 'adBox', 'promotion'])}>{other}{text()}</{t}>"
        if kind == 6:
            return f"<form {named(['search', 'login', 'newsletter-form', 'signup', 'contact', 'c-3', 'f12'])}><label>{other}{few()}</label><p>{other}{text()}</p><select><option>{other}{few()}<option>{other}{few()}</select><button>{other}{few()}</button></form>"
        if kind == 7:
            return f"<{(t := rng.choice(('div', 'section', 'ol')))} {named(['comments', 'comment-list', 'user-comments', 'disqus', 'replies', 'discussion', 'readerComments', 'comment-thread'])}>" + "".join(
                f'<{(c := rng.choice(("div", "li", "article")))} class="comment">{paragraph(other)}</{c}>' for _ in range(rng.randint(1, 5))) + f"</{t}>"
        return f"<div {named(['share', 'social', 'share-buttons', 'tags', 'pagination'])}>{links()}</div>"

    def main():
        m, parts = _MAIN_MARK, []
        if rng.random() < 0.7:
            parts.append(f"<h1>{m}{few()}</h1>")
        for _ in range(rng.randint(1, 12)):
            kind = rng.random()
            if kind < 0.6:
                parts.append(paragraph(m))
            elif kind < 0.65:
                parts.append(rng.choice((
                    f"<dl><dt>{m}{few()}</dt><dd>{m}{few()}</dd></dl>", f"<pre>{m}{few()}</pre>", f"<div>{m}{text()}</div>",
                    f"<figure><img><figcaption>{m}{few()}</figcaption></figure>", f"<h3>{m}{few()}</h3>", f"<details><summary>{m}{few()}</summary>{m}{text()}</details>",
                )))
            elif kind < 0.7:
                parts.append("<ul>" + "".join(f"<li>{m}{few()}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
            elif kind < 0.75:
                parts.append(f"<h2>{m}{few()}</h2>")
            elif kind < 0.79:
                parts.append(f"<blockquote>{paragraph(m)}</blockquote>")
            elif kind < 0.83:
                parts.append("<table>" + "".join(f"<tr><td>{m}{few()}</td><td>{m}{few()}</td></tr>" for _ in range(rng.randint(1, 3))) + "</table>")
            else:
                parts.append(extra())
        inner = "".join(parts)
        return rng.choice((
            f"<article>{inner}</article>", f"<main>{inner}</main>", f"<main><article>{inner}</article></main>",
            f"<article>{inner}</article>", f"<div {named(['content', 'post', 'post-content', 'entry', 'entry-content', 'article-body', 'story', 'main-text', 'main'])}>{inner}</div>",
            f"<section {named(['article', 'content', 'story-body'])}>{inner}</section>",
            # Layouts that say nothing about the main text: what is not named otherwise is main.
            inner, f"<div>{inner}</div>", f"<div {named(['c1', 'x-23', 'col', 'row', 'inner', 'box'])}>{inner}</div>",
            f"<table><tr><td>{inner}</td></tr></table>",
        ))

    before, after = [extra() for _ in range(rng.randint(0, 4))], [extra() for _ in range(rng.randint(0, 4))]
    body = "".join([*before, main(), *after])
    if rng.random() < 0.3:
        body = f'<div {named(["wrapper", "page", "container", "layout"])}>{body}</div>'
    return f"<html><head><title>{other}{few()}</title></head><body>{body}</body></html>"


def training_set(pages: list[str], layouts: int = LAYOUTS, seed: int = 9) -> tuple[list[np.ndarray], list[np.ndarray]]:
    rng = random.Random(seed)
    x, y, texts = [], [], []
    for page in pages:
        blocks = page_blocks(page)
        if blocks:
            x.append(vectors(blocks))
            y.append(np.array([named_label(b) for b in blocks], np.float32))
            texts += [b.text[:600] for b in blocks]
    texts = texts or ["text"]
    for _ in range(layouts):
        blocks = page_blocks(made_page(rng, rng.sample(texts, min(len(texts), 60))))
        labels = np.array([b.text[:1] == _MAIN_MARK for b in blocks], np.float32)
        plain = [Block(b.text[1:].strip() or "x", b.path, b.linked) for b in blocks]
        x.append(vectors(plain))
        y.append(labels)
    return x, y


def learn(pages: DataFrame, training_pages: int = TRAINING_PAGES) -> Labeller:
    """Fit the network. At most ``training_pages`` pages of at most ``TRAINING_CHARS`` characters reach the driver."""
    usable = pages.where(F.length("html").between(1, TRAINING_CHARS))
    count = usable.count()
    rows = (
        sampled(usable, min(1.0, 2 * training_pages / count) if count else 1.0, "page_id", F.length("html"))
        .select("html").orderBy(F.xxhash64("html"), "html").limit(training_pages).collect()
    )
    return train(*training_set([r["html"] for r in rows]))


def main_texts(model: Labeller, pages: list[str | None]) -> list[tuple[str, int, int]]:
    """The main text, its number of blocks and the number of all blocks of every page."""
    blocks = [page_blocks(p) for p in pages]
    out = []
    for own, p in zip(blocks, model.predict([vectors(b) for b in blocks])):
        kept = [b.text for b, q in zip(own, p) if q >= MAIN]
        out.append(("\n".join(kept), len(kept), len(own)))
    return out


def extract(pages: DataFrame, model: Labeller) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars, main_blocks, blocks.

    The text is that of all blocks labelled as main, joined by line breaks; it is empty for null or empty pages and
    for pages without main text. Null ids and urls are carried along, repeated rows repeat, other columns are ignored.
    """
    small_batches(pages.sparkSession)

    @F.pandas_udf("text string, main_blocks int, blocks int")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for htmls in batches:
            yield pd.DataFrame(main_texts(model, list(htmls)), columns=["text", "main_blocks", "blocks"])

    found = pages.select("page_id", "url", read(F.col("html").cast("string")).alias("read"))
    return found.select(
        "page_id", "url", F.col("read.text").alias("text"), F.length("read.text").cast("long").alias("n_chars"),
        F.col("read.main_blocks").alias("main_blocks"), F.col("read.blocks").alias("blocks"),
    )
