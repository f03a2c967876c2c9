"""Main-text extraction with a bidirectional LSTM over a page's leaf blocks.

A page is cut into leaf blocks (text between block-level tags) with their tag path (tags,
classes, ids) and share of linked text. A block's vector is its hashed tag path, its hashed
words and a few sizes; the LSTM reads a page's blocks both ways, so each block is judged
with the whole page in view. Blocks called main text are joined in page order.

The table has no labels, so the labeller is trained on a bounded sample of its own pages:
the meaning of HTML5 sections tells body from boilerplate there, and copies of the sample
with other layouts (plain divs with classes, sidebars, notices, forms, comments) teach it
to go by more than one tag.

Text of formulas and objects belongs to the block around it; scripts, styles, graphics and
choice lists are left out as wholes, where they are closed: an unclosed graphic or list
hides nothing, an unclosed script the rest of the page, as in browsers.

Defined results: null, empty and markup-only pages give an empty text; a page without any
tag is one block; repeated rows give the same text; without pages nothing is trained and no
row comes out; extra columns are ignored.
"""

import re
import zlib
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, table

#: Pages the labeller is trained on at most (about; picked by a hash of the id).
TRAIN_PAGES = 500
PATH, WORDS, SIZES, HIDDEN = 128, 48, 4, 12
#: Blocks of a training window, and windows of a page at most, spread evenly over all of it.
WINDOW, WINDOWS = 80, 6
#: Steps of a fit at least, where the sample is small.
STEPS = 100

#: Element names of HTML (fixed values).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
          "label", "mark", "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
INLINE |= {"object", "math", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mfrac", "msup", "msub", "msubsup", "msqrt", "mroot", "mover", "munder",
           "munderover", "mtable", "mtr", "mtd", "mstyle", "mpadded", "menclose", "semantics"}
#: Raw text up to the end tag (or the page's end), and elements left out as a whole where they are closed.
RAW = "script|style|textarea|title|iframe"
WHOLE = {"svg", "select", "noscript", "template", "annotation"}
PIECE = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*?(?:/>|>.*?(?:</\1\s*>|\Z))|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
LOWER = {c: c + 32 for c in range(65, 91)}  # keeps every position, unlike lower()
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
PART = re.compile(r"[A-Za-z]+")
#: Sections whose text is not the article's, by HTML5 element and by usual class words.
BOILER = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "button", "head", ".ad", ".ads", ".advert", ".sidebar", ".comment", ".comments",
          ".cookie", ".notice", ".nav", ".menu", ".footer", ".header", ".banner", ".related", ".share", ".newsletter", ".promo", ".breadcrumb"}
BODY = {"article", "main", ".article", ".content", ".post", ".entry", ".story"}


def blocks(html: str) -> list[tuple[tuple[str, ...], str, float]]:
    """(path, text, share of linked characters) of each leaf block, in page order."""
    out, stack, buf = [], [], []
    linked = [0, 0]  # depth of open links, characters inside them
    at = past = 0
    low, unclosed = "", set()

    def flush():
        if buf:
            text = " ".join(unescape("".join(buf)).split())
            if text:
                path = tuple(t for e in stack for t in e[1])
                out.append((path, text, min(1.0, linked[1] / len(text))))
            buf.clear()
        linked[1] = 0

    for m in PIECE.finditer(html):
        if m.start() < past:
            continue
        if m.start() > at:
            buf.append(text := html[at:m.start()])
            linked[1] += len(text) if linked[0] else 0
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in WHOLE and not m[2] and name not in unclosed:
            low = low or html.translate(LOWER)
            if (end := low.find(f"</{name}", at)) >= 0:
                end = low.find(">", end)
                at = past = len(html) if end < 0 else end + 1
                continue
            unclosed.add(name)  # it hides nothing: what follows is read as usual
        if name in INLINE:
            if name == "br":
                buf.append(" ")
            if name == "a":
                linked[0] = max(0, linked[0] + (-1 if m[2] else 1))
            continue
        flush()
        linked[0] = 0
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        elif name not in VOID:
            if stack and stack[-1][0] == "p" or stack and stack[-1][0] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                stack.pop()  # its end tag was left out
            names = {p.lower() for n in NAMES.findall(m[4] or "") for p in PART.findall("".join(n))}
            stack.append((name, (name, *sorted("." + n for n in names))))
    if at < len(html):
        buf.append(html[at:])
    flush()
    return out


class Hashes(dict):
    def __init__(self, size: int):
        self.size = size

    def __missing__(self, key: str) -> int:
        if len(self) > 200_000:
            self.clear()
        v = self[key] = zlib.crc32(key.encode("utf-8", "surrogatepass")) % self.size
        return v


PATH_HASH, WORD_HASH = Hashes(PATH), Hashes(WORDS)


def vectors(page: list[tuple[tuple[str, ...], str, float]]) -> np.ndarray:
    """One row per block: hashed path, hashed words (shares), sizes."""
    n = len(page)
    x = np.zeros((n, PATH + WORDS + SIZES), dtype=np.float32)
    for k, (path, text, link) in enumerate(page):
        for p in path:
            x[k, PATH_HASH[p]] = 1
        words = text.split()
        x[k, PATH:PATH + WORDS] = np.bincount([WORD_HASH[w] for w in words], minlength=WORDS) / len(words)
        x[k, -4:] = np.log1p(len(words)) / 5, link, text.count(".") / (len(words) + 1), np.log1p(n) / 5
    return x


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        d, h = PATH + WORDS + SIZES, HIDDEN
        self.p = {}
        for s in "fb":
            self.p["w" + s] = r.normal(0, 0.1, (d, 4 * h)).astype(np.float32)
            self.p["u" + s] = r.normal(0, 0.2, (h, 4 * h)).astype(np.float32)
            self.p["c" + s] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]).astype(np.float32)
        self.p["o"] = r.normal(0, 0.2, 2 * h).astype(np.float32)
        self.p["k"] = np.zeros(1, dtype=np.float32)

    def _run(self, g: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states over time for gate inputs ``g`` (time, pages, 4h)."""
        t, n, h4 = g.shape
        h = h4 // 4
        hid, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out = np.zeros((t, n, h), np.float32)
        for k in range(t):
            z = g[k] + hid @ u
            s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * h], -20, 20)))
            new = np.tanh(z[:, 3 * h:])
            m = mask[k][:, None]
            c = (s[:, h:2 * h] * cell + s[:, :h] * new) * m
            tc = np.tanh(c)
            if keep is not None:
                keep.append((hid, cell, s, new, tc))
            hid, cell = s[:, 2 * h:] * tc * m, c
            out[k] = hid
        return out

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of main text for each block of each page."""
        out: list = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            first, stop = len(pages[order[at]]), at
            while stop < len(order) and len(pages[order[stop]]) <= first * 1.25 + 4 and stop - at < 512:
                stop += 1
            group = order[at:stop]
            at = stop
            x, mask = _padded([pages[i] for i in group])
            p = self._forward(x, mask)
            for k, i in enumerate(group):
                out[i] = p[: len(pages[i]), k]
        return out

    def _forward(self, x, mask, keep=None):
        p = self.p
        kf, kb = ([], []) if keep is not None else (None, None)
        f = self._run(x @ p["wf"] + p["cf"], mask, p["uf"], kf)
        b = self._run((x @ p["wb"] + p["cb"])[::-1], mask[::-1], p["ub"], kb)[::-1]
        s = np.concatenate([f, b], axis=2) @ p["o"] + p["k"]
        if keep is not None:
            keep += [f, b, kf, kb]
        return 1 / (1 + np.exp(-np.clip(s, -20, 20)))

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 6, batch: int = 48, rate: float = 0.01) -> None:
        """Back-propagation through time, Adam."""
        h = HIDDEN
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        r, step = np.random.default_rng(3), 0
        for _ in range(epochs):
            order = r.permutation(len(pages))
            for b0 in range(0, len(order), batch):
                group = order[b0:b0 + batch]
                x, mask = _padded([pages[i] for i in group])
                y = np.zeros(mask.shape, np.float32)
                for k, i in enumerate(group):
                    y[: len(labels[i]), k] = labels[i]
                keep: list = []
                prob = self._forward(x, mask, keep)
                f, b, kf, kb = keep
                d = ((prob - y) * mask / mask.sum()).astype(np.float32)
                both = np.concatenate([f, b], axis=2)
                grad = {"o": np.einsum("tn,tnh->h", d, both), "k": d.sum(keepdims=True)[0]}
                dh = d[:, :, None] * self.p["o"]
                for side, part, kept, xs, ms in (("f", dh[:, :, :h], kf, x, mask), ("b", dh[::-1, :, h:], kb, x[::-1], mask[::-1])):
                    u = self.p["u" + side]
                    gh = gc = np.zeros((len(group), h), np.float32)
                    gu, dz = np.zeros_like(u), np.zeros((*mask.shape, 4 * h), np.float32)
                    for t in range(len(xs) - 1, -1, -1):
                        hid, cell, s, new, tc = kept[t]
                        mt = ms[t][:, None]
                        g = (part[t] + gh) * mt
                        o = s[:, 2 * h:]
                        dc = (g * o * (1 - tc * tc) + gc) * mt
                        i_, f_ = s[:, :h], s[:, h:2 * h]
                        z = np.concatenate([dc * new * i_ * (1 - i_), dc * cell * f_ * (1 - f_), g * tc * o * (1 - o), dc * i_ * (1 - new * new)], axis=1)
                        gu += hid.T @ z
                        gh, gc = z @ u.T, dc * f_
                        dz[t] = z
                    grad["w" + side] = np.einsum("tnd,tnz->dz", xs, dz, optimize=True)
                    grad["u" + side], grad["c" + side] = gu, dz.sum(axis=(0, 1))
                step += 1
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.99 * v2[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    top = max(map(len, pages))
    x = np.zeros((top, len(pages), PATH + WORDS + SIZES), np.float32)
    mask = np.zeros((top, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


def teacher(page) -> np.ndarray:
    """Training labels from the meaning of sections: inside a body section, outside boilerplate."""
    has = any(not BODY.isdisjoint(p) for p, _, _ in page)
    return np.array([(not has or not BODY.isdisjoint(p)) and BOILER.isdisjoint(p) for p, _, _ in page], dtype=np.float32)


def relaid(page, r: np.random.Generator):
    """The same page in another layout, with its labels."""
    y = teacher(page)
    body = [(p[-1:] or ("p",), t, l) for (p, t, l), v in zip(page, y) if v]
    rest = [(t, l) for (_, t, l), v in zip(page, y) if not v] or [("Home", 1.0)]
    pick = lambda: rest[int(r.integers(len(rest)))]
    inner = [("main",), ("article",), ("main", "article"), ("div", ".content"), ("div", ".post", ".content"), ("section", ".article"), ("div", ".entry")][int(r.integers(7))]
    top = [[("header", "div"), ("nav", "ul", "li"), ("div", ".nav"), ("div", ".cookie", ".notice"), ("form",), ("div", ".header"), ("div", ".ad"), ("div", ".banner"), ("div", ".breadcrumb")][int(r.integers(9))] for _ in range(int(r.integers(1, 4)))]
    low = [[("aside", "div"), ("aside", "ul", "li"), ("div", ".sidebar"), ("section", ".comments", "div", ".comment", "p"), ("section", ".comments", "article", ".comment", "p"), ("form", "p"), ("footer", "p"), ("div", ".footer"), ("div", ".related"), ("div", ".newsletter"), ("div", ".share"), ("div", ".ad")][int(r.integers(12))] for _ in range(int(r.integers(1, 5)))]
    out, lab = [], []
    for path in top:
        for _ in range(int(r.integers(1, 5))):
            t, l = pick()
            out.append((("html", "body", *path), t, l if "li" in path else 0.0)), lab.append(0)
    for tag, t, l in body:
        out.append((("html", "body", *inner, *tag), t, l)), lab.append(1)
        if r.random() < 0.1:
            ad = [("div", ".ad"), ("aside", "p"), ("form", "p"), ("div", ".promo")][int(r.integers(4))]
            out.append((("html", "body", *inner, *ad), pick()[0], 0.0)), lab.append(0)
    for path in low:
        nested = r.random() < 0.3 and path[0] not in ("footer",)
        for _ in range(int(r.integers(1, 4))):
            # some boilerplate repeats body-like text: reader comments, teasers
            t, l = (body[int(r.integers(len(body)))][1], 0.0) if body and r.random() < 0.4 else pick()
            out.append((("html", "body", *(inner if nested else ()), *path), t, l)), lab.append(0)
    return out, np.array(lab, dtype=np.float32)


def train(pages: DataFrame, limit: int = TRAIN_PAGES) -> Labeller:
    """Fit a labeller on about ``limit`` pages, half of it again in other layouts."""
    got = bounded_sample(pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")), "page_id", limit).toPandas()
    r = np.random.default_rng(11)
    x, y = [], []
    for html in got["html"]:
        page = blocks(html)
        for p, lab in ((page, teacher(page)), relaid(page, r)) if page else ():
            v = vectors(p)  # of the whole page, as in scoring
            for a in np.unique(np.linspace(0, max(0, len(v) - WINDOW), WINDOWS).astype(int)):
                x.append(v[a:a + WINDOW]), y.append(lab[a:a + WINDOW])
    model = Labeller()
    if x:
        model.fit(x, y, epochs=max(6, -(-STEPS * 48 // len(x))))
    return model


def extract(pages: DataFrame, model: Labeller) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""

    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            out = []
            for k in range(0, len(htmls), 1000):
                found = [blocks(h) for h in htmls.iloc[k:k + 1000]]
                keep = model.probabilities([vectors(f) for f in found])
                out += ["\n".join(t for (_, t, _), p in zip(f, q) if p >= 0.5) for f, q in zip(found, keep)]
            yield pd.Series(out, dtype=object)

    d = pages.select("page_id", "url", main_text(F.coalesce("html", F.lit(""))).alias("text"))
    return d.withColumn("n_chars", F.length("text").cast("long"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))
