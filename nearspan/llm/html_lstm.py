"""HTML extraction: a recurrent labeller decides for every block of a page whether it belongs to the article.

A page is cut into leaf blocks (``html_blocks``). Each block becomes a vector: the mean embedding of its hashed
tag-path marks (elements, classes, ids, roles), the mean embedding of its hashed words, and a few measures. A
bidirectional LSTM in numpy reads the whole sequence of a page from both sides, so every decision sees the whole
document. It is trained here on pages of a seeded grammar (``html_grammar``); nothing about a corpus is stored.

The text of a page is its article blocks joined by line feeds. Character references are decoded, white space
inside a block becomes one space. Headings and titles inside the article belong to it; the document's head never.

Defined cases: null and empty pages and pages without article blocks give ''; pages of any length are read whole,
what follows an unfinished tag or comment is dropped; repeated rows are extracted each; extra columns are ignored.
Pages are read where they lie, no shuffle; a batch of pages is labelled in padded groups of bounded size.
"""

from __future__ import annotations

import functools
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nearspan.llm.html_blocks import Block, blocks_of
from nearspan.llm.html_grammar import Grammar
from nearspan.session import attach

WORDS = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    pages: int = 1200
    epochs: int = 5
    batch: int = 24
    rate: float = 0.01
    hidden: int = 16
    paths: int = 2048
    words: int = 1024
    path_width: int = 20
    word_width: int = 6
    blind: float = 0.15
    seed: int = 5


MEASURES = 6
GROUP = 120_000


def signs_of(block: Block, s: Settings) -> tuple[list[int], list[int], list[float]]:
    """Hashed path marks, hashed distinct words and measures of a block."""
    path = [zlib.crc32(m.encode()) % s.paths for m in block.path]
    path += [zlib.crc32(f"last {block.path[-1]}".encode()) % s.paths] if block.path else []
    words = [zlib.crc32(w.encode("utf8", "replace")) % s.words for w in sorted(set(WORDS.findall(block.text.lower())))]
    n = len(block.text)
    stops = block.text.count(".") + block.text.count(",")
    return path, words, [np.log1p(n) / 8, block.linked, min(1.0, 20 * stops / n), float("©" in block.text),
                         min(1.0, len(block.path) / 16), 1.0]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in lists], np.int64)
    return np.array([i for x in lists for i in x], np.int64), size


class Lstm:
    """One direction. x: (steps, pages, width)."""

    def __init__(self, width: int, hidden: int, rng: np.random.Generator):
        self.w = (rng.normal(0, 1, (width, 4 * hidden)) / np.sqrt(width)).astype(np.float32)
        self.u = (rng.normal(0, 1, (hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.b = np.zeros(4 * hidden, np.float32)
        self.b[hidden:2 * hidden] = 1
        self.hidden = hidden

    def forward(self, x: np.ndarray, keep: bool = False):
        steps, pages, _ = x.shape
        k = self.hidden
        z = x @ self.w + self.b
        h, c = np.zeros((pages, k), np.float32), np.zeros((pages, k), np.float32)
        out = np.empty((steps, pages, k), np.float32)
        kept = []
        for t in range(steps):
            a = z[t] + h @ self.u
            g = 1 / (1 + np.exp(-np.clip(a[:, :3 * k], -30, 30)))
            i, f, o, n = g[:, :k], g[:, k:2 * k], g[:, 2 * k:], np.tanh(a[:, 3 * k:])
            if keep:
                kept.append((i, f, o, n, c, h))
            c = f * c + i * n
            h = o * np.tanh(c)
            out[t] = h
            if keep:
                kept[-1] += (c,)
        return (out, kept) if keep else out

    def backward(self, x: np.ndarray, kept: list, dout: np.ndarray):
        steps, pages, _ = x.shape
        k = self.hidden
        dz = np.empty((steps, pages, 4 * k), np.float32)
        du = np.zeros_like(self.u)
        dh, dc = np.zeros((pages, k), np.float32), np.zeros((pages, k), np.float32)
        for t in range(steps - 1, -1, -1):
            i, f, o, n, c0, h0, c = kept[t]
            dh = dh + dout[t]
            tc = np.tanh(c)
            dc = dc + dh * o * (1 - tc * tc)
            dz[t] = np.concatenate([dc * n * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - n * n)], axis=1)
            du += h0.T @ dz[t]
            dh, dc = dz[t] @ self.u.T, dc * f
        flat = dz.reshape(-1, 4 * k)
        return dz @ self.w.T, [x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(axis=0)]


@dataclass
class Labeller:
    s: Settings = field(default_factory=Settings)

    def __post_init__(self):
        rng, s = np.random.default_rng(self.s.seed), self.s
        self.path = rng.normal(0, 0.3, (s.paths, s.path_width)).astype(np.float32)
        self.word = rng.normal(0, 0.1, (s.words, s.word_width)).astype(np.float32)
        width = s.path_width + s.word_width + MEASURES
        self.ahead, self.back = Lstm(width, s.hidden, rng), Lstm(width, s.hidden, rng)
        self.top = np.zeros(2 * s.hidden + width, np.float32)
        self.bias = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.path, self.word, self.ahead.w, self.ahead.u, self.ahead.b, self.back.w, self.back.u, self.back.b,
                self.top, self.bias]

    def inputs(self, blocks: list[tuple]) -> tuple[np.ndarray, list]:
        out, parts, at = [], [], 0
        for table, column in ((self.path, 0), (self.word, 1)):
            ids, size = _flat([b[column] for b in blocks])
            owner = np.repeat(np.arange(len(blocks)), size)
            scale = (1 / np.sqrt(np.maximum(size, 1))).astype(np.float32)
            mean = np.zeros((len(blocks), table.shape[1]), np.float32)
            full = size > 0
            if full.any():
                mean[full] = np.add.reduceat(table[ids], (np.cumsum(size) - size)[full], axis=0)
            out.append(mean * scale[:, None])
            parts.append((ids, owner, scale))
        out.append(np.array([b[2] for b in blocks], np.float32).reshape(len(blocks), MEASURES))
        return np.concatenate(out, axis=1), parts

    @staticmethod
    def places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Step from the front, step from the end and page of every block."""
        page = np.repeat(np.arange(len(sizes)), sizes)
        step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return step, sizes[page] - 1 - step, page

    def margins(self, blocks: list[tuple], sizes: np.ndarray) -> np.ndarray:
        x, _ = self.inputs(blocks)
        step, rstep, page = self.places(sizes)
        states = []
        for net, at in ((self.ahead, step), (self.back, rstep)):
            padded = np.zeros((sizes.max(), len(sizes), x.shape[1]), np.float32)
            padded[at, page] = x
            states.append(net.forward(padded)[at, page])
        return np.concatenate([*states, x], axis=1) @ self.top + self.bias[0]

    def loss(self, blocks: list[tuple], sizes: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean logistic loss and its gradient for every parameter."""
        s = self.s
        x, parts = self.inputs(blocks)
        step, rstep, page = self.places(sizes)
        runs = []
        for net, at in ((self.ahead, step), (self.back, rstep)):
            padded = np.zeros((sizes.max(), len(sizes), x.shape[1]), np.float32)
            padded[at, page] = x
            runs.append((net, at, padded, *net.forward(padded, keep=True)))
        full = np.concatenate([*(out[at, page] for _, at, _, out, _ in runs), x], axis=1)
        m = full @ self.top + self.bias[0]
        p = 1 / (1 + np.exp(-np.clip(m, -30, 30)))
        loss = float(-(y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9)).mean())
        dm = ((p - y) / len(y)).astype(np.float32)
        dfull = dm[:, None] * self.top
        dx = dfull[:, 2 * s.hidden:].copy()
        nets = []
        for j, (net, at, padded, out, kept) in enumerate(runs):
            dout = np.zeros_like(out)
            dout[at, page] = dfull[:, j * s.hidden:(j + 1) * s.hidden]
            dpad, grads = net.backward(padded, kept, dout)
            dx += dpad[at, page]
            nets += grads
        tables, low = [], 0
        for (ids, owner, scale), table in zip(parts, (self.path, self.word), strict=True):
            grad = np.zeros_like(table)
            np.add.at(grad, ids, (dx[:, low:low + table.shape[1]] * scale[:, None])[owner])
            tables.append(grad)
            low += table.shape[1]
        return loss, [*tables, *nets, full.T @ dm, np.array([dm.sum()], np.float32)]

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For every page, which of its blocks belong to the article. Pages are padded together by similar length."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        low = 0
        while low < len(order):
            high = low + 1
            while high < len(order) and (high + 1 - low) * len(pages[order[high]]) <= GROUP and high - low < 512:
                high += 1
            part = order[low:high]
            sizes = np.array([len(pages[i]) for i in part])
            yes = self.margins([signs_of(b, self.s) for i in part for b in pages[i]], sizes) > 0
            for i, mine in zip(part, np.split(yes, np.cumsum(sizes)[:-1]), strict=True):
                out[i] = mine
            low = high
        return out


def sample_pages(n: int, seed: int) -> list[tuple[list[Block], np.ndarray]]:
    """Labelled pages of the grammar; the reader must find as many blocks as the grammar wrote."""
    grammar, out = Grammar(seed), []
    while len(out) < n:
        text, labels = grammar.page()
        blocks = blocks_of(text)
        if len(blocks) == len(labels) and blocks:
            out.append((blocks, np.array(labels)))
    return out


@functools.lru_cache(maxsize=2)
def train(s: Settings = Settings()) -> Labeller:
    """Adam over batches of pages; marks and words are dropped at random so that no single one decides."""
    model, rng = Labeller(s), np.random.default_rng(s.seed + 1)
    pages = [([signs_of(b, s) for b in blocks], y) for blocks, y in sample_pages(s.pages, s.seed)]
    params = model.parameters()
    m1, m2, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(s.epochs):
        order = rng.permutation(len(pages))
        for i in range(0, len(order), s.batch):
            part = [pages[j] for j in order[i:i + s.batch]]
            blocks = [([p for p in b[0] if rng.random() > s.blind], [w for w in b[1] if rng.random() > 0.3], b[2])
                      for page, _ in part for b in page]
            sizes = np.array([len(page) for page, _ in part])
            _, grads = model.loss(blocks, sizes, np.concatenate([y for _, y in part]).astype(np.float32))
            t += 1
            rate = s.rate * (1 - 0.8 * epoch / s.epochs)
            for p, g, a, b in zip(params, grads, m1, m2, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-7)
    return model


def main_text(blocks: list[Block], labels: np.ndarray) -> str:
    return "\n".join(b.text for b, yes in zip(blocks, labels, strict=True) if yes)


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_kept) for every row of pages (page_id, url, html)."""
    attach(pages.sparkSession)
    model = model or train()
    given = pages.select("page_id", "url", "html")
    kinds = dict(given.dtypes)

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                b = batch.slice(low, 256)
                read = [blocks_of(x.as_py()) for x in b.column("html")]
                labels = model.label(read)
                texts = [main_text(p, y) for p, y in zip(read, labels, strict=True)]
                yield pa.record_batch([
                    b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()), pa.array([len(p) for p in read], pa.int32()),
                    pa.array([int(y.sum()) for y in labels], pa.int32())],
                    ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    return given.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, "
                                 "n_blocks int, n_kept int")
