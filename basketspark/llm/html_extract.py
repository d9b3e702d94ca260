"""Main text of HTML pages by a recurrent block labeller.

A page is cut into leaf blocks. Each is described by its hashed tag path (elements and their names), its hashed words and a few
figures; a bidirectional LSTM reads the page's sequence of blocks both ways, so that each block is classified in the context of
the whole page. Blocks labelled as main text are joined by line ends. The network is written in numpy and trained here, on
synthetic pages with many layouts (``PAGES`` of them), once in a driver process.

Edge cases: a null or empty page has an empty text; pages without markup are one block, kept whole; repeated rows, null ids and null urls are
carried; pages of any length are read whole; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
from functools import cache, lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import release
from .html_blocks import Block, Element, blocks
from .html_training import labelled_pages

#: Inputs: elements of the path, names of the innermost named element, names of those around it, words, figures.
TAGS, NAMES, AROUND, WORDS, FIGURES = 48, 112, 64, 48, 14
PATH = TAGS + NAMES + AROUND
WIDTH = PATH + WORDS + FIGURES
HIDDEN = 24
NEAR = 12
PAGES, ROUNDS, BATCH, SEED = 2400, 15, 32, 7
#: Blocks of pages that are labelled side by side, padding included.
TOGETHER = 60_000
SPLIT = re.compile(r"[^a-z]+")


def _add(out: np.ndarray, tag: str, names: str, weight: float, first: int, size: int) -> None:
    h = crc32(tag.encode())
    out[h % TAGS] += (1 if h >> 16 & 1 else -1) * weight
    for n in filter(None, SPLIT.split(names)):
        h = crc32(n.encode())
        out[first + h % size] += 1 if h >> 16 & 1 else -1


@lru_cache(maxsize=20_000)
def _inner(path: tuple) -> np.ndarray:
    """Of the innermost elements, the innermost first; the names of the first that has some are told from the others."""
    out, inner = np.zeros(PATH, np.float32), True
    for depth, (tag, names) in enumerate(path):
        _add(out, tag, names, 1.0 if depth < 2 else 0.6, *((TAGS, NAMES) if inner else (TAGS + NAMES, AROUND)))
        inner = inner and not names
    return out


def _outer(element: Element | None) -> np.ndarray:
    """Of an element and all around it: each different one counts once, so that depth doesn't drown names."""
    chain = []
    while element is not None and element.pooled is None:
        chain.append(element)
        element = element.outer
    out = np.zeros(PATH, np.float32) if element is None else element.pooled
    for e in reversed(chain):
        if e.fresh:
            out = out.copy()
            _add(out, e.tag, e.names, 0.6, TAGS + NAMES, AROUND)
        e.pooled = out
    return out


def _path_vector(element: Element | None) -> np.ndarray:
    """Of the whole path: its ``NEAR`` innermost elements by depth, those outside pooled."""
    near = []
    while element is not None and len(near) < NEAR:
        near.append((element.tag, element.names))
        element = element.outer
    inner = _inner(tuple(near))
    return np.clip(inner if element is None else inner + _outer(element), -3, 3)


def _heading(tag: str) -> int:
    return {"h1": 1, "h2": 2, "h3": 2, "h4": 2, "h5": 2, "h6": 2, "li": 3, "p": 4}.get(tag, 0)


_WORD_AT: dict[str, int] = {}


def _words_at(words: list[str]) -> list[int]:
    got = list(map(_WORD_AT.get, words))
    if None in got:
        if len(_WORD_AT) > 150_000:
            _WORD_AT.clear()
        for i, w in enumerate(words):
            if got[i] is None:
                got[i] = crc32(w.strip(".,:;!?()|").encode()) % WORDS
                if len(w) <= 40:
                    _WORD_AT[w] = got[i]
    return got


def vectors(page: list[Block]) -> np.ndarray:
    """A row for each block."""
    out = np.zeros((len(page), WIDTH), np.float32)
    n = len(page)
    at = PATH + WORDS
    for i, b in enumerate(page):
        words = b.text.lower().split()
        k = len(words)
        path, data = b.path, b.text.encode()
        row = out[i]
        row[:PATH] = _path_vector(path)
        row[PATH:at] = np.bincount(_words_at(words), minlength=WORDS) / np.sqrt(k)
        last = b.text[-1]
        row[at : at + 9] = 1, np.log1p(k) / 4, b.linked, last in ".!?…", last in ":,;", i / n, np.log1p(n) / 4, min(path.depth if path else 0, 24) / 8, 4 * (1 - len(data.translate(None, b"0123456789")) / len(data))
        if h := _heading(path.tag if path else ""):
            row[at + 8 + h] = 1
        row[at + 13] = k <= 3
    return out


class BlockLabeller:
    """Bidirectional LSTM with a logistic output for each step; parameters by name."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    @classmethod
    def fresh(cls, seed: int) -> BlockLabeller:
        r, p = np.random.default_rng(seed), {}
        for d in "fb":
            p[f"w{d}"] = r.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, 4 * HIDDEN))
            p[f"u{d}"] = r.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            p[f"b{d}"] = np.zeros(4 * HIDDEN)
            p[f"b{d}"][HIDDEN : 2 * HIDDEN] = 1
        p["o"], p["x"], p["c"] = r.normal(0, 0.1, 2 * HIDDEN), np.zeros(WIDTH), np.zeros(1)
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, x: np.ndarray, there: np.ndarray, keep: bool) -> tuple[np.ndarray, tuple | None]:
        """Both directions side by side. x: (steps, pages, WIDTH); there: (steps, pages, 1). States past a page's end stay as they
        were. The result is (steps, 2, pages, HIDDEN), by each direction's own steps; what ``_back`` needs is kept if asked for."""
        steps, n, _ = x.shape
        flat, kind = x.reshape(-1, WIDTH), x.dtype
        z = np.empty((steps, 2, n, 4 * HIDDEN), kind)
        z[:, 0] = (flat @ self.p["wf"] + self.p["bf"]).reshape(steps, n, -1)
        z[:, 1] = (flat @ self.p["wb"] + self.p["bb"]).reshape(steps, n, -1)[::-1]
        mask, full, u = np.stack([there, there[::-1]], 1), there.all((1, 2)) & there[::-1].all((1, 2)), np.stack([self.p["uf"], self.p["ub"]])
        z[..., : 3 * HIDDEN] *= 0.5  # the logistic function by the hyperbolic tangent of a half
        u[..., : 3 * HIDDEN] *= 0.5
        h, c = np.zeros((2, n, HIDDEN), kind), np.zeros((2, n, HIDDEN), kind)
        out = np.empty((steps, 2, n, HIDDEN), kind)
        tanh, before = (np.empty_like(out), np.empty_like(out)) if keep else (None, None)
        for t in range(steps):
            a = np.tanh(z[t] + h @ u)
            gates = a[..., : 3 * HIDDEN]
            gates *= 0.5
            gates += 0.5
            new = a[..., HIDDEN : 2 * HIDDEN] * c + a[..., :HIDDEN] * a[..., 3 * HIDDEN :]
            s = np.tanh(new)
            if keep:
                z[t], tanh[t], before[t] = a, s, c
            o = a[..., 2 * HIDDEN : 3 * HIDDEN] * s
            c, h = (new, o) if full[t] else (np.where(mask[t], new, c), np.where(mask[t], o, h))
            out[t] = h
        return out, (z, tanh, before, mask) if keep else None

    def _scores(self, out: np.ndarray, x: np.ndarray) -> np.ndarray:
        return out[:, 0] @ self.p["o"][:HIDDEN] + out[::-1, 1] @ self.p["o"][HIDDEN:] + x @ self.p["x"] + self.p["c"]

    def scores(self, x: np.ndarray, there: np.ndarray) -> np.ndarray:
        return self._scores(self._run(x, there, False)[0], x)

    def _back(self, grad: np.ndarray, x: np.ndarray, out: np.ndarray, kept: tuple, g: dict) -> None:
        """grad: of the states, by each direction's own steps."""
        gates, tanh, before, mask = kept
        steps, _, n, _ = grad.shape
        i, f, o, new = (gates[..., k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
        # What each gate's input takes of its state's and its cell's gradient; nothing past a page's end.
        own = np.where(mask, o * (1 - tanh * tanh), 0)
        take = np.where(mask[..., None], np.stack([new * i * (1 - i), before * f * (1 - f), tanh * o * (1 - o), i * (1 - new * new)], 3), 0)
        back = np.stack([self.p["uf"].T, self.p["ub"].T])
        dz = np.empty((steps, 2, n, 4, HIDDEN), gates.dtype)
        dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
        for t in range(steps - 1, -1, -1):
            dh = dh + grad[t]
            cell = dc + dh * own[t]
            a = dz[t]
            np.multiply(take[t], cell[:, :, None], out=a)
            a[:, :, 2] = take[t, :, :, 2] * dh
            there = mask[t]
            dh = np.where(there, a.reshape(2, n, -1) @ back, dh)
            dc = np.where(there, cell * f[t], dc)
        flat = dz.reshape(steps, 2, n, -1)
        for k, d in enumerate("fb"):
            of = flat[:, k]
            g[f"u{d}"] = out[:-1, k].reshape(-1, HIDDEN).T @ of[1:].reshape(-1, 4 * HIDDEN)
            of = (of if d == "f" else of[::-1]).reshape(-1, 4 * HIDDEN)
            g[f"w{d}"], g[f"b{d}"] = x.reshape(-1, WIDTH).T @ of, of.sum(0)

    def gradients(self, x: np.ndarray, there: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log-loss of the blocks, by parameter."""
        out, kept = self._run(x, there, True)
        s = self._scores(out, x)
        ds = (np.where(there[..., 0], 1 / (1 + np.exp(-s)) - y, 0) / there.sum()).astype(x.dtype)
        flat, o = ds.ravel(), self.p["o"].reshape(2, HIDDEN)
        g = {"o": np.concatenate([flat @ out[:, 0].reshape(-1, HIDDEN), flat @ out[::-1, 1].reshape(-1, HIDDEN)]), "x": flat @ x.reshape(-1, WIDTH), "c": flat.sum(keepdims=True)}
        self._back(np.stack([ds[..., None] * o[0], ds[::-1, :, None] * o[1]], 1), x, out, kept, g)
        return g

    def train(self, pages: list[tuple[np.ndarray, list[int]]], rounds: int = ROUNDS, rate: float = 8e-3, seed: int = SEED) -> BlockLabeller:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        batches = [order[a : a + BATCH] for a in range(0, len(order), BATCH)]
        t, mean, n = 0, None, 0
        for k in range(rounds):
            for j in r.permutation(len(batches)):
                part = [pages[i] for i in batches[j]]
                x, there = padded([a for a, _ in part])
                y = np.zeros(there.shape[:2], np.float32)
                for i, (_, marks) in enumerate(part):
                    y[: len(marks), i] = marks
                # Dropped-out inputs: neither names nor elements nor words may be relied on alone.
                x = x * (r.random((1, x.shape[1], WIDTH)) > 0.1)
                x[:, r.random(x.shape[1]) < 0.06, TAGS:PATH] = 0
                x = x.astype(np.float32)
                g = self.gradients(x, there, y)
                norm = float(np.sqrt(sum((a * a).sum() for a in g.values())))
                t += 1
                step = rate * (1 - k / rounds) / max(1.0, norm)
                for name, a in g.items():
                    a = a.astype(np.float32) + 1e-5 * self.p[name]
                    m[name] = 0.9 * m[name] + 0.1 * a
                    v[name] = 0.99 * v[name] + 0.01 * a * a
                    self.p[name] = self.p[name] - step * (m[name] / (1 - 0.9**t)) / (np.sqrt(v[name] / (1 - 0.99**t)) + 1e-8)
                if k >= rounds * 0.6:  # the mean of the last rounds' parameters
                    n += 1
                    mean = {a: b.copy() for a, b in self.p.items()} if mean is None else {a: mean[a] + (b - mean[a]) / n for a, b in self.p.items()}
        self.p = mean
        return self

    def labels(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is of the main text; pages of like length go together."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        while order:
            n = max(1, min(256, TOGETHER // len(pages[order[-1]])))
            part, order = order[-n:], order[:-n]
            s = self.scores(*padded([pages[i] for i in part]))
            for k, i in enumerate(part):
                out[i] = s[: len(pages[i]), k] > 0
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if len(pages) == 1:
        return pages[0][:, None], np.ones((len(pages[0]), 1, 1), bool)
    x = np.zeros((max(map(len, pages)), len(pages), WIDTH), np.float32)
    there = np.zeros((*x.shape[:2], 1), bool)
    for i, p in enumerate(pages):
        x[: len(p), i], there[: len(p), i] = p, True
    return x, there


@cache
def trained(pages: int = PAGES, seed: int = SEED) -> BlockLabeller:
    return BlockLabeller.fresh(seed).train([(vectors(b), y) for b, y in labelled_pages(pages, seed)])


def main_texts(htmls: list[str | None], labeller: BlockLabeller) -> list[str]:
    found = [blocks(h) for h in htmls]
    marks = labeller.labels([vectors(b) for b in found])
    # Where there is no element there is nothing but text.
    marks = [[True] * len(page) if all(b.path is None for b in page) else own for page, own in zip(found, marks, strict=True)]
    return ["\n".join(b.text for b, m in zip(page, own, strict=True) if m) for page, own in zip(found, marks, strict=True)]


def extract(pages: DataFrame, labeller: BlockLabeller | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of each page."""
    p = (labeller or trained()).p
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        release()
        labeller = BlockLabeller(p)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = main_texts(part.column(2).to_pylist(), labeller)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars long")


def query(pages: DataFrame) -> DataFrame:
    return extract(pages)
