"""Quality rules by line sequence labelling.

Every line with a word is described by a few figures; a linear-chain conditional random field, decoded by Viterbi, marks each as
content or boilerplate; a text is retained if content lines hold at least ``SHARE`` of its characters and the fixed limits are
met. The field is trained by gradient ascent on a bounded sample (``TRAIN_ROWS`` texts of up to ``TRAIN_CHARS`` characters, in runs
of ``TRAIN_LINES`` lines). Its texts have labels, its lines don't, so lines get theirs in rounds: those of good texts are content;
those of low texts begin as boilerplate, and in each round the ones that a logistic model of single lines takes for content become
content, the likeliest first, up to half of a text's characters. Then each good text gets the boilerplate of a low one put between its lines, and the whole field
learns from these mixtures and the texts themselves how labels follow each other.

Edge cases: a null text has no words and fails; a text without lines has no content; repeated rows and null ids are carried; an
empty table gives no rows; without labels of both kinds every line counts as content. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from random import Random

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, map_rows

SHARE = 0.5
MIN_WORDS, REPEATED_PERCENT = 50, 50
TRAIN_ROWS, TRAIN_CHARS, TRAIN_LINES = 2000, 20_000, 24
LABEL_ROUNDS, SEED = 3, 7
BLANKS, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
N_FEATURES = 12

#: Classes of UTF-8 bytes: capitals, digits, symbols, end marks.
_CLASS = np.zeros((4, 256), np.uint8)
_CLASS[0, 65:91] = _CLASS[1, 48:58] = 1
_CLASS[2, [ord(c) for c in SYMBOLS]] = _CLASS[3, [ord(c) for c in "!?"]] = 1


def base_rules(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed)."""
    text = text or ""
    data = text.encode()
    words = data.split()
    n = len(words)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(BLANKS):
            seen.add(line)
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            often = {w for w, k in Counter(windows).items() if k > 1}
            end = 0
            for i, w in enumerate(windows):
                if w in often:
                    repeated += i + 3 - max(i, end)
                    end = i + 3
    chars = len(text) - sum(map(text.count, BLANKS))
    return n, chars, sum(map(text.count, SYMBOLS)), dup, repeated, n < MIN_WORDS or 100 * repeated > REPEATED_PERCENT * n


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(figures of each line with a word, its characters)."""
    lines = [x for x in (text or "").split("\n") if x.strip(BLANKS)]
    if not lines:
        return np.zeros((0, N_FEATURES), np.float32), np.zeros(0)
    data = [x.encode() for x in lines]
    size = np.array([len(x) for x in data])
    every = np.frombuffer(b"".join(data), np.uint8)
    at = np.concatenate([[0], np.cumsum(size)[:-1]])
    share = np.stack([np.add.reduceat(c[every], at, dtype=np.int64) for c in _CLASS], 1) / size[:, None]
    out, count = np.zeros((len(lines), N_FEATURES), np.float32), Counter(lines) if len(lines) > 1 else {}
    for i, x in enumerate(data):
        words = x.split()
        n = len(words)
        out[i, 5:10] = n, len(set(words)) / n, sum(map(bytes.__eq__, words, words[1:])) / n, size[i] / n, words.count(b"|") / n
        out[i, 10] = bool(count) and count[lines[i]] > 1
    out[:, 0] = 1
    out[:, 1:5] = share
    out[:, 11] = out[:, 5] < 4
    out[:, 5] = np.log1p(out[:, 5]) / 5
    out[:, 8] = np.minimum(out[:, 8], 40) / 10
    return out, np.array([len(x) for x in lines], float)


class LineField:
    """Linear-chain conditional random field of two labels (0 boilerplate, 1 content)."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    @classmethod
    def trained(cls, samples: Iterable[tuple[np.ndarray, np.ndarray]], rounds: int = 200, rate: float = 0.15, decay: float = 1e-5) -> LineField:
        """Adam on the conditional log-likelihood of (figures, labels) of runs of lines."""
        samples = [(x, np.asarray(y)) for x, y in samples if len(x)]
        if len({k for _, y in samples for k in y.tolist()}) < 2:
            return cls(np.array([[0.0] * N_FEATURES, [1.0] + [0.0] * (N_FEATURES - 1)]), np.zeros((2, 2)))
        batch = _batch(samples)
        known = told(*batch)
        p = np.zeros(2 * N_FEATURES + 4)
        m, v = np.zeros_like(p), np.zeros_like(p)
        for t in range(1, rounds + 1):
            g = likelihood(p, *batch, known)[1] - decay * p
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            p = p + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return cls(p[:-4].reshape(2, -1), p[-4:].reshape(2, 2))

    def labels(self, x: np.ndarray) -> np.ndarray:
        """The likeliest labels of a text's lines."""
        score, move = (x @ self.emit.T).tolist(), self.move.tolist()
        if not score:
            return np.zeros(0, int)
        (a, b), back = score[0], []
        for s0, s1 in score[1:]:
            aa, ba, ab, bb = a + move[0][0], b + move[1][0], a + move[0][1], b + move[1][1]
            back.append((ba > aa, bb >= ab))
            a, b = s0 + max(aa, ba), s1 + max(ab, bb)
        out = [int(b >= a)]
        for k in reversed(back):
            out.append(int(k[out[-1]]))
        return np.array(out[::-1])


def _batch(samples: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(figures, whether a line is there, gold labels one-hot, weight of a run) of runs beside each other.

    A run weighs as its lines do on average; both labels have equal weight."""
    longest = max(len(x) for x, _ in samples)
    x, there, gold = np.zeros((len(samples), longest, N_FEATURES)), np.zeros((len(samples), longest)), np.zeros((len(samples), longest, 2))
    for i, (f, y) in enumerate(samples):
        x[i, : len(f)], there[i, : len(f)] = f, 1
        gold[i, np.arange(len(f)), y] = 1
    each = 0.5 / np.maximum(1, gold.sum((0, 1)))
    return x, there, gold, (gold @ each).sum(1) / there.sum(1)


def told(x: np.ndarray, there: np.ndarray, gold: np.ndarray, weigh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the gold labels say of figures and of moves, which no parameter changes."""
    by_line = (gold * weigh[:, None, None]).reshape(-1, 2)
    steps = np.stack([[(gold[:, :-1, a] * gold[:, 1:, b]).sum(1) @ weigh for b in (0, 1)] for a in (0, 1)])
    return by_line.T @ x.reshape(len(by_line), -1), steps


def likelihood(p: np.ndarray, x: np.ndarray, there: np.ndarray, gold: np.ndarray, weigh: np.ndarray, known: tuple | None = None) -> tuple[float, np.ndarray]:
    """Weighted log-likelihood of the gold labels and its gradient, by the forward-backward sums. p: emissions, then moves; known: what
    told() returns. The sums are kept as shares; ``scale`` is what a place multiplies them by."""
    emit, move, longest = p[:-4].reshape(2, -1), p[-4:].reshape(2, 2), x.shape[1]
    figures, steps = known or told(x, there, gold, weigh)
    score = (emit @ x.reshape(-1, x.shape[2]).T).reshape(2, len(x), longest).transpose(2, 0, 1)  # by place, label and run
    most, here = np.maximum(score[:, 0], score[:, 1]), there.T > 0
    e, step = np.exp(score - most[:, None]), np.exp(move - move.max())
    alpha, scale, beta = np.empty_like(e), np.ones((longest, len(x))), np.ones_like(e)
    for k in range(longest):
        new = e[k] if not k else (step.T @ alpha[k - 1]) * e[k]
        total = new[0] + new[1]
        scale[k] = np.where(here[k], total, 1)
        alpha[k] = np.where(here[k], new / total, alpha[k - 1] if k else new)
    for k in range(longest - 2, -1, -1):
        beta[k] = np.where(here[k + 1], step @ (e[k + 1] * beta[k + 1]) / scale[k + 1], 1)
    after = e[1:] * beta[1:] * (here[1:] * weigh / scale[1:])[:, None]
    both = step * np.array([[np.vdot(alpha[:-1, a], after[:, b]) for b in (0, 1)] for a in (0, 1)])
    one = (alpha * beta * (here * weigh)[:, None]).transpose(1, 2, 0).reshape(2, -1)
    total = (np.log(scale) + np.where(here, most, 0)).sum(0) @ weigh + move.max() * (here[1:].sum(0) @ weigh)
    value = (emit * figures).sum() + (move * steps).sum() - total
    return float(value), np.concatenate([(figures - one @ x.reshape(-1, x.shape[2])).ravel(), (steps - both).ravel()])


def content_share(field: LineField, text: str | None) -> float:
    x, chars = features(text)
    return float((field.labels(x) * chars).sum() / chars.sum()) if len(x) else 0.0


def _lines(text: str) -> list[str]:
    return [x for x in text.split("\n") if x.strip(BLANKS)]


def _line_model(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression of single lines, both labels of equal weight."""
    w, n = np.zeros(x.shape[1]), max(1, len(y))
    weigh = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * n
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weigh * p * (1 - p))[:, None]).T @ x / n + ridge * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(h, x.T @ (weigh * (y - p)) / n - ridge * w), -2, 2)
    return w


def line_labels(sample: list[tuple[str, int]]) -> list[np.ndarray]:
    """A label for each line of (text, quality label), in rounds as above."""
    figures = [features(t) for t, _ in sample]
    out = [np.full(len(x), y) for (x, _), (_, y) in zip(figures, sample, strict=True)]
    if not any(map(len, out)):
        return out
    every = np.concatenate([x for x, _ in figures]).astype(float)
    for _ in range(LABEL_ROUNDS):
        w = _line_model(every, np.concatenate(out))
        for i, ((x, chars), (_, good)) in enumerate(zip(figures, sample, strict=True)):
            if not good and len(x):
                lead = x @ w
                order = np.argsort(-lead, kind="stable")
                out[i] = np.zeros(len(x), int)
                out[i][order] = (lead[order] > 0) & (2 * np.cumsum(chars[order]) <= chars.sum())
    return out


def mixtures(sample: list[tuple[str, int]], of: list[np.ndarray], seed: int = SEED) -> list[tuple[str, np.ndarray]]:
    """Each good text with the boilerplate lines of a low one between, before or after its lines, and the labels of its lines."""
    r, out = Random(seed), []
    low = [[x for x, k in zip(_lines(t), y, strict=True) if not k] for (t, good), y in zip(sample, of, strict=True) if not good]
    low = [x for x in low if x]
    for text, good in sample:
        lines = _lines(text)
        if good and lines and low:
            more, at = r.choice(low), r.randint(0, len(lines))
            out.append(("\n".join([*lines[:at], *more, *lines[at:]]), np.array([1] * at + [0] * len(more) + [1] * (len(lines) - at))))
    return out


def learn(sample: list[tuple[str, int]]) -> LineField:
    """A field from (text, quality label)."""
    of = line_labels(sample)
    every = [(t, y) for (t, _), y in zip(sample, of, strict=True)] + mixtures(sample, of)
    return LineField.trained((x[a : a + TRAIN_LINES], y[a : a + TRAIN_LINES]) for t, y in every for x in [features(t)[0]] for a in range(0, len(x), TRAIN_LINES))


def fit(docs: DataFrame, labels: DataFrame) -> LineField:
    return learn(labelled_sample(docs, labels.filter(F.col("quality").isin(0, 1)), "quality", TRAIN_ROWS, TRAIN_CHARS))


def judge(docs: DataFrame, field: LineField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base figures, the share of content and the verdict for each text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def one(_, i, text):
        *base, failed = base_rules(text)
        share = content_share(field, text)
        return (i, *base, failed, share, not failed and share >= SHARE)

    return map_rows(docs, [id_col, text_col], f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean", one)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, fit(docs, labels))
