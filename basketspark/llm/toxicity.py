"""Toxicity behind a noisy channel.

Writers hide words by look-alike signs, by blanks or dots between letters, and by repeating letters. A token (or a run of single
letters) that shows such noise becomes a lattice: each sign may stand for the letters it resembles, a run of a letter for one or
two of it, a separator for nothing or a word's end. Viterbi decoding under a character trigram model of all documents' words restores it.
The model's alphabet has ``ALPHABET`` letters: those that signs stand for, those of weighted words, then the corpus's most frequent.
All other letters are one symbol, so at most (ALPHABET + 2) ** 3 trigrams reach the driver whatever scripts the corpus is written in.
Tokens without noise have a lattice of one path and are taken as they are.

Words, restored ones too, and their beginnings carry weights: those that labelled toxic texts have far more often than chance
allows. The score is a logistic function of a text's largest weight, the sum of its weights (``MOST`` at most, so that long texts
don't run away) and their share, fitted on the same bounded sample (``TRAIN_ROWS`` labelled texts of up to ``TRAIN_CHARS`` characters).

Edge cases: a null or empty text has no words and gets the score of such; without labels of both kinds every text scores 0;
repeated rows and null ids are carried; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterable
from hashlib import sha256
from math import comb, exp, log

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROWS, checkpointed, fold, held, labelled_sample, map_rows, release, trim

TRAIN_ROWS, TRAIN_CHARS = 6000, 20_000
FOLDS, HELD_OUT = 5, 0
BEGINNINGS = (4, 5, 6, 7, 8)
CHANCE = 1e-5
KNOWN = 150_000
MOST = 50.0
#: Different tokens that a task counts before it cuts them into trigrams, and different trigrams before it hands them on.
WORDS = 200_000
#: Letters that the character model tells apart, and the symbol of all others.
ALPHABET, OTHER = 128, "\ufffd"

#: Letters that signs stand for.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l"}
#: Costs (log) of a sign for a letter, of each letter dropped from a run, of a separator dropped, and of one that ends a word.
SIGN, DROP, JOIN, SPLIT = 1.0, 0.2, 0.2, 4.0
TRIM = ".,;:!?\"'`()[]{}<>|*#%&$~_-+=/\\…«»“”‘’¡¿"
NOISY_SIGN = re.compile(r"(?:^|[^\W\d_])[0-9@$!|+€£]+[^\W\d_]|[^\W\d_][0-9@$!|+€£]+$")
NOISY_RUN = re.compile(r"([^\W\d_])\1\1")
NOISY_GAPS = re.compile(r"(?:\w[._*\-]){2,}\w")
#: What is trimmed before a token whose first sign may stand for a letter.
BEFORE = TRIM.translate({ord(c): None for c in LOOKS})
#: Runs of at least three single signs, one to four blanks between.
SPACED = re.compile(r"(?<!\S)[\w@$!|+](?:[ \t\u00a0]{1,4}[\w@$!|+]){2,}(?![^\s.,;:!?\"')])")


class CharModel:
    """Interpolated character trigrams of words between blanks."""

    def __init__(self, trigrams: dict[str, int]):
        self.three, self.two, self.one, self.of_two, self.of_one = trigrams, Counter(), Counter(), Counter(), Counter()
        for gram, n in trigrams.items():
            self.two[gram[1:]] += n
            self.of_two[gram[:2]] += n
            self.of_one[gram[1]] += n
            self.one[gram[2]] += n
        self.total = sum(self.one.values()) + 1
        self.letters = {" ", *self.of_one, *self.one}
        self.known: dict[str, float] = {}

    def cost(self, a: str, b: str, c: str) -> float:
        gram = a + b + c
        got = self.known.get(gram)
        if got is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            a, b, c = (x if x in self.letters else OTHER for x in gram)
            p = 0.7 * self.three.get(a + b + c, 0) / (self.of_two[a + b] or 1) + 0.24 * self.two[b + c] / (self.of_one[b] or 1) + 0.05 * self.one[c] / self.total + 1e-5
            got = self.known[gram] = -log(p)
        return got


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """(letters, cost) choices by place of a noisy token; "" is nothing and " " a word's end."""
    out, at = [], 0
    while at < len(token):
        c, run = token[at], 1
        while at + run < len(token) and token[at + run] == c:
            run += 1
        if c.isalpha():
            kept = {1, 2, run} if run > 2 else {run}
            out.append([(c * k, DROP * (run - k)) for k in sorted(kept)] if run > 2 else [(c * run, 0.0)])
        elif c in LOOKS:
            out.append([(x * k, SIGN + DROP * (run - k)) for x in LOOKS[c] for k in sorted({1, min(run, 2)})])
        else:
            out.append([("", JOIN), (" ", SPLIT)])
        at += run
    return out


def decode(token: str, model: CharModel) -> str:
    """The likeliest letters of a noisy token, words between blanks."""
    best: dict[tuple[str, str], tuple[float, tuple]] = {(" ", " "): (0.0, ())}
    for choices in [*lattice(token), [(" ", 0.0)]]:
        new: dict = {}
        for (a, b), (cost, path) in best.items():
            for letters, more in choices:
                x, y, total = a, b, cost + more
                for c in letters:
                    if not (c == " " and y == " "):
                        total += model.cost(x, y, c)
                        x, y = ("  " if c == " " else (y, c))
                if (x, y) not in new or total < new[x, y][0]:
                    new[x, y] = (total, (path, letters) if letters else path)
        best = new
    _, path = min(best.values(), key=lambda v: v[0])
    parts = []
    while path:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts)).strip()


def noisy(token: str) -> bool:
    return bool(NOISY_SIGN.search(token) or NOISY_RUN.search(token) or NOISY_GAPS.fullmatch(token))


def readings(token: str, model: CharModel | None) -> list[str]:
    """The words that a lower-case token may hold: itself, and what it is restored to."""
    bare = token.strip(TRIM)
    out = [bare] if bare else []
    start = token.lstrip(BEFORE).rstrip(TRIM)
    if model:
        out += [w for s in {bare, start} if s and noisy(s) for w in decode(s, model).split()]
    return out


def beginnings(word: str) -> list[str]:
    return [f"{word[:n]}~" for n in BEGINNINGS if len(word) > n]


def features(word: str) -> list[str]:
    return [word, *beginnings(word)]


class Scorer:
    def __init__(self, weights: dict[str, float], model: CharModel | None, fitted: tuple[float, ...]):
        self.weights, self.model, self.fitted, self.known = weights, model, fitted, {}
        self.heads = {f[:3] for f in weights}

    def fresh(self) -> Scorer:
        """The scorer without the tokens that it remembers of an earlier task."""
        self.known = {}
        return self

    def weight(self, token: str) -> float:
        """Largest weight of what a token may hold; most tokens are plain words that no weighted one begins like."""
        bare = token.strip(TRIM)
        if bare.isalpha() and len(token) == len(bare) and not NOISY_RUN.search(bare):
            words = [bare]
        else:
            words = readings(token, self.model)
        return max((self.weights.get(f, 0.0) for w in words if w[:3] in self.heads for f in features(w)), default=0.0)

    def figures(self, text: str | None) -> tuple[float, float, float]:
        low = (text or "").lower()
        tokens = set(low.split())
        if fresh := tokens.difference(self.known):
            if len(self.known) + len(fresh) > KNOWN:
                self.known, fresh = {}, tokens
            new = {t: self.weight(t) for t in fresh}
            self.known.update((t, w) for t, w in new.items() if len(t) <= 40)
            got = [w for w in map(self.known.get, tokens.difference(fresh)) if w] if len(fresh) < len(tokens) else []
            got += [w for w in new.values() if w]
        else:
            got = [w for w in map(self.known.__getitem__, tokens) if w]
        if self.model:
            for run in set(SPACED.findall(low)):
                words = [w for w in decode(run, self.model).split() if len(w) > 1]
                got += [w for w in (max((self.weights.get(f, 0.0) for f in features(x)), default=0.0) for x in words) if w]
        return max(got, default=0.0), min(sum(sorted(got)), MOST) / 5, 10 * len(got) / max(10, len(tokens))

    def score(self, text: str | None) -> float:
        b, *w = self.fitted
        z = b + sum(x * y for x, y in zip(w, self.figures(text), strict=True))
        return 1 / (1 + exp(-max(-30.0, min(30.0, z))))


def _chance(k: int, n: int, share: float) -> float:
    """How likely k or more of n texts are toxic by chance."""
    return sum(comb(n, i) * share**i * (1 - share) ** (n - i) for i in range(k, n + 1)) if n < 60 else exp(-n * _divergence(k / n, share)) if k / n > share else 1.0


def _divergence(p: float, q: float) -> float:
    return p * log(p / q) + ((1 - p) * log((1 - p) / (1 - q)) if p < 1 else 0)


def _grams(batches):
    """Trigrams of the words of letters in a task's texts; a word is cut once for all of its places in ``WORDS`` different ones."""
    import pyarrow as pa

    release()
    words, grams = Counter(), Counter()

    def cut() -> None:
        for token, n in words.items():
            if (w := token.strip(TRIM)).isalpha():
                w = f"  {w} "
                for i in range(len(w) - 2):
                    grams[w[i : i + 3]] += n
        words.clear()

    def handed():
        found = list(grams.items())
        grams.clear()
        for at in range(0, len(found), 10_000):
            part = found[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in part], pa.string()), pa.array([n for _, n in part], pa.int64())], names=["gram", "n"])

    for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
        for text in batch.column(0).to_pylist():
            words.update((text or "").lower().split())
            if len(words) > WORDS:
                cut()
            if len(grams) > WORDS:
                yield from handed()
    cut()
    yield from handed()
    del words, grams
    trim()


def trigrams(docs: DataFrame, text_col: str = "text", first: Iterable[str] = ()) -> tuple[tuple[str, int], ...]:
    """(trigram, count) over all words of letters of all documents, two blanks before and one after each.

    Trigrams are counted in full in Spark; letters out of the alphabet are then one symbol. ``first`` are letters that come into the
    alphabet after those of LOOKS and before the corpus's most frequent (ties by code point)."""
    grams = checkpointed(docs.select(text_col).mapInArrow(_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    chosen = list(dict.fromkeys([*"".join(LOOKS.values()), *first]))[:ALPHABET]
    seen = grams.groupBy(F.substring("gram", 2, 1).alias("letter")).agg(F.sum("n").alias("n")).filter(~F.col("letter").isin(" ", *chosen))
    chosen += [r.letter for r in seen.orderBy(F.desc("n"), "letter").limit(ALPHABET - len(chosen)).collect()]
    at = [F.substring("gram", k, 1) for k in (1, 2, 3)]
    gram = F.concat(*(F.when(c.isin(" ", *chosen), c).otherwise(OTHER) for c in at))
    return tuple(sorted(map(tuple, grams.groupBy(gram.alias("gram")).agg(F.sum("n").alias("n")).collect())))


def fitted(rows: list[tuple[str, int]]) -> tuple[dict, tuple]:
    """(weights of words and beginnings, the logistic's figures) from (text, label)."""
    if len({int(y) for _, y in rows}) < 2:
        return {}, (-30.0, 0.0, 0.0, 0.0)
    own: dict[str, str] = {}  # one copy of each word
    bare = [(tuple({own.setdefault(x, x) for x in (t.strip(TRIM) for t in text.lower().split()) if x}), int(y)) for text, y in rows]
    n = [sum(y == k for _, y in bare) for k in (0, 1)]
    share = n[1] / len(bare)
    weights: dict[str, float] = {}
    for of in (lambda w: [w], beginnings):  # a beginning must tell without the words that tell by themselves
        toxic, clean = Counter(), Counter()
        for known, y in bare:
            if y:
                toxic.update({f for w in known if w not in weights for f in of(w)})
        toxic = {f: k for f, k in toxic.items() if k >= 3}
        for known, y in bare:
            if not y:
                clean.update({f for w in known if w not in weights for f in of(w) if f in toxic})
        chosen = {}
        for f, k in toxic.items():
            c = clean[f]
            if k / n[1] > 3 * c / n[0] and _chance(k, k + c, share) <= CHANCE:
                chosen[f] = log((k + 0.5) / (n[1] + 1)) - log((c + 0.5) / (n[0] + 1))
        weights |= chosen
    plain = Scorer(weights, None, (0.0, 0.0, 0.0, 0.0))
    x = np.array([(1.0, *plain.figures(t)) for t, _ in rows])
    y = np.array([y for _, y in rows], float)
    balance = np.where(y == 1, 0.5 / max(1, n[1]), 0.5 / max(1, n[0])) * len(y)
    b, keep = np.zeros(4), np.diag([1e-3, 0.1, 0.1, 0.1])
    for _ in range(50):  # Newton's steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-x @ b))
        h = (x * (balance * p * (1 - p) + 1e-9)[:, None]).T @ x + keep
        b = b + np.clip(np.linalg.solve(h, x.T @ (balance * (y - p)) - keep @ b), -2, 2)
    return weights, tuple(map(float, b))


def _packed(learnt: tuple) -> tuple[str, bytes]:
    """What fit() returns, as bytes for the tasks, and a name for it."""
    data = zlib.compress(pickle.dumps(learnt))
    return sha256(data).hexdigest(), data


def _scorer(name: str, data: bytes) -> Scorer:
    def made() -> Scorer:
        weights, grams, figures = pickle.loads(zlib.decompress(data))
        return Scorer(dict(weights), CharModel(dict(grams)), figures)

    return held(("toxicity", name), made).fresh()


def fit(docs: DataFrame, labels: DataFrame) -> tuple:
    """A learnt scorer as plain tuples: weights of the labelled sample, the whole corpus's trigrams, the logistic's figures."""
    learn = labels.filter(F.col("toxic").isin(0, 1) & (fold("doc_id", FOLDS) != HELD_OUT))
    weights, figures = fitted(labelled_sample(docs, learn, "toxic", TRAIN_ROWS, TRAIN_CHARS))
    often = Counter(c for f in weights for c in set(f) if c.isalpha())
    first = sorted(often, key=lambda c: (-often[c], c))
    return tuple(sorted(weights.items())), trigrams(docs, first=first) if weights else (), figures


def score(docs: DataFrame, learnt: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each text."""
    kind, packed = docs.schema[id_col].dataType.simpleString(), _packed(learnt)
    return map_rows(docs, [id_col, text_col], f"`{id_col}` {kind}, score double", lambda scorer, i, t: (i, scorer.score(t)), lambda: _scorer(*packed))


def kept(docs: DataFrame, learnt: tuple, text_col: str = "text") -> DataFrame:
    """The rows whose text scores below one half."""
    packed = _packed(learnt)

    def run(batches):
        import pyarrow as pa

        scorer = _scorer(*packed)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array([scorer.score(t) < 0.5 for t in texts], pa.bool_()))
        trim()

    return docs.mapInArrow(run, docs.schema)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return score(docs, fit(docs, labels)).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
