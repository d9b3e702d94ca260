"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed greedily against it: each phrase is the longest
match that starts where the last one ended. The phrases needed, times the logarithm of the labelled text's length and divided by
the characters, estimate the cross entropy; the language with the least wins. The score is one minus its share of the
runner-up's.

The labelled text is a bounded sample: about ``TRAIN_DOCS`` documents of a language, at most ``DOC_CHARS`` characters of each and
``TRAIN_CHARS`` of all (``ALL_CHARS`` of all languages, which bounds the automata to some 250 MB), of the ``MOST_LANGS`` languages
that most documents have (dirty values have few). Every letter is a symbol of
its own: those that most often occur have a column in a table of states, others are looked up by state.

Whole texts are parsed, in pieces of ``PIECE`` characters side by side, each as if a phrase began with it. Then each piece is gone
through again from the state in which the one before it ended, until a phrase begins at the same place in both parses; from there
on they are the same, so the phrases are those of the whole text. Pieces without such a place, as in long runs of one letter, are gone
through once more, one after the other.

Edge cases: ``und`` with score 0 if a text is null or has no letter, or nothing could be learnt; equal figures go to the first
language by name; a document without id or language is not learnt from; repeated rows and null ids are carried; an empty table
gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, fold, held

TRAIN_DOCS, TRAIN_CHARS, ALL_CHARS, DOC_CHARS, MOST_LANGS = 80, 30_000, 600_000, 20_000, 200
FOLDS, HELD_OUT = 4, 2
PIECE, SIDE_BY_SIDE = 1024, 4096
#: Letters that have a column of their own in the table of states.
COLUMNS = 64


def symbols(text: str) -> np.ndarray:
    """Lower-case letters as code points; each run of anything else as one blank."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    points = np.where(_letters()[points], points, 32)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    return points[keep]


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions by state; state 0 is the root, and every substring of the text can be walked from it."""
    moves, link, length, last = [{}], [-1], [0], 0
    for c in text:
        now = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = now
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    return moves


class CrossParser:
    """Parses texts against all languages' automata.

    A table holds for each state and frequent letter where the parse goes on; sorted keys of state and letter do so for the others.
    Entries that start a new phrase are negative. States are kept times the table's width, from the second row on, so that signs
    tell.
    """

    def __init__(self, learnt: dict[str, str]):
        self.names = sorted(learnt)
        texts = [symbols(learnt[n]) for n in self.names]
        alphabet, often = np.unique(np.concatenate(texts), return_counts=True)
        alphabet = alphabet[np.argsort(-often, kind="stable")]
        self.of = np.zeros(0x110000, np.uint16 if len(alphabet) < 65_000 else np.uint32)  # 0: no language has it
        self.of[alphabet] = np.arange(1, len(alphabet) + 1)
        self.size = len(alphabet) + 1
        self.width = min(self.size, COLUMNS + 1)
        tables, rare, self.roots, first = [np.zeros((1, self.width), np.int32)], [], [], 1
        for text in texts:
            moves = suffix_automaton(self.of[text].tolist())
            root = np.full(self.width, -first * self.width, np.int64)
            for c, s in moves[0].items():
                if c < self.width:
                    root[c] = -(first + s) * self.width
            table = np.tile(root, (len(moves), 1))
            for i, m in enumerate(moves):
                for c, s in m.items():
                    if c >= self.width:
                        rare.append(((first + i) * self.size + c, (first + s) * self.width))
                    elif i:
                        table[i, c] = (first + s) * self.width
            tables.append(table.astype(np.int32))
            self.roots.append(first * self.width)
            first += len(moves)
        rare = np.array(sorted(rare), np.int64).reshape(-1, 2)
        self.keys, self.goes = np.append(rare[:, 0], np.iinfo(np.int64).max), np.append(rare[:, 1], 0).astype(np.int32)
        self.table = np.concatenate(tables).ravel()
        self.table_view, self.key_view = memoryview(self.table), memoryview(self.keys)
        self.weight = np.array([np.log2(max(2, len(t))) for t in texts])

    def _find(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Where rare letters go from states; 0 for nowhere."""
        keys = states.astype(np.int64) // self.width * self.size + letters
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.goes[at], 0)

    def _go(self, states: np.ndarray, letters: np.ndarray, any_rare: bool, root: int) -> np.ndarray:
        if not any_rare:
            return self.table[states + letters]
        rare = np.flatnonzero(letters >= self.width)
        go = self.table[states + np.where(letters < self.width, letters, 0)]
        there = self._find(states[rare], letters[rare])
        anew = self._find(np.full(len(rare), root, np.int64), letters[rare])
        go[rare] = np.where((there > 0) & (states[rare] != root), there, -np.where(anew > 0, anew, root))
        return go

    def _one(self, state: int, letter: int, root: int) -> int:
        """``_go`` of one rare letter."""
        for of in (state, root):
            key = of // self.width * self.size + letter
            at = bisect_left(self.key_view, key)
            if self.key_view[at] == key:
                return int(self.goes[at]) if of != root else -int(self.goes[at])
        return -root

    def _again(self, letters: list[int], old: list[bool], state: int, root: int) -> tuple[list[bool], int, int | None]:
        """A piece from a state on, up to a phrase that the old parse has too: where phrases begin so far, how many more they are,
        and the last state if there was no such phrase."""
        table, width, new = self.table_view, self.width, []
        for c, was in zip(letters, old, strict=True):
            state = table[state + c] if c < width else self._one(state, c, root)
            new.append(state < 0)
            if state < 0:
                state = -state
                if was:
                    break
        else:
            return new, sum(new) - sum(old), state
        return new, sum(new) - sum(old[: len(new)]), None

    def _parsed(self, side: np.ndarray, active: np.ndarray, owner: np.ndarray, place: np.ndarray, follows: np.ndarray, root: int, n: int) -> np.ndarray:
        """Phrases of each text. side: letters of pieces in columns, ``active`` of them at each place; ``place``: of a piece in its
        text; ``follows``: the column of the piece before a piece, or -1."""
        longest, pieces = side.shape
        rare = side.max(1) >= self.width
        begins, state, ends = np.zeros(side.shape, bool), np.full(pieces, root, np.int32), np.zeros(pieces, np.int32)
        for t in range(longest):
            k = active[t]
            go = self._go(state[:k], side[t, :k], rare[t], root)
            begins[t, :k] = go < 0
            np.abs(go, out=state[:k])
        phrases, ends = begins.sum(0), state
        begun = np.where(follows >= 0, ends[follows], -1).astype(np.int32)  # the state in which each piece has to begin
        at = np.flatnonzero(begun >= 0)
        state, change, t = begun[at], np.zeros(pieces, np.int64), 0
        while len(at):
            stay = active[t] > at if t < longest else np.zeros(len(at), bool)
            if not stay.all():  # to a piece's end without a common phrase: the next piece has to begin in another state
                ends[at[~stay]] = state[~stay]
                at, state = at[stay], state[stay]
                if not len(at):
                    break
            go = self._go(state, side[t, at], rare[t], root)
            new, old = go < 0, begins[t, at]
            change[at] += new.astype(np.int64) - old
            begins[t, at] = new
            state = np.abs(go)
            differ = ~(new & old)
            at, state, t = at[differ], state[differ], t + 1
        after = np.full(pieces, -1)
        after[follows[follows >= 0]] = np.flatnonzero(follows >= 0)
        todo = np.flatnonzero((follows >= 0) & (ends[follows] != begun))
        for k in todo[np.argsort(place[todo], kind="stable")].tolist():  # runs: one piece after the other, each once
            while k >= 0 and ends[follows[k]] != begun[k]:
                begun[k] = ends[follows[k]]
                size = int(np.searchsorted(-active, -k, side="left"))
                marks, more, end = self._again(side[:size, k].tolist(), begins[:size, k].tolist(), int(begun[k]), root)
                begins[: len(marks), k] = marks
                change[k] += more
                ends[k] = ends[k] if end is None else end
                k = int(after[k])
        phrases = phrases + change
        count = np.zeros(n, np.int64)
        np.add.at(count, owner, phrases)
        return count

    def figures(self, texts: list[str]) -> np.ndarray:
        """Phrases by text and language, times the language's weight, for each symbol."""
        every = [self.of[symbols(t)] for t in texts]
        count = np.zeros((len(texts), len(self.names)), np.int64)
        first = 0
        while first < len(texts):  # texts side by side, all pieces of a text together
            last, pieces = first, 0
            while last < len(texts) and (last == first or pieces + -(-len(every[last]) // PIECE) <= SIDE_BY_SIDE):
                pieces += -(-len(every[last]) // PIECE)
                last += 1
            cut = [(i - first, k, every[i][a : a + PIECE]) for i in range(first, last) for k, a in enumerate(range(0, len(every[i]), PIECE))]
            order = sorted(range(len(cut)), key=lambda i: -len(cut[i][2]))
            column = {cut[i][:2]: c for c, i in enumerate(order)}
            sizes = np.array([len(cut[i][2]) for i in order])
            side = np.zeros((int(sizes[0]), len(order)), self.of.dtype)
            for c, i in enumerate(order):
                side[: len(cut[i][2]), c] = cut[i][2]
            active = np.searchsorted(-sizes, -np.arange(len(side)), side="left")
            owner, place = (np.array([cut[i][k] for i in order]) for k in (0, 1))
            follows = np.array([column.get((cut[i][0], cut[i][1] - 1), -1) for i in order])
            for lang, root in enumerate(self.roots):
                count[first:last, lang] = self._parsed(side, active, owner, place, follows, root, last - first)
            first = last
        return count * self.weight / np.maximum(1, [len(s) for s in every])[:, None]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [("und", 0.0)] * len(texts)
        can = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if can and self.names:
            for i, row in zip(can, self.figures([texts[i] for i in can]), strict=True):
                best = int(row.argmin())
                rest = np.delete(row, best)
                out[i] = self.names[best], float(1 - row[best] / rest.min()) if len(rest) and rest.min() > 0 else 1.0
        return out


def _parser(learnt: tuple) -> CrossParser:
    return held(("languages", crc32(repr(learnt).encode())), lambda: CrossParser(dict(learnt)))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[tuple[str, str], ...]:
    """(language, labelled text) from the bounded sample of the folds that are learnt from."""
    rows = docs.filter(F.col(lang_col).isNotNull() & (fold(id_col, FOLDS) != HELD_OUT)).select(F.col(lang_col).alias("lang"), F.pmod(F.xxhash64(id_col, F.lit(5)), F.lit(1 << 20)).alias("at"), F.substring(text_col, 1, DOC_CHARS).alias("text"))
    langs = checkpointed(rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGS))
    below = F.least(F.lit(1 << 20), 1 + F.floor(F.lit(float(1 << 20)) * TRAIN_DOCS / F.col("n")))
    sample = rows.join(F.broadcast(langs), "lang").filter(F.col("at") < below).select("lang", "at", "text").collect()
    texts: dict[str, str] = {}
    most = min(TRAIN_CHARS, ALL_CHARS // max(1, len({lang for lang, *_ in sample})))
    for lang, _, text in sorted((lang, at, text or "") for lang, at, text in sample):
        if len(texts.get(lang, "")) < most:
            texts[lang] = f"{texts.get(lang, '')}{text}\n"[:most]
    return tuple(sorted((lang, t) for lang, t in texts.items() if any(map(str.isalpha, t))))


def identify(docs: DataFrame, learnt: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for each text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        parser = _parser(learnt) if learnt else None
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                found = parser.predict(part.column(1).to_pylist()) if parser else [("und", 0.0)] * part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())], names=[id_col, "lang_pred", "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def query(docs: DataFrame) -> DataFrame:
    held = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return identify(docs, learn(docs)).select("doc_id", held.alias("held_out"), "lang_pred", "score")
