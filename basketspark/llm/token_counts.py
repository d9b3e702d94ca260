"""Token counts by byte-pair merging with a heap and a linked list, without making any token.

A piece of text (what the vocabulary's own rules never join across) starts as its list of symbols. Adjacent pairs with a merge rule
lie in a heap by rank and place; the lowest is merged again and again, neighbours linked past the symbol that went, and pairs that a
merge has broken are passed over when they come up. A piece's count is its number of symbols minus the merges; no identifiers are
emitted. A text's count is the sum over its pieces, each different piece merged once in a Python worker that remembers up to
``KNOWN`` of them. Time is n log n in a piece's length, whatever it holds.

Normal form and pieces are the tokenizer file's own: its declared normalizer and splitter are asked once for each different
white-space-free chunk (or, for vocabularies whose pieces hold blanks, for the text between line ends).

Edge cases: a null or empty text has 0 bytes and 0 tokens; special tokens' strings in a text count one token, as the library reads
them by default; repeated rows are counted each; a null id is carried; an empty table gives no rows; only the two named columns
are read, so others may have any name.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import held, map_rows

LIMIT = 2048
#: Chunks, and pieces of them, that a Python worker remembers, the longest that it does so for, and how many stay when there is no room: the earliest
#: learnt, which are the most frequent.
KNOWN, KNOWN_CHARS, STAYING = 300_000, 64, 150_000
#: Characters of a long text that are cut into chunks at a time.
BLOCK = 1 << 18
#: Fixed: ASCII white space, at which every vocabulary whose pieces hold no blanks may be cut.
CHUNK, BLANK = re.compile(r"[^ \t\n\r\x0b\x0c]+"), re.compile(r"[ \t\n\r\x0b\x0c]")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def n_merges(symbols: list[int], rules: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many merges the rules (pair: rank, merged symbol) make of the symbols, lowest rank first, leftmost among equals."""
    of = list(symbols)
    n = len(of)
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    heap = [(rules[pair][0], i) for i, pair in enumerate(zip(of, of[1:], strict=False)) if pair in rules]
    heapify(heap)
    done = 0
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        # A symbol that went has no pair any more; a pair that has changed has another rank or none.
        rule = rules.get((of[i], of[j])) if j >= 0 and of[i] >= 0 else None
        if rule is None or rule[0] != rank:
            continue
        of[i], of[j] = rule[1], -1
        after[i] = k = after[j]
        done += 1
        if k >= 0:
            before[k] = i
            if new := rules.get((of[i], of[k])):
                heappush(heap, (new[0], i))
        if (h := before[i]) >= 0 and (new := rules.get((of[h], of[i]))):
            heappush(heap, (new[0], h))
    return done


class Remembered(dict):
    """What was worked out for short keys, by key."""

    def put(self, key: str, n: int) -> int:
        if len(key) <= KNOWN_CHARS:
            if len(self) >= KNOWN:
                stay = dict(islice(self.items(), STAYING))
                self.clear()
                self.update(stay)
            self[key] = n
        return n


class Counts(Remembered):
    """Tokens by chunk; what is missing is worked out and remembered, and so are the pieces that chunks share."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        if not path.endswith(".json"):
            raise ValueError(f"{path}: only tokenizer files in JSON are read")
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        unusual = [k for k in ("dropout", "unk_token", "continuing_subword_prefix") if model.get(k)] + [k for k in ("fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if model.get("type", "BPE") != "BPE" or unusual:
            raise ValueError(f"{path}: not a plain byte-pair vocabulary {unusual}")
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in told["added_tokens"]):
            raise ValueError(f"{path}: special tokens with rules of their own")
        of = Tokenizer.from_file(path)
        self.normal = of.normalizer.normalize_str if of.normalizer else str
        self.split = of.pre_tokenizer.pre_tokenize_str
        self.vocab, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rules = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        names = sorted((t["content"] for t in told["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names)) or r"(?!)")
        self.pieces = Remembered()
        # Where blanks are no part of any piece, chunks between them can be counted one by one.
        self.by_chunk = not self.split(self.normal(" \t\n\r\x0b\x0c"))

    def piece(self, text: str) -> int:
        if (n := self.pieces.get(text)) is not None:
            return n
        marks = [*text[:-1], text[-1] + self.end]
        symbols = [s for s in map(self.vocab.get, marks) if s is not None]
        return self.pieces.put(text, len(symbols) - n_merges(symbols, self.rules))

    def __missing__(self, chunk: str) -> int:
        parts = self.special.split(chunk)
        n = len(parts) - 1 + sum(self.piece(p) for part in parts if part for p, _ in self.split(self.normal(part)))
        return self.put(chunk, n)

    def count(self, text: str) -> int:
        if not self.by_chunk:
            return self[text] if text else 0
        return sum(sum(map(self.__getitem__, CHUNK.findall(part))) for part in blocks(text))


def blocks(text: str) -> Iterator[str]:
    """The text in parts of about BLOCK characters, cut at white space."""
    at = 0
    while len(text) - at > BLOCK:
        cut = BLANK.search(text, at + BLOCK)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:] if at else text


def counts(path: str) -> Counts:
    return held(("tokens", path), lambda: Counts(path))


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row."""
    path = path or tokenizer_path()
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def row(known: Counts, i, text: str | None) -> tuple:
        n = known.count(text or "")
        return i, len((text or "").encode()), n, n > limit

    return map_rows(docs, [id_col, text_col], out, row, lambda: counts(path))


def query(docs: DataFrame) -> DataFrame:
    return counted(docs)
