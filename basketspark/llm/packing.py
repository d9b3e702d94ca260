"""Best-two-fit packing of tokenized documents into sequences.

Documents are tokenized where they are read; only (id, piece, length, crc) travels. Pieces are dealt by a hash of their place in the
table into groups of about ``GROUP`` pieces, so no task sees more than a group whatever the corpus holds (repeated rows spread too),
and each group is packed alone:
a bin is filled greedily with the largest piece that still fits, then its smallest piece is replaced by the two unpacked pieces
that fit the widened gap most tightly. A group loses at most its last bins against a global packing.

Edge cases: a null or empty text is one piece of its end token alone; a text is cut only if it is longer than a sequence (its
last piece may be shorter); repeated rows are packed each; a null id is carried; an empty table gives no rows. Only the two named
columns are read.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from itertools import chain, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, held, trim

LENGTH = 4096
END = 1
GROUP = 20_000
#: Words and word parts whose ids a Python worker remembers, the longest word it does so for, and the share of them that stays
#: when there is no room: the earliest learnt, which are the most frequent.
KNOWN, KNOWN_CHARS, STAYING = 300_000, 40, 0.4
#: Chunks whose normal form and parts Python finds as the tokenizer does: printable ASCII and Latin-1 letters.
PLAIN = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
#: Fixed: the tokenizer's own split of lower-case text.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\sa-z\u00df-\u00f6\u00f8-\u00ff0-9]+")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenizer(path: str) -> tuple:
    """(the tokenizer, its model alone for parts between blanks, what the model reads for each character, which ids end a part)."""
    from tokenizers import Tokenizer, pre_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    of = Tokenizer.from_file(path)
    alone = Tokenizer(of.model)
    alone.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    # Bytes that can't be printed have stand-ins from 256 up, in order.
    printed = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
    bytes_as = printed | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in printed)}
    vocabulary = of.get_vocab(with_added_tokens=True)
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
    return of, alone, {c: "".join(map(bytes_as.__getitem__, chr(c).encode())) for c in range(33, 256)}, ends


def lowered(text: str) -> str:
    """The text in lower case where that is what the tokenizer makes of it too: fewer different words have to be known."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text if "<|" in text else text.lower()


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes.

    The tokenizer drops white space and never joins tokens across it, nor across the parts of PARTS, each of which ends in a
    token marked </w>. So texts are cut at blanks and line ends, and each different part is tokenized once in a worker.
    """

    def __init__(self, path: str):
        self.of, self.alone, self.reads, self.ends = tokenizer(path)
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) + 2 * len(words) > KNOWN:
            self.known = dict(islice(self.known.items(), int(STAYING * KNOWN)))
        fresh, made, odd = set(), {}, []
        for w in words:
            if PLAIN.fullmatch(w) and "<|" not in w:
                parts = PARTS.findall(w if w.islower() else w.lower())
                if len(parts) == 1 and parts[0] == w:
                    fresh.add(w)
                else:
                    made[w] = parts
            else:
                odd.append(w)
        fresh.update(set(chain.from_iterable(made.values())).difference(self.known))
        fresh = list(fresh)
        for at in range(0, len(fresh), 4000):
            part = fresh[at : at + 4000]
            ids = np.array(self.alone.encode_batch_fast([" ".join(part).translate(self.reads)], add_special_tokens=False)[0].ids, "<u4")
            data, stops = ids.tobytes(), [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
            self.known.update((w, data[a:b]) for w, a, b in zip(part, stops[:-1], stops[1:], strict=True))
        self.known.update((w, b"".join(map(self.known.__getitem__, parts))) for w, parts in made.items())
        for at in range(0, len(odd), 1000):
            part = odd[at : at + 1000]
            self.known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(part, self.of.encode_batch_fast(part, add_special_tokens=False), strict=True))
        for w in [w for w in fresh if len(w) > KNOWN_CHARS and w not in words]:
            del self.known[w]

    def texts(self, texts: list[str]) -> list[bytes]:
        found, missing = [], set()
        for t in texts:
            words = lowered(t).replace("\n", " ").split(" ")
            ids = list(map(self.known.get, words))
            holes, at = [], -1
            try:
                while True:
                    at = ids.index(None, at + 1)
                    holes.append((at, words[at]))
            except ValueError:
                pass
            missing.update(w for _, w in holes)
            found.append((ids, holes))
        if missing:
            self.learn(missing)
            for ids, holes in found:
                for at, w in holes:
                    ids[at] = self.known[w]
            for w in missing:
                if len(w) > KNOWN_CHARS:
                    del self.known[w]
        return [b"".join(ids) for ids, _ in found]


def encoder(path: str) -> Encoder:
    return held(("packing", path), lambda: Encoder(path))


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, length: int = LENGTH) -> DataFrame:
    """(id, piece, start, length, ids_crc32): the tokenized pieces of each text, its end token included."""
    kind = docs.schema[id_col].dataType
    path = path or tokenizer_path()
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        known = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, texts = (c.to_pylist() for c in batch.slice(at, 256).columns)
                rows = []
                for i, data in zip(ids, known.texts([t or "" for t in texts]), strict=True):
                    data += end
                    for k, a in enumerate(range(0, len(data), 4 * length)):
                        part = data[a : a + 4 * length]
                        rows.append((i, k, a // 4, len(part) // 4, crc32(part)))
                turned = list(zip(*rows, strict=True))
                types = [to_arrow_type(kind), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(turned, types, strict=True)], names=[id_col, "piece", "start", "length", "ids_crc32"])
        trim()

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, piece int, start long, length long, ids_crc32 long")


def pack(lengths: list[int], size: int = LENGTH) -> list[list[int]]:
    """Bins of indexes of lengths (1 to size). Free lengths are kept as bits of a number, so that the largest that fits a gap and
    the pairs of a given sum are found by shifts."""
    free: dict[int, list[int]] = defaultdict(list)
    for i, n in enumerate(lengths):
        free[n].append(i)
    have = sum(1 << n for n in free)
    mirror = sum(1 << (size - n) for n in free)
    bins = []

    def take(n: int) -> int:
        nonlocal have, mirror
        i = free[n].pop()
        if not free[n]:
            have ^= 1 << n
            mirror ^= 1 << (size - n)
        return i

    def give(n: int, i: int) -> None:
        nonlocal have, mirror
        if not free[n]:
            have |= 1 << n
            mirror |= 1 << (size - n)
        free[n].append(i)

    while have:
        gap, held = size, []
        while fits := have & ((2 << gap) - 1):
            n = fits.bit_length() - 1
            held.append((n, take(n)))
            gap -= n
        if gap:
            least = held[-1][0]  # pieces were taken from the largest down
            # The two smallest free pieces have the least sum of all; where that is too much, no pair fits.
            small = (have & -have).bit_length() - 1
            rest = have & (have - 1)
            lowest = small + (small if len(free[small]) > 1 else (rest & -rest).bit_length() - 1 if rest else size) if have else 2 * size
            for total in range(gap + least, max(least, lowest - 1), -1):
                pairs = have & (mirror >> (size - total)) & ((2 << total // 2) - 1)  # a is free, and so is total - a
                a = pairs.bit_length() - 1
                if pairs and 2 * a == total and len(free[a]) < 2:
                    pairs ^= 1 << a
                    a = pairs.bit_length() - 1
                if pairs:
                    two = [(total - a, take(total - a)), (a, take(a))]
                    give(*held.pop())
                    held += two
                    break
        bins.append([i for _, i in held])
    return bins


def packed(found: DataFrame, id_col: str = "doc_id", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """pieces() with the sequence and the place in it of each. ``found`` must be a table or a checkpoint: rows are dealt by place."""
    out = found.schema.add("sequence_id", "long").add("offset", "long")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("length", id_col, "start", "ids_crc32")])
        sizes, base = table["length"].to_pylist(), table["part"][0].as_py() << 32
        sequence, offset = [0] * len(sizes), [0] * len(sizes)
        for k, held in enumerate(pack(sizes, length)):
            at = 0
            for i in held:
                sequence[i], offset[i] = base + k, at
                at += sizes[i]
        return table.drop_columns("part").append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    parts = max(1, -(-found.count() // group))
    dealt = found.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)))
    return dealt.groupBy("part").applyInArrow(run, out)


def query(docs: DataFrame) -> DataFrame:
    return packed(checkpointed(pieces(docs)))
