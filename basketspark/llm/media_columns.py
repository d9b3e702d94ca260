"""Media columns: payloads as PNG files in binary columns, and perceptual hashes of what is read back.

A payload is stored as an 8-bit RGB image of 64 pixels a row: signature, header, zlib data chunks and end chunk, each with its
checksum; every row has the filter whose differences are least in sum. Reading tests the signature and every chunk's checksum,
inflates the data, undoes the row filters with numpy, and returns the samples. A filtered pixel hangs on those left of it and above
it, so the pixels of a diagonal are undone at once, of all images of a group together (``GROUP`` bytes, one image at least). The feature is a 64-bit hash: luma averaged to 32 x 32, its cosine transform's 8 x 8 lowest frequencies,
each bit telling whether one is above their median.

Edge cases: a null or empty text is one row of blanks; any payload length is padded to whole rows; equal payloads give equal
files, hashes and features; a broken file raises ValueError; repeated rows and null ids are carried; an empty table gives no
rows. Only the two named columns are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ROWS, release

#: Fixed values of the format: signature, colour type of RGB and its bytes a pixel.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
RGB, PIXEL = 2, 3
WIDTH = 64
ROW = WIDTH * PIXEL
CHUNK = 1 << 20
LEVEL = 4
GROUP = 1 << 21


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def _paeth(left: np.ndarray, up: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """Whichever of the three is nearest to left + up - corner, in that order."""
    a, b = np.abs(up - corner), np.abs(left - corner)
    c = np.abs(left + up - 2 * corner)
    return np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))


def _firsts(heights: list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(heights)[:-1]]).astype(np.int64)


def filtered(raw: np.ndarray, heights: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(filter, filtered samples) of each row of images below each other: the filter of the least sum of signed differences."""
    now = raw.astype(np.int16)
    left, up, corner = np.zeros_like(now), np.zeros_like(now), np.zeros_like(now)
    left[:, PIXEL:] = now[:, :-PIXEL]
    up[1:] = now[:-1]
    up[_firsts(heights)] = 0
    corner[:, PIXEL:] = up[:, :-PIXEL]
    out, kinds, least = raw.copy(), np.zeros(len(raw), np.uint8), np.abs(raw.view(np.int8).astype(np.int16)).sum(1, dtype=np.int32)
    for kind, guess in enumerate((left, up, (left + up) >> 1, _paeth(left, up, corner)), 1):
        turned = (now - guess).astype(np.uint8)
        total = np.abs(turned.view(np.int8).astype(np.int16)).sum(1, dtype=np.int32)
        better = total < least
        out[better], kinds[better], least[better] = turned[better], kind, total[better]
    return kinds, out


def encode_all(payloads: list[bytes], filters: str = "least") -> list[bytes]:
    """PNG files of payloads (positive multiples of ROW bytes). filters: "least", or "none"."""
    heights = [len(p) // ROW for p in payloads]
    raw = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, ROW)
    lines = np.zeros((len(raw), ROW + 1), np.uint8)
    if filters == "least":
        lines[:, 0], lines[:, 1:] = filtered(raw, heights)
    else:
        lines[:, 1:] = raw
    out = []
    for a, n in zip(_firsts(heights).tolist(), heights, strict=True):
        data = zlib.compress(lines[a : a + n].tobytes(), LEVEL)
        parts = [_chunk(b"IDAT", data[k : k + CHUNK]) for k in range(0, len(data), CHUNK)]
        out.append(b"".join([SIGNATURE, _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, n, 8, RGB, 0, 0, 0)), *parts, _chunk(b"IEND", b"")]))
    return out


def encode(payload: bytes, filters: str = "least") -> bytes:
    return encode_all([payload], filters)[0]


def unfilter(kinds: np.ndarray, lines: np.ndarray, pixel: int, heights: list[int] | None = None) -> np.ndarray:
    """Samples of the filtered rows of images below each other, of one width.

    Pixel x of an image's row r is undone in step x + r, when those left, above and in the corner are known.
    """
    if kinds.size and kinds.max() > 4:
        raise ValueError(f"row filter {kinds.max()}")
    if not kinds.any():
        return lines
    heights = [len(lines)] if heights is None else heights
    width = lines.shape[1] // pixel
    row = np.arange(len(lines)) - np.repeat(_firsts(heights), heights)
    order = np.argsort(row, kind="stable")  # rows of one step are neighbours
    row, kind, held = row[order], kinds[order][:, None], lines.reshape(len(lines), width, pixel)[order].astype(np.int16)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    above = np.where(row > 0, place[order - 1], len(order))
    now, corner = np.zeros((len(order) + 1, pixel), np.int16), np.zeros((len(order), pixel), np.int16)
    begins = np.searchsorted(row, np.arange(row[-1] + width + 1))
    for t in range(int(row[-1]) + width):
        a, b = begins[max(0, t - width + 1)], begins[t + 1]
        which, x = np.arange(a, b), t - row[a:b]
        left, up, last, k = now[a:b], now[above[a:b]], corner[a:b], kind[a:b]
        guess = np.where(k == 1, left, np.where(k == 2, up, np.where(k == 3, (left + up) >> 1, np.where(k == 4, _paeth(left, up, last), 0))))
        done = (held[which, x] + guess) & 255
        held[which, x] = done
        now[a:b], corner[a:b] = done, up
    out = np.empty(held.shape, np.uint8)
    out[order] = held
    return out.reshape(len(lines), -1)


def _opened(file: bytes) -> tuple[int, int, np.ndarray]:
    """(width, bytes a pixel, rows with their filters) of a non-interlaced 8-bit PNG file."""
    if file[:8] != SIGNATURE:
        raise ValueError("not a PNG file")
    at, head, data, ended = 8, None, [], False
    while at < len(file) and not ended:
        if at + 12 > len(file):
            raise ValueError("a chunk is cut off")
        (n,), kind = struct.unpack_from(">I", file, at), file[at + 4 : at + 8]
        body = file[at + 8 : at + 8 + n]
        if len(body) != n or zlib.crc32(body, zlib.crc32(kind)) != struct.unpack(">I", file[at + 8 + n : at + 12 + n].rjust(4, b"\0"))[0]:
            raise ValueError(f"checksum of {kind!r}")
        head, ended, at = body if kind == b"IHDR" else head, kind == b"IEND", at + 12 + n
        if kind == b"IDAT":
            data.append(body)
    if not ended or head is None:
        raise ValueError("a chunk is missing")
    width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", head)
    pixel = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if depth != 8 or interlaced or pixel is None:
        raise ValueError("only plain 8-bit images")
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    if lines.size != height * (width * pixel + 1):
        raise ValueError("image data of another size")
    return width, pixel, lines.reshape(height, -1)


def decode_all(files: list[bytes]) -> list[np.ndarray]:
    """Samples (rows, width, channels) of each file; those of one shape are undone together."""
    opened = [_opened(f) for f in files]
    out: list = [None] * len(files)
    for width, pixel in {(w, p) for w, p, _ in opened}:
        which = [i for i, (w, p, _) in enumerate(opened) if (w, p) == (width, pixel)]
        heights = [len(opened[i][2]) for i in which]
        lines = np.concatenate([opened[i][2] for i in which])
        samples = unfilter(lines[:, 0], lines[:, 1:], pixel, heights).reshape(-1, width, pixel)
        for i, a, n in zip(which, _firsts(heights).tolist(), heights, strict=True):
            out[i] = samples[a : a + n]
    return out


def decode(file: bytes) -> np.ndarray:
    return decode_all([file])[0]


@cache
def _cosines(n: int = 32, low: int = 8) -> np.ndarray:
    return np.cos(np.pi * np.arange(low)[:, None] * (2 * np.arange(n) + 1) / (2 * n))


def feature(samples: np.ndarray) -> str:
    """16 hex digits: signs against their median of the 64 lowest cosine frequencies of the luma at 32 x 32."""
    luma = samples[:, :, :3].astype(np.float32) @ np.array([0.299, 0.587, 0.114], np.float32) if samples.shape[2] >= 3 else samples[:, :, 0].astype(np.float32)
    for axis in (0, 1):
        n = luma.shape[axis]
        if n < 32:
            luma = np.repeat(luma, -(-32 // n), axis)
            n = luma.shape[axis]
        cuts = np.arange(32) * n // 32
        luma = np.add.reduceat(luma, cuts, axis=axis, dtype=np.float64) / np.diff(np.append(cuts, n)).reshape((-1, 1) if axis == 0 else (1, -1))
    low = np.round((_cosines() @ luma @ _cosines().T).ravel(), 3)
    return np.packbits(low > np.median(low[1:])).tobytes().hex()


def payload(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, the text padded by blanks to whole rows)."""
    data = (text or "").encode()
    return len(data), data + b" " * (-len(data) % ROW or ROW * (not data))


def groups(items: list, size: Callable) -> Iterator[list]:
    """Neighbours together, up to ``GROUP`` bytes or one item."""
    part, held = [], 0
    for x in items:
        if part and held + size(x) > GROUP:
            yield part
            part, held = [], 0
        part.append(x)
        held += size(x)
    if part:
        yield part


def _mapped(df: DataFrame, columns: list[str], schema: str, turn: Callable) -> DataFrame:
    """``turn`` makes rows of a list of rows, in slices of ROWS."""
    out = df.sparkSession.createDataFrame([], schema).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        release()
        arrow = to_arrow_schema(out)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            turned = list(zip(*turn(list(zip(*(c.to_pylist() for c in batch.columns), strict=True))), strict=True)) or [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(turned, arrow, strict=True)], schema=arrow)

    return df.select(*columns).mapInArrow(run, out)


def _written(rows: list[tuple]) -> list[tuple]:
    held = [(i, *payload(text)) for i, text in rows]
    return [(i, n, file) for part in groups(held, lambda x: len(x[2])) for (i, n, _), file in zip(part, encode_all([p for _, _, p in part]), strict=True)]


def media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text as a PNG file in a binary column."""
    kind = docs.schema[id_col].dataType.simpleString()
    return _mapped(docs, [id_col, text_col], f"`{id_col}` {kind}, n_bytes long, media binary", _written)


def _digests(rows: list[tuple]) -> list[tuple]:
    out = []
    for part in groups(rows, lambda x: x[1]):
        for (i, n, file), samples in zip(part, decode_all([f for _, _, f in part]), strict=True):
            data = samples.tobytes()
            out.append((i, n, len(data), sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(file), sha256(file).hexdigest(), feature(samples)))
    return out


def query(docs: DataFrame) -> DataFrame:
    return _mapped(media(docs), ["doc_id", "n_bytes", "media"], "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", _digests)
