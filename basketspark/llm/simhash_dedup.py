"""SimHash near-duplicate groups by pigeonring filtering.

The 64 bits form a ring of segments, more than bits may differ. If two fingerprints differ in at most t bits, some segment starts
a chain in which every prefix of l of m segments differs in at most l*t/m bits. Prefixes with a budget below one bit must be equal,
so they are the join key; the longer prefixes are tested next, and the whole distance last.

Where more than ``PAIR_BUCKET`` fingerprints share a key, the chain is lengthened by a segment: a member goes on with each choice of
bits of that segment that the budget lets differ, left out of its key. Two members within t bits meet under the bits in which they
differ, so no link is lost. For two bits a member has at most 28 such keys before the ring's last segment, and a whole ring's key
holds at most 2^t fingerprints, so the work stays linear in the bucket.

Edge cases: a null or blank text has fingerprint zero and links like any other; repeated rows are rows of their own; a null
doc_id takes no part in the smallest id (a group of nothing else has a null component_id); an empty table gives no rows; only
the two named columns are read, so other columns can't clash.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, drop, map_rows, release, stored

SEGMENTS = 7
PAIR_BUCKET = 64
MAX_BITS = 2
BLOCK = 1 << 15
#: Ids of documents to drop are broadcast up to this checked number.
BROADCAST_IDS = 1_000_000
#: Edges that one task joins.
TASK_EDGES = 100_000


def simhash(text: str | None, words: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles (repeats included) of the ASCII-lower-cased text."""
    from xxhash import xxh64_intdigest

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    if len(w) < words:
        shingles, n = [b" ".join(w)], 1
    else:
        shingles, n = None, len(w) - words + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = shingles or [b" ".join(x) for x in zip(*(w[at + k : at + k + min(BLOCK, n - at)] for k in range(words)), strict=True)]
        h = np.fromiter(map(xxh64_intdigest, part, repeat(42)), np.uint64, len(part))
        counts += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) for each row."""
    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs, [id_col, text_col], f"`{id_col}` {kind}, fp long", lambda _, i, text: (i, simhash(text)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _ring(segments: int) -> list[int]:
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _ways(bits: int, most: int) -> list[tuple[int, int]]:
    """(bits left out, how many) of all choices of at most ``most`` of the given bits."""
    each = [1 << i for i in range(64) if bits >> i & 1]
    return [(_signed(sum(some)), n) for n in range(min(most, len(each)) + 1) for some in combinations(each, n)]


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int | None = None, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """(a, b) with a > b: the pairs of distinct fingerprints within max_bits (up to 62 of 64). fps: distinct fp."""
    segments = segments or max(SEGMENTS, max_bits + 1)
    ring = _ring(segments)
    chain = lambda i, n: reduce(lambda x, y: x | y, (ring[(i + k) % segments] for k in range(n)))
    budget = lambda n: n * max_bits // segments
    by_start = lambda of: F.element_at(F.array(*(F.lit(_signed(of(i))) for i in range(segments))), F.col("start") + 1)
    length = max(n for n in range(1, segments + 1) if budget(n) == 0)
    rows, near = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("start")).withColumns({"out": F.lit(0).cast("long"), "used": F.lit(0)}), []
    while True:
        keyed = rows.withColumn("key", F.xxhash64(F.col("fp").bitwiseAND(by_start(lambda i: chain(i, length))).bitwiseAND(F.bitwise_not("out")), "out"))
        sizes = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).filter("n > 1")
        met = checkpointed(keyed.join(sizes, ["start", "key"]))
        last = length == segments
        a, b = (met.filter(F.lit(last) | (F.col("n") <= pair_bucket)).alias(x) for x in "ab")
        differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
        tests = []
        for n in range(length, segments + 1):
            if n == segments or budget(n + 1) > budget(n):  # the longest chain of a budget implies the shorter ones
                mask = F.element_at(F.array(*(F.lit(_signed(chain(i, n))) for i in range(segments))), F.col("a.start") + 1)
                tests.append(F.bit_count(differ.bitwiseAND(mask)) <= budget(n))
        near.append(a.join(b, [F.col("a.start") == F.col("b.start"), F.col("a.key") == F.col("b.key"), F.col("a.fp") > F.col("b.fp"), *tests]).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))
        hot = met.filter(F.col("n") > pair_bucket)
        if last or hot.isEmpty():
            return reduce(DataFrame.unionByName, near).distinct()
        ways = F.element_at(F.array(*(F.array(*(F.struct(F.lit(m).alias("m"), F.lit(n).alias("n")) for m, n in _ways(ring[(i + length) % segments], budget(length + 1)))) for i in range(segments))), F.col("start") + 1)
        more = F.filter(ways, lambda w: w.n + F.col("used") <= budget(length + 1))
        rows = hot.select("fp", "start", "out", "used", F.explode(more).alias("w")).select("fp", "start", F.col("out").bitwiseOR(F.col("w.m")).alias("out"), (F.col("used") + F.col("w.n")).alias("used"))
        length += 1


def _contracted(batches):
    """(a, b) of each node of a task's edges but the smallest of its group there, and that one."""
    import pyarrow as pa

    release()
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    for at in range(0, len(nodes), 10_000):
        part = nodes[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(map(find, part), pa.int64())], names=["a", "b"])


def components(edges: DataFrame, most: int = 60, task: int = TASK_EDGES) -> DataFrame:
    """(node, root) for each node of edges (a > b) but the smallest of its group, which is the root.

    Edges are dealt to tasks of ``task`` at most, each of which joins what its own edges do; between tasks, alternating large and
    small stars do so.
    """
    e = stored(edges.select("a", "b"))
    n = e.count()
    parts = max(1, -(-n // task))
    e, old = stored(e.repartition(parts).mapInArrow(_contracted, "a long, b long")), e
    drop(old)
    seen = None
    for _ in range(most * (parts > 1)):
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        seen = now
        both = e.union(e.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        e, old = stored(small.select(F.col("a"), F.col("m").alias("b")).union(small.filter("b != m").select(F.col("b"), F.col("m"))).distinct()), e
        drop(old)
    else:
        if parts > 1:
            raise RuntimeError(f"components did not settle in {most} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component_id): component_id is the smallest id whose fingerprint can be reached by links, itself included."""
    rows = checkpointed(fingerprints(docs, id_col, text_col))
    own = checkpointed(rows.groupBy("fp").agg(F.min(id_col).alias("first"), F.count("*").alias("n")))
    roots = components(links(own.select("fp"), max_bits))
    nodes = roots.union(roots.select("root", "root").distinct()).toDF("fp", "root").join(own, "fp")
    least = nodes.groupBy("root").agg(F.min("first").alias("least"))
    linked = nodes.select("fp", "root").join(least, "root").select("fp", "least")
    # Only fingerprints of several rows or with links need a look-up; hot ones are split as skewed join partitions.
    several = checkpointed(own.filter("n > 1").join(linked, "fp", "left_anti").select("fp", F.col("first").alias("least")).unionByName(linked).withColumn("found", F.lit(True)))
    return rows.join(several, "fp", "left").select(id_col, "fp", F.when(F.col("found"), F.col("least")).otherwise(F.col(id_col)).alias("component_id"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keep the document with the smallest id of each group; rows that share an id are one document, rows without one stay."""
    found = checkpointed(near_duplicates(docs, id_col, text_col).filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct())
    drop = F.broadcast(found) if found.count() <= BROADCAST_IDS else found
    return docs.join(drop, id_col, "left_anti").select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
