"""Exact centroid clustering (Lloyd's rounds over whole numbers) with ns-bounds.

Every vector keeps, for each centroid, a lower bound of its distance and the round in which that bound was measured, and an upper
bound of its own centroid's distance with its round. The centroids of all rounds are kept. A bound is loosened by the norm of its
centroid's total displacement since the round of its measurement, ||c(now) - c(then)||, which is never more than the sum of the
drifts of the rounds between and is nothing where a centroid came back. Where all lower bounds stay above the upper one the vector
stays where it is and nothing is measured; where not, the own distance is measured, then those centroids whose bounds fail, in whole
numbers, so that every round's assignment is exact, ties included. Bounds are rounded outwards.

A round is one pass over a table of slim states (the whole numbers in the smallest width that holds them, bounds as 4-byte floats),
written to the folder that all executors share; tasks add the changes of sums of the vectors that moved, a row for each centroid, to
a folder of their own in the same table, and only k sums reach the driver. A state table is removed when the next one is written.

Edge cases: vectors of another length, null ones, and those with a null, NaN or infinite component are left out; a vector without an
id can be a starting centroid only if others are too few; fewer vectors than centroids make fewer centroids; equal hashes (repeated
ids) are ordered by the vector; repeated rows are clustered each; an empty centroid stays; equal centroids give the smaller number;
an empty table gives no rows. Whole numbers of 2^28 and more, whose squared distances fit no long, are an error. Only the two named
columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, release, shared_folder, stored, trim

K, DIMENSIONS, ROUNDS, SCALE = 16, 64, 3, 64
SALT = "1:"
#: Beyond this a sum of squared differences may not fit a long.
LARGEST = 1 << 28
#: Products of components below this are exact as doubles, sums of 64 of them too.
EXACT = 1 << 20
#: Rows whose distances are worked out at a time.
ROWS = 4096
#: Rounding of distances and bounds, in parts of their size.
SLACK = 1e-9
#: state: a vector's row; sums: a task's changes of a centroid's sums.
STATE, SUMS = 0, 1


class Clusters(NamedTuple):
    """(vec_id, cluster, distance) rows; the last centroids; exact measurements a pass; and the sizes and inertias by centroid."""

    rows: DataFrame
    centroids: np.ndarray
    measured: list[int]
    inertia: dict[int, int]


def usable(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """Whether there are as many components as there must be, each a finite number."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & ~odd, F.lit(False))


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as whole numbers."""
    out = np.floor(values.astype(np.float64) * scale)
    if out.size and np.abs(out).max() >= LARGEST:
        raise ValueError(f"components of {LARGEST} and more have no squared distances that fit a long")
    return out.astype(np.int64)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroids."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < EXACT:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


def lower(n: np.ndarray) -> np.ndarray:
    """Roots of squared distances as 4-byte floats that are not above them."""
    return np.nextafter(np.sqrt(n).astype(np.float32), np.float32(-1))


def upper(n: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(n).astype(np.float32), np.float32(np.inf))


def displacements(history: np.ndarray) -> np.ndarray:
    """[round, centroid]: how far each centroid of the last round is from where it was in a round."""
    moved = history[-1] - history
    return np.sqrt((moved.astype(np.float64) ** 2).sum(2)) * (1 + SLACK)


class States(NamedTuple):
    """Rows of a block: whole numbers, own centroid, upper bound and its round, lower bounds and their rounds."""

    x: np.ndarray
    own: np.ndarray
    high: np.ndarray
    since: np.ndarray
    low: np.ndarray
    times: np.ndarray

    @classmethod
    def first(cls, x: np.ndarray, centroids: np.ndarray) -> States:
        n = squared(x, centroids)
        own = n.argmin(1)
        zeros = np.zeros(n.shape, np.uint8)
        return cls(x, own.astype(np.int32), upper(n[np.arange(len(x)), own]), zeros[:, 0].copy(), lower(n), zeros)


def reassign(s: States, history: np.ndarray) -> tuple[States, int]:
    """The states in the last round of the history, and how many distances were measured for it."""
    now, drift = len(history) - 1, displacements(history)
    at, each = np.arange(len(s.x)), np.arange(history.shape[1])
    own, high, since, low, times = s.own.copy(), s.high.copy(), s.since.copy(), s.low.copy(), s.times.copy()
    bound = low - drift[times, each]
    bound[at, own] = np.inf
    reach = high + drift[since, own]
    margin = SLACK * (1 + reach[:, None] + low + drift[times, each])
    failing = np.flatnonzero((bound <= reach[:, None] + margin).any(1))
    if not len(failing):
        return States(s.x, own, high, since, low, times), 0
    # The own distance first; what still fails is measured too.
    x, mine, centroids = s.x[failing], own[failing], history[-1]
    exact = ((x - centroids[mine]) ** 2).sum(1)
    near = np.sqrt(exact)
    rows, others = np.nonzero(bound[failing] <= near[:, None] + margin[failing])
    found = ((x[rows] - centroids[others]) ** 2).sum(1)
    every = np.full((len(x), len(centroids)), np.iinfo(np.int64).max)
    every[np.arange(len(x)), mine] = exact
    every[rows, others] = found
    low[failing, mine], times[failing, mine] = lower(exact), now
    low[failing[rows], others], times[failing[rows], others] = lower(found), now
    best = every.argmin(1)
    own[failing] = best
    high[failing], since[failing] = upper(every[np.arange(len(x)), best]), now
    return States(s.x, own, high, since, low, times), len(x) + len(rows)


def _bytes(rows: np.ndarray) -> pa.Array:
    """Rows of equal width as binary values."""
    width = rows.dtype.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _values(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _smallest(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max(initial=0)
    return x.astype(np.int8 if most < 1 << 7 else np.int16 if most < 1 << 15 else np.int32)


def _wide(column: pa.Array, dimensions: int) -> np.ndarray:
    """Whole numbers of rows that may have different widths."""
    values = column.to_pylist()
    if len(widths := {len(v) for v in values}) == 1:
        return np.frombuffer(b"".join(values), f"<i{widths.pop() // dimensions}").reshape(-1, dimensions).astype(np.int64)
    return np.stack([np.frombuffer(v, f"<i{len(v) // dimensions}") for v in values]).astype(np.int64)


def _pass(id_type: T.DataType, k: int, dimensions: int, block) -> tuple:
    """(function, schema) of a pass: ``block(batch)`` gives ids, new states, old own centroids (None at first) and the measured."""
    schema = T.StructType(
        [T.StructField("kind", T.IntegerType()), T.StructField("id", id_type), T.StructField("x", T.BinaryType()), T.StructField("own", T.IntegerType()), T.StructField("high", T.FloatType()), T.StructField("since", T.IntegerType())]
        + [T.StructField("low", T.BinaryType()), T.StructField("times", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType())), T.StructField("measured", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        release()
        arrow = to_arrow_schema(schema)
        sums, counts, measured = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64), 0
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            ids, s, before, n = block(batch)
            measured += n
            moved = np.arange(len(s.x)) if before is None else np.flatnonzero(before != s.own)
            np.add.at(sums, s.own[moved], s.x[moved])
            np.add.at(counts, s.own[moved], 1)
            if before is not None:
                np.subtract.at(sums, before[moved], s.x[moved])
                np.subtract.at(counts, before[moved], 1)
            none = lambda f: pa.nulls(len(s.x), arrow.field(f).type)
            columns = [pa.array(np.full(len(s.x), STATE, np.int32)), ids, _bytes(_smallest(s.x)), pa.array(s.own), pa.array(s.high.astype(np.float32)), pa.array(s.since.astype(np.int32)), _bytes(s.low.astype(np.float32)), _bytes(s.times.astype(np.uint8)), none("n"), none("sums"), none("measured")]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        rows = [{"kind": SUMS, "own": c, "n": int(counts[c]), "sums": sums[c].tolist(), "measured": measured if c == 0 else 0} for c in range(k) if counts[c] or sums[c].any() or (c == 0 and measured)]
        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
        trim()

    return run, schema


def first_pass(vectors: DataFrame, centroids: np.ndarray, scale: int = SCALE) -> DataFrame:
    """(id, vector) of usable vectors as states."""
    k, dimensions = centroids.shape

    def block(batch):
        x = whole(np.asarray(batch.column(1).flatten()).reshape(-1, dimensions), scale)
        return batch.column(0), States.first(x, centroids), None, len(x) * k

    return vectors.mapInArrow(*_pass(vectors.schema["id"].dataType, k, dimensions, block))


def next_pass(states: DataFrame, history: np.ndarray) -> DataFrame:
    """States in the last round of the history."""
    _, k, dimensions = history.shape

    def block(batch):
        ids, x, own, high, since, low, times = batch.columns
        s = States(_wide(x, dimensions), np.asarray(own), np.asarray(high), np.asarray(since), _values(low, "<f4", k), _values(times, np.uint8, k))
        new, n = reassign(s, history)
        return ids, new, s.own, n

    return states.mapInArrow(*_pass(states.schema["id"].dataType, k, dimensions, block))


def measured_rows(states: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) with the exact squared distance to the own centroid."""
    dimensions, kind = centroids.shape[1], states.schema["id"].dataType
    out = T.StructType([T.StructField("id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches):
        release()
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            own = np.asarray(batch.column(2))
            distance = ((_wide(batch.column(1), dimensions) - centroids[own]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own), pa.array(distance)], names=["id", "cluster", "distance"])

    return states.select("id", "x", "own").mapInArrow(run, out)


def starting(vectors: DataFrame, k: int = K, scale: int = SCALE, salt: str = SALT) -> np.ndarray:
    """The vectors of the k smallest hashes, in their order; k rows reach the driver."""
    key = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    some = vectors.select(key.alias("key"), "vector").orderBy(F.col("key").asc_nulls_last(), "vector").limit(k).collect()
    return whole(np.array([r.vector for r in some], np.float64), scale) if some else np.zeros((0, 0), np.int64)


def _changes(table: DataFrame) -> tuple[dict[int, tuple[int, list[int]]], int]:
    """By centroid the changes of its count and sums, k rows from Spark; and the distances measured."""
    parts = table.filter(F.col("kind") == SUMS).select("own", "n", "sums", "measured")
    counts = parts.groupBy("own").agg(F.sum("n").alias("n"), F.sum("measured").alias("measured"))
    sums = parts.select("own", F.posexplode("sums").alias("place", "x")).groupBy("own", "place").agg(F.sum("x").alias("x")).groupBy("own").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("s"))
    rows = counts.join(sums, "own").select("own", "n", "measured", F.col("s.x").alias("sums")).collect()
    return {r.own: (r.n, r.sums) for r in rows}, sum(r.measured for r in rows)


def _kept(df: DataFrame) -> DataFrame:
    """The pass's rows as a table whose states and sums lie in folders of their own."""
    from uuid import uuid4

    path = f"{shared_folder(df.sparkSession)}/states-{uuid4().hex}"
    df.write.partitionBy("kind").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, salt: str = SALT) -> Clusters:
    """``rounds`` times assigned and centroids replaced by their vectors' floored means, then assigned once more."""
    if rounds >= 256:
        raise ValueError("rounds are counted in one byte")
    vectors = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).filter(usable(F.col("vector"), dimensions))
    centroids = starting(vectors, k, scale, salt)
    if not len(centroids):
        return Clusters(vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids, [], {})
    history, totals, counts, measured = [centroids], np.zeros(centroids.shape, object), np.zeros(len(centroids), object), []
    table = _kept(first_pass(vectors, centroids, scale))
    for turn in range(rounds + 1):
        changes, n = _changes(table)
        measured.append(n)
        if turn == rounds:
            break
        for c, (more, sums) in changes.items():
            counts[c] += more
            totals[c] += np.array(sums, object)
        centroids = np.array([[int(x) // counts[c] for x in totals[c]] if counts[c] else history[-1][c] for c in range(len(centroids))], np.int64)
        history.append(centroids)
        states = table.filter(F.col("kind") == STATE).select("id", "x", "own", "high", "since", "low", "times")
        table, old = _kept(next_pass(states, np.array(history))), table
        drop(old)
    rows = stored(measured_rows(table.filter(F.col("kind") == STATE), centroids))
    drop(table)
    inertia = {r.cluster: r.inertia for r in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    return Clusters(rows, centroids, measured, inertia)


def query(df: DataFrame) -> DataFrame:
    found = cluster(df)
    by_cluster = [(c, found.inertia.get(c, 0), sum(found.inertia.values()), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(found.centroids.tolist())]
    facts = df.sparkSession.createDataFrame(by_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.withColumnRenamed("id", "vec_id").join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """Every round as tables of its own: assignments a<i> and centroids c<i>."""
    nearest = "(SELECT row, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance, c.cluster FROM v, c{i} c)"
    steps = [
        "kept AS (SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)",
        "v AS (SELECT row, vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS x FROM kept)",
        "c0 AS (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, x) - 1)::INT AS cluster, x FROM v QUALIFY cluster < 16)",
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"a{i} AS (SELECT row, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM {nearest.format(i=i)} GROUP BY row)")
        if i < ROUNDS:
            steps.append(f"s{i} AS (SELECT cluster, place, sum(e) AS total, count(*) AS n FROM (SELECT cluster, unnest(x) AS e, generate_subscripts(x, 1) AS place FROM a{i} JOIN v USING (row)) GROUP BY ALL)")
            steps.append(f"m{i} AS (SELECT cluster, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY place) AS x FROM s{i} GROUP BY cluster)")
            steps.append(f"c{i + 1} AS (SELECT cluster, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (cluster))")
    return f"""
WITH {''', '''.join(steps)}
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (row) JOIN c{ROUNDS} c USING (cluster)"""


ORACLE_SQL = _oracle()
