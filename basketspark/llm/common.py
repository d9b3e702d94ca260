"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that a task turns into Python values at a time.
ROWS = 512


#: MB of the Arrow batches that tasks hand to Python, each of which lies in the executor and in its worker at once.
BATCH_MB = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_MB}m")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a session on this machine alone may do without one and gets a local folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder all executors share."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_HELD: dict = {}


def trim() -> None:
    """Give memory that is free in this Python worker back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not there on every platform
        pass


def release() -> None:
    """Forget what an operator holds in this Python worker."""
    if _HELD:
        _HELD.clear()
        gc.collect()
        trim()


def held(key, make: Callable):
    """What an operator keeps in a Python worker from task to task; a worker holds only one such thing at a time."""
    if key not in _HELD:
        release()
        _HELD[key] = make()
        trim()
    return _HELD[key]


def map_rows(df: DataFrame, columns: list[str], schema: str, rows: Callable[..., tuple], setup: Callable = None) -> DataFrame:
    """One output row for each input row: ``rows(state, *values)`` in Arrow batches; ``setup()`` once a task."""
    out = df.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    names = out.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        state = setup() if setup else release()
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            values = [rows(state, *row) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            turned = list(zip(*values, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(v, type=arrow.field(i).type) for i, v in enumerate(turned)], schema=arrow)
        trim()

    return df.select(*columns).mapInArrow(run, out)


def few(df: DataFrame, most: int) -> DataFrame:
    """df, to be broadcast if it has at most ``most`` rows. df is a table or a checkpoint, as it is counted first."""
    return F.broadcast(df) if df.count() <= most else df


def fold(column: str, parts: int) -> F.Column:
    """crc32 of the id as text, modulo parts; an unknown id is in no fold (null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, chars: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """About ``rows`` (text, label) of labelled rows, for fitting a classifier: ids below a hash threshold that follows from the
    count of labels; texts over ``chars`` are left out of the sample."""
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label).alias("_label"))
    n = known.count()
    part = min(1.0, rows / n) if n else 0.0
    chosen = known.filter(F.pmod(F.xxhash64(id_col, F.lit(17)), F.lit(1 << 20)) < int(part * (1 << 20)) + (part == 1.0)).limit(2 * rows)
    found = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).filter(F.length(text_col) <= chars).select(id_col, text_col, "_label")
    return [(t, y) for _, t, y in sorted(map(tuple, found.collect()), key=lambda r: (str(r[0]), r[1]))]


def stored(df: DataFrame) -> DataFrame:
    """Write the table beside the checkpoints, in the folder all executors share, and read it again.

    For what a loop hands on: a checkpoint keeps the estimated size of its plan, which joins multiply in each round."""
    from uuid import uuid4

    path = f"{shared_folder(df.sparkSession)}/table-{uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def drop(df: DataFrame) -> None:
    """Remove the table behind a frame of stored(), which nothing may need any more."""
    path = getattr(df, "stored_path", None)
    if path:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
