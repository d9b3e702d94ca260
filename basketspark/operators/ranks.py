"""Places in a total order, without a window over all rows.

Rows are dealt by ranges of the order and sorted within them, so a row's place is the sum of the sizes of the ranges before plus its
place in its own: two levels of prefix sums. Only the ranges' sizes, a number for each partition, are summed up in one place. The dealt
rows are written once, as the bounds of ranges are sampled and must not be drawn again between the two levels; a range holds its share
of the rows whatever their values, unless equal keys are many, so the order should name rows apart.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

#: monotonically_increasing_id has the partition above these bits and the row's place in it below.
PLACE_BITS = 33


def ranked(df: DataFrame, order: list[Column | str], rank: str = "rank", sums: dict[str, str] | None = None) -> DataFrame:
    """df with each row's place in the order, from 1 up; and, by ``sums`` {new column: column}, the sum of a column over all rows
    before it. A null counts nothing. The rows are read from a table in the shared scratch folder."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ranked")
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    dealt, sums = spark.read.parquet(path), sums or {}
    part, place = F.shiftright("_at", PLACE_BITS), F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    figures = [F.count("*").alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(f"s{i}") for i, c in enumerate(sums.values()))]
    # A row for each partition that was written.
    sizes = dealt.groupBy(part.cast("int").alias("_part")).agg(*figures).orderBy("_part").collect()
    before = [accumulate((r[1 + k] for r in sizes), initial=0) for k in range(1 + len(sums))]
    offsets = [(r[0], *b) for r, *b in zip(sizes, *before)]
    if not offsets:
        return df.select("*", F.lit(0).cast("long").alias(rank), *(F.lit(0).cast("long").alias(c) for c in sums)).limit(0)
    kinds = [dealt.agg(*figures).schema[f"s{i}"].dataType.simpleString() for i in range(len(sums))]
    known = spark.createDataFrame(offsets, ", ".join(["_of int, _n long", *(f"_s{i} {k}" for i, k in enumerate(kinds))]))
    out = dealt.join(F.broadcast(known), part.cast("int") == F.col("_of"))
    own = {c: F.col(f"_s{i}") + F.coalesce(F.sum(of).over(_earlier(part)), F.lit(0)) for i, (c, of) in enumerate(sums.items())}
    return out.select(*df.columns, (F.col("_n") + place + 1).alias(rank), *(v.alias(c) for c, v in own.items()))


def _earlier(part: Column):
    from pyspark.sql.window import Window

    return Window.partitionBy(part).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
