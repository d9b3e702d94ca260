"""CSV and Parquet scans and the Parquet sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import versions

#: How the raw files are quoted.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": "\\", "unescapedQuoteHandling": "STOP_AT_CLOSING_QUOTE"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Values that don't fit the schema become null; without a schema it is inferred."""
    reader = spark.read.options(**CSV_OPTIONS)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_parquet(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A table of versions as its newest (or the named) commit says, or a folder or file of plain Parquet."""
    return spark.read.parquet(versions.data_path(spark, path, version))


def read_tables(spark: SparkSession, folder: str, names: list[str], suffix: str = "") -> dict[str, DataFrame]:
    return {n: read_parquet(spark, f"{folder.rstrip('/')}/{n}{suffix}") for n in names}


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, by: list[str], buckets: int, path: str | None = None) -> None:
    """A Parquet table of the catalog, one file a bucket: rows are dealt by the bucketing before they are written. Aggregates and joins by
    these columns (and more) need no exchange then."""
    writer = df.repartition(buckets, *by).write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*by)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def drop_path(spark: SparkSession, path: str) -> None:
    versions.Store(spark, path).delete()
