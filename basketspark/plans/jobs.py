"""Jobs: read, compute, hold against the contract, write. Each returns its table's report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import baskets, history, sampling, text, training
from ..quality import contracts
from ..quality.gate import Report, gated_write
from ..sources.files import drop_path, read_csv, read_parquet, read_tables, write_bucketed, write_parquet
from ..sources.schema import spark_schema
from ..sources.scratch import scratch_path

#: Raw table: its contract, and its parents.
RAW = {
    "orders": ("orders", ()),
    "aisles": ("aisles", ()),
    "departments": ("departments", ()),
    "products": ("products", ("aisles", "departments")),
    "order_products__prior": ("order_products", ("orders", "products")),
    "order_products__train": ("order_products", ("orders", "products")),
}


def ingest_csv(spark: SparkSession, source: str, target: str, contract: dict, references: dict[str, DataFrame] | None = None, quoted: str | None = None) -> Report:
    """A CSV file as checked Parquet; ``quoted`` names a text column whose doubled quotes are made single."""
    df = read_csv(spark, source, spark_schema(contract))
    if quoted:
        df = df.withColumn(quoted, baskets.normalize_quotes(quoted))
    return gated_write(df, contract, target, references)


def bronze(spark: SparkSession, csv_path: str, out: str) -> dict[str, Report]:
    """All raw tables, parents first; dependent ones are checked against what was written of their parents."""
    done = {}
    for name, (contract, parents) in RAW.items():
        references = {p: read_parquet(spark, f"{out}/{p}") for p in parents}
        done[name] = ingest_csv(spark, f"{csv_path}/{name}.csv", f"{out}/{name}", contracts.CONTRACTS[contract], references, "product_name" if name == "products" else None)
    return done


def order_products(spark: SparkSession, bronze_path: str, out: str) -> Report:
    t = read_tables(spark, bronze_path, ["orders", "products", "order_products__prior", "order_products__train"])
    lines = baskets.union_lines(t["order_products__prior"], t["order_products__train"])
    return gated_write(baskets.enriched_lines(lines, t["orders"], t["products"]), contracts.SILVER, out)


def user_data(spark: SparkSession, silver_path: str, out: str) -> Report:
    return gated_write(baskets.user_sequences(baskets.order_sequences(read_parquet(spark, silver_path))), contracts.USER_DATA, out)


def product_history(spark: SparkSession, silver_path: str, bronze_path: str, out: str) -> Report:
    t = read_tables(spark, bronze_path, ["orders", "products"])
    return gated_write(history.product_history_all(read_parquet(spark, silver_path), baskets.target_orders(t["orders"]), t["products"]), contracts.PRODUCT_HISTORY, out)


def product_training(spark: SparkSession, history_path: str, products_path: str, out: str, min_word_freq: int = text.MIN_WORD_FREQ, name_length: int = training.NAME_LENGTH, encode_length: int = training.ENCODE_LENGTH) -> Report:
    products = read_parquet(spark, products_path)
    encoded = text.encoded_names(products, text.word_index(products, min_word_freq=min_word_freq))
    rows = training.product_training(read_parquet(spark, history_path), encoded, name_length, encode_length)
    return gated_write(rows, contracts.product_training(name_length, encode_length), out)


def aisle_history(spark: SparkSession, silver_path: str, products_path: str, out: str) -> Report:
    departments = baskets.aisle_departments(read_parquet(spark, products_path))
    return gated_write(history.aisle_history(read_parquet(spark, silver_path), departments), contracts.AISLE_HISTORY, out)


def aisle_training(spark: SparkSession, history_path: str, out: str, pad_length: int = training.PAD_LENGTH) -> Report:
    return gated_write(training.aisle_training(read_parquet(spark, history_path), pad_length), contracts.aisle_training(pad_length), out)


def reorder_size_training(spark: SparkSession, silver_path: str, out: str, pad_length: int = training.PAD_LENGTH) -> Report:
    return gated_write(training.reorder_size_training(history.reorder_size(read_parquet(spark, silver_path)), pad_length), contracts.reorder_size_training(pad_length), out)


def user_product_count(spark: SparkSession, silver_path: str, out: str) -> Report:
    return gated_write(baskets.user_product_count(read_parquet(spark, silver_path)), contracts.USER_PRODUCT_COUNT, out)


def gold(spark: SparkSession, silver_path: str, bronze_path: str, out: str, pad_length: int = training.PAD_LENGTH) -> dict[str, Report]:
    """All tables that come from the lines (users, product_history, aisle_history, reorder_size_training, user_product_count, by these
    names below ``out``) with one shuffle of the lines: they are staged as baskets first, which each table then reads."""
    t, staged = read_tables(spark, bronze_path, ["orders", "products"]), scratch_path(spark, "baskets")
    try:
        write_parquet(history.staged_baskets(read_parquet(spark, silver_path)), staged)
        all_baskets = spark.read.parquet(staged)
        made = {
            "users": (baskets.user_sequences(baskets.sequences_of(all_baskets)), contracts.USER_DATA),
            "product_history": (history.histories_of(all_baskets, baskets.target_orders(t["orders"]), t["products"], True), contracts.PRODUCT_HISTORY),
            "aisle_history": (history.aisles_of(all_baskets, baskets.aisle_departments(t["products"])), contracts.AISLE_HISTORY),
            "reorder_size_training": (training.reorder_size_training(history.sizes_of(all_baskets), pad_length), contracts.reorder_size_training(pad_length)),
            "user_product_count": (baskets.counts_of(all_baskets), contracts.USER_PRODUCT_COUNT),
        }
        return {name: gated_write(df, contract, f"{out}/{name}") for name, (df, contract) in made.items()}
    finally:
        drop_path(spark, staged)


def bucketed_lines(spark: SparkSession, silver_path: str, table: str, buckets: int, path: str | None = None, most_of_one: float = 0.05) -> bool:
    """The lines as a table bucketed by user, on which orders, counts and sequences by user need no shuffle. Whether it was made: not if
    one user has more than ``most_of_one`` of all lines, as one bucket would then hold them; the lines are to be read as they are."""
    lines = read_parquet(spark, silver_path)
    sizes = lines.groupBy("user_id").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("every")).first()
    if not sizes["every"] or sizes["most"] > max(most_of_one, 1 / buckets) * sizes["every"]:
        return False
    write_bucketed(lines, table, ["user_id"], buckets, path)
    return True


def sample(spark: SparkSession, source: str, out: str, n: int, seed: int = sampling.SEED) -> None:
    """A consistent part of the raw CSV tables as CSV: n users, their orders and lines, and all look-up tables."""
    read = lambda name: read_csv(spark, f"{source}/{name}.csv", spark_schema(contracts.CONTRACTS[RAW[name][0]]))
    orders = sampling.belonging(read("orders"), sampling.sample_users(read("orders"), n, seed), "user_id")
    for name in RAW:
        rows = orders if name == "orders" else sampling.belonging(read(name), orders, "order_id") if name.startswith("order_products") else read(name)
        columns = [c["name"] for c in contracts.CONTRACTS[RAW[name][0]]["schema"]]
        rows.select(*columns).write.mode("overwrite").csv(f"{out}/{name}.csv", header=True, escape="\\")


def sample_parquet(tables: dict[str, DataFrame], out: str, n: int, seed: int = sampling.SEED) -> None:
    """The same of tables that are read already."""
    orders = sampling.belonging(tables["orders"], sampling.sample_users(tables["orders"], n, seed), "user_id")
    for name, df in tables.items():
        rows = orders if name == "orders" else sampling.belonging(df, orders, "order_id") if "order_id" in df.columns else df
        write_parquet(rows, f"{out}/{name}")


