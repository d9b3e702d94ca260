"""Basket tables from a star schema of orders, lineitem and part.

An order's number is its rank among its customer's orders that have lines; a customer's last order is a train order, or a test
order whose lines are withheld, the others are prior ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .exchanges import sized


def _int(column: F.Column | str) -> F.Column:
    return (F.col(column) if isinstance(column, str) else column).cast("int")


def basket_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """orders, prior, train, lines (all, test lines too), carts (these before they meet their orders), products, aisles and departments."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    sized(spark, read("lineitem").count())
    pairs = read("lineitem").groupBy("l_orderkey", "l_partkey").agg(F.min("l_linenumber").alias("line"))
    by_user = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    kept = read("orders").select("o_orderkey", "o_custkey", "o_orderdate").join(pairs.select("l_orderkey").distinct(), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    numbered = kept.select("*", F.row_number().over(by_user).alias("n"), F.lag("o_orderdate").over(by_user).alias("before"), F.count("*").over(Window.partitionBy("o_custkey")).alias("of"))
    user = F.col("o_custkey") + 1
    orders = numbered.select(
        _int(F.col("o_orderkey") + 1).alias("order_id"),
        _int(user).alias("user_id"),
        F.when(F.col("n") < F.col("of"), "prior").when(user % 3 == 0, "test").otherwise("train").alias("eval_set"),
        _int("n").alias("order_number"),
        _int(F.dayofweek("o_orderdate") - 1).alias("order_dow"),
        _int((F.col("o_orderkey") + 1) % 24).alias("order_hour_of_day"),
        F.when(F.col("before").isNotNull(), F.least(F.lit(30), F.datediff("o_orderdate", "before"))).cast("double").alias("days_since_prior_order"),
    )
    pairs = pairs.select(_int(F.col("l_orderkey") + 1).alias("order_id"), _int(F.col("l_partkey") + 1).alias("product_id"), "line")
    carts = pairs.select("order_id", "product_id", _int(F.row_number().over(Window.partitionBy("order_id").orderBy("line", "product_id"))).alias("add_to_cart_order"))
    lines = carts.join(orders.select("order_id", "user_id", "eval_set", "order_number"), "order_id").select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        (F.col("order_number") > F.min("order_number").over(Window.partitionBy("user_id", "product_id"))).cast("int").alias("reordered"),
        "eval_set",
    )
    aisle = _int(F.regexp_extract("p_brand", "[0-9]+", 0))
    products = read("part").select(_int(F.col("p_partkey") + 1).alias("product_id"), F.col("p_name").alias("product_name"), aisle.alias("aisle_id")).withColumn("department_id", _int(F.floor((F.col("aisle_id") - 1) / 5) + 1))
    of = lambda e: lines.filter(F.col("eval_set") == e).drop("eval_set")
    return {
        "orders": orders,
        "prior": of("prior"),
        "train": of("train"),
        "lines": lines,
        "carts": carts,
        "products": products,
        "aisles": products.select("aisle_id", F.concat(F.lit("aisle "), "aisle_id").alias("aisle")).distinct(),
        "departments": products.select("department_id", F.concat(F.lit("department "), "department_id").alias("department")).distinct(),
    }


#: The same tables for DuckDB, as common table expressions.
DUCKDB = """
b_pairs AS (SELECT l_orderkey, l_partkey, min(l_linenumber) AS line FROM lineitem GROUP BY ALL),
b_numbered AS (
  SELECT *, row_number() OVER u AS n, lag(o_orderdate) OVER u AS before, count(*) OVER (PARTITION BY o_custkey) AS of
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM b_pairs)
  WINDOW u AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
b_orders AS (
  SELECT (o_orderkey + 1)::INT AS order_id, (o_custkey + 1)::INT AS user_id,
         CASE WHEN n < of THEN 'prior' WHEN (o_custkey + 1) % 3 = 0 THEN 'test' ELSE 'train' END AS eval_set,
         n::INT AS order_number, dayofweek(o_orderdate)::INT AS order_dow, ((o_orderkey + 1) % 24)::INT AS order_hour_of_day,
         CASE WHEN before IS NOT NULL THEN least(30, date_diff('day', before, o_orderdate))::DOUBLE END AS days_since_prior_order
  FROM b_numbered),
b_lines AS (
  SELECT o.order_id, (l_partkey + 1)::INT AS product_id, row_number() OVER (PARTITION BY o.order_id ORDER BY line, l_partkey)::INT AS add_to_cart_order,
         (order_number > min(order_number) OVER (PARTITION BY user_id, l_partkey))::INT AS reordered, o.eval_set
  FROM b_pairs JOIN b_orders o ON o.order_id = l_orderkey + 1),
b_products AS (
  SELECT (p_partkey + 1)::INT AS product_id, p_name AS product_name, regexp_extract(p_brand, '[0-9]+')::INT AS aisle_id,
         ((regexp_extract(p_brand, '[0-9]+')::INT - 1) // 5 + 1)::INT AS department_id
  FROM part),
b_silver AS (
  SELECT l.product_id, l.order_id, l.add_to_cart_order, l.reordered, o.user_id, o.eval_set, o.order_number, o.order_dow, o.order_hour_of_day,
         coalesce(o.days_since_prior_order, -1) AS days_since_prior_order, p.product_name, p.aisle_id, p.department_id
  FROM b_lines l LEFT JOIN b_orders o USING (order_id) LEFT JOIN b_products p USING (product_id)
  WHERE l.eval_set IN ('prior', 'train'))
"""
