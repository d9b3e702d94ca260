"""Golden rows of the basket operators."""

import random
import re

import pytest
from pyspark.sql import functions as F

from basketspark.functions import sequences as s
from basketspark.operators import baskets, history, sampling, text, training
from basketspark.operators.ranks import ranked
from basketspark.sources import exchanges

LINES = "user_id int, order_id int, order_number int, eval_set string, product_id int, aisle_id int, department_id int, add_to_cart_order int, reordered int, order_dow int, order_hour_of_day int, days_since_prior_order double"


def lines(spark, orders, user=1, last="train", aisles=None, flags=None):
    """Baskets of product ids in cart order; flags default to 0."""
    rows = []
    for n, basket in enumerate(orders, 1):
        for k, p in enumerate(basket, 1):
            split = last if n == len(orders) else "prior"
            rows.append((user, 100 * user + n, n, split, p, (aisles or {}).get(p, 1), 1, k, flags[n - 1][k - 1] if flags else 0, n % 7, n, -1.0 if n == 1 else 7.0))
    return spark.createDataFrame(rows, LINES)


def targets(spark, *rows):
    return spark.createDataFrame(list(rows), "user_id int, train_eval_set string")


def products(spark, *ids):
    return spark.createDataFrame([(i, f"product {i}", 1, 1) for i in ids], "product_id int, product_name string, aisle_id int, department_id int")


def test_parse_sequence(spark):
    df = spark.createDataFrame([("1 2 3",), ("  4   5 ",), (None,), (" ",), ("1 x",)], "t string")
    got = [r[0] for r in df.select(s.parse_sequence("t")).collect()]
    assert got == [[1, 2, 3], [4, 5], [], [], [1, None]]
    assert spark.createDataFrame([("1,2",)], "t string").select(s.parse_sequence("t", ",", "double")).first()[0] == [1.0, 2.0]
    with pytest.raises(ValueError):
        s.parse_sequence("t", kind="string")


def test_pad_text(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([5],), ([],)], "a array<int>")
    assert [tuple(r) for r in df.select(*s.pad_text("a", 2)).collect()] == [("1 2", 2), ("5 0", 1), ("0 0", 0)]
    assert [r[0] for r in df.select(s.pad_text(F.col("a").cast("array<double>"), 2, "double")[0]).collect()] == ["1.0 2.0", "5.0 0.0", "0.0 0.0"]


def test_pad_sequence(spark):
    df = spark.createDataFrame([([9, 7, 6, 5, 4],), ([4, 8],), ([],)], "a array<int>")
    a, n = s.pad_sequence("a", 4)
    assert [tuple(r) for r in df.select(a, n).collect()] == [([9, 7, 6, 5], 4), ([4, 8, 0, 0], 2), ([0, 0, 0, 0], 0)]


def test_one_order_is_history(spark):
    df = spark.createDataFrame([("10_20_30",), ("1_2 3",)], "t string")
    d = s.decode_baskets("t")
    assert [tuple(r) for r in df.select(s.history_of(d), s.target_of(d)).collect()] == [([[10, 20, 30]], None), ([[1, 2]], [3])]


def test_order_and_user_sequences(spark):
    df = lines(spark, [[10, 20], [10, 30]], flags=[[0, 0], [1, 0]])
    orders = baskets.order_sequences(df.orderBy(F.desc("add_to_cart_order")))
    assert {r.order_id: (r.product_ids, r.reorders) for r in orders.collect()} == {101: ("10_20", "0_0"), 102: ("10_30", "1_0")}
    user = baskets.user_sequences(orders).first()
    assert (user.product_ids, user.reorders, user.days_since_prior_orders, user.eval_set) == ("10_20 10_30", "0_0 1_0", "-1.0 7.0", "train")
    assert baskets.user_sequences(baskets.order_sequences(lines(spark, [[1]], last="prior"))).first().eval_set == "test"


def test_orders_sort_by_number(spark):
    user = baskets.user_sequences(baskets.order_sequences(lines(spark, [[n] for n in range(1, 13)]))).first()
    assert user.order_numbers == " ".join(map(str, range(1, 13)))


def test_product_history(spark):
    df = lines(spark, [[1, 2, 10], [2, 3, 5], [2, 5, 11], [10], [2, 3]])
    got = {r.product_id: r for r in history.product_history(df, targets(spark, (1, "train")), products(spark, 1, 2, 3, 5, 10)).collect()}
    assert set(got) == {1, 2, 3, 5, 10, 11}
    assert got[5].history_order_size == "3 3 3 1" and got[5].history_reorder_size == "0 1 2 1"
    assert (got[5].is_ordered_history, got[5].position_in_order_history, got[5].label) == ("0 1 1 0", "0 3 2 0", 0)
    assert got[2].label == 1 and got[11].product_name is None
    assert got[2].order_numbers == "1 2 3 4 5"


def test_product_history_of_test_users_and_single_orders(spark):
    both = lines(spark, [[1], [2]], user=1, last="prior").union(lines(spark, [[7, 8]], user=2))
    got = {(r.user_id, r.product_id): r for r in history.product_history_all(both, targets(spark, (1, "test"), (2, "train")), products(spark, 1, 2, 7, 8)).collect()}
    assert set(got) == {(1, 0), (1, 1), (2, 0), (2, 7), (2, 8)}
    assert got[1, 1].label == got[1, 0].label == -1
    assert got[2, 7].label == 0 and got[2, 0].label is None
    assert got[2, 7].order_numbers == "1"


def test_no_reorder_history(spark):
    df = lines(spark, [[1, 2], [1, 3], [1, 2, 4], [5, 6]], flags=[[0, 0], [1, 0], [1, 1, 0], [0, 0]])
    r = history.no_reorder_history(df, targets(spark, (1, "train"))).first()
    assert (r.is_ordered_history, r.history_order_size, r.history_reorder_size, r.label, r.position_in_order_history, r.product_name) == ("1 0 0", "2 2 3", "0 1 2", 1, "0 0 0", "")


def test_aisle_history(spark):
    aisles = {1: 1, 2: 1, 3: 2, 4: 3, 5: 3}
    df = lines(spark, [[1, 2, 3], [3, 4, 5], [1, 4], [3]], aisles=aisles)
    deps = spark.createDataFrame([(1, 9), (2, 9)], "aisle_id int, department_id int")
    got = {r.aisle_id: r for r in history.aisle_history(df, deps).collect()}
    assert (got[1].is_ordered_history, got[1].position_in_order, got[1].num_products_from_aisle, got[1].aisle_history_size) == ("1 0 1", "1 0 1", "2 0 1", "2 2 2")
    assert (got[3].position_in_order, got[3].num_products_from_aisle, got[3].department_id) == ("0 2 2", "0 2 1", None)


def test_aisles_with_nulls_and_two_baskets_of_one_number(spark):
    aisles = {1: 1, 2: None, 3: 2}
    df = lines(spark, [[2, 1], [3], [1]], aisles=aisles)
    df = df.union(df.filter("order_number = 2").withColumns({"order_id": F.lit(99), "aisle_id": F.lit(1)}))
    got = {r.aisle_id: r for r in history.aisle_history(df, spark.createDataFrame([(1, 9)], "aisle_id int, department_id int")).collect()}
    steps = lambda r: (r.is_ordered_history, r.position_in_order, r.num_products_from_aisle, r.aisle_history_size)
    assert steps(got[1]) == ("1 1 1", "2 1 1", "1 1 1", "1 1 1") and steps(got[2]) == ("0 1 1", "0 1 1", "0 1 1", "1 1 1")
    assert steps(got[None]) == ("1 0 0", "1 0 0", "1 0 0", "1 1 1") and got[None].department_id is None


def test_aisles_of_baskets_are_found_once(spark):
    df = history.aisle_history(lines(spark, [[1, 2], [1]], aisles={1: 1, 2: 2}), spark.createDataFrame([(1, 9)], "aisle_id int, department_id int"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"Aggregate\(.*collect_list\(struct\(add_to_cart_order", plan)) == 2  # partial and final
    assert not re.search(r"lambdafunction\([^\n]*map_from_entries", plan)


def test_aisle_training_of_lines(spark):
    df = lines(spark, [[1, 2, 3], [3, 1], [1, 2], [3]], aisles={1: 1, 2: 1, 3: 2}).union(lines(spark, [[2]], user=2, aisles={2: 1}))
    deps = spark.createDataFrame([(1, 9)], "aisle_id int, department_id int")
    for length in (2, 6):
        want = training.aisle_training(history.aisle_history(df, deps), length)
        got = training.aisle_training_of(df, deps, length)
        assert got.dtypes == want.dtypes and sorted(got.collect()) == sorted(want.collect()) and want.count() == 3
        texts = want.select(*(s.joined(c).alias(c) if t.startswith("array") else c for c, t in want.dtypes))
        assert sorted(training.aisle_training_of(df, deps, length, s.pad_text).collect()) == sorted(texts.collect())


def test_reorder_size(spark):
    df = lines(spark, [[1, 2, 3], [1, 2, 4], [1, 5, 3]], flags=[[0, 1, 0], [1, 1, 0], [1, 0, 1]]).union(lines(spark, [[1, 2, 3]], user=2, flags=[[0, 1, 1]]))
    got = {r.user_id: r for r in history.reorder_size(df).collect()}
    assert (got[1].order_sizes, got[1].reorder_sizes, got[1].label) == ([3, 3], [1, 2], 2)
    assert (got[2].order_sizes, got[2].reorder_sizes, got[2].label) == ([3], [2], 0)


def test_training_rows(spark):
    df = lines(spark, [[1, 2], [1, 3], [2]])
    row = training.reorder_size_training(history.reorder_size(df), 4).first()
    assert (row.order_sizes, row.history_length, row.order_numbers) == ([2, 2, 0, 0], 2, [1, 2, 3, 0])
    rows = history.product_history_all(df, targets(spark, (1, "train")), products(spark, 1, 2, 3))
    names = spark.createDataFrame([(1, "4 8"), (2, "9 7 6 5 4")], "product_id int, product_name_encoded string")
    got = {r.product_id: r for r in training.product_training(rows, names, 4, 4).collect()}
    assert (got[1].product_name_encoded, got[1].product_name_length) == ([4, 8, 0, 0], 2)
    assert (got[2].product_name_encoded, got[2].product_name_length) == ([9, 7, 6, 5], 4)
    assert (got[0].product_name_encoded, got[0].product_name_length, got[0].history_length) == ([0, 0, 0, 0], 0, 2)
    blank = spark.createDataFrame([(1, 1, 1, "test", *[""] * 8)], "user_id int, aisle_id int, department_id int, eval_set string, " + ", ".join(f"{c} string" for c in (*training.AISLE_STEPS, *history.TIMES)))
    row = training.aisle_training(blank, 3).first()
    assert row.is_ordered_history == [0, 0, 0] and row.days_since_prior_orders == [0.0, 0.0, 0.0] and row.history_length == 0


def test_vocabulary(spark):
    df = spark.createDataFrame([(1, "Apple Banana"), (2, "apple   carrot"), (3, "BANANA carrot"), (4, "apple durian"), (5, ""), (6, None)], "product_id int, product_name string")
    index = text.word_index(df, min_word_freq=2)
    assert {r.word: r.word_idx for r in index.collect()} == {"apple": 1, "banana": 2, "carrot": 3, "durian": 0}
    got = {r.product_id: r.product_name_encoded for r in text.encoded_names(df, index.filter("word <> 'carrot'")).collect()}
    assert got == {1: "1 2", 2: "1", 3: "2", 4: "1 0", 5: "0", 6: "0"}


def test_purchase_count(spark):
    df = lines(spark, [[1, 2], [1], [1]])
    got = {(r.user_id, r.product_id): r["count"] for r in baskets.user_product_count(df).collect()}
    assert got == {(1, 1): 2, (1, 2): 1}
    assert dict(baskets.user_product_count(df).dtypes)["count"] == "int"


def test_samples_belong_together(spark):
    orders = spark.createDataFrame([(i, i % 5) for i in range(20)], "order_id int, user_id int")
    some = sampling.belonging(orders, sampling.sample_users(orders, 2), "user_id")
    assert some.count() == 8 and some.select("user_id").distinct().count() == 2
    with pytest.raises(ValueError):
        sampling.sample_users(orders, 6)


@pytest.mark.parametrize("n, spread", [(0, 1), (1, 1), (500, 40), (500, 2)])
def test_ranks_are_places_in_the_order(spark, n, spread):
    r = random.Random(n + spread)
    rows = [(i, r.choice([None, *range(spread)]), r.choice("abc") + str(i % 7), r.choice([None, *range(9)])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a int, b string, v int").repartition(5)
    got = {x.id: (x.place, x.before) for x in ranked(df, [F.desc("a"), "b", "id"], "place", {"before": "v"}).collect()}
    want, total = {}, 0
    for place, (i, _, _, v) in enumerate(sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0), x[2], x[0])), 1):
        want[i] = (place, total)
        total += v or 0
    assert got == want


def test_ranks_need_no_single_partition(spark):
    df = ranked(spark.range(1000).withColumn("v", F.lit(1)), [F.desc("id")], "place", {"before": "v"})
    assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()


def test_further_columns_of_products_reach_training(spark):
    """The names' indexes come with the products, so that no history with texts is shuffled for them."""
    known = products(spark, 1, 2, 3).withColumn("product_name_encoded", F.concat_ws(" ", "product_id", F.lit("5")))
    rows = history.product_history_all(lines(spark, [[1, 2], [1, 3], [2]]), targets(spark, (1, "train")), known)
    assert rows.columns == [*history.PRODUCT_COLUMNS, "product_name_encoded"]
    got = {r.product_id: (r.product_name_encoded, r.product_name_length) for r in training.product_training(rows, None, 3, 4).collect()}
    assert got == {0: ([0, 0, 0], 0), 1: ([1, 5, 0], 2), 2: ([2, 5, 0], 2), 3: ([3, 5, 0], 2)}


def test_exchanges_grow_with_the_input(spark):
    """More rows are dealt into more partitions; what a session has is only made finer."""
    before = {n: spark.conf.get(n, None) for n in (exchanges._PARTS, exchanges._SIZE)}
    try:
        exchanges.sized(spark, 40 * exchanges.ROWS)
        exchanges.sized(spark, 10)
        assert spark.conf.get(exchanges._PARTS) == "40" and spark.conf.get(exchanges._SIZE) == f"{exchanges.TASK_MB}m"
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
