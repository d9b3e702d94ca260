"""Raw CSV files through all jobs; every table meets its contract."""

import pytest

from basketspark import __main__ as cli
from basketspark.operators import baskets, history
from basketspark.plans import jobs
from basketspark.quality import contracts
from basketspark.quality.errors import DataValidationError
from basketspark.sources.files import read_csv, read_parquet
from basketspark.sources.schema import spark_schema

RAW = {
    "aisles": ["aisle_id,aisle", "1,fresh fruits", "2,milk", "3,paper"],
    "departments": ["department_id,department", "1,produce", "2,dairy"],
    "products": ["product_id,product_name,aisle_id,department_id", "10,Banana,1,1", '20,"Milk 5\\"\\" Whole, Organic",2,2', "30,Organic Banana,1,1", "40,Paper,3,2"],
    "orders": ["order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order", "1,1,prior,1,0,8,", "2,1,prior,2,1,9,5.0", "3,1,train,3,2,10,7.0", "4,2,prior,1,3,8,", "5,2,prior,2,3,8,1.0", "6,2,test,3,4,9,10.0"],
    "order_products__prior": ["order_id,product_id,add_to_cart_order,reordered", "1,10,1,0", "1,20,2,0", "2,10,1,1", "2,30,2,0", "4,40,1,0", "5,40,1,1"],
    "order_products__train": ["order_id,product_id,add_to_cart_order,reordered", "3,30,1,1", "3,10,2,1"],
}


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    for name, rows in RAW.items():
        (path / f"{name}.csv").write_text("\n".join(rows) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    reports = jobs.bronze(spark, raw, out)
    reports["silver"] = jobs.order_products(spark, out, f"{out}/silver")
    reports["users"] = jobs.user_data(spark, f"{out}/silver", f"{out}/users")
    reports["history"] = jobs.product_history(spark, f"{out}/silver", out, f"{out}/history")
    reports["training"] = jobs.product_training(spark, f"{out}/history", f"{out}/products", f"{out}/training", 1, 6, 8)
    reports["aisles_h"] = jobs.aisle_history(spark, f"{out}/silver", f"{out}/products", f"{out}/aisle_history")
    reports["aisles_t"] = jobs.aisle_training(spark, f"{out}/aisle_history", f"{out}/aisle_training", 8)
    reports["sizes"] = jobs.reorder_size_training(spark, f"{out}/silver", f"{out}/sizes", 8)
    reports["counts"] = jobs.user_product_count(spark, f"{out}/silver", f"{out}/counts")
    return out, reports


def test_every_table_passes(built):
    _, reports = built
    assert all(r.can_continue and not r.has_warning for r in reports.values())


def test_tables(spark, built):
    out, _ = built
    read = lambda n: read_parquet(spark, f"{out}/{n}")
    assert read("products").filter("product_id = 20").first().product_name == 'Milk 5" Whole, Organic'
    assert read("silver").columns == baskets.LINE_COLUMNS and read("silver").filter("days_since_prior_order = -1").count() == 3
    assert {r.user_id: (r.product_ids, r.eval_set) for r in read("users").collect()} == {1: ("10_20 10_30 30_10", "train"), 2: ("40 40", "test")}
    assert {(r.user_id, r.product_id): r.label for r in read("history").collect()} == {(1, 0): 0, (1, 10): 1, (1, 20): 0, (1, 30): 1, (2, 0): -1, (2, 40): -1}
    assert read("training").filter("product_id = 30").first().product_name_length == 2
    assert {(r.user_id, r.product_id): r["count"] for r in read("counts").collect()}[1, 10] == 2
    assert {r.user_id: r.label for r in read("sizes").collect()} == {1: 2, 2: 1}


def test_gold_from_staged_baskets(spark, built, tmp_path):
    """One job for all tables gives what each job gives."""
    out, _ = built
    reports = jobs.gold(spark, f"{out}/silver", out, str(tmp_path), 8)
    single = {"users": "users", "product_history": "history", "aisle_history": "aisle_history", "reorder_size_training": "sizes", "user_product_count": "counts"}
    assert list(reports) == list(single) and all(r.can_continue for r in reports.values())
    for made, name in single.items():
        got, want = read_parquet(spark, str(tmp_path / made)), read_parquet(spark, f"{out}/{name}")
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())), made


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_shuffled_once_for_staged_tables(spark, built, tmp_path):
    out, _ = built
    made = history.staged_baskets(read_parquet(spark, f"{out}/silver"))
    assert plan(made).count("Exchange hashpartitioning") == 1
    made.write.parquet(str(tmp_path / "b"))
    staged = spark.read.parquet(str(tmp_path / "b"))
    assert "items:array<struct<product_id:int>>" in plan(baskets.counts_of(staged))  # only what is needed is read
    assert "items" not in plan(staged.select("user_id", "order_dow"))


def test_bucketed_lines_need_no_exchange(spark, built, tmp_path):
    out, _ = built
    assert jobs.bucketed_lines(spark, f"{out}/silver", "lines_by_user", 2, str(tmp_path / "t"), most_of_one=0.9)
    lines, plain = spark.table("lines_by_user"), read_parquet(spark, f"{out}/silver")
    for make in (baskets.user_product_count, baskets.order_sequences, lambda x: baskets.user_sequences(baskets.order_sequences(x))):
        assert "Exchange" not in plan(make(lines)) and "Exchange" in plan(make(plain))
        assert sorted(map(str, make(lines).collect())) == sorted(map(str, make(plain).collect()))
    spark.sql("DROP TABLE lines_by_user")
    assert not jobs.bucketed_lines(spark, f"{out}/silver", "hot", 2, str(tmp_path / "h"), most_of_one=0.3)  # one user has most lines
    assert not spark.catalog.tableExists("hot")


def test_unknown_product_stops_the_silver_job(spark, built, tmp_path):
    out, _ = built
    for n in ("orders", "products", "order_products__prior", "order_products__train"):
        df = read_parquet(spark, f"{out}/{n}")
        (df.filter("product_id <> 40") if n == "products" else df).write.parquet(str(tmp_path / n))
    with pytest.raises(DataValidationError):
        jobs.order_products(spark, str(tmp_path), str(tmp_path / "silver"))
    assert not (tmp_path / "silver").exists()


def test_sample(spark, raw, tmp_path):
    jobs.sample(spark, raw, str(tmp_path), 1)
    orders = read_csv(spark, str(tmp_path / "orders.csv"), spark_schema(contracts.ORDERS))
    assert orders.select("user_id").distinct().count() == 1 and orders.count() == 3
    lines = read_csv(spark, str(tmp_path / "order_products__prior.csv"), spark_schema(contracts.ORDER_PRODUCTS))
    assert {r.order_id for r in lines.collect()} <= {r.order_id for r in orders.collect()} and lines.count()
    assert read_csv(spark, str(tmp_path / "aisles.csv")).count() == 3
    with pytest.raises(ValueError):
        jobs.sample(spark, raw, str(tmp_path / "more"), 9)


def test_command_line(spark, raw, tmp_path, caplog):
    assert cli.main(["bronze", "--csv-path", raw, "--out", str(tmp_path / "b")]) == 0
    assert cli.main(["order-products", "--bronze-path", str(tmp_path / "b"), "--out", str(tmp_path / "s")]) == 0
    assert cli.main(["gold", "--silver-path", str(tmp_path / "s"), "--bronze-path", str(tmp_path / "b"), "--out", str(tmp_path / "g"), "--pad-length", "8"]) == 0
    assert read_parquet(spark, str(tmp_path / "g" / "reorder_size_training")).first().order_sizes.__len__() == 8
    assert "dataset products passed its contract" in caplog.text or not caplog.records
    with pytest.raises(SystemExit):
        cli.main(["bronze", "--out", "x"])
    with pytest.raises(Exception):
        cli.main(["user-data", "--silver-path", str(tmp_path / "nowhere"), "--out", str(tmp_path / "u")])
