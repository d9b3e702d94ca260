"""Contracts: exact counts, null handling, thresholds, malformed contracts, and the gate."""

import json
import logging
import os

import pytest
from pyspark.sql import types as T

from basketspark.quality import contracts, gate, keys, metrics, rules
from basketspark.quality.contracts import column, contract
from basketspark.quality.errors import DataValidationError, EmptyDatasetError, InvalidConstraintError, InvalidContractError
from basketspark.quality.loader import load_contract
from basketspark.quality.wellformed import check_contract
from basketspark.sources import schema
from basketspark.sources.files import read_parquet

ORDER_SCHEMA = "order_id int, user_id int, eval_set string, order_number int, order_dow int, order_hour_of_day int, days_since_prior_order double"
ORDERS = [(1, 1, "prior", 1, 0, 9, None), (2, 1, "prior", 2, 1, 9, 5.0), (3, 1, "train", 3, 2, 9, 7.0), (4, 2, "prior", 1, 3, 9, None), (5, 2, "test", 2, 4, 9, 10.0)]


def orders(spark, change=None):
    rows = [list(r) for r in ORDERS]
    for (i, j), v in (change or {}).items():
        rows[i][j] = v
    return spark.createDataFrame([tuple(r) for r in rows], ORDER_SCHEMA)


def failed(spark, change):
    return {r[1] for r in gate.findings(orders(spark, change), contracts.ORDERS).rows if r[7] == "failed"}


def test_valid_orders_pass(spark):
    report = gate.validate(orders(spark), contracts.ORDERS)
    assert report.can_continue and not report.has_warning and report.frame(spark).count() == len(report.rows)


@pytest.mark.parametrize(
    "change, rule",
    [
        ({(0, 0): 2}, "order_id_uniqueness"),
        ({(0, 1): 0}, "user_id_range"),
        ({(0, 2): "other"}, "eval_set_allowed_values"),
        ({(1, 6): None}, "later_orders_must_have_prior_interval"),
        ({(0, 6): 3.0}, "first_order_has_no_prior_interval"),
        ({(2, 2): "prior"}, "last_order_per_user_is_train_or_test"),
        ({(1, 2): "train"}, "only_one_train_or_test_per_user"),
        ({(2, 3): 4}, "contiguous_order_numbers"),
        ({(2, 4): None}, "order_dow_nullability"),
    ],
)
def test_one_wrong_cell(spark, change, rule):
    assert rule in failed(spark, change)


def test_threshold_boundary(spark):
    c = contract("t", [], [column("n", thresholds={"range": {"max_failed_percent": 20.0}}, minimum=1)])
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (4,)], "n int")
    report = gate.validate(df, c)
    assert report.has_warning and report.rows[-1][4:9] == (1, 5, 20.0, "warning", "warning")
    c["schema"][0]["thresholds"]["range"]["max_failed_percent"] = 19.9
    with pytest.raises(DataValidationError) as e:
        gate.validate(df, c)
    assert e.value.report.has_errors


def test_column_metrics_ignore_nulls(spark):
    c = {"schema": [column("a", "string", True, allowed_values=["x"], pattern="^x", minimum_length=1), column("l", "array<int>", True, minimum_items=1, maximum_items=2), column("d", "double", False, minimum=0, maximum=1)]}
    df = spark.createDataFrame([("x", [1], 0.0), (None, None, None), ("yy", [], 1.0), ("", [1, 2, 3], 1.1)], "a string, l array<int>, d double")
    got = metrics.counted(df, metrics.column_metrics(c)).first().asDict()
    assert got == {"total": 4, "a_allowed_values": 2, "a_string_length": 1, "a_pattern": 2, "l_array_length": 2, "d_nullability": 1, "d_range": 1}


def test_keys_leave_nulls_out(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (1, None), (2, 1), (2, 1), (2, 1)], "a int, b int")
    assert tuple(keys.uniqueness(df, ["a", "b"]).first()) == (5, 2)
    parent = spark.createDataFrame([(1, 1), (None, 5)], "x int, y int")
    assert keys.orphans(df, parent, ["a", "b"], ["x", "y"]).count() == 3
    for bad in ([], ["a", "a"], ["z"], "a"):
        with pytest.raises(InvalidConstraintError):
            keys.uniqueness(df, bad)
    with pytest.raises(InvalidConstraintError):
        keys.orphans(df, parent, ["a"], ["x", "y"])


def test_null_partition_keys_never_fail(spark):
    df = orders(spark, {(1, 1): None, (2, 1): None})
    got = rules.with_derived_fields(df, contracts.ORDERS["derived_fields"])
    assert {r.order_id: r.greatest_number for r in got.collect()} == {1: 1, 2: None, 3: None, 4: 2, 5: 2}
    bad = rules.violations(got, {"expression": "greatest_number = 99"})
    assert sorted(r.order_id for r in bad.collect()) == [1, 4, 5]


def test_derived_fields_in_order(spark):
    fields = [{"name": "n", "aggregation": "sum", "column": "order_number", "partition_by": ["user_id"]}, {"name": "m", "expression": "n + 1"}, {"name": "k", "expression": "m * 2"}]
    assert {r.k for r in rules.with_derived_fields(orders(spark), fields).collect()} == {14, 8}


@pytest.mark.parametrize(
    "field",
    [
        {"name": "x"},
        {"name": "x", "expression": "1", "aggregation": "min"},
        {"name": "x", "aggregation": "median", "column": "order_id", "partition_by": ["user_id"]},
        {"name": "x", "aggregation": "min", "partition_by": ["user_id"]},
        {"name": "x", "aggregation": "min", "column": "order_id", "partition_by": []},
        {"name": "x", "aggregation": "min", "column": "order_id", "partition_by": ["user_id", "user_id"]},
        {"name": "x", "aggregation": "conditional_count", "partition_by": ["user_id"]},
        {"name": "order_id", "expression": "1"},
    ],
)
def test_malformed_derived_fields(spark, field):
    with pytest.raises(InvalidConstraintError):
        rules.with_derived_fields(orders(spark), [field])


@pytest.mark.parametrize("of", [{"allowed_values": "x"}, {"allowed_values": []}, {"allowed_values": [1]}, {"pattern": " "}, {"pattern": "("}, {"minimum_length": 3, "maximum_length": 1}, {"minimum": "a"}, {"minimum_length": -1}])
def test_malformed_constraints(of):
    with pytest.raises(InvalidConstraintError):
        metrics.column_metrics({"schema": [column("a", "string", True, **of)]})


def test_malformed_thresholds_and_rules(spark):
    for t in ({"max_failed_percent": 101}, {"max_failed_percent": "5"}, {"severity": "bad"}):
        with pytest.raises(InvalidConstraintError):
            gate.threshold({"schema": [column("a", thresholds={"range": t})]}, "a", "range")
    for bad in ([{"name": "a"}], [{"name": "a", "expression": " "}], [{"name": "a", "expression": "1"}, {"name": "a", "expression": "1"}]):
        with pytest.raises(InvalidConstraintError):
            rules.rule_metrics(bad)
    with pytest.raises(InvalidConstraintError):
        keys.foreign_keys({"relationships": [{"name": "f", "type": "foreign_key", "child_columns": ["a"], "parent": {"dataset": "p", "columns": ["a", "b"]}}]})
    assert keys.foreign_keys({"relationships": [{"type": "other"}]}) == []


def test_columns_and_types(spark):
    c = contract("t", [], [column("a"), column("b", "array<double>")])
    with pytest.raises(DataValidationError) as e:
        gate.validate(spark.createDataFrame([(1, 2)], "a int, c int"), c)
    assert e.value.report.rows == [] and "missing" in str(e.value) and "unexpected" in str(e.value)
    with pytest.raises(DataValidationError):
        gate.validate(spark.createDataFrame([("1", [1.0])], "a string, b array<double>"), c)
    assert schema.accepts("long", T.IntegerType()) and schema.accepts("array<number>", T.ArrayType(T.FloatType())) and not schema.accepts("float", T.DoubleType())
    assert schema.spark_schema(c)["b"].dataType == T.ArrayType(T.DoubleType())
    for bad in ("array<>", "map"):
        with pytest.raises(InvalidContractError):
            schema.data_type(bad)


def test_empty_and_missing_parent(spark):
    with pytest.raises(EmptyDatasetError):
        gate.validate(orders(spark).limit(0), contracts.ORDERS)
    lines = spark.createDataFrame([(1, 1, 1, 0)], "order_id int, product_id int, add_to_cart_order int, reordered int")
    with pytest.raises(ValueError):
        gate.validate(lines, contracts.ORDER_PRODUCTS)


def test_nothing_is_written_on_failure(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(DataValidationError):
        gate.gated_write(orders(spark, {(0, 0): 2}), contracts.ORDERS, out)
    assert not os.path.exists(out) and os.listdir(tmp_path) == []
    gate.gated_write(orders(spark), contracts.ORDERS, out)
    assert read_parquet(spark, out).count() == 5
    with pytest.raises(DataValidationError):
        gate.gated_write(orders(spark, {(0, 1): 0}), contracts.ORDERS, out)
    assert read_parquet(spark, out).count() == 5 and os.listdir(tmp_path) == ["out"]
    gate.gated_write(orders(spark).filter("user_id = 1"), contracts.ORDERS, out)
    gate.gated_write(read_parquet(spark, out), contracts.ORDERS, out)  # a table may replace itself
    assert read_parquet(spark, out).count() == 3 and os.listdir(tmp_path) == ["out"]
    assert gate.violation_samples(orders(spark, {(2, 3): 4}), contracts.ORDERS)["contiguous_order_numbers"].count() == 3


GOOD = {"name": "a", "type": "integer", "nullable": True}


@pytest.mark.parametrize(
    "bad, said",
    [
        (None, "mapping"),
        ([], "mapping"),
        ({}, "mapping"),
        ({"name": "t"}, "schema"),
        ({"schema": {"a": 1}}, "schema"),
        ({"schema": []}, "schema"),
        ({"schema": ["a"]}, "column 0"),
        ({"schema": [{"type": "integer", "nullable": True}]}, "name is missing"),
        ({"schema": [{**GOOD, "name": " "}]}, "name is not usable"),
        ({"schema": [{**GOOD, "name": 3}]}, "name is not usable"),
        ({"schema": [{"name": "a", "nullable": True}]}, "type is missing"),
        ({"schema": [{**GOOD, "type": 7}]}, "type is not usable"),
        ({"schema": [{"name": "a", "type": "integer"}]}, "nullable is missing"),
        ({"schema": [{**GOOD, "nullable": "yes"}]}, "nullable is not usable"),
        ({"schema": [{**GOOD, "constraints": []}]}, "constraints is not usable"),
        ({"schema": [GOOD, GOOD]}, "listed 2 times"),
    ],
)
def test_malformed_contracts(spark, bad, said):
    for use in (gate.validate, gate.findings, lambda df, c: gate.gated_write(df, c, "/nowhere")):
        with pytest.raises(InvalidContractError, match=said):
            use(orders(spark), bad)


def test_every_contract_is_well_formed():
    for c in contracts.CONTRACTS.values():
        check_contract(c)


@pytest.mark.parametrize("kind", [" INTEGER ", "Integer", "ARRAY< String >", "array<array< LONG>>"])
def test_type_names_are_normalised(kind):
    made = schema.data_type(kind)
    assert schema.accepts(kind, made) and not schema.accepts(kind, T.DateType())


def test_samples_and_messages_of_keys(spark):
    df = spark.createDataFrame([(i % 40, i % 3) for i in range(100)] + [(None, 1)] * 3, "a int, b int")
    c = contract("t", ["a"], [column("a", "integer", True), column("b", "integer", True)], foreign={"b_fk": (["b"], "p", ["x"])})
    parent = {"p": spark.createDataFrame([(0,)], "x int")}
    some = gate.key_samples(df, c)["a_uniqueness"].collect()
    assert [(r.a, r.n) for r in some] == [(i, 3) for i in range(20)] + [(i, 2) for i in range(20, 30)]
    assert [(r.b, r.n) for r in gate.orphan_samples(df, c, parent)["b_fk"].collect()] == [(1, 36), (2, 33)]
    report = gate.findings(df, c, parent)
    assert report.duplicate_keys == {"a_uniqueness": 40} and "40 keys" in report.messages()["a_uniqueness"]
    assert {r.rule_name: r.duplicate_keys for r in report.details(spark).collect()} == {"a_uniqueness": 40, "b_fk": None}


YAML = """
dataset:
  name: orders
  allow_extra_columns: false
  grain: [order_id, user_id]
schema:
  - {name: order_id, type: integer, nullable: false, constraints: {minimum: 1, unique: true}, thresholds: {range: {max_failed_percent: 2.5, severity: critical}}}
  - {name: user_id, type: integer, nullable: true}
derived_fields:
  - {name: orders, aggregation: count, column: order_id, partition_by: [user_id]}
rules:
  - name: few
    expression: >
      orders <= 3
      AND order_id > 0
"""


def test_contract_files(spark, tmp_path):
    (tmp_path / "c.yaml").write_text(YAML)
    c = load_contract(tmp_path / "c.yaml")
    assert (c["name"], c["grain"], c["allow_extra_columns"], len(c["schema"]), len(c["rules"])) == ("orders", ["order_id", "user_id"], False, 2, 1)
    assert load_contract(str(tmp_path / "c.yaml"), spark) == c
    (tmp_path / "c.json").write_text(json.dumps(c))
    assert load_contract(tmp_path / "c.json") == c
    df = spark.createDataFrame([(i, i // 4) for i in range(1, 10)], "order_id int, user_id int")
    report = gate.findings(df, c)
    assert {r[1]: r[4] for r in report.rows if r[4]} == {"few": 4} and report.has_errors
    for name, text in (("a.yaml", ""), ("b.yaml", "- 1"), ("c.yaml", "a: [1"), ("d.yaml", "dataset: 3"), ("e.yaml", "dataset: {name: x}"), ("f.json", "{"), ("g.json", "")):
        (tmp_path / name).write_text(text)
        with pytest.raises(InvalidContractError):
            load_contract(tmp_path / name)
    for more in ({}, {"spark": spark}):
        with pytest.raises(FileNotFoundError):
            load_contract(tmp_path / "none.yaml", **more)


def test_findings_are_logged_at_their_level(spark, caplog):
    c = contract("t", [], [column("n", thresholds={"range": {"max_failed_percent": 50.0}}, minimum=1), column("m", minimum=1)], {"r": "n < 3"})
    with caplog.at_level(logging.INFO, "basketspark"), pytest.raises(DataValidationError):
        gate.validate(spark.createDataFrame([(0, 0), (1, 1), (3, 1)], "n int, m int"), c)
    assert [(r.levelname, r.args[1]) for r in caplog.records if r.name == gate.LOG.name] == [("WARNING", "n_range"), ("ERROR", "m_range"), ("CRITICAL", "r")]
    caplog.clear()
    with caplog.at_level(logging.INFO, "basketspark"):
        gate.validate(spark.createDataFrame([(1, 1)], "n int, m int"), c)
    assert [r.message for r in caplog.records if r.name == gate.LOG.name] == ["dataset t passed its contract"]
