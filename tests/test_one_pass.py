"""The gate's single passes against what they replace: key by key, foreign key by foreign key, rule by rule over joined rows."""

import random

import pytest
from pyspark.sql import functions as F

from basketspark.quality import contracts, gate, keys, rules
from basketspark.quality.contracts import column, contract
from basketspark.quality.errors import InvalidConstraintError


def table(spark, seed, n=400):
    r = random.Random(seed)
    rows = [(r.choice([None, *range(20)]), r.choice([None, "a", "b", "", "c" * 50]), r.choice([0.0, -0.0, 1.5, None]), r.randrange(n), r.choice([1, 1, 1, 2, None])) for _ in range(n)]
    return spark.createDataFrame(rows, "a int, b string, c double, d long, e int")


KEYS = [["a"], ["b", "a"], ["a", "b"], ["c"], ["d"], ["a", "b", "c"], ["e", "d"]]


@pytest.mark.parametrize("bits", [64, 9, 3, 0])
def test_keys_of_one_pass(spark, bits):
    """Few bits make different keys meet under one hash: they are counted again, exactly."""
    df = table(spark, 1)
    assert keys.uniqueness_of(df, KEYS, bits) == [tuple(keys.uniqueness(df, k).first()) for k in KEYS]
    assert keys.uniqueness_of(df, []) == [] and keys.uniqueness_of(df.limit(0), [["a"]]) == [(0, 0)]
    for bad in ([[]], [["z"]], [["a", "a"]]):
        with pytest.raises(InvalidConstraintError):
            keys.uniqueness_of(df, bad)


def test_keys_are_dealt_before_they_are_summed(spark):
    df = spark.range(100).selectExpr("id AS a", "id % 7 AS b")
    met = keys._met(df, [["a"], ["b"]], [keys._hashes(k, 64) for k in (["a"], ["b"])])
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan.split("Exchange")[1]
    assert sorted(r.n for r in met.collect()) == [14] * 5 + [15] * 2


def test_keys_need_one_scan(spark, tmp_path):
    table(spark, 1).write.parquet(str(tmp_path / "t"))
    df, scans = spark.read.parquet(str(tmp_path / "t")), []
    tagged = keys._tagged(df, [["a"], ["b", "a"], ["d"]])
    plan = tagged.groupBy("_key").count()._jdf.queryExecution().executedPlan().toString()
    scans = plan.count("FileScan parquet")
    assert scans == 1


FOREIGN = [
    {"name": "f0", "child_columns": ["a"], "dataset": "p", "parent_columns": ["x"]},
    {"name": "f1", "child_columns": ["a", "b"], "dataset": "p", "parent_columns": ["x", "y"]},
    {"name": "f2", "child_columns": ["d"], "dataset": "q", "parent_columns": ["z"]},
]


@pytest.mark.parametrize("seed", range(3))
def test_foreign_keys_of_one_pass(spark, seed):
    child, r = table(spark, seed), random.Random(seed)
    parents = {
        "p": spark.createDataFrame([(r.choice([None, *range(0, 20, 2)]), r.choice([None, "a", "b"])) for _ in range(60)], "x long, y string"),
        "q": spark.createDataFrame([(i % 100,) for i in range(300)], "z int"),
    }
    each = [keys.orphans(child, parents[f["dataset"]], f["child_columns"], f["parent_columns"]) for f in FOREIGN]
    assert keys.orphan_counts(child, parents, FOREIGN) == [df.count() for df in each]
    some = keys.orphan_samples(child, parents, FOREIGN, 5).collect()
    for f, df in zip(FOREIGN, each, strict=True):
        want = df.groupBy(*f["child_columns"]).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *f["child_columns"]).limit(5).collect()
        got = sorted((s for s in some if s.rule_name == f["name"]), key=lambda s: s.place)
        assert [(*(s[c] for c in f["child_columns"]), s.n) for s in got] == list(map(tuple, want))
    none = {p: df.limit(0) for p, df in parents.items()}
    assert keys.orphan_counts(child, none, FOREIGN) == [child.dropna(subset=f["child_columns"]).count() for f in FOREIGN]
    assert keys.orphan_counts(child.limit(0), parents, FOREIGN) == [0, 0, 0] and keys.orphan_counts(child, parents, []) == []


FIELDS = [
    {"name": "least", "aggregation": "min", "column": "d", "partition_by": ["a"]},
    {"name": "kinds", "aggregation": "count_distinct", "column": "b", "partition_by": ["a"]},
    {"name": "ones", "aggregation": "conditional_count", "condition": "e = 1", "partition_by": ["a"]},
    {"name": "by_two", "aggregation": "max", "column": "d", "partition_by": ["a", "b"]},
    {"name": "twice", "expression": "d * 2"},
    {"name": "wide", "expression": "kinds > 3 AND least < 100"},
    {"name": "over", "expression": "twice - least"},
]
RULES = {
    "row": "d > 20 OR e = 1",
    "row_field": "twice < 600",
    "group": "kinds >= 4",
    "group_field": "wide",
    "group_and_key": "a < 10 OR ones > 8",
    "group_of_two": "by_two > 350",
    "group_of_two_with_key": "b <> 'a' OR by_two > 300",
    "null_group": "least IS NOT NULL",
    "null_group_key": "coalesce(a, -1) <> -1 OR kinds IS NOT NULL",
    "both": "d <> least",
    "both_field": "over > 30",
    "two_partitionings": "by_two > least",
    "word_in_text": "b <> 'least' OR d < 0",
    "lambda": "forall(array(d), least -> least < 300)",
}


@pytest.mark.parametrize("seed", range(2))
def test_rules_by_group_are_rules_over_rows(spark, seed):
    df = table(spark, seed)
    listed = [{"name": n, "expression": e} for n, e in RULES.items()]
    judged = rules.Judged(df, FIELDS, listed)
    names = lambda rs: [r["name"] for r in rs]
    assert names(judged.parts.rows) == ["row", "row_field", "word_in_text"]
    assert {k: names(v) for k, v in judged.parts.by_group.items()} == {("a",): ["group", "group_field", "group_and_key", "null_group", "null_group_key"], ("a", "b"): ["group_of_two", "group_of_two_with_key"]}
    joined = rules.with_derived_fields(df, FIELDS)
    want = {n: joined.filter(~F.expr(e)).count() for n, e in RULES.items()}
    counted = judged.rows.agg(*(F.count_if(m.failed).alias(m.rule) for m in judged.row_metrics())).first().asDict()
    assert counted | judged.counts() == want and sum(n > 0 for n in want.values()) >= 11
    # Without rules that need both, groups alone are read.
    alone = [r for r in listed if r["name"] not in ("both", "both_field", "two_partitionings", "lambda")]
    assert rules.Judged(df, FIELDS, alone).counts() == {n: want[n] for n in names(alone) if n not in counted}
    for r in listed:
        got = sorted(map(str, judged.violations(r).collect()))
        assert got == sorted(map(str, joined.filter(~F.expr(r["expression"])).select(df.columns).collect()))


def test_rules_on_groups_join_nothing(spark):
    judged = rules.Judged(table(spark, 0), FIELDS, [{"name": n, "expression": RULES[n]} for n in ("group", "group_field", "group_of_two")])
    for df in judged.group_counts():
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_all_samples_at_once(spark):
    df = table(spark, 4)
    c = {"name": "t", "grain": ["d"], "schema": [], "derived_fields": FIELDS, "rules": [{"name": n, "expression": e} for n, e in RULES.items()]}
    found = gate.violation_rows(df, c)
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    got: dict = {}
    for r in sorted(found.collect(), key=lambda r: r.place):
        got.setdefault(r.rule_name, []).append(r.d)
    joined = rules.with_derived_fields(df, FIELDS)
    assert got == {n: [r.d for r in joined.filter(~F.expr(e)).orderBy("d").limit(20).collect()] for n, e in RULES.items() if joined.filter(~F.expr(e)).count()}
    assert {r.rule_name for r in gate.violation_rows(df, c, ["row", "both"]).collect()} == {"row", "both"}
    assert gate.violation_rows(df, c, []).count() == 0


def test_a_failed_write_tells_samples(spark, tmp_path):
    c = contract("t", ["a"], [column("a", "integer", True), column("b", "integer", True)], {"below": "b < 2"}, foreign={"b_fk": (["b"], "p", ["x"])})
    df = spark.createDataFrame([(i % 7, i % 3) for i in range(50)], "a int, b int")
    with pytest.raises(gate.DataValidationError) as e:
        gate.gated_write(df, c, str(tmp_path / "t"), {"p": spark.createDataFrame([(0,)], "x int")})
    found = e.value.report.samples
    assert {n: len(rows) for n, rows in found.items()} == {"a_uniqueness": 7, "b_fk": 2, "below": 16}
    assert [(r.a, r.n) for r in found["a_uniqueness"]][:2] == [(0, 8), (1, 7)] and [(r.b, r.n) for r in found["b_fk"]] == [(1, 17), (2, 16)]
    assert contracts.CONTRACTS and not list(tmp_path.iterdir())
