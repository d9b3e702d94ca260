"""Derived fields and boolean row rules.

Partition aggregates are joined to the rows rather than computed as windows: a null partition key joins nothing, so its fields are
null and rules on them pass; windows would take all nulls for one group, and can't count distinct values.

To count failures few rules need that join. ``split`` deals the rules out: those on the rows' own columns are counted in any pass over
the rows; those on the fields of one partitioning are judged once a group, a failing group counting as many rows as it has; only rules
that need both meet the rows again.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .errors import InvalidConstraintError
from .metrics import Metric

AGGREGATES = {
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "count": F.count,
    "count_distinct": F.countDistinct,
}


def _aggregate(field: dict) -> Column:
    kind = field["aggregation"]
    if kind == "conditional_count":
        if not field.get("condition"):
            raise InvalidConstraintError(f"{field['name']}: a conditional count needs a condition")
        return F.count_if(F.expr(field["condition"])).alias(field["name"])
    if kind not in AGGREGATES:
        raise InvalidConstraintError(f"{field['name']}: unsupported aggregation {kind!r}")
    if not field.get("column"):
        raise InvalidConstraintError(f"{field['name']}: {kind} needs a column")
    return AGGREGATES[kind](field["column"]).alias(field["name"])


def _named(items: list[dict], what: str, taken: list[str] = ()) -> None:
    names = [i.get("name") for i in items]
    if any(not n for n in names) or len(set(names)) < len(names) or set(names) & set(taken):
        raise InvalidConstraintError(f"{what} need names of their own")


def _partitions(df: DataFrame, fields: list[dict]) -> dict[tuple, list[Column]]:
    """Aggregates by the columns that they are partitioned by."""
    _named(fields, "derived fields", df.columns)
    by: dict[tuple, list[Column]] = {}
    for f in fields:
        if ("aggregation" in f) == ("expression" in f):
            raise InvalidConstraintError(f"{f['name']}: either an aggregation or an expression")
        if "aggregation" in f:
            keys = f.get("partition_by")
            if not isinstance(keys, list) or not keys or len(set(keys)) < len(keys) or set(keys) - set(df.columns):
                raise InvalidConstraintError(f"{f['name']}: partition_by needs a list of different columns of the table")
            by.setdefault(tuple(keys), []).append(_aggregate(f))
    return by


def with_derived_fields(df: DataFrame, fields: list[dict] | None) -> DataFrame:
    """Partition aggregates first, those of equal ``partition_by`` together; then expressions, in order."""
    fields = fields or []
    for keys, aggregates in _partitions(df, fields).items():
        df = df.join(df.dropna(subset=list(keys)).groupBy(*keys).agg(*aggregates), list(keys), "left")
    for f in fields:
        if "expression" in f:
            df = df.withColumn(f["name"], F.expr(f["expression"]))
    return df


#: Texts in an expression, names in backticks, other names.
_TEXT, _NAME = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\""), re.compile(r"`([^`]+)`|(\w+)")


def mentioned(expression: str, names: list[str]) -> set[str]:
    """Those of the names that may stand in an expression: none that it uses is left out."""
    words = {(a or b).lower() for a, b in _NAME.findall(_TEXT.sub(" ", expression))}
    return {n for n in names if n.lower() in words}


def groups(df: DataFrame, keys: tuple[str, ...], aggregates: list[Column], size: str) -> DataFrame:
    """A row for each group with its rows' number. Rows with a null in the key are groups too, whose fields are null."""
    made = df.groupBy(*keys).agg(F.count("*").alias(size), *aggregates)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(f"`{k}`").isNotNull()
    return made.withColumns({c: F.when(known, F.col(f"`{c}`")) for c in made.columns if c not in (*keys, size)})


class Parts(NamedTuple):
    """Rules by what they must be judged on."""

    rows: list[dict]
    by_group: dict[tuple[str, ...], list[dict]]
    both: list[dict]


class Judged:
    """The rules of a table and the frames they are judged on; nothing is read before a count is asked for."""

    def __init__(self, df: DataFrame, fields: list[dict] | None, rules: list[dict] | None):
        self.df, self.fields = df, fields or []
        rule_metrics(rules)
        partitions = _partitions(df, self.fields)
        self.size = next(n for n in ("n", *(f"n{i}" for i in range(10_000))) if n not in df.columns and all(n != f["name"] for f in self.fields))
        aggregated = {f["name"]: tuple(f["partition_by"]) for f in self.fields if "aggregation" in f}
        made = {f["name"]: f["expression"] for f in self.fields if "expression" in f}

        def needs(expression: str, seen: frozenset = frozenset()) -> set[str]:
            """Columns and aggregates that an expression comes down to."""
            found = mentioned(expression, [*df.columns, *aggregated, *made])
            return {n for n in found if n not in made} | {n for m in found if m in made and m not in seen for n in needs(made[m], seen | {m})}

        def place(expression: str):
            """The partitioning that the expression can be worked out on; () for the rows, None for both together."""
            used = needs(expression)
            by = {aggregated[n] for n in used if n in aggregated}
            if not by:
                return ()
            return next((k for k in by if len(by) == 1 and all(n in aggregated or n in k for n in used)), None)

        self.rows = df
        self.groups = {keys: groups(df, keys, aggregates, self.size) for keys, aggregates in partitions.items()}
        for name, expression in made.items():
            if (at := place(expression)) == ():
                self.rows = self.rows.withColumn(name, F.expr(expression))
            # On groups a field of rows is there too, if it needs their key alone.
            for keys in self.groups:
                if at == keys or (at == () and needs(expression) <= set(keys)):
                    self.groups[keys] = self.groups[keys].withColumn(name, F.expr(expression))
        self.parts = Parts([], {}, [])
        for r in rules or []:
            at = place(r["expression"])
            (self.parts.rows if at == () else self.parts.both if at is None else self.parts.by_group.setdefault(at, [])).append(r)

    def row_metrics(self) -> list[Metric]:
        """What can be counted in any pass over ``rows``."""
        return rule_metrics(self.parts.rows)

    def needed_fields(self, rules: list[dict]) -> list[dict]:
        """The derived fields that the rules, or fields needed by them, name."""
        texts, found = [r["expression"] for r in rules], []
        for f in reversed(self.fields):
            if any(mentioned(t, [f["name"]]) for t in texts):
                found.append(f)
                texts += [f["expression"]] if "expression" in f else []
        return found[::-1]

    def joined(self, rules: list[dict]) -> DataFrame:
        """The rows with the fields that the rules need."""
        return with_derived_fields(self.df, self.needed_fields(rules))

    def group_counts(self, but: set[tuple[str, ...]] = frozenset()) -> list[DataFrame]:
        """For each partitioning (``but`` some) one row of failures by rule: the rows of failing groups, from the groups alone."""
        failing = lambda r: F.coalesce(F.sum(F.when(~F.expr(r["expression"]), F.col(self.size))), F.lit(0)).alias(r["name"])
        return [self.groups[keys].agg(*map(failing, rules)) for keys, rules in self.parts.by_group.items() if keys not in but]

    def counts(self) -> dict[str, int]:
        """Failures of the rules that a pass over the rows can't count: an aggregate for each partitioning, and one for all rules
        that need rows and groups."""
        both = list(self.parts.both)
        # Groups that must meet the rows anyway have their own rules counted there too.
        met = {tuple(f["partition_by"]) for f in self.needed_fields(both) if "aggregation" in f}
        both += [r for keys, rs in self.parts.by_group.items() if keys in met for r in rs]
        found = [df.first().asDict() for df in self.group_counts(met)]
        if both:
            found.append(self.joined(both).agg(*(F.count_if(m.failed).alias(m.rule) for m in rule_metrics(both))).first().asDict())
        return {rule: n for row in found for rule, n in row.items()}

    def violations(self, rule: dict) -> DataFrame:
        """The rows (with the table's own columns) that break a rule. A rule on groups keeps the rows of failing groups, whose keys
        alone are joined."""
        if rule in self.parts.rows:
            return self.rows.filter(~F.expr(rule["expression"])).select(self.df.columns)
        if keys := next((k for k, rs in self.parts.by_group.items() if rule in rs), None):
            bad = self.groups[keys].filter(~F.expr(rule["expression"])).select(*(F.col(f"`{k}`").alias(f"_{i}") for i, k in enumerate(keys)))
            same = F.lit(True)
            for i, k in enumerate(keys):
                same = same & self.df[k].eqNullSafe(bad[f"_{i}"])
            return self.df.join(bad, same, "left_semi")
        return self.joined([rule]).filter(~F.expr(rule["expression"])).select(self.df.columns)


def rule_metrics(rules: list[dict] | None) -> list[Metric]:
    """A rule fails where its expression is false; null passes."""
    rules = rules or []
    _named(rules, "rules")
    if any(not isinstance(r.get("expression"), str) or not r["expression"].strip() for r in rules):
        raise InvalidConstraintError("a rule needs an expression")
    return [Metric(r["name"], "row_logic", (), ~F.expr(r["expression"])) for r in rules]


def violations(df: DataFrame, rule: dict) -> DataFrame:
    return df.filter(~F.expr(rule["expression"]))
