"""The gate: columns, types, column constraints, keys, foreign keys and rules; a report; and writing only what passed.

A table is read as seldom as can be. What needs rows alone (constraints, rules on a row's own columns) is one aggregate, which a
gated write gets as it writes; all keys are one pass, all foreign keys one, the rules on one partitioning one over its groups, and rules
that need rows and groups one. Samples of what failed are one pass for rules, one for keys and one for foreign keys.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources import versions
from ..sources.files import write_parquet
from ..sources.schema import accepts
from . import keys, metrics, rules
from .errors import DataValidationError, EmptyDatasetError, InvalidConstraintError
from .wellformed import check_contract

LOG = logging.getLogger(__name__)
SEVERITIES = ("info", "warning", "error", "critical")
LEVELS = {"info": logging.INFO, "warning": logging.WARNING, "error": logging.ERROR, "critical": logging.CRITICAL}
#: Offending rows that are shown: by duplicate keys, by foreign key, by rule.
SAMPLES = {"uniqueness": 30, "foreign_key": 20, "row_logic": 20}
REPORT = "dataset string, rule_name string, category string, columns string, failed_count long, total long, failed_percent double, status string, severity string, passed boolean"
#: More on a finding: how many keys occur twice or more, and how to say it.
DETAIL = "dataset string, rule_name string, duplicate_keys long, message string"


@dataclass
class Report:
    dataset: str
    rows: list[tuple] = field(default_factory=list)
    duplicate_keys: dict[str, int] = field(default_factory=dict)
    #: Of a write that failed: some offending rows or keys by rule.
    samples: dict[str, list[Row]] = field(default_factory=dict)

    @property
    def has_errors(self) -> bool:
        return any(r[7] == "failed" for r in self.rows)

    @property
    def has_warning(self) -> bool:
        return any(r[7] == "warning" for r in self.rows)

    @property
    def can_continue(self) -> bool:
        return not self.has_errors

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, REPORT)

    def messages(self) -> dict[str, str]:
        """What each finding says, by rule."""
        out = {}
        for _, rule, category, columns, failed, total, percent, status, _, _ in self.rows:
            what = {"uniqueness": f"rows share a key ({columns})", "foreign_key": f"rows have no parent ({columns})", "row_logic": "rows break the rule"}.get(category, f"values fail {category} ({columns})")
            more = f", {self.duplicate_keys[rule]} keys" if rule in self.duplicate_keys else ""
            out[rule] = f"{status}: {failed} of {total} {what}{more}, {percent:.2f} %"
        return out

    def log(self) -> None:
        """What didn't pass, each at its severity's level; or that all did."""
        said = self.messages()
        for r in self.rows:
            if r[7] != "passed":
                LOG.log(LEVELS[r[8]], "%s, %s: %s", self.dataset, r[1], said[r[1]])
        if not self.has_errors:
            LOG.info("dataset %s passed its contract", self.dataset)

    def details(self, spark: SparkSession) -> DataFrame:
        said = self.messages()
        return spark.createDataFrame([(self.dataset, r, self.duplicate_keys.get(r), m) for r, m in said.items()], DETAIL)


def threshold(contract: dict, column: str, category: str) -> tuple[float, str]:
    """(percent that may fail, severity beyond it)."""
    of = next((c.get("thresholds") or {} for c in contract["schema"] if c["name"] == column), {}).get(category) or {}
    most, severity = of.get("max_failed_percent", 0.0), of.get("severity", "error")
    if isinstance(most, bool) or not isinstance(most, (int, float)) or not 0 <= most <= 100:
        raise InvalidConstraintError(f"{column}: max_failed_percent must be from 0 to 100")
    if severity not in SEVERITIES:
        raise InvalidConstraintError(f"{column}: unknown severity {severity!r}")
    return float(most), severity


def judged(failed: int, total: int, most: float, severity: str) -> tuple[float, str, str, bool]:
    """(percent, status, severity, passed): nothing failed is info, up to the threshold a warning, more has its severity."""
    percent = 100.0 * failed / total
    if not failed:
        return 0.0, "passed", "info", True
    return (percent, "warning", "warning", True) if percent <= most else (percent, "failed", severity, False)


def check_columns(df: DataFrame, contract: dict) -> list[str]:
    """What is wrong with the table's columns."""
    named, there, out = [c["name"] for c in contract["schema"]], df.columns, []
    if missing := [c for c in named if c not in there]:
        out.append(f"missing columns: {missing}")
    if not contract.get("allow_extra_columns", False) and (extra := [c for c in there if c not in named]):
        out.append(f"unexpected columns: {extra}")
    if double := sorted({c for c in there if there.count(c) > 1}):
        out.append(f"columns twice: {double}")
    return out


def check_types(df: DataFrame, contract: dict) -> list[str]:
    of = {f.name: f.dataType for f in df.schema}
    return [f"{c['name']} is {of[c['name']].simpleString()}, not {c['type']}" for c in contract["schema"] if not accepts(c["type"], of[c["name"]])]


def unique_keys(contract: dict) -> list[list[str]]:
    """The grain and the unique columns, each once."""
    every = [contract["grain"]] if contract.get("grain") else []
    every += [[c["name"]] for c in contract["schema"] if (c.get("constraints") or {}).get("unique")]
    return [k for i, k in enumerate(every) if k not in every[:i]]


def findings(df: DataFrame, contract: dict, references: dict[str, DataFrame] | None = None, counted: dict[str, int] | None = None) -> Report:
    """The report on a table whose columns are as the contract says; raises for unusable contracts and empty tables. ``counted`` has
    what a pass over the rows counts (``row_counts``) if that is known already."""
    check_contract(contract)
    name, report = contract.get("name", ""), Report(contract.get("name", ""))
    own, judged_rules = metrics.column_metrics(contract), rules.Judged(df, contract.get("derived_fields"), contract.get("rules"))
    foreign = keys.foreign_keys(contract)
    for fk in foreign:
        if fk["dataset"] not in (references or {}):
            raise ValueError(f"{name}: the parent dataset {fk['dataset']} of {fk['name']} is not given")
    got = metrics.counts(judged_rules.rows, own + judged_rules.row_metrics(), name) if counted is None else counted
    if not got["total"]:
        raise EmptyDatasetError(f"dataset {name} has no rows")

    def say(rule: str, category: str, columns, failed: int, most: float = 0.0, severity: str = "critical") -> None:
        report.rows.append((name, rule, category, ",".join(columns), failed, got["total"], *judged(failed, got["total"], most, severity)))

    for m in own:
        say(m.rule, m.category, m.columns, got[m.rule], *threshold(contract, m.columns[0], m.category))
    every = unique_keys(contract)
    for key, (rows, again) in zip(every, keys.uniqueness_of(df, every), strict=True):
        rule = f"{'_'.join(key)}_uniqueness"
        report.duplicate_keys[rule] = again
        say(rule, "uniqueness", key, rows)
    for fk, lost in zip(foreign, keys.orphan_counts(df, references or {}, foreign), strict=True):
        say(fk["name"], "foreign_key", fk["child_columns"], lost)
    got = got | judged_rules.counts()
    for m in rules.rule_metrics(contract.get("rules")):
        say(m.rule, m.category, (), got[m.rule])
    return report


def validate(df: DataFrame, contract: dict, references: dict[str, DataFrame] | None = None) -> Report:
    """The report, if the table may be used; DataValidationError with it if not. Wrong columns or types end it at once."""
    check_contract(contract)
    for wrong in (check_columns(df, contract), None):
        if wrong := check_types(df, contract) if wrong is None else wrong:
            raise DataValidationError(Report(contract.get("name", "")), "; ".join(wrong))
    report = findings(df, contract, references)
    report.log()
    if report.has_errors:
        raise DataValidationError(report, ", ".join(r[1] for r in report.rows if r[7] == "failed"))
    return report


def gated_write(df: DataFrame, contract: dict, path: str, references: dict[str, DataFrame] | None = None, keep: int = versions.KEEP) -> Report:
    """Write a new version of the table, counting as it is written, and commit it if it meets its contract.

    The table is computed once, by a write that survives lost executors; constraints and rules on rows are counted by that write, and
    only columns that keys, foreign keys and rules on groups need are read again. A failed contract or write leaves the target at the
    version it had; the error's report then has samples of what failed. Columns and types are tested before anything is written. The
    ``keep`` newest versions stay readable.
    """
    check_contract(contract)
    if wrong := check_columns(df, contract) or check_types(df, contract):
        raise DataValidationError(Report(contract.get("name", "")), "; ".join(wrong))
    spark, folder = df.sparkSession, versions.new_folder()
    at, committed = f"{path.rstrip('/')}/{folder}", False
    for m in metrics.column_metrics(contract):
        threshold(contract, m.columns[0], m.category)  # an unusable one is an error before the table is written
    on_rows = rules.Judged(df, contract.get("derived_fields"), contract.get("rules"))
    try:
        seen = Observation()
        wanted = metrics.column_metrics(contract) + on_rows.row_metrics()
        write_parquet(on_rows.rows.observe(seen, *metrics.counting(wanted)).select(df.columns), at)
        written = spark.read.parquet(at)
        report = findings(written, contract, references, seen.get)
        report.log()
        if report.has_errors:
            report.samples = samples(written, contract, references, [r[1] for r in report.rows if r[7] == "failed"])
            raise DataValidationError(report, ", ".join(r[1] for r in report.rows if r[7] == "failed"))
        versions.commit(spark, path, folder, report.rows[0][5] if report.rows else None, written.schema.json())
        committed = True
        versions.retire(spark, path, keep)
        return report
    finally:
        if not committed:
            versions.discard(spark, path, folder)


def violation_rows(df: DataFrame, contract: dict, only: list[str] | None = None) -> DataFrame:
    """(rule_name, place, the table's columns): of each rule some rows that break it, smallest grain first, all in one pass."""
    chosen = [r for r in contract.get("rules") or [] if only is None or r["name"] in only]
    made, by = rules.Judged(df, contract.get("derived_fields"), contract.get("rules")).joined(chosen), contract.get("grain") or df.columns
    broken = F.array_compact(F.array(*(F.when(~F.expr(r["expression"]), F.lit(r["name"])) for r in chosen))) if chosen else F.array().cast("array<string>")
    first = F.row_number().over(Window.partitionBy("_rule").orderBy(*by))
    found = made.select(*df.columns, F.explode(broken).alias("_rule")).withColumn("_place", first).filter(F.col("_place") <= SAMPLES["row_logic"])
    return found.select(F.col("_rule").alias("rule_name"), F.col("_place").alias("place"), *df.columns)


def repeated_rows(df: DataFrame, contract: dict) -> DataFrame:
    """(rule_name, place, columns of the keys, n): some keys that occur more than once, the most frequent first, then the smallest."""
    every = unique_keys(contract)
    return keys.repeated_samples(df, every, [f"{'_'.join(k)}_uniqueness" for k in every], SAMPLES["uniqueness"])


def orphan_rows(df: DataFrame, contract: dict, references: dict[str, DataFrame]) -> DataFrame:
    """(rule_name, place, child columns, n): some keys without a parent and the rows that have them, the most frequent first."""
    return keys.orphan_samples(df, references, keys.foreign_keys(contract), SAMPLES["foreign_key"])


def samples(df: DataFrame, contract: dict, references: dict[str, DataFrame] | None, failed: list[str]) -> dict[str, list[Row]]:
    """Samples of the failed rules, keys and foreign keys by name, in order; a bounded number of rows each."""
    names = [f"{'_'.join(k)}_uniqueness" for k in unique_keys(contract)]
    found = []
    if any(r["name"] in failed for r in contract.get("rules") or []):
        found.append(violation_rows(df, contract, failed))
    if any(n in failed for n in names):
        found.append(repeated_rows(df, contract))
    if any(fk["name"] in failed for fk in keys.foreign_keys(contract)):
        found.append(orphan_rows(df, contract, references or {}))
    out: dict[str, list[Row]] = {}
    for row in (r for f in found for r in sorted(f.collect(), key=lambda r: (r.rule_name, r.place))):
        out.setdefault(row.rule_name, []).append(row)
    return out


def violation_samples(df: DataFrame, contract: dict) -> dict[str, DataFrame]:
    """The rows of ``violation_rows`` by rule."""
    found = violation_rows(df, contract)
    return {r["name"]: found.filter(F.col("rule_name") == r["name"]).orderBy("place").select(df.columns) for r in contract.get("rules") or []}


def key_samples(df: DataFrame, contract: dict) -> dict[str, DataFrame]:
    """The rows of ``repeated_rows`` by rule: the key's columns and ``n``."""
    found, every = repeated_rows(df, contract), {f"{'_'.join(k)}_uniqueness": k for k in unique_keys(contract)}
    return {rule: found.filter(F.col("rule_name") == rule).orderBy("place").select(*k, "n") for rule, k in every.items()}


def orphan_samples(df: DataFrame, contract: dict, references: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The rows of ``orphan_rows`` by foreign key: its child columns and ``n``."""
    found = orphan_rows(df, contract, references)
    return {fk["name"]: found.filter(F.col("rule_name") == fk["name"]).orderBy("place").select(*fk["child_columns"], "n") for fk in keys.foreign_keys(contract)}
