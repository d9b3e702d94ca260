"""Uniqueness and foreign keys. Keys with a null part are left out of both.

All keys of a table are counted in one pass: each row gives a slim row (number of the key, two hashes) for each key, which are dealt by
the first hash and then summed. Rows of equal first hash are equal keys if their second hashes agree; where they don't, different keys
have met under one hash, and those alone are counted again by their values. All foreign keys are tested in one pass too: the child's
keys and the parents' keys, tagged, meet in one sum, which the hot ones enter once a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .errors import InvalidConstraintError


def _known(df: DataFrame, columns: list[str]) -> list[str]:
    if not isinstance(columns, list) or not columns or any(not isinstance(c, str) or not c for c in columns):
        raise InvalidConstraintError("a key needs a list of column names")
    if len(set(columns)) < len(columns):
        raise InvalidConstraintError("a key names a column twice")
    if missing := [c for c in columns if c not in df.columns]:
        raise InvalidConstraintError(f"no such columns: {missing}")
    return columns


def repeated_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """The keys that occur more than once, with ``n``."""
    return df.dropna(subset=_known(df, columns)).groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def uniqueness(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``duplicate_rows`` and ``duplicate_keys``, by one aggregate over the keys."""
    return repeated_keys(df, columns).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"), F.count("*").alias("duplicate_keys"))


#: Sets the second hash of a key apart from the first.
SECOND = 7


def _whole(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"`{c}`").isNotNull() for c in columns))


def _tagged(df: DataFrame, keys: list[list[str]], *more: str) -> DataFrame:
    """Each row once for each of its keys that have no null, ``key`` being the key's number; without keys, no row."""
    tags = F.array_compact(F.array(*(F.when(_whole(k), F.lit(i)) for i, k in enumerate(keys)))) if keys else F.array().cast("array<int>")
    columns = dict.fromkeys([c for k in keys for c in k] + list(more))
    return df.select(*(F.col(f"`{c}`") for c in columns), F.explode(tags).alias("_key"))


def _of(values: list[Column]) -> Column:
    """The value of the row's own key."""
    return reduce(lambda a, b: F.coalesce(b, a), (F.when(F.col("_key") == i, v) for i, v in enumerate(values)), F.lit(None))


def _hashes(columns: list[str], bits: int) -> tuple[Column, Column]:
    first = F.xxhash64(*(f"`{c}`" for c in columns))
    return (first if bits >= 64 else F.pmod(first, F.lit(1 << bits))), F.xxhash64(F.lit(SECOND), *(f"`{c}`" for c in reversed(columns)))


def _met(df: DataFrame, keys: list[list[str]], hashes: list[tuple[Column, Column]]) -> DataFrame:
    """(key's number, first hash, n, low, high): the hashes that occur more than once, with the range of their second ones."""
    slim = _tagged(df, keys).select("_key", _of([h for h, _ in hashes]).alias("_hash"), _of([g for _, g in hashes]).alias("_check"))
    # Dealt before they are summed: sums of keys that hardly repeat would fill a reading task's memory and be spilled by it.
    dealt = slim.repartition("_key", "_hash")
    return dealt.groupBy("_key", "_hash").agg(F.count("*").alias("n"), F.min("_check").alias("low"), F.max("_check").alias("high")).filter("n > 1")


def uniqueness_of(df: DataFrame, keys: list[list[str]], bits: int = 64) -> list[tuple[int, int]]:
    """(duplicate_rows, duplicate_keys) of each key, from one scan and one shuffle of df. ``bits`` of the first hash are used."""
    keys = [_known(df, k) for k in keys]
    if not keys:
        return []
    hashes = [_hashes(k, bits) for k in keys]
    met = _met(df, keys, hashes)
    same = F.col("low") == F.col("high")
    found = {r[0]: r[1:] for r in met.groupBy("_key").agg(F.coalesce(F.sum(F.when(same, F.col("n"))), F.lit(0)), F.count_if(same), F.count_if(~same)).collect()}
    out = []
    for i, k in enumerate(keys):
        rows, again, mixed = found.get(i, (0, 0, 0))
        if mixed:
            of = met.filter((F.col("_key") == i) & ~same).select("_hash")
            more = uniqueness(df.dropna(subset=k).withColumn("_hash", hashes[i][0]).join(of, "_hash", "left_semi"), k).first()
            rows, again = rows + more["duplicate_rows"], again + more["duplicate_keys"]
        out.append((rows, again))
    return out


def _first(df: DataFrame, by: str, order: list, most: int) -> DataFrame:
    """The first rows of each group, with their ``place``; a task keeps no more than these of a group before it is shuffled."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("place") <= most)


def _named(number: str, names: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), F.col(number) + 1).alias("rule_name")


def repeated_samples(df: DataFrame, keys: list[list[str]], names: list[str], most: int) -> DataFrame:
    """(rule_name, place, columns of all keys, n): of each key those values that occur most often, then the smallest."""
    columns = list(dict.fromkeys(c for k in keys for c in k))
    own = [F.when(F.col("_key").isin([i for i, k in enumerate(keys) if c in k]), F.col(f"`{c}`")).alias(c) for c in columns]
    met = _tagged(df, keys).select("_key", *own).groupBy("_key", *(f"`{c}`" for c in columns)).agg(F.count("*").alias("n")).filter("n > 1")
    return _first(met, "_key", [F.desc("n"), *(f"`{c}`" for c in columns)], most).select(_named("_key", names), "place", *(f"`{c}`" for c in columns), "n")


def orphan_keys(child: DataFrame, references: dict[str, DataFrame], foreign: list[dict]) -> DataFrame:
    """(fk, columns of all foreign keys, n): the keys without a parent and the rows that have them; ``fk`` is the place in
    ``foreign``. One scan of the child, and one shuffle of its and the parents' keys after they are summed in each task."""
    for fk in foreign:
        _known(child, fk["child_columns"]), _known(references[fk["dataset"]], fk["parent_columns"])
        if len(fk["child_columns"]) != len(fk["parent_columns"]):
            raise InvalidConstraintError("a foreign key's columns don't match in number")
    every = [fk["child_columns"] for fk in foreign]
    columns = [(i, j) for i, k in enumerate(every) for j in range(len(k))]
    tagged = _tagged(child, every)
    parts = [tagged.select(F.col("_key").alias("fk"), *(F.when(F.col("_key") == i, F.col(f"`{every[i][j]}`")).alias(f"k{i}_{j}") for i, j in columns), F.lit(1).cast("long").alias("n"), F.lit(False).alias("there"))]
    for i, fk in enumerate(foreign):
        parent = references[fk["dataset"]].dropna(subset=fk["parent_columns"])
        own = [F.col(f"`{c}`").alias(f"k{i}_{j}") for j, c in enumerate(fk["parent_columns"])]
        parts.append(parent.select(F.lit(i).alias("fk"), *own, F.lit(0).cast("long").alias("n"), F.lit(True).alias("there")))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [f"k{i}_{j}" for i, j in columns]
    return united.groupBy("fk", *names).agg(F.sum("n").alias("n"), F.max("there").alias("there")).filter(~F.col("there")).drop("there")


def orphan_counts(child: DataFrame, references: dict[str, DataFrame], foreign: list[dict]) -> list[int]:
    """Rows without a parent by foreign key."""
    if not foreign:
        return []
    found = dict(map(tuple, orphan_keys(child, references, foreign).groupBy("fk").agg(F.sum("n")).collect()))
    return [found.get(i, 0) for i in range(len(foreign))]


def orphan_samples(child: DataFrame, references: dict[str, DataFrame], foreign: list[dict], most: int) -> DataFrame:
    """(rule_name, place, columns of all foreign keys, n): of each foreign key the lost values of most rows, then the smallest."""
    lost = orphan_keys(child, references, foreign)
    names = [c for c in lost.columns if c not in ("fk", "n")]
    first = _first(lost, "fk", [F.desc("n"), *names], most)
    places: dict[str, list[str]] = {}
    for i, fk in enumerate(foreign):
        for j, c in enumerate(fk["child_columns"]):
            places.setdefault(c, []).append(f"k{i}_{j}")
    return first.select(_named("fk", [fk["name"] for fk in foreign]), "place", *(F.coalesce(*p).alias(c) for c, p in places.items()), "n")


def duplicate_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.join(repeated_keys(df, columns), columns, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, child_columns: list[str], parent_columns: list[str]) -> DataFrame:
    """The rows whose key the parent doesn't have."""
    _known(child, child_columns), _known(parent, parent_columns)
    if len(child_columns) != len(parent_columns):
        raise InvalidConstraintError("a foreign key's columns don't match in number")
    keys = parent.select(*(F.col(p).alias(c) for p, c in zip(parent_columns, child_columns, strict=True))).dropna().distinct()
    return child.dropna(subset=child_columns).join(keys, child_columns, "left_anti")


def foreign_keys(contract: dict) -> list[dict]:
    """name, child_columns, dataset and parent_columns of each foreign key; relationships of other kinds are left out."""
    out = []
    for r in contract.get("relationships") or []:
        if r.get("type") == "foreign_key":
            child, parent = r.get("child_columns"), r.get("parent") or {}
            if not child or not parent.get("dataset") or not parent.get("columns") or len(child) != len(parent["columns"]):
                raise InvalidConstraintError(f"foreign key {r.get('name')} is incomplete")
            out.append({"name": r.get("name") or f"{'_'.join(child)}_fk", "child_columns": child, "dataset": parent["dataset"], "parent_columns": parent["columns"]})
    if len({k["name"] for k in out}) < len(out):
        raise InvalidConstraintError("two foreign keys of one name")
    return out
