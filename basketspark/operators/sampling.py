"""Consistent samples: users, and the rows that belong to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 42


def sample_users(orders: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """``n`` users by a seeded hash; more than there are is an error."""
    users = orders.select("user_id").distinct()
    if (there := users.count()) < n:
        raise ValueError(f"{n} users asked for, {there} there")
    return users.orderBy(F.md5(F.concat("user_id", F.lit(f":{seed}")).cast("binary")), "user_id").limit(n)


def belonging(rows: DataFrame, to: DataFrame, key: str) -> DataFrame:
    return rows.join(to.select(key), key, "left_semi")
