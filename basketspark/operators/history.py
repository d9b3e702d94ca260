"""Histories of candidates: products, aisles, the pseudo-product for "no reorder", and reorder sizes.

Lines are dealt by user and order once, so that a user with very many lines is no task of its own; a basket's lines become one
sorted array, from which both its figures and its candidates are taken. Candidates are gathered by (user, product), baskets by user,
and the two meet last: which order is the target is only known then. A candidate's entry is one number (its order's in the upper half, its
place in the lower), so that both uses of the entries, a candidate's list and its first order, share one exchange, and sums of firsts
alone go on to the baskets. A candidate's texts are written from entry to entry, with the zeros between them repeated, instead of going
through every basket for every candidate; texts that all candidates of a user share are made once a user.

A user's last order is the target, all before it history; a single order is history. The orders' times also cover the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import joined
from .baskets import user_split

TIMES = {"order_dows": "order_dow", "order_hours": "order_hour_of_day", "days_since_prior_orders": "days_since_prior_order", "order_numbers": "order_number"}
PRODUCT_COLUMNS = ["user_id", "product_id", "label", "aisle_id", "department_id", "product_name", "train_eval_set", "is_ordered_history", "position_in_order_history", "history_order_size", "history_reorder_size", *TIMES]
AISLE_COLUMNS = ["user_id", "aisle_id", "department_id", "eval_set", "is_ordered_history", "position_in_order", "num_products_from_aisle", "aisle_history_size", *TIMES]
REORDER_COLUMNS = ["user_id", "eval_set", "order_sizes", "reorder_sizes", "label", *TIMES]


def _baskets(lines: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each basket with its lines by place. All that is needed of lines is in the one array, so that every use of the
    baskets shares one exchange."""
    items = F.sort_array(F.collect_list(F.struct("add_to_cart_order", "product_id", *columns)))
    return lines.groupBy("user_id", "order_id", "order_number").agg(items.alias("items"))


#: What a staged basket keeps of its lines, in the order that sorts them, and of its order.
ITEMS = ["add_to_cart_order", "product_id", "reordered", "aisle_id", "department_id"]
FACTS = ["order_dow", "order_hour_of_day", "days_since_prior_order", "eval_set"]


def staged_baskets(lines: DataFrame) -> DataFrame:
    """(user_id, order_id, order_number, facts, items): all that sequences, histories, sizes and counts need of the lines. Written once,
    it spares each of them the shuffle of the lines; ``*_of`` functions and those of ``baskets`` read it, each only its columns."""
    items = F.sort_array(F.collect_list(F.struct(*ITEMS)))
    return lines.groupBy("user_id", "order_id", "order_number").agg(*(F.min(c).alias(c) for c in FACTS), items.alias("items"))


def _users(baskets: DataFrame, facts: list[str]) -> DataFrame:
    """A row for each user: ``h`` the history's baskets, ``t`` the target's (null without one), its number (null without one), times
    as texts, eval_set if the baskets have it."""
    split = "eval_set" in baskets.columns
    every = ["order_number", "order_dow", "order_hour_of_day", "days_since_prior_order", *["eval_set"] * split, *facts]
    grouped = baskets.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(*every))).alias("o"))
    last = F.element_at("o", -1)["order_number"]
    grouped = grouped.withColumn("target", F.when(F.element_at("o", 1)["order_number"] < last, last))
    history = F.filter("o", lambda x: F.col("target").isNull() | (x.order_number < F.col("target")))
    target = F.try_element_at(F.filter("o", lambda x: x.order_number == F.col("target")), F.lit(1))
    return grouped.select("user_id", "target", history.alias("h"), target.alias("t"), *[user_split(F.element_at("o", -1)["eval_set"]).alias("eval_set")] * split, *(joined(F.col(f"o.{f}")).alias(name) for name, f in TIMES.items()))


def _times(baskets: DataFrame, *more: str) -> dict[str, Column]:
    """An order's facts, from its lines unless the basket has them."""
    return {c: F.array_min(F.col(f"items.{c}")) for c in ("order_dow", "order_hour_of_day", "days_since_prior_order", *more) if c not in baskets.columns}


def _by_step(value) -> Column:
    return joined(F.transform("h", value))


def _order(entry: Column | str) -> Column:
    return F.shiftright(entry, 32).cast("int")


def _place(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def _written() -> Column:
    """(flags, places): the texts of a candidate by step, from its entries ``before`` the target and the numbers of the ``steps``."""
    zeros = lambda n: F.repeat(F.lit("0 "), n)

    def add(done: Column, e: Column) -> Column:
        at = F.array_position("steps", _order(e)).cast("int")
        gap = zeros(at - done.at - 1)
        return F.struct(at.alias("at"), F.concat(done.flags, gap, F.lit("1 ")).alias("flags"), F.concat(done.places, gap, _place(e).cast("string"), F.lit(" ")).alias("places"))

    def end(done: Column) -> Column:
        rest = zeros(F.size("steps") - done.at)
        return F.struct(*(F.rtrim(F.concat(done[c], rest)).alias(c) for c in ("flags", "places")))

    return F.aggregate("before", F.struct(F.lit(0).alias("at"), F.lit("").alias("flags"), F.lit("").alias("places")), add, end)


def _entries(baskets: DataFrame, kind, with_none: bool) -> DataFrame:
    """(user_id, product_id, none, entry): a row for each basket and different product in it, its first place counting; and of product
    0, at place 0 with ``none``, for each basket if asked for."""
    entry = lambda place: F.shiftleft(F.col("order_number").cast("long"), 32).bitwiseOR(place.cast("long"))
    own = F.transform("items", lambda x, i: F.struct(x.product_id.alias("product_id"), (i + 1).alias("place"), F.lit(False).alias("none")))
    none = F.array(F.struct(F.lit(0).cast(kind).alias("product_id"), F.lit(0).alias("place"), F.lit(True).alias("none")))
    every = baskets.select("user_id", "order_number", F.explode(F.concat(own, none) if with_none else own).alias("x"))
    every = every.select("user_id", "x.product_id", *["x.none"] * with_none, entry(F.col("x.place")).alias("entry")).repartition("user_id", "product_id")
    return every.groupBy("user_id", "product_id", *["none"] * with_none, F.shiftright("entry", 32).alias("_order")).agg(F.min("entry").alias("entry")).drop("_order")


def _histories(lines: DataFrame, targets: DataFrame, products: DataFrame, with_none: bool) -> DataFrame:
    """Histories of products and, if asked for, of product 0 for each user, from one exchange of the baskets' lines."""
    return histories_of(_baskets(lines, ["reordered", "order_dow", "order_hour_of_day", "days_since_prior_order"]), targets, products, with_none)


def histories_of(baskets: DataFrame, targets: DataFrame, products: DataFrame, with_none: bool) -> DataFrame:
    """The same of baskets: (user_id, order_id, order_number, items). Further columns of the products are handed on. Products join the
    slim candidates, before texts are written: no row with texts is shuffled."""
    more = [c for c in products.columns if c not in ("product_id", "product_name", "aisle_id", "department_id")]
    entries = _entries(baskets, products.schema["product_id"].dataType, with_none)
    by, none = ["user_id", "product_id", *["none"] * with_none], F.col("none") if with_none else F.lit(False)
    candidates = entries.groupBy(*by).agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    # What a basket has of products bought before: its different products without those that are in it for the first time.
    firsts = (entries.filter(~none) if with_none else entries).groupBy("user_id", "product_id").agg(F.min("entry").alias("first")).groupBy("user_id", _order("first").alias("order_number")).agg(F.count("*").cast("int").alias("new"))
    figures = baskets.withColumns({**_times(baskets), "size": F.size("items"), "different": F.size(F.array_distinct("items.product_id")), "reorders": F.aggregate("items", F.lit(0), lambda n, x: n + F.coalesce(x.reordered, F.lit(0)).cast("int")), "any": F.array_max("items.reordered")}).drop("items")
    figures = figures.join(firsts, ["user_id", "order_number"], "left").withColumn("again", F.col("different") - F.coalesce("new", F.lit(0)))
    users = _users(figures, ["size", "again", "reorders", "any"])
    texts = {"history_order_size": _by_step(lambda x: x.size), "_again": _by_step(lambda x: x.again), "_reorders": _by_step(lambda x: x.reorders), "_nothing": _by_step(lambda x: (x["any"] == 0).cast("int"))}
    users = users.withColumns(texts).select("user_id", "target", F.col("h.order_number").alias("steps"), F.col("t.any").alias("_any"), *texts, *TIMES)
    zero = F.lit(0).cast("int")
    before = F.filter("entries", lambda e: F.col("target").isNull() | (_order(e) < F.col("target")))
    of = lambda yes, no: F.when(none, yes).otherwise(no) if with_none else no
    return (
        candidates.join(products, "product_id", "left")
        .join(users.join(targets, "user_id", "left"), "user_id")
        .withColumn("before", before)
        .filter(none | (F.size("before") > 0))
        .withColumn("written", _written())
        .withColumns(
            {
                "aisle_id": of(zero, F.col("aisle_id")),
                "department_id": of(zero, F.col("department_id")),
                "product_name": of(F.lit(""), F.col("product_name")),
                "label": F.when(F.col("train_eval_set") == "train", of((F.col("_any") == 0).cast("int"), F.coalesce(F.exists("entries", lambda e: _order(e) == F.col("target")), F.lit(False)).cast("int"))).otherwise(-1),
                "is_ordered_history": of(F.col("_nothing"), F.col("written.flags")),
                "position_in_order_history": F.col("written.places"),
                "history_reorder_size": of(F.col("_reorders"), F.col("_again")),
            }
        )
        .select(*PRODUCT_COLUMNS, *more)
    )


def product_history(lines: DataFrame, targets: DataFrame, products: DataFrame) -> DataFrame:
    """A row for each user and product of the history. ``label``: whether a train user's target has it, -1 for others."""
    return _histories(lines, targets, products, False)


def no_reorder_history(lines: DataFrame, targets: DataFrame) -> DataFrame:
    """A row of product 0 for each user: in which baskets nothing was reordered. A train user without a target has no label."""
    users = _users(_figures(lines, [F.count("*").alias("size"), F.sum("reordered").cast("int").alias("again"), F.max("reordered").alias("any")]), ["size", "again", "any"])
    zero = F.lit(0).cast("int")
    return (
        users.join(targets, "user_id", "left")
        .withColumns(
            {
                "product_id": zero,
                "aisle_id": zero,
                "department_id": zero,
                "product_name": F.lit(""),
                "label": F.when(F.col("train_eval_set") == "train", (F.col("t.any") == 0).cast("int")).otherwise(-1),
                "is_ordered_history": _by_step(lambda x: (x["any"] == 0).cast("int")),
                "position_in_order_history": _by_step(lambda x: F.lit(0)),
                "history_order_size": _by_step(lambda x: x.size),
                "history_reorder_size": _by_step(lambda x: x.again),
            }
        )
        .select(PRODUCT_COLUMNS)
    )


def product_history_all(lines: DataFrame, targets: DataFrame, products: DataFrame) -> DataFrame:
    """Both of the above; the pseudo-product comes from the same baskets."""
    return _histories(lines, targets, products, True)


def aisle_history(lines: DataFrame, departments: DataFrame, shared: dict[str, Column] | None = None, own=joined) -> DataFrame:
    """A row for each user and aisle of the history; an aisle's position is among the basket's different aisles. ``shared`` are columns
    to make of those that all aisles of a user share, once a user; ``own`` makes a column of an aisle's numbers by step."""
    items = F.sort_array(F.collect_list(F.struct("add_to_cart_order", "product_id", "aisle_id")))
    return aisles_of(lines.groupBy("user_id", "order_id", "order_number").agg(*(F.min(c).alias(c) for c in FACTS), items.alias("items")), departments, shared, own)


def aisles_of(baskets: DataFrame, departments: DataFrame, shared: dict[str, Column] | None = None, own=joined) -> DataFrame:
    """The same of baskets: (user_id, order_id, order_number, items). A candidate is looked up once a step, for all its columns, and what
    its user hands on are numbers of steps and texts that are ready."""
    every = F.col("items.aisle_id")
    found = baskets.withColumns(_times(baskets, "eval_set")).select("user_id", "order_number", *FACTS, every.alias("every"), F.array_distinct(every).alias("aisles"))
    found = found.select("*", F.size(F.array_compact("aisles")).alias("size"), F.posexplode("aisles").alias("place", "aisle_id"))
    # An array of one, which both uses of these rows unpack after the one exchange that they share.
    n = F.size(F.filter("every", lambda x: x.eqNullSafe(F.col("aisle_id"))))
    basket = F.when(F.col("place") == 0, F.struct(*FACTS, "size"))
    packed = F.array(F.struct("order_number", (F.col("place") + 1).alias("place"), n.alias("n"), basket.alias("basket")))
    rows = found.select("user_id", "aisle_id", packed.alias("packed")).repartition("user_id", "aisle_id")
    users = _users(rows.select("user_id", F.inline("packed")).filter(F.col("basket").isNotNull()).select("user_id", "order_number", "basket.*"), ["size"])
    users = users.select("user_id", "target", F.col("h.order_number").alias("steps"), "eval_set", _by_step(lambda x: x.size).alias("aisle_history_size"), *TIMES).withColumns(shared or {})
    rows = rows.select("user_id", "aisle_id", F.inline("packed"))
    rows = rows.groupBy("user_id", "aisle_id", "order_number").agg(F.min("place").alias("place"), F.sum("n").cast("int").alias("n"))
    entry = F.struct("order_number", F.struct(F.lit(1).alias("one"), "place", "n").alias("v"))
    candidates = rows.groupBy("user_id", "aisle_id").agg(F.min("order_number").alias("first"), F.map_from_entries(F.collect_list(F.when(F.col("order_number").isNotNull(), entry))).alias("at"))
    absent = F.struct(*(F.lit(0).alias(c) for c in ("one", "place", "n")))
    return (
        candidates.join(users, "user_id")
        .filter(F.col("target").isNull() | (F.col("first") < F.col("target")))
        .join(departments, "aisle_id", "left")
        .withColumn("found", F.transform("steps", lambda n: F.coalesce(F.try_element_at("at", n), absent)))
        .withColumns({"is_ordered_history": own(F.col("found.one")), "position_in_order": own(F.col("found.place")), "num_products_from_aisle": own(F.col("found.n"))})
        .select(AISLE_COLUMNS)
    )


def _figures(lines: DataFrame, facts: list[Column]) -> DataFrame:
    """A row for each basket with its times and ``facts``, summed before lines travel. Without eval_set, a text, it can use hashing."""
    times = [F.min(c).alias(c) for c in ("order_dow", "order_hour_of_day", "days_since_prior_order")]
    return lines.groupBy("user_id", "order_id", "order_number").agg(*times, *facts)


def reorder_size(lines: DataFrame) -> DataFrame:
    """A row for each user: sizes and reorders of the history's baskets; ``label`` is the target's reorders, 0 without one."""
    facts = [F.count("*").cast("int").alias("size"), F.sum("reordered").cast("int").alias("again"), F.min("eval_set").alias("eval_set")]
    return _sizes(_figures(lines, facts))


def sizes_of(baskets: DataFrame) -> DataFrame:
    """The same of staged baskets. A basket whose lines have no value for ``reordered`` has no sum."""
    known = F.exists("items.reordered", lambda x: x.isNotNull())
    again = F.when(known, F.aggregate("items.reordered", F.lit(0), lambda n, x: n + F.coalesce(x, F.lit(0)).cast("int")))
    return _sizes(baskets.select("user_id", "order_number", *FACTS, F.size("items").alias("size"), again.alias("again")))


def _sizes(figures: DataFrame) -> DataFrame:
    users = _users(figures, ["size", "again"])
    return users.withColumns({"order_sizes": F.col("h.size"), "reorder_sizes": F.col("h.again"), "label": F.coalesce("t.again", F.lit(0))}).select(REORDER_COLUMNS)
