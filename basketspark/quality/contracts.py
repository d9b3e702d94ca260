"""Contracts of the basket tables, as data. Rules are written by a few helpers over the columns they concern.

Lengths of training arrays are parameters, so a job that pads to another length is held to that length.
"""

from __future__ import annotations

STEPS, NAME_STEPS = 100, 30


def column(name: str, kind: str = "integer", nullable: bool = False, thresholds: dict | None = None, **constraints) -> dict:
    return {"name": name, "type": kind, "nullable": nullable, "constraints": constraints, "thresholds": thresholds or {}}


def key(name: str, **constraints) -> dict:
    """An id from 1 up whose nulls and bounds are critical."""
    return column(name, thresholds={"nullability": {"severity": "critical"}, "range": {"severity": "critical"}}, minimum=1, **constraints)


def contract(name: str, grain: list[str], schema: list[dict], rules: dict[str, str] | None = None, derived: list[dict] | None = None, foreign: dict[str, tuple] | None = None) -> dict:
    return {
        "name": name,
        "grain": grain,
        "allow_extra_columns": False,
        "schema": schema,
        "derived_fields": derived or [],
        "rules": [{"name": n, "expression": e} for n, e in (rules or {}).items()],
        "relationships": [{"name": n, "type": "foreign_key", "child_columns": child, "parent": {"dataset": parent, "columns": columns}} for n, (child, parent, columns) in (foreign or {}).items()],
    }


def _of_group(by: str, fields: dict[str, tuple[str, str]]) -> list[dict]:
    """Derived fields of the rows that share ``by``: aggregation and column (or condition) by name."""
    return [{"name": n, "aggregation": a, "condition" if a == "conditional_count" else "column": of, "partition_by": [by]} for n, (a, of) in fields.items()]


def _within(array: str, test: str) -> str:
    return f"forall({array}, v -> {test})"


def _pairs(a: str, b: str, test: str) -> str:
    """A test of v and w, the values of two arrays at each place; a place that one array lacks is null there."""
    return f"forall(zip_with({a}, {b}, (v, w) -> {test}), ok -> ok)"


def _numbers(text: str, kind: str = "int") -> str:
    return f"transform(split({text}, ' '), v -> try_cast(v AS {kind}))"


def _same_size(*texts: str) -> str:
    first, *rest = (f"size(split({t}, ' '))" for t in texts)
    return " AND ".join(f"{first} = {r}" for r in rest)


def _zeros_from(arrays: list[str], start: str) -> str:
    """Elements after the first ``start`` are zero."""
    return " AND ".join(f"NOT exists(slice({a}, {start} + 1, size({a})), v -> v <> 0)" for a in arrays)


def _positive_to(array: str, end: str) -> str:
    """The first ``end`` elements are above zero."""
    return f"NOT exists(slice({array}, 1, greatest({end}, 0)), v -> v <= 0)"


_COUNTING = "{0} = sequence(1, size({0}))"
TIMES = ("order_dows", "order_hours", "days_since_prior_orders", "order_numbers")


def _time_rules() -> dict[str, str]:
    numbers, days = _numbers("order_numbers"), _numbers("days_since_prior_orders", "double")
    return {
        "order_numbers_start_at_one": f"{numbers}[0] = 1",
        "order_numbers_are_contiguous": _COUNTING.format(numbers),
        "order_dows_are_valid": _within(_numbers("order_dows"), "v BETWEEN 0 AND 6"),
        "order_hours_are_valid": _within(_numbers("order_hours"), "v BETWEEN 0 AND 23"),
        "first_order_has_no_prior_interval": f"{days}[0] = -1",
    }


def _history_rules(steps: tuple[str, ...], ordered: str, place: str, size: str, exempt: str = "") -> dict[str, str]:
    flags, places = _numbers(ordered), _numbers(place)
    return {
        "all_historical_data_has_the_same_length": _same_size(*steps),
        "all_temporal_data_has_the_same_length": _same_size("order_numbers", *(t for t in TIMES if t != "order_numbers")),
        "temporal_data_has_one_more_step_than_historical_data": f"size(split(order_numbers, ' ')) = 1 OR size(split(order_numbers, ' ')) = size(split({ordered}, ' ')) + 1",
        "unordered_product_position_is_zero": _pairs(flags, places, "v = 1 OR w = 0"),
        "ordered_product_has_positive_position": exempt + _pairs(flags, places, "v = 0 OR w > 0"),
        "product_position_does_not_exceed_order_size": _pairs(places, _numbers(size), "v <= w"),
    }


def _user_data_rules() -> dict[str, str]:
    lists = ("order_ids", "order_numbers", "order_dows", "order_hours", "days_since_prior_orders", "product_ids", "reorders", "department_ids", "aisle_ids")
    items = lambda t: f"transform(split({t}, ' '), b -> size(split(b, '_')))"
    return {
        "all_order_level_sequences_have_same_length": _same_size(*lists),
        "user_has_at_least_one_order": "size(split(order_ids, ' ')) >= 1",
        **_time_rules(),
        "basket_sequences_have_matching_lengths": " AND ".join(f"{items('product_ids')} = {items(t)}" for t in ("reorders", "department_ids", "aisle_ids")),
        "reorder_values_are_binary": "forall(split(reorders, '[ _]'), v -> v IN ('0', '1'))",
    }


def _split(*allowed: str) -> dict:
    return {"kind": "string", "allowed_values": list(allowed)}


def _texts(*names: str) -> list[dict]:
    return [column(n, "string") for n in names]


def _arrays(names: tuple[str, ...], steps: int) -> list[dict]:
    return [column(n, "array<double>" if n == "days_since_prior_orders" else "array<int>", minimum_items=steps, maximum_items=steps) for n in names]


AISLES = contract("aisles", ["aisle_id"], [key("aisle_id", unique=True), column("aisle", "string")], {"aisle_name_is_not_blank": "trim(aisle) <> ''"})
DEPARTMENTS = contract("departments", ["department_id"], [key("department_id", unique=True), column("department", "string")], {"department_name_is_not_blank": "trim(department) <> ''"})
PRODUCTS = contract(
    "products",
    ["product_id"],
    [key("product_id", unique=True), column("product_name", "string"), column("aisle_id", minimum=1), column("department_id", minimum=1)],
    foreign={"products_aisle_fk": (["aisle_id"], "aisles", ["aisle_id"]), "products_department_fk": (["department_id"], "departments", ["department_id"])},
)
ORDERS = contract(
    "orders",
    ["order_id"],
    [
        key("order_id", unique=True),
        column("user_id", minimum=1),
        column("eval_set", thresholds={"nullability": {"max_failed_percent": 2.0}, "allowed_values": {"max_failed_percent": 5.0}}, **_split("prior", "train", "test")),
        column("order_number", minimum=1),
        column("order_dow", thresholds={"range": {"max_failed_percent": 5.0}}, minimum=0, maximum=6),
        column("order_hour_of_day", thresholds={"range": {"max_failed_percent": 5.0}}, minimum=0, maximum=23),
        column("days_since_prior_order", "double", True, {"range": {"max_failed_percent": 10.0}}, minimum=0, maximum=30),
    ],
    {
        "first_order_has_no_prior_interval": "order_number <> 1 OR days_since_prior_order IS NULL",
        "later_orders_must_have_prior_interval": "order_number = 1 OR days_since_prior_order IS NOT NULL",
        "last_order_per_user_is_train_or_test": "later_orders > 0 OR eval_set IN ('train', 'test')",
        "only_one_train_or_test_per_user": "n_target = 1",
        "contiguous_order_numbers": "least_number = 1 AND n_gaps = 0",
    },
    [
        *_of_group("user_id", {"least_number": ("min", "order_number"), "greatest_number": ("max", "order_number"), "n_numbers": ("count_distinct", "order_number"), "n_target": ("conditional_count", "eval_set IN ('train', 'test')")}),
        {"name": "later_orders", "expression": "greatest_number - order_number"},
        {"name": "n_gaps", "expression": "greatest_number - least_number + 1 - n_numbers"},
    ],
)
ORDER_PRODUCTS = contract(
    "order_products",
    ["order_id", "product_id"],
    [key("order_id"), column("product_id", thresholds={"range": {"max_failed_percent": 5.0}}, minimum=1), column("add_to_cart_order", minimum=1), column("reordered", allowed_values=[0, 1])],
    {"cart_positions_are_contiguous": "first_place = 1 AND last_place - first_place + 1 - n_places = 0"},
    _of_group("order_id", {"first_place": ("min", "add_to_cart_order"), "last_place": ("max", "add_to_cart_order"), "n_places": ("count_distinct", "add_to_cart_order")}),
    {"order_products_order_fk": (["order_id"], "orders", ["order_id"]), "order_products_product_fk": (["product_id"], "products", ["product_id"])},
)
SILVER = contract(
    "order_products_silver",
    ["order_id", "product_id"],
    [
        *(column(c, minimum=1) for c in ("product_id", "order_id", "add_to_cart_order")),
        column("reordered", allowed_values=[0, 1]),
        column("user_id", minimum=1),
        column("eval_set", **_split("prior", "train")),
        column("order_number", minimum=1),
        column("order_dow", minimum=0, maximum=6),
        column("order_hour_of_day", minimum=0, maximum=23),
        column("days_since_prior_order", "double", minimum=-1, maximum=30),
        column("product_name", "string"),
        column("aisle_id", minimum=1),
        column("department_id", minimum=1),
    ],
    {"first_order_has_no_prior_interval": "order_number <> 1 OR days_since_prior_order = -1", "later_orders_have_prior_interval": "order_number = 1 OR days_since_prior_order >= 0"},
)
USER_DATA = contract("user_data", ["user_id"], [column("user_id", minimum=1), *_texts("order_ids", "order_numbers", "order_dows", "order_hours", "days_since_prior_orders", "product_ids", "reorders", "department_ids", "aisle_ids"), column("eval_set", **_split("train", "test"))], _user_data_rules())
PRODUCT_HISTORY = contract(
    "product_history_data",
    ["user_id", "product_id"],
    [
        column("user_id", minimum=1),
        column("product_id", minimum=0),
        column("label", allowed_values=[-1, 0, 1]),
        column("aisle_id", minimum=0),
        column("department_id", minimum=0),
        column("product_name", "string"),
        column("train_eval_set", **_split("train", "test")),
        *_texts("is_ordered_history", "position_in_order_history", "history_order_size", "history_reorder_size", *TIMES),
    ],
    {
        **_history_rules(("is_ordered_history", "position_in_order_history", "history_order_size", "history_reorder_size"), "is_ordered_history", "position_in_order_history", "history_order_size", "product_id = 0 OR "),
        "train_rows_have_binary_label": "NOT train_eval_set = 'train' OR label IN (0, 1)",
        "test_rows_have_unknown_label": "NOT train_eval_set = 'test' OR label = -1",
        "reorder_size_does_not_exceed_order_size": _pairs(_numbers("history_reorder_size"), _numbers("history_order_size"), "v <= w"),
        **_time_rules(),
        "days_since_prior_orders_are_whole_numbers": _within(_numbers("days_since_prior_orders", "double"), "v = floor(v)"),
        "minimum_length_of_product_name_must_be_one": "product_id = 0 OR trim(product_name) <> ''",
    },
)
AISLE_HISTORY = contract(
    "aisle_history_data",
    ["user_id", "aisle_id"],
    [column("user_id", minimum=1), column("aisle_id", minimum=1), column("department_id", minimum=1), column("eval_set", **_split("train", "test")), *_texts("is_ordered_history", "position_in_order", "num_products_from_aisle", "aisle_history_size", *TIMES)],
    _history_rules(("is_ordered_history", "position_in_order", "aisle_history_size", "num_products_from_aisle"), "is_ordered_history", "position_in_order", "aisle_history_size"),
)
USER_PRODUCT_COUNT = contract("user_product_count", ["user_id", "product_id"], [column("user_id", minimum=1), column("product_id", minimum=1), column("count", minimum=1)])


def product_training(name_steps: int = NAME_STEPS, steps: int = STEPS) -> dict:
    own = ("is_ordered_history", "position_in_order_history", "history_order_size", "history_reorder_size")
    return contract(
        "product_training_data",
        ["user_id", "product_id"],
        [
            column("user_id", minimum=1),
            column("product_id", minimum=0),
            column("train_eval_set", **_split("train", "test")),
            column("label", allowed_values=[-1, 0, 1]),
            *_arrays(("product_name_encoded",), name_steps),
            *_arrays((*own, *TIMES), steps),
            column("history_length"),
            column("product_name_length"),
        ],
        {
            "name_length_when_product_id_greater_than_zero": "product_id = 0 OR product_name_length > 0",
            "name_length_when_product_id_equal_to_zero": "product_id > 0 OR product_name_length = 0",
            "history_length_within_encoded_sequence": "size(is_ordered_history) >= history_length",
            "product_name_length_within_encoding": "size(product_name_encoded) >= product_name_length",
            "active_history_has_positive_order_number": _positive_to("order_numbers", "history_length"),
            "padded_product_history_values_are_zero": _zeros_from(list(own), "history_length"),
            "padded_order_context_values_are_zero": _zeros_from(list(TIMES), "history_length + 1"),
        },
    )


def aisle_training(steps: int = STEPS) -> dict:
    own = ("is_ordered_history", "position_in_order", "num_products_from_aisle", "aisle_history_size")
    return contract(
        "aisle_training_data",
        ["user_id", "aisle_id"],
        [column("user_id", minimum=1), column("aisle_id", minimum=1), column("department_id", minimum=1), column("eval_set", **_split("train", "test")), *_arrays((*own, *TIMES), steps), column("history_length", minimum=1, maximum=steps)],
        {
            "ordered_history_is_binary": _within("is_ordered_history", "v IN (0, 1)"),
            **{f"{c}_is_non_negative": _within(c, "v >= 0") for c in own[1:]},
            "ordered_and_position_are_consistent": _pairs("is_ordered_history", "position_in_order", "(v = 0 AND w = 0) OR (v = 1 AND w > 0)"),
            "ordered_and_product_count_are_consistent": _pairs("is_ordered_history", "num_products_from_aisle", "(v = 0 AND w = 0) OR (v = 1 AND w > 0)"),
            "position_does_not_exceed_aisle_count": _pairs("position_in_order", "aisle_history_size", "v <= w"),
            "history_prefix_is_real": _positive_to("aisle_history_size", "history_length"),
            "history_padding_is_zero": _zeros_from(list(own), "history_length"),
            "temporal_padding_is_zero": _zeros_from(list(TIMES), "history_length + 1"),
        },
    )


def reorder_size_training(steps: int = STEPS) -> dict:
    return contract(
        "reorder_size_training_data",
        ["user_id"],
        [column("user_id", minimum=1), column("eval_set", **_split("train", "test")), *_arrays(("order_sizes", "reorder_sizes"), steps), column("label", minimum=0), *_arrays(TIMES, steps), column("history_length", minimum=1, maximum=steps)],
        {
            "reorder_size_does_not_exceed_order_size": _pairs("reorder_sizes", "order_sizes", "v BETWEEN 0 AND w"),
            "active_history_has_positive_order_sizes": _positive_to("order_sizes", "history_length"),
            "padded_order_sizes_are_zero": _zeros_from(["order_sizes"], "history_length"),
            "padded_reorder_sizes_are_zero": _zeros_from(["reorder_sizes"], "history_length"),
            "temporal_history_contains_target_order": "history_length >= size(order_numbers) OR size(order_numbers) = 1 OR get(order_numbers, history_length) > 0",
            "temporal_padding_after_target_order_is_zero": _zeros_from(["order_numbers"], "history_length + 1"),
        },
    )


CONTRACTS = {c["name"]: c for c in (AISLES, DEPARTMENTS, PRODUCTS, ORDERS, ORDER_PRODUCTS, SILVER, USER_DATA, PRODUCT_HISTORY, AISLE_HISTORY, USER_PRODUCT_COUNT, product_training(), aisle_training(), reorder_size_training())}
