"""Fixed-length training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import pad_sequence, parse_sequence
from .history import TIMES, aisle_history

PAD_LENGTH = 30
NAME_LENGTH, ENCODE_LENGTH = 50, 50
PRODUCT_STEPS = ["is_ordered_history", "position_in_order_history", "history_order_size", "history_reorder_size"]
AISLE_STEPS = ["is_ordered_history", "position_in_order", "num_products_from_aisle", "aisle_history_size"]


def _kind(column: str) -> str:
    return "double" if column == "days_since_prior_orders" else "int"


def _padded(columns: list[str], length: int, pad=pad_sequence) -> dict[str, tuple[F.Column, F.Column]]:
    return {c: pad(parse_sequence(c, kind=_kind(c)), length, _kind(c)) for c in columns}


def reorder_size_training(sizes: DataFrame, pad_length: int = PAD_LENGTH) -> DataFrame:
    arrays = {c: pad_sequence(c, pad_length) for c in ("order_sizes", "reorder_sizes")}
    every = arrays | _padded(list(TIMES), pad_length)
    out = lambda c: every[c][0].alias(c)
    return sizes.select("user_id", "eval_set", out("order_sizes"), out("reorder_sizes"), "label", *map(out, TIMES), arrays["reorder_sizes"][1].alias("history_length"))


def aisle_training(history: DataFrame, pad_length: int = PAD_LENGTH) -> DataFrame:
    every = _padded([*AISLE_STEPS, *TIMES], pad_length)
    return history.select("user_id", "aisle_id", "department_id", "eval_set", *(every[c][0].alias(c) for c in every), every["is_ordered_history"][1].alias("history_length"))


def aisle_training_of(lines: DataFrame, departments: DataFrame, pad_length: int = PAD_LENGTH, pad=pad_sequence) -> DataFrame:
    """The same of lines: an aisle's numbers by step are padded without a text between, and what all aisles of a user share is parsed and
    padded once a user. ``pad``: arrays, or ``pad_text`` for texts of them."""
    shared = {c: padded for c, (padded, _) in _padded(["aisle_history_size", *TIMES], pad_length, pad).items()}
    rows = aisle_history(lines, departments, shared, lambda numbers: numbers)
    own = {c: pad(c, pad_length) for c in AISLE_STEPS if c not in shared}
    steps = [own[c][0].alias(c) if c in own else c for c in (*AISLE_STEPS, *TIMES)]
    return rows.select("user_id", "aisle_id", "department_id", "eval_set", *steps, own["is_ordered_history"][1].alias("history_length"))


def product_training(history: DataFrame, encoded: DataFrame | None, name_length: int = NAME_LENGTH, encode_length: int = ENCODE_LENGTH) -> DataFrame:
    """A product without an encoding has an empty name. Without ``encoded``, the history has ``product_name_encoded`` itself, which spares
    its rows a shuffle by product."""
    every = _padded([*PRODUCT_STEPS, *TIMES], encode_length)
    name, size = pad_sequence(parse_sequence("product_name_encoded"), name_length)
    rows = history if encoded is None else history.join(encoded, "product_id", "left")
    return rows.select("user_id", "product_id", "train_eval_set", "label", name.alias("product_name_encoded"), *(every[c][0].alias(c) for c in every), every["is_ordered_history"][1].alias("history_length"), size.alias("product_name_length"))
