"""Vocabulary of a text column and texts as word indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import ranked

MIN_WORD_FREQ = 5


def _words(text: str) -> F.Column:
    return F.split(F.trim(F.lower(F.col(text))), r"\s+")


def word_count(texts: DataFrame, text: str = "product_name") -> DataFrame:
    return texts.select(F.explode(_words(text)).alias("word")).filter("word != ''").groupBy("word").agg(F.count("*").alias("word_count"))


def word_index(texts: DataFrame, text: str = "product_name", min_word_freq: int = MIN_WORD_FREQ) -> DataFrame:
    """(word, word_idx): 1 and up by count and word for frequent words, 0 for rare ones.

    Frequent words come first in the order by count, so their places among all words are theirs; the texts are read once. Places are
    two-level sums over ranges of the order (``ranks``): no task has to see the whole vocabulary."""
    placed = ranked(word_count(texts, text), [F.desc("word_count"), "word"], "place")
    return placed.select("word", F.when(F.col("word_count") >= min_word_freq, F.col("place")).otherwise(0).cast("int").alias("word_idx"))


def encoded_names(texts: DataFrame, index: DataFrame, key: str = "product_id", text: str = "product_name") -> DataFrame:
    """(key, product_name_encoded): indexes in word order. Words not in the index are dropped; no words at all give "0"."""
    tokens = texts.select(key, F.posexplode(_words(text)).alias("place", "word")).filter("word != ''").join(index, "word", "left")
    encoded = tokens.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", "word_idx"))).alias("w"))
    encoded = encoded.select(key, F.array_join(F.col("w.word_idx").cast("array<string>"), " ").alias("product_name_encoded"))
    return texts.select(key).join(encoded, key, "left").fillna({"product_name_encoded": "0"})
