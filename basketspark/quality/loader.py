"""Contracts from YAML or JSON files."""

from __future__ import annotations

import json
import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ..sources.versions import Store
from .errors import InvalidContractError
from .wellformed import check_contract


def _text(path: str, spark: SparkSession | None) -> str:
    """The file's text: from any store that Spark reads if a session is given, else from this machine."""
    try:
        if spark is None:
            with open(path, encoding="utf-8") as f:
                return f.read()
        return Store(spark, path).read()
    except (FileNotFoundError, Py4JJavaError) as e:
        if isinstance(e, Py4JJavaError) and e.java_exception.getClass().getSimpleName() not in ("FileNotFoundException", "NoSuchFileException"):
            raise
        raise FileNotFoundError(f"no contract at {path}") from e


def load_contract(path: str | os.PathLike, spark: SparkSession | None = None) -> dict:
    """The contract of a file: ``dataset`` (name, grain, allow_extra_columns and what else describes it), ``schema``, ``relationships``,
    ``derived_fields`` and ``rules``. What is under ``dataset`` stands beside the rest in the contract that is returned."""
    path = os.fspath(path)
    text = _text(path, spark)
    if path.lower().endswith(".json"):
        try:
            told = json.loads(text) if text.strip() else None
        except json.JSONDecodeError as e:
            raise InvalidContractError(f"{path}: {e}") from e
    else:
        import yaml

        try:
            told = yaml.safe_load(text)
        except yaml.YAMLError as e:
            raise InvalidContractError(f"{path}: {e}") from e
    if told is None:
        raise InvalidContractError(f"{path} is empty")
    if not isinstance(told, dict) or not isinstance(told.get("dataset", {}), dict):
        raise InvalidContractError(f"{path}: a contract is a mapping, and so is its dataset")
    contract = {**told.get("dataset", {}), **{k: v for k, v in told.items() if k != "dataset"}}
    check_contract(contract)
    return contract
