"""Errors of contracts and of the data they are held against."""

from __future__ import annotations


class ContractError(Exception):
    pass


class InvalidContractError(ContractError):
    """The contract itself is malformed."""


class InvalidConstraintError(ValueError):
    """A constraint, threshold, key or rule of the contract can't be used."""


class EmptyDatasetError(ValueError):
    """There is nothing to check."""


class DataValidationError(RuntimeError):
    """Data failed its contract; ``report`` has the findings that were made."""

    def __init__(self, report, why: str = ""):
        self.report = report
        super().__init__(f"dataset {report.dataset} failed its contract" + (f": {why}" if why else ""))
