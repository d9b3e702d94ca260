"""Declarative data quality: contract, aggregates, report, write gate."""
