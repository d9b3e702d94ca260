"""Basket-history features and declarative data quality on Spark."""
