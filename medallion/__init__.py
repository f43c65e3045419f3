"""Medallion tables for semi-structured review feeds, on stock PySpark."""
