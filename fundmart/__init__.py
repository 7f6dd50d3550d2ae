"""Funding deliveries to checked, queryable star tables, as Spark DataFrames."""

__version__ = "0.1.0"
