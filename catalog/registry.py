"""Where the query modules put their queries and the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its SQL where SQL can express it."""
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return keep


def r(column: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; keeps the column's own name."""
    if isinstance(column, str):
        return F.round(F.col(column), digits).alias(column)
    return F.round(column, digits)
