"""Registry of queries and of the SQL text that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from repledger.catalog import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, uses: tuple[str, ...] = ("lines",), oracle: str | None = None):
    """Register a function of `Tables`; `oracle` is SQL over the tables named in `uses`."""
    def register(fn: Callable[[tables.Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(tables.Tables(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = tables.with_tables(oracle, uses)
        return fn
    return register
