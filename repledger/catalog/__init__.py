"""Queries over the driver's tables, each with the SQL that checks it."""

from importlib import import_module


def load():
    """Import every query module and return the filled registry."""
    for module in ("money", "matching", "merging", "sheets", "insight", "stored", "evidence"):
        import_module(f"repledger.catalog.{module}")
    return import_module("repledger.catalog.registry")
