"""Schemas, loaders, sinks and the file ledger."""
