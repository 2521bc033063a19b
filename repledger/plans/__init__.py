"""Whole flows: dicts of DataFrames in and out; nothing is written here."""
