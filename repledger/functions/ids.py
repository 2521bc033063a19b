"""Row identity (C-14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_id(from_file: Column, sheet_name: Column, row_idx: Column) -> Column:
    """Identity of a sheet row: the same row gets the same id on every attempt and every run."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (from_file, sheet_name, row_idx)]
    return F.sha2(F.concat_ws("/", *parts), 256)
