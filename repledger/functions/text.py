"""Text cleanup expressions (P-1, P-2, P-11, P-12 and the string functions of the inventory)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\r\n\f\u000b"


def strip(c: Column) -> Column:
    """Both ends without white space. Trimming blanks alone is much the faster, and nearly always enough.

    A text that begins with white space comes before `!`; what it ends with is compared in place.
    """
    t = F.trim(c)
    rest = t < F.lit("!")
    for space in WHITESPACE[1:]:
        rest = rest | F.endswith(t, F.lit(space))
    return F.when(rest, F.btrim(t, F.lit(WHITESPACE))).otherwise(t)


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WHITESPACE))


def known(trimmed: Column) -> Column:
    """Trimmed text, with what is missing as NULL."""
    return F.when((trimmed != F.lit("")) & (trimmed != F.lit("nan")), trimmed)


def blank_to_null(c: Column) -> Column:
    """Trimmed cell text; empty cells and the literal `nan` are missing."""
    return F.nullif(F.nullif(strip(c), F.lit("")), F.lit("nan"))


def initials(c: Column) -> Column:
    """Salesperson initials and principal codes: trimmed, upper case, blank as NULL."""
    return F.nullif(F.upper(strip(c)), F.lit(""))


def fold(c: Column) -> Column:
    """Case-insensitive join key in which a blank equals a blank."""
    return F.coalesce(F.lower(c), F.lit(""))


def same_or_blank(c: Column) -> Column:
    """Case-sensitive join key in which a blank equals a blank."""
    return F.coalesce(c, F.lit(""))


def alnum_lower(c: Column) -> Column:
    """Letters and digits only, lower case (the form distributor abbreviations are searched in)."""
    return F.lower(F.regexp_replace(c, "[^a-zA-Z0-9]", ""))


def city_list(c: Column) -> Column:
    """`'Oslo, Bergen'` as an upper-case array."""
    return F.split(F.upper(rstrip(c)), ", ")


def file_name(path: Column) -> Column:
    """Last component of a slash or backslash path."""
    return F.regexp_extract(path, r"([^/\\]+)$", 1)


SPREAD_BY = ("unique_id", "from_file", "sheet_name", "row_idx", "invoice_number", "part_number")


def key_or_spread(key: Column, columns: list[str]) -> Column:
    """The key of a left join, or, where it is NULL, a text that no key equals and that differs from row to row.

    NULL keys would all be dealt to one task. The text is made of those columns of SPREAD_BY that the rows have.
    """
    by = [F.col(c) for c in SPREAD_BY if c in columns]
    return F.coalesce(key, F.concat(F.lit("\u0001"), F.xxhash64(*by).cast("string"))) if by else key
