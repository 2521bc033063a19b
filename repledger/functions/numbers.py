"""Money, number and percentage parsing; exact decimals instead of binary floats (P-6..P-8, C-8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repledger.functions.text import WHITESPACE

MONEY = "decimal(18,2)"
UNIT = "decimal(18,6)"
SHARE = "decimal(18,4)"
FRACTION = "decimal(9,6)"


def parse_money(c: Column, to: str = MONEY) -> Column:
    """`'$1,234.50'` as a decimal; anything that is not a number becomes NULL."""
    return F.translate(c, "$," + WHITESPACE, "").try_cast(to)


def parse_number(c: Column, to: str = "bigint") -> Column:
    """Whole numbers; `'12.0'` is accepted and rounded the way a decimal cast rounds."""
    return F.translate(c, "," + WHITESPACE, "").try_cast(UNIT).try_cast(to)


def parse_percent(c: Column) -> Column:
    """Number in front of an optional percent sign, still on the scale the sheet used."""
    return F.translate(c, "%," + WHITESPACE, "").try_cast(UNIT)


def scale_percent(value: Column, sheet_max: Column) -> Column:
    """Fractions; a sheet whose column holds any value above 1 was written in percent points."""
    return F.when(sheet_max > 1, value / 100).otherwise(value).cast(FRACTION)


def unparsed(raw: Column, parsed: Column) -> Column:
    """True where text was present but no number came out of it."""
    return raw.isNotNull() & parsed.isNull()


def ratio(part: Column, whole: Column) -> Column:
    """`part / whole`, NULL when either is zero or missing."""
    return F.when((part != 0) & (whole != 0), F.try_divide(part.cast("double"), whole.cast("double")))


def currency(c: Column) -> Column:
    """`$1,234.50`, with the sign in front of the currency mark."""
    return F.concat(F.when(c < 0, F.lit("-$")).otherwise(F.lit("$")), F.format_number(F.abs(c), 2))
