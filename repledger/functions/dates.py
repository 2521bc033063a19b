"""Date parsing, validity and commission calendar (P-9, F-8, F-9, C-3, C-9..C-11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted spellings of a date, as (shape, pattern).
DATE_FORMATS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,9} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
)
TIME_SUFFIX = r"[ T]([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?$"


# A two-digit year lies in the hundred years that end so many years after the day of the run, or, where
# none is given, after this year. The clock is never read.
YEARS_AHEAD = 50
WITHOUT_A_DAY = 2025


def parse_date(c: Column, as_of: dt.date | None = None) -> Column:
    """Date from text in any of DATE_FORMATS with an optional time of day, else NULL.

    Two-digit years are read as of the day `as_of`. The shape test is made first so that a row tries one pattern only.
    Days and months are told apart by the shape alone; `sheet_dates` in `operators.evidence` goes by the whole sheet.
    """
    text = F.regexp_replace(F.trim(c), TIME_SUFFIX, "")
    century_ends = F.lit((WITHOUT_A_DAY if as_of is None else as_of.year) + YEARS_AHEAD)
    branches = None
    for shape, pattern in DATE_FORMATS:
        source = F.initcap(text) if "MMM" in pattern else text
        parsed = F.try_to_timestamp(source, F.lit(pattern)).cast("date")
        if pattern.endswith("/yy"):
            within = F.year(parsed) % 100 + F.floor(century_ends / 100) * 100  # in the century of the last such year
            year = F.when(within >= century_ends, within - 100).otherwise(within)
            parsed = F.add_months(parsed, ((year - F.year(parsed)) * 12).cast("int"))
        branches = F.when(text.rlike(shape), parsed) if branches is None else branches.when(text.rlike(shape), parsed)
    return branches


# Names in dates, and words that say nothing about the day.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
NOISE = ("mon", "monday", "tue", "tues", "tuesday", "wed", "wednesday", "thu", "thur", "thurs", "thursday", "fri", "friday", "sat",
         "saturday", "sun", "sunday", "of", "the", "day")
CLOCK = r"[ t,]+([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?( ?[ap]m)?( ?(z|utc|gmt))?$"


def month_number(token: Column) -> Column:
    """1 to 12 for a month's name or its first letters, three at least."""
    short = "".join(m[:3] for m in MONTHS)
    at = F.instr(F.lit(short), F.substring(token, 1, 3))
    found = F.floor((at + 2) / 3).cast("int")
    name = F.get(F.array(*[F.lit(m) for m in MONTHS]), found - 1)
    return F.when((at % 3 == 1) & (F.length(token) >= 3) & F.startswith(name, token), found)


def with_date_parts(df: DataFrame, column: str, into: str) -> DataFrame:
    """`into`: a text's date as (year, short, month, day, a, b), NULL if it is no date.

    The text is taken apart into numbers and words, whatever stands between them; a time of day, weekdays and ordinal
    endings say nothing. Known are `y m d`, eight digits, and a month's name with day and year around it; of two short
    numbers before the year, either may be the month: they are `a` and `b`, and month and day are left open. `short` is
    true where the year has two digits.
    """
    t = F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.col(column))), CLOCK, ""), r"(\d)(st|nd|rd|th)\b", "$1")
    split = F.filter(F.regexp_extract_all("_t", F.lit("([0-9]+|[a-z]+)"), F.lit(1)), lambda x: ~x.isin(*NOISE))
    x, y, z = (F.get("_k", F.lit(k)) for k in range(3))
    number = [c.rlike("^[0-9]{1,4}$") for c in (x, y, z)]
    three = (F.size("_k") == 3) & F.col("_t").rlike(r"^[0-9a-z ,./\-]+$")
    short_day, short_second, year_last = F.length(x) <= 2, F.length(y) <= 2, F.length(z).isin(2, 4)
    compact = (F.size("_k") == 1) & F.col("_t").rlike(r"^\d{8}$")
    ymd = three & number[0] & number[1] & number[2] & (F.length(x) == 4) & short_second & (F.length(z) <= 2)
    either = three & number[0] & number[1] & number[2] & short_day & short_second & year_last
    name_first = three & month_number(x).isNotNull() & number[1] & number[2] & short_second & year_last
    name_between = three & number[0] & month_number(y).isNotNull() & number[2] & ((F.length(x) == 4) & (F.length(z) <= 2)
                                                                                 | short_day & year_last)
    year_first = ymd | name_between & (F.length(x) == 4)
    year = F.when(compact, F.substring(x, 1, 4)).when(year_first, x).otherwise(z)
    month = (F.when(compact, F.substring(x, 5, 2).try_cast("int")).when(ymd, y.try_cast("int")).when(name_first, month_number(x))
             .when(name_between, month_number(y)))
    day = (F.when(compact, F.substring(x, 7, 2)).when(ymd, z).when(name_first, y)
           .when(name_between, F.when(F.length(x) == 4, z).otherwise(x))).try_cast("int")
    parts = F.struct(year.try_cast("int").alias("year"), (F.length(year) == 2).alias("short"), month.alias("month"), day.alias("day"),
                     F.when(either, x.try_cast("int")).alias("a"), F.when(either, y.try_cast("int")).alias("b"))
    known = compact | ymd | either | name_first | name_between
    return df.withColumn("_t", t).withColumn("_k", split).withColumn(into, F.when(known, parts)).drop("_t", "_k")


def settled_date(parts: Column, day_first: Column, century_ends: Column) -> Column:
    """The date of `with_date_parts`, two open numbers read in the order given; NULL if there is no such day."""
    within = parts["year"] + F.floor(century_ends / 100) * 100
    year = F.when(parts["short"], F.when(within >= century_ends, within - 100).otherwise(within)).otherwise(parts["year"])
    month = F.coalesce(parts["month"], F.when(day_first, parts["b"]).otherwise(parts["a"]))
    day = F.coalesce(parts["day"], F.when(day_first, parts["a"]).otherwise(parts["b"]))
    return F.try_to_timestamp(F.format_string("%04d-%d-%d", year.cast("int"), month, day), F.lit("yyyy-M-d")).cast("date")


def is_recent(d: Column, as_of: dt.date, allow_future: bool = False) -> Column:
    """Invoice dates count when they lie in this year or the last, and not after `as_of`."""
    age = F.lit(as_of.year) - F.year(d)
    ok = d.isNotNull() & age.isin(0, 1)
    if not allow_future:
        ok = ok & (d <= F.lit(as_of))
    return F.coalesce(ok, F.lit(False))


def quarter_key(d: Column) -> Column:
    """`2024Q1`; sorts as text."""
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def month_abbreviation(d: Column) -> Column:
    return F.date_format(d, "MMM")


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def next_month(d: Column) -> Column:
    """First day of the month after `d`."""
    return F.add_months(F.trunc(d, "month"), 1)


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "quarter").cast("date")


def is_quarter_end(month: Column) -> Column:
    return F.month(month) % 3 == 0


def finished_quarter_start(latest_month: Column) -> Column:
    """Start of the newest quarter all of whose months are on record."""
    return F.add_months(quarter_start(next_month(latest_month)), -3)
