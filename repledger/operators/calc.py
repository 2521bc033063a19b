"""Commission arithmetic and row-level business expressions (C-1..C-7, C-12..C-15, F-7..F-12)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repledger.functions import dates, ids
from repledger.functions.numbers import MONEY, SHARE
from repledger.operators import match
from repledger.operators.issues import issue_rows
from repledger.sources.readers import DEFAULT_SPLIT

# House share of the commission, the pool's initials and its report labels.
HOUSE_RATE = "0.45"
POOL = "QQ"
POOL_CUSTOMER = "MISC POOL"
POOL_PRINCIPAL = "VARIOUS (MISC POOL)"
NO_LOOKUP_WORDS = ("INDIVIDUAL", "UNKNOWN", "ALLOWANCE")


def house_rate() -> Column:
    return F.lit(HOUSE_RATE).cast("decimal(4,2)")


def percent_points(c: Column) -> Column:
    """A percent-point value as an exact decimal, ready to be divided by 100 through a constant."""
    return c.cast("decimal(9,4)") * F.lit("0.01").cast("decimal(3,2)")


def split_shares(lines: DataFrame) -> DataFrame:
    """Sales commission at the house rate and its split between the two roles (C-1, C-2).

    The CM role gets the line's split (the standard one where blank or zero) if it is filled; the design
    role gets what is left, so the two always add up to the whole.
    """
    total = (F.col("actual_comm_paid") * house_rate()).cast(SHARE)
    points = F.when(F.col("cm_sales").isNull(), 0).otherwise(
        F.coalesce(F.nullif(F.col("cm_split"), F.lit(0)), F.lit(DEFAULT_SPLIT)))
    cm = (total * percent_points(points)).cast(SHARE)
    return lines.withColumns({
        "sales_commission": total,
        "cm_sales_comm": cm,
        "design_sales_comm": (total - cm).cast(SHARE)})


def calendar_columns(lines: DataFrame, date: str = "invoice_date") -> DataFrame:
    """Year, month abbreviation and quarter of the invoice date (C-3)."""
    d = F.col(date)
    return lines.withColumns({"year": F.year(d), "month": dates.month_abbreviation(d),
                              "quarter_shipped": dates.quarter_key(d)})


def month_end_commission(lines: DataFrame, salespeople: DataFrame) -> DataFrame:
    """Sales commission from the percentages of the people on each line (C-4, J-10).

    Pool lines get the house rate; two people share by split; one person gets their own percentage;
    where a person is unknown the line keeps its commission and `rate_issue` says so.
    """
    rated = match.attach_rates(lines, salespeople)
    cm, design, split = F.col("cm_pct"), F.col("design_pct"), F.col("cm_split")
    pool = (F.coalesce(F.col("cm_sales"), F.lit("")) == POOL) | (F.coalesce(F.col("design_sales"), F.lit("")) == POOL)
    both = F.col("cm_sales").isNotNull() & F.col("design_sales").isNotNull()
    hundredth = F.lit("0.01").cast("decimal(3,2)")
    points = F.coalesce(F.nullif(split, F.lit(0)), F.lit(DEFAULT_SPLIT)).cast("decimal(9,4)")
    shared = (cm * points + design * (F.lit(100).cast("decimal(9,4)") - points)) * hundredth
    alone = F.coalesce(F.nullif(cm, F.lit(0)), F.nullif(design, F.lit(0)))
    rate = F.when(both, shared).otherwise(alone).cast("decimal(10,6)")
    own = F.col("sales_commission") if "sales_commission" in lines.columns else F.lit(None).cast(SHARE)
    paid = F.col("actual_comm_paid")
    commission = (F.when(pool, (paid * house_rate()).cast(SHARE))
                  .when(rate != 0, (paid * rate * hundredth).cast(SHARE)).otherwise(own))
    missing = ~pool & rate.isNull()
    issue = F.when(missing & both, F.lit("NO_PERCENTAGE")).when(missing, F.lit("NO_SALESPERSON"))
    return rated.withColumns({"sales_commission": commission, "rate_issue": issue}).drop("cm_pct", "design_pct")


def rate_issues(calculated: DataFrame) -> DataFrame:
    rows = calculated.filter(F.col("rate_issue").isNotNull())
    parts = [issue_rows(rows.filter(F.col("rate_issue") == code), "month_end_commission", code,
                        F.concat_ws("/", "cm_sales", "design_sales"), "from_file", row_ref="unique_id")
             for code in ("NO_PERCENTAGE", "NO_SALESPERSON")]
    return parts[0].unionByName(parts[1])


def by_person(lines: DataFrame, salespeople: DataFrame) -> DataFrame:
    """One row per line and known person on it, scaled to that person's share (C-5).

    Where two people are named the commission is scaled by the split and the sales commission recomputed
    at the person's percentage; lines with one person are passed through.
    """
    people = F.array_distinct(F.array_compact(F.array("cm_sales", "design_sales")))
    fanned = lines.withColumn("salesperson", F.explode(people))
    rates = match.person_rates(salespeople).select(F.col("sales_initials").alias("salesperson"),
                                                   F.col("sales_percentage").alias("_pct"))
    rated = fanned.join(rates, "salesperson")
    points = F.coalesce(F.nullif(F.col("cm_split"), F.lit(0)), F.lit(DEFAULT_SPLIT)).cast("decimal(9,4)")
    is_cm, is_design = F.col("cm_sales") == F.col("salesperson"), F.col("design_sales") == F.col("salesperson")
    shared = F.col("cm_sales").isNotNull() & F.col("design_sales").isNotNull()
    share = (F.when(is_cm & ~is_design, points).when(is_design & ~is_cm, 100 - points).otherwise(F.lit(100))
             .cast("decimal(9,4)"))
    hundredth = F.lit("0.01").cast("decimal(3,2)")
    paid = F.when(shared, (F.col("actual_comm_paid") * share * hundredth).cast(SHARE)).otherwise(
        F.col("actual_comm_paid").cast(SHARE))
    own = F.when(shared, (paid * F.col("_pct") * hundredth).cast(SHARE)).otherwise(F.col("sales_commission"))
    return rated.withColumns({"actual_comm_paid": paid, "sales_commission": own}).drop("_pct")


def pool_lines(lines: DataFrame, salespeople: DataFrame, month: dt.date | Column) -> DataFrame:
    """One line per person with their share of the pool's sales commission (C-6).

    The pool total is one number, put in as a scalar subquery. People without a pool share get no line.
    """
    total = lines.filter(F.col("design_sales") == POOL).agg(F.sum("sales_commission").alias("s")).scalar()
    hundredth = F.lit("0.01").cast("decimal(3,2)")
    share = (F.coalesce(total, F.lit(0)).cast("decimal(20,4)") * F.col("qq_split") * hundredth).cast(SHARE)
    month = month if isinstance(month, Column) else F.lit(month)
    return (match.person_rates(salespeople).filter(F.col("qq_split").isNotNull())
            .select(F.col("sales_initials").alias("salesperson"),
                    F.lit(POOL_CUSTOMER).alias("t_end_cust"), F.lit(POOL_PRINCIPAL).alias("principal"),
                    F.lit(POOL).alias("design_sales"), month.alias("comm_month"),
                    share.alias("sales_commission")))


def mark_complete(lines: DataFrame, as_of: dt.date) -> DataFrame:
    """`date_ok` and `is_complete`: one lookup match, one distributor match, a valid date (C-15, F-8)."""
    ok = dates.is_recent(F.col("invoice_date"), as_of)
    marked = lines.withColumn("date_ok", ok)
    return marked.withColumn("is_complete", (F.col("lookup_matches") == 1) & (F.col("distributor_matches") == 1)
                             & F.col("date_ok"))


def needs_fixing(marked: DataFrame, as_of: dt.date) -> DataFrame:
    """Whole rows of the lines that are not complete, with the reason columns and the day added (C-15)."""
    return marked.filter(~F.col("is_complete")).withColumn("date_added", F.lit(as_of))


def finish_lines(marked: DataFrame) -> DataFrame:
    """All lines; the complete ones with commission shares, the others with none yet (C-1, C-2, C-15)."""
    shared = split_shares(marked)
    return shared.withColumns({c: F.when(F.col("is_complete"), F.col(c)) for c in
                               ("sales_commission", "cm_sales_comm", "design_sales_comm")})


def learnable(lines: DataFrame) -> DataFrame:
    """Lines whose end customer may enter the lookup master (F-11); a blank end customer may."""
    name = F.upper(F.coalesce(F.col("t_end_cust"), F.lit("")))
    return lines.filter(~name.rlike("|".join(NO_LOOKUP_WORDS)))


def nonstandard_splits(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("cm_split") != DEFAULT_SPLIT)


def tag_ids(lines: DataFrame) -> DataFrame:
    """Give an id to lines that lack one, leaving the others alone (C-14)."""
    made = ids.row_id(F.col("from_file"), F.col("sheet_name"), F.col("row_idx"))
    return lines.withColumn("unique_id", F.coalesce(F.col("unique_id"), made))


def stamp_report_date(lines: DataFrame, as_of: dt.date) -> DataFrame:
    """`sales_report_date` where still blank (P-19)."""
    return lines.withColumn("sales_report_date", F.coalesce(F.col("sales_report_date"), F.lit(as_of)))


def blank_zeros(lines: DataFrame) -> DataFrame:
    """Quantity and year of 0 are shown as blanks (P-14)."""
    return lines.withColumns({c: F.nullif(F.col(c), F.lit(0)) for c in ("quantity", "year") if c in lines.columns})
