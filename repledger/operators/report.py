"""Totals, pivots, statements and per-person reports (A-1..A-16, O-1..O-3, F-14, F-15, U-5, U-6, C-8..C-11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repledger.functions import dates, numbers
from repledger.functions.numbers import MONEY, SHARE
from repledger.operators import calc, match

GRAND_TOTAL = "Grand Total"
REPORT_QUARTERS = 5
GRID_SLOTS = 8
BLANK_HEADING = "(blank)"
MEASURES = {"paid_on_revenue": MONEY, "actual_comm_paid": SHARE, "sales_commission": SHARE}


def _sums(columns=tuple(MEASURES)) -> list[Column]:
    return [F.sum(c).cast(MEASURES[c]).alias(c) for c in columns]


# --- totals ------------------------------------------------------------------------------------------

def principal_totals(lines: DataFrame, with_rate: bool = False) -> DataFrame:
    """Revenue, commission and sales commission by principal, and one `Grand Total` row (A-2, A-3, C-8).

    `level` is 1 on the grand total; `orderBy('level', 'principal')` puts it last (O-3).
    """
    rolled = lines.rollup("principal").agg(F.grouping("principal").cast("int").alias("level"), *_sums())
    name = F.when(F.col("level") == 1, F.lit(GRAND_TOTAL)).otherwise(F.col("principal"))
    out = rolled.withColumn("principal", name)
    if with_rate:
        out = out.withColumn("true_comm_pct", numbers.ratio(F.col("actual_comm_paid"), F.col("paid_on_revenue")))
    return out


def totals_by_person(scaled: DataFrame, columns=tuple(MEASURES)) -> DataFrame:
    """Per person a subtotal (`level` 1, no principal) and the principals (`level` 0) (A-4, A-5, A-6)."""
    people, principal = F.col("salesperson"), F.col("principal")
    return (scaled.groupingSets([[people], [people, principal]], people, principal)
            .agg(F.grouping("principal").cast("int").alias("level"), *_sums(columns)))


def file_totals(lines: DataFrame) -> DataFrame:
    """Commission per sheet and per file in one aggregation; `sheet_name` is NULL on file rows (A-1)."""
    file, sheet = F.col("from_file"), F.col("sheet_name")
    return (lines.groupingSets([[file, sheet], [file]], file, sheet)
            .agg(F.grouping("sheet_name").cast("int").alias("level"), F.count(F.lit(1)).alias("n_lines"),
                 F.sum("actual_comm_paid").cast(MONEY).alias("total_commissions")))


def merged_file_totals(totals: DataFrame) -> DataFrame:
    """Totals of several batches as those of all their lines (A-1, T-1)."""
    return totals.groupBy("from_file", "sheet_name", "level").agg(
        F.sum("n_lines").alias("n_lines"), F.sum("total_commissions").cast(MONEY).alias("total_commissions"))


# --- pivots ------------------------------------------------------------------------------------------

def labels(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a pivot column, blank last: all of them, as each becomes a column of the result.

    A column whose values are not few belongs in `pivot_long`, which brings none of them to the driver.
    """
    found = [r[0] for r in df.select(_heading(column).alias("h")).distinct().collect()]
    return sorted(found, key=lambda h: (h == BLANK_HEADING, h))


def _heading(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(BLANK_HEADING))


def pivot_long(df: DataFrame, rows: list[str], col: str, value: str, page: Column | None = None, totals: bool = False,
               to: str = SHARE) -> DataFrame:
    """Sum of `value` by `rows` and heading, one row for each cell (A-7..A-10); headings are free in number.

    With `totals`, subtotals over the row fields from the last to the first, each by heading and over all headings:
    `level` counts as in `rollup`, and `all_headings` is 1 where the cell is a total over the headings.
    """
    if page is not None:
        df = df.filter(page)
    shown = df.withColumn("heading", _heading(col))
    total = F.sum(value).cast(to).alias("value")
    if not totals:
        return shown.groupBy(*rows, "heading").agg(total)
    fields = [F.col(c) for c in rows]
    sets = [fields[:n] + extra for n in range(len(fields), -1, -1) for extra in ([F.col("heading")], [])]
    level = sum((F.grouping(c).cast("int") * (1 << (len(rows) - 1 - k)) for k, c in enumerate(rows)), F.lit(0))
    return shown.groupingSets(sets, *fields, F.col("heading")).agg(
        level.alias("level"), F.grouping("heading").cast("int").alias("all_headings"), total)


def pivot_sum(df: DataFrame, rows: list[str], col: str, value: str, page: Column | None = None,
              values: list[str] | None = None, totals: bool = False, to: str = SHARE) -> DataFrame:
    """Sum of `value` by `rows` against the values of `col` (A-7..A-10).

    A single aggregation with one conditional sum per column; a blank is a heading like any other. `page` is the page
    filter; `totals` adds subtotals over the row fields (`level` > 0) and a `total` column over all lines, also those
    whose heading is not among `values`.
    """
    if page is not None:
        df = df.filter(page)
    values = labels(df, col) if values is None else values
    cells = [F.sum(F.when(_heading(col) == v, F.col(value))).cast(to).alias(v) for v in values]
    if not totals:
        return df.groupBy(*rows).agg(*cells)
    return (df.rollup(*rows)
            .agg(F.grouping_id().cast("int").alias("level"), *cells, F.sum(value).cast(to).alias("total")))


# --- periods -----------------------------------------------------------------------------------------

def last_quarters(*tables: DataFrame, count: int = REPORT_QUARTERS) -> DataFrame:
    """The newest quarters across all tables; a blank quarter sorts before all others (O-2, U-5)."""
    quarters = tables[0].select("quarter_shipped").distinct()
    for other in tables[1:]:
        quarters = quarters.union(other.select("quarter_shipped").distinct())
    return (quarters.distinct().orderBy(F.col("quarter_shipped").desc_nulls_last()).limit(count))


def newest_quarters(*tables: DataFrame, count: int = REPORT_QUARTERS) -> list[str | None]:
    """The values of `last_quarters`: metadata like a pivot's headings, `count` at most."""
    return [r[0] for r in last_quarters(*tables, count=count).collect()]


def headings(values: list[str | None]) -> list[str]:
    """Values of a pivot column as `labels` gives them."""
    return sorted({BLANK_HEADING if v is None else v for v in values}, key=lambda h: (h == BLANK_HEADING, h))


def revenue_history(history: DataFrame, running: DataFrame | None = None, quarters: list[str | None] | None = None) -> DataFrame:
    """History of the last five quarters plus all running lines (O-2, U-1).

    With `quarters`, found before by `newest_quarters`, the lines are not read for them again, and those of other quarters
    go as soon as their own is known, which may be before they have met all the tables that they are made from.
    """
    own = F.coalesce("quarter_shipped", F.lit(""))
    if quarters is not None:
        kept = history.filter(own.isin([q or "" for q in quarters]))
    else:
        found = last_quarters(*([history] if running is None else [history, running]))
        keys = found.select(own.alias("_q"))
        kept = history.withColumn("_q", own).join(F.broadcast(keys), "_q", "left_semi").drop("_q")
    return kept if running is None else kept.unionByName(running, allowMissingColumns=True)


def latest_month(history: DataFrame, month: str = "comm_month") -> Column:
    """Newest commission month as a scalar subquery (A-12)."""
    return history.agg(F.max(month).alias("m")).scalar()


def latest_month_slice(history: DataFrame, month: str = "comm_month") -> DataFrame:
    """Lines of the newest month, for a report re-run (F-14)."""
    return history.filter(F.col(month) == latest_month(history, month))


def tag_next_month(running: DataFrame, history: DataFrame) -> DataFrame:
    """Running lines tagged with the month after the newest in history (C-9, P-19)."""
    return running.withColumn("comm_month", dates.next_month(latest_month(history)))


def quarter_to_date(history: DataFrame, current_month: Column, month: str = "comm_month") -> DataFrame:
    """Lines of the current quarter up to and including the current month (C-10, F-18)."""
    m = F.col(month)
    return history.filter(m.isNotNull() & (m >= dates.quarter_start(current_month)) & (m <= current_month))


def finished_quarter(history: DataFrame, month: str = "comm_month") -> DataFrame:
    """Lines of the newest finished quarter (C-11)."""
    start = dates.finished_quarter_start(latest_month(history, month))
    m = F.col(month)
    return history.filter((m >= start) & (m < F.add_months(start, 3)))


def remove_month(history: DataFrame, month: dt.date) -> DataFrame:
    """History without one commission month; lines without a month stay (F-13)."""
    return history.filter(~F.col("comm_month").eqNullSafe(F.lit(month)))


# --- per-person reports ------------------------------------------------------------------------------

def revenue_by_person(lines: DataFrame, accounts: DataFrame, salespeople: DataFrame) -> DataFrame:
    """Lines of each person's revenue report (U-6, F-12, F-15, J-8).

    A line goes to its current design salesperson and, where the split is not the standard one, also to
    a different CM salesperson. One pass serves everybody; lines that carry their current design salesperson already
    are not tagged again.
    """
    tagged = lines if "cds" in lines.columns else match.tag_current_design_sales(lines, accounts)
    cm = F.when(F.col("cm_split") != calc.DEFAULT_SPLIT, F.col("cm_sales"))
    people = F.array_distinct(F.array_compact(F.array(F.col("cds"), cm)))
    known = match.person_rates(salespeople).select(F.col("sales_initials").alias("salesperson"))
    return (tagged.filter(F.col("quarter_shipped").isNotNull())
            .withColumn("salesperson", F.explode(people)).join(known, "salesperson", "left_semi"))


def commission_report(lines: DataFrame, salespeople: DataFrame, month: dt.date | Column) -> DataFrame:
    """Every person's lines scaled to their share, with their pool line (C-5, C-6, U-1)."""
    scaled = calc.by_person(lines, salespeople)
    return scaled.unionByName(calc.pool_lines(lines, salespeople, month), allowMissingColumns=True)


def quarterly_salespeople(lines: DataFrame, salespeople: DataFrame) -> DataFrame:
    """Commission and sales commission per person and principal, without the pool line (A-4)."""
    return totals_by_person(calc.by_person(lines, salespeople), ("actual_comm_paid", "sales_commission"))


def overall_revenue_pivot(tagged: DataFrame, principal: str | None = None) -> DataFrame:
    """Revenue of all lines by principal page, current salesperson, end customer, part and maker, against quarters (A-8).

    `principal` keeps one page; without it each page's rows carry their principal.
    """
    page = None if principal is None else F.col("principal") == principal
    return pivot_long(tagged, ["principal", "cds", "t_end_cust", "part_number", "cm"], "quarter_shipped",
                      "paid_on_revenue", page=page, to=MONEY)


def commission_pivot(report: DataFrame) -> DataFrame:
    """Each person's commission by end customer and principal against the report's own months (A-9).

    The pool line is one of the customers. Subtotals by customer and by person, each by month and over all months.
    """
    months = report.withColumn("_month", dates.month_key(F.col("comm_month")))
    shown = pivot_long(months, ["salesperson", "t_end_cust", "principal"], "_month", "sales_commission", totals=True)
    return shown.filter("level < 7")


def statement(report: DataFrame, principals: DataFrame, salespeople: DataFrame) -> DataFrame:
    """Each person's sales commission for every principal, those without sales included, and the total (A-14).

    The report asks for every person and every principal: the grid is the product of the two dimensions, and as large
    as the statement itself. It is built from their distinct rows, dealt to tasks by person.
    """
    people = match.person_rates(salespeople).select(F.col("sales_initials").alias("salesperson"))
    listed = principals.select(F.col("abbreviation").alias("principal"), "full_name").distinct()
    slots = F.sequence(F.lit(0), F.lit(GRID_SLOTS - 1))
    grid = (people.withColumn("_slot", F.explode(slots))
            .join(listed.withColumn("_slot", F.pmod(F.xxhash64("principal", "full_name"), F.lit(GRID_SLOTS)).cast("int")), "_slot")
            .drop("_slot"))
    sums = report.groupBy("salesperson", "principal").agg(F.sum("sales_commission").alias("_c"))
    filled = grid.join(sums, ["salesperson", "principal"], "left").withColumn("_c", F.coalesce("_c", F.lit(0)))
    person, full = F.col("salesperson"), F.col("full_name")
    rolled = (filled.groupingSets([[person], [person, full]], person, full)
              .agg(F.grouping("full_name").cast("int").alias("level"),
                   F.sum("_c").cast(MONEY).alias("sales_commission")))
    return rolled.select(
        "salesperson", F.when(F.col("level") == 1, F.lit("TOTAL COMMISSIONS DUE")).otherwise(full).alias("line"),
        "level", "sales_commission", numbers.currency(F.col("sales_commission")).alias("shown"))


# --- counters and checks -----------------------------------------------------------------------------

def run_counters(read: DataFrame, matched: DataFrame) -> DataFrame:
    """Per file of a run: rows read, lines that count, rows dropped, lines with exactly one lookup entry (A-16)."""
    rows = read.groupBy("from_file").agg(F.count(F.lit(1)).alias("n_rows"))
    kept = matched.groupBy("from_file").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("lookup_matches") == 1).alias("n_matched"))
    none = F.lit(0).cast("bigint")
    return rows.join(kept, "from_file", "left").select(
        "from_file", "n_rows", F.coalesce("n_lines", none).alias("n_lines"),
        (F.col("n_rows") - F.coalesce("n_lines", none)).alias("n_dropped"), F.coalesce("n_matched", none).alias("n_matched"))


def data_quality_counts(lines: DataFrame, as_of: dt.date) -> DataFrame:
    """Counters of a run by principal: lines, blanks, zero commissions, bad dates, newest month (A-11, A-12, A-16)."""
    recent = dates.is_recent(F.col("invoice_date"), as_of)
    return lines.groupBy("principal").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("reported_customer").isNull()).alias("n_no_customer"),
        F.count_if(F.coalesce(F.col("actual_comm_paid"), F.lit(0)) == 0).alias("n_no_commission"),
        F.count_if(F.col("cm_sales").isNull() & F.col("design_sales").isNull()).alias("n_no_salesperson"),
        F.count_if(~recent).alias("n_bad_date"),
        F.max("comm_month").alias("latest_month"))


class NotConserved(ValueError):
    """Lines were merged and their commission total is not what it was."""


def require_conserved(check: DataFrame) -> None:
    """Raise when the totals of `commission_difference` differ (A-15)."""
    row = check.first()
    if row["difference"]:
        raise NotConserved(f"commission was {row['commission_before']}, is {row['commission_after']}")


def commission_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Commission totals of two tables and their difference; 0 means conserved (A-15)."""
    total = F.sum("actual_comm_paid").cast(MONEY)
    both = (before.agg(total.alias("t")).select("t", F.lit("before").alias("side"))
            .unionByName(after.agg(total.alias("t")).select("t", F.lit("after").alias("side"))))
    return both.agg(
        F.max(F.when(F.col("side") == "before", F.col("t"))).alias("commission_before"),
        F.max(F.when(F.col("side") == "after", F.col("t"))).alias("commission_after")).withColumn(
        "difference", F.coalesce("commission_after", F.lit(0)) - F.coalesce("commission_before", F.lit(0)))
