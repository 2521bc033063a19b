"""The four working flows: process files, merge fixed entries, migrate and report, insight rows.

Each flow starts from stored tables; store what one returns (`sinks`) before handing it to the next.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from repledger.functions import dates
from repledger.operators import calc, conform, insight, issues, match, merge, report
from repledger.sources import ledger as files
from repledger.sources import schema


@dataclass
class Dimensions:
    """Supporting tables; a flow uses those it needs."""
    principals: DataFrame | None = None
    lookup_master: DataFrame | None = None
    distributor_map: DataFrame | None = None
    invoice_log: DataFrame | None = None
    salespeople: DataFrame | None = None
    accounts: DataFrame | None = None
    root_customers: DataFrame | None = None


ORDER = ("from_file", "sheet_name", "row_idx")


def line_order(df: DataFrame):
    """Order of lines across files: file, sheet, row as far as they are known, then id."""
    return F.struct(*[c for c in (*ORDER, "unique_id") if c in df.columns])


def accepted_sheets(raw: DataFrame, ledger: DataFrame, aliases: dict[str, list[str]], dims: Dimensions, as_of: dt.date,
                    strict: bool = False, stage=None, **options) -> tuple[conform.Conformed, DataFrame]:
    """What conforming makes of the new files, lines of accepted files only, and the accepted files."""
    fresh = files.new_files(raw, ledger)
    out = conform.conform_sheets(fresh, aliases, dims.principals, dims.distributor_map, dims.invoice_log, stage=stage,
                                 as_of=as_of, **options)
    if stage is not None:
        out.issues = stage(out.issues)
    if strict:
        issues.enforce(out.issues)
    # The refused files are known from the profile, which is small, whatever the number of issues about cells.
    if out.drops is None:
        out.lines = out.lines.join(out.refused, "from_file", "left_anti")
    # The profile has a row for each sheet, so the rows need not be read for the names of their files.
    return out, out.profile.select("from_file").distinct().join(out.refused, "from_file", "left_anti")


def accepted_lines(raw: DataFrame, ledger: DataFrame, aliases: dict[str, list[str]], dims: Dimensions, as_of: dt.date,
                   strict: bool = False, stage=None, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines of the new files that are free of fatal issues, those files, and the issues of all new files."""
    out, read = accepted_sheets(raw, ledger, aliases, dims, as_of, strict, stage, **options)
    return out.lines, read, out.issues


def canonical(lines: DataFrame) -> DataFrame:
    """Accepted lines with all columns of a finished line, in place of what only the rules needed."""
    base = lines.drop("present", "bad_cells", "oem_pos", "sales_region",
                      "customer_hits", "logged_part", "distributor")
    return base.withColumns({c: F.lit(None).cast(schema.LINE_TYPES.get(c, "string"))
                             for c in schema.ordered_columns() if c not in base.columns})


def process_files(raw: DataFrame, ledger: DataFrame, aliases: dict[str, list[str]], dims: Dimensions, as_of: dt.date,
                  lookup_order=None, running: DataFrame | None = None, strict: bool = False,
                  stage=None) -> dict[str, DataFrame]:
    """New sheets to running lines, entries needing fixing, lookup usage, ledger and issues.

    A file whose sheets cannot be mapped is refused as a whole: none of its lines runs on, and it gets no ledger entry, so
    its corrected copy is read in a later run. Every other file that was read gets one, with a total of 0 if no line of it
    counts; a cell of it that is no number is NULL and an issue. `strict` stops the run instead. `stage` may store the
    mapped sheets, the issues and the finished lines, which several outputs read; then `drop_reasons` tells how many rows
    were left out, and why, as counted while the lines were stored. `running` must have the columns of finished lines, no more and no less.
    """
    # Rows can be counted as lines are stored; without a store each output would count them anew.
    drops = None if stage is None else Observation()
    sheets, read = accepted_sheets(raw, ledger, aliases, dims, as_of, strict, stage, drops=drops)
    lines, found = sheets.lines, sheets.issues
    tagged = calc.tag_ids(canonical(lines))
    order = F.col("lookup_id") if lookup_order is None else lookup_order
    matched = match.match_distributor(match.match_lookup(tagged, dims.lookup_master, order), dims.distributor_map)
    valid = F.when(dates.is_recent(F.col("invoice_date"), as_of), F.col("invoice_date"))
    dated = calc.calendar_columns(matched.withColumn("_valid", valid), "_valid").drop("_valid")
    marked = calc.mark_complete(dated, as_of)
    if stage is not None:
        marked = matched = lines = stage(marked)
    done = calc.finish_lines(marked)
    if running is not None:
        schema.require_same_columns(done, running)
        combined = running.unionByName(done)
    else:
        combined = done
    counted = {} if stage is None else {"drop_reasons": sheets.drop_reasons()}
    return counted | {
        "running": combined,
        "entries_need_fixing": calc.needs_fixing(marked, as_of),
        "lookup_master": match.lookup_usage(matched, dims.lookup_master, as_of, line_order(matched)),
        "counters": report.run_counters(raw.join(read, "from_file", "left_semi"), matched),
        "ledger": files.append_entries(ledger, files.file_entries(lines, as_of, read)),
        "undecided_dates": sheets.undecided_dates(),
        "issues": found}


def merge_fixed_entries(running: DataFrame, entries: DataFrame, lookup: DataFrame, quarantined: DataFrame,
                        as_of: dt.date, strict: bool = False) -> dict[str, DataFrame]:
    """Fixed entries back into the running lines, stale lookups into quarantine, totals compared."""
    merged, remaining, outcome = merge.merge_fixed(running, entries, as_of, line_order(entries))
    found = merge.merge_issues(outcome, "merge_fixed_entries")
    current, stale, unreadable = merge.quarantine(lookup, as_of)
    found = found.unionByName(issues.issue_rows(unreadable, "quarantine", "UNPARSED_LOOKUP_DATE",
                                                row_ref="part_number"))
    check = report.commission_difference(running, merged)
    if strict:
        issues.enforce(found)
        report.require_conserved(check)
    return {"running": merged, "entries_need_fixing": remaining,
            "lookup_master": current.unionByName(unreadable),
            "quarantined": quarantined.unionByName(stale, allowMissingColumns=True),
            "check": check, "issues": found}


def migrate_and_report(history: DataFrame, history_files: DataFrame, dims: Dimensions, as_of: dt.date,
                       running: DataFrame | None = None, running_files: DataFrame | None = None,
                       stage=None) -> dict[str, DataFrame]:
    """Reports for the new month (or, without running lines, again for the newest one) and the grown history.

    `stage` may store the calculated lines, which every report reads.
    """
    if running is not None:
        files.refuse_known_files(running_files, history_files)
        stamped = calc.stamp_report_date(running, as_of)
        lines = report.tag_next_month(calc.month_end_commission(stamped, dims.salespeople), history)
        if stage is not None:
            lines = stage(lines)
        found = calc.rate_issues(lines)
        lines = lines.drop("rate_issue")
        month = dates.next_month(report.latest_month(history))
    else:
        lines, found = report.latest_month_slice(history), None
        month = report.latest_month(history)
    recent = report.revenue_history(history, lines if running is not None else None)
    revenue = match.tag_current_design_sales(recent, dims.accounts)
    if stage is not None:
        revenue = stage(revenue)
    quarter = report.quarter_to_date(history, month)
    if running is not None:
        quarter = quarter.unionByName(lines, allowMissingColumns=True)
    commission = report.commission_report(quarter, dims.salespeople, month)
    own = report.revenue_by_person(revenue, dims.accounts, dims.salespeople)
    quarters = report.labels(report.last_quarters(recent), "quarter_shipped")
    out = {
        "lines": lines,
        "revenue_by_person": own,
        "revenue_pivot_by_person": report.pivot_sum(own, ["salesperson", "principal", "t_end_cust", "part_number", "cm"],
                                                    "quarter_shipped", "paid_on_revenue", values=quarters),
        "overall_revenue_pivot": report.overall_revenue_pivot(revenue),
        "commission_pivot": report.commission_pivot(commission),
        "revenue_lines": revenue,
        "commission_by_person": commission,
        "salesperson_totals": report.totals_by_person(commission),
        "principal_totals": report.principal_totals(lines, with_rate=True),
        "quarterly_principals": report.principal_totals(quarter, with_rate=True).filter(dates.is_quarter_end(month)),
        "quarterly_salespeople": report.quarterly_salespeople(quarter, dims.salespeople)
        .filter(dates.is_quarter_end(month))}
    if dims.principals is not None:
        out["statement"] = report.statement(commission, dims.principals, dims.salespeople)
    if running is not None:
        out["issues"] = found
        out["new_lookups"] = merge.new_lookups(lines, dims.lookup_master, as_of, line_order(lines))
        out["lookup_master"] = merge.extend_lookup(dims.lookup_master, out["new_lookups"])
        out["history"] = history.unionByName(lines, allowMissingColumns=True)
        out["history_files"] = files.append_entries(history_files, running_files)
    return out


def assign_insight(rows: DataFrame, dims: Dimensions, strict: bool = False) -> dict[str, DataFrame]:
    """Working columns, salespeople and review flags for insight rows, with duplicate territory cities as issues."""
    twice = insight.duplicate_cities(dims.salespeople)
    found = issues.issue_rows(twice, "assign_insight", "DUPLICATE_CITY", F.col("city"))
    if strict:
        issues.enforce(found)
    assigned = insight.assign_sales(insight.insight_columns(rows), dims.accounts, dims.root_customers,
                                    dims.salespeople, F.col("sales_initials"))
    return {"insight_rows": assigned, "issues": found}


def compile_insight(rows: DataFrame, master: DataFrame, master_files: DataFrame, dims: Dimensions, as_of: dt.date,
                    order, strict: bool = False) -> dict[str, DataFrame]:
    """Feedback files into the insight master, the root-customer map and the file ledger.

    `strict` stops at an unknown or repeated owner and at a customer that the map lists more than once.
    """
    own, found = insight.compile_feedback(rows, dims.salespeople)
    mapping = merge.upsert_root_customers(dims.root_customers, own, order)
    found = found.unionByName(issues.issue_rows(mapping.filter("status = 'refused'"), "compile_feedback",
                                                "DUPLICATE_CUSTOMER", F.col("root_customer")))
    if strict:
        issues.enforce(found)
    grown = master.unionByName(own.select(*[c for c in master.columns if c in own.columns and c != "current_sales"]),
                               allowMissingColumns=True)
    refreshed = merge.refresh_current_sales(grown, dims.accounts, mapping.drop("status"), F.col("sls"),
                                            F.col("salesperson"))
    new = own.select(F.col("from_file").alias("filename")).distinct().withColumns(
        {"total_commissions": F.lit(None).cast("string"), "date_added": F.lit(as_of)})
    return {"final": own, "insight_master": refreshed, "root_customers": mapping.drop("status"),
            "files_processed": master_files.unionByName(new, allowMissingColumns=True), "issues": found}
