"""Queries on sheets over rows of their own: what is reported, and what is delivered again."""

import datetime as dt
from decimal import Decimal

from repledger.catalog import sheets
from repledger.catalog.tables import Tables

ROW = ("code string, from_file string, sheet_name string, sheet_no int, row_idx string, flag string, status string, line_no int, "
       "quantity bigint, part string, customer string, supplier string, city string, invoice string, ship_date date, "
       "dollars decimal(12,2), paid_on decimal(18,2), comm decimal(18,2), rate decimal(4,2)")


def row(code, flag, n, line, day, quantity=7):
    return (code, f"{code} 1998.xlsx", f"Sheet {flag}", 0, f"{n:019d}1", flag, "F", line, quantity, f"part {n}", "Acme", "Disty",
            "CITY 1", f"{n:012d}", day, Decimal("100.00"), Decimal("90.00"), Decimal("9.00"), Decimal("0.10"))


def small(spark, name, rows):
    t = Tables(spark, f"/nowhere/{name}")
    t._cache.update({
        "sheet_rows": spark.createDataFrame(rows, ROW),
        "sheet_principals": spark.createDataFrame([("TRI",), ("LAT",), ("GAN",)], "abbreviation string"),
        "distributor_map": spark.createDataFrame([], "search_abbreviation string, corrected_dist string"),
        "invoice_log": spark.createDataFrame([], "inv_no string, part_number string")})
    return t


def test_issues_list_undecided_dates(spark):
    t = small(spark, "undecided", [row("TRI", "N", 1, 2, dt.date(1998, 3, 4)), row("TRI", "N", 2, 5, dt.date(1998, 5, 6)),
                                   row("GAN", "N", 3, 2, dt.date(1998, 3, 14))])
    found = {(r["code"], r["from_file"]): r["n_issues"] for r in sheets.all_issues(t).collect()}
    assert found == {("UNDECIDED_DATES", "TRI 1998.xlsx"): 1}


def test_second_delivery_has_all_files(spark, monkeypatch):
    day = dt.date(1998, 3, 14)
    t = small(spark, "again", [row("TRI", "N", 1, 1, day), row("LAT", "R", 2, 1, day), row("LAT", "N", 3, 1, day)])
    given, accepted = [], sheets.flows.accepted_lines

    def watched(raw, *args, **options):
        given.append(sorted((r["from_file"], r["sheet_name"]) for r in raw.select("from_file", "sheet_name").collect()))
        return accepted(raw, *args, **options)

    monkeypatch.setattr(sheets.flows, "accepted_lines", watched)
    ledger = {r["filename"]: r["date_added"] for r in sheets.process_files_ledger(t).collect()}
    assert given[1] == [("LAT 1998.xlsx", "Sheet N"), ("TRI 1998.xlsx", "Sheet N")]
    assert ledger == {"TRI 1998.xlsx": dt.date(2001, 12, 31), "LAT 1998.xlsx": dt.date(2002, 1, 31)}
