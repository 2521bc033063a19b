"""Files with a cell that cannot be read: refused whole where a run asks for it, and read from their corrected copies."""

import datetime as dt
from decimal import Decimal as D

from repledger.catalog import sheets, tables
from repledger.plans import flows
from repledger.sources import ledger
from test_flows import ALIASES, base, dims, raw, sheet  # noqa: F401

NO_LEDGER = "filename string, total_commissions string, date_added date, paid_date date"


def test_files_with_unreadable_cells_are_refused_whole_and_read_once_mended(spark, dims):  # noqa: F811
    known = spark.createDataFrame([], NO_LEDGER)
    good, bad, other = sheet("LAT 1", "s", base()), sheet("LAT 2", "a", base(Sales="n/a")), sheet("LAT 2", "b", base(), base(), no=1)
    first = flows.accepted_lines(raw(spark, good, bad, other), known, ALIASES, dims, dt.date(2024, 5, 20), refuse_unreadable=True)
    assert {r.from_file for r in first[0].collect()} == {"LAT 1"} and [r.from_file for r in first[1].collect()] == ["LAT 1"]
    assert [(r.code, r.fatal, r.from_file) for r in first[2].collect()] == [("UNPARSED_MONEY", True, "LAT 2")]
    known = ledger.append_entries(known, ledger.file_entries(first[0], dt.date(2024, 5, 20), first[1]))
    again = flows.accepted_lines(raw(spark, good, other), known, ALIASES, dims, dt.date(2024, 5, 21), refuse_unreadable=True)
    entered = ledger.file_entries(again[0], dt.date(2024, 5, 21), again[1]).collect()
    assert [(r.filename, r.total_commissions) for r in entered] == [("LAT 2", D(20))]


def test_without_being_asked_a_run_reads_such_files(spark, dims):  # noqa: F811
    got = flows.accepted_lines(raw(spark, sheet("LAT 2", "a", base(Sales="n/a"))), spark.createDataFrame([], NO_LEDGER), ALIASES,
                               dims, dt.date(2024, 5, 20))
    assert got[0].count() == 1 and [(r.code, r.fatal) for r in got[2].collect()] == [("UNPARSED_MONEY", False)]


SHEET_ROWS = ("code string, from_file string, sheet_name string, sheet_no int, row_idx string, flag string, status string, line_no int, "
              "quantity long, part string, customer string, supplier string, city string, invoice string, ship_date date, "
              "dollars decimal(12,2), paid_on decimal(18,2), comm decimal(18,2), rate decimal(4,2)")


def test_the_second_delivery_lacks_the_faults_and_nothing_else(spark, tmp_path):
    rows = [(code, f"{code} 1.xlsx", f"Sheet {flag}", 0, f"{code}{flag}{n}", flag, "F", 1, n, "p", "c", "s", "x", "1",
             dt.date(1995, 1, 5), D(9), D(8), D(1), D("0.05"))
            for code in ("LAT", "TRI", "GAN", "XMO") for flag in ("A", "R") for n in (2, 13, None)]
    t = tables.Tables(spark, str(tmp_path))
    t._cache["sheet_rows"] = spark.createDataFrame(rows, SHEET_ROWS)
    gone = {r.row_idx for r in t.sheet_rows.filter(sheets.FAULTY).collect()}
    left = {r.row_idx for r in sheets.mended_sheets(t).collect()}
    assert gone == {"LATR2", "LATR13", "LATRNone", "TRIA13", "TRIR13", "GANA2", "GANR2"} and left == {r[4] for r in rows} - gone
