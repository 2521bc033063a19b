import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from repledger.operators import conform, issues
from repledger.plans import flows
from repledger.sources import ledger, readers, schema, sinks
from repledger.streaming import ingest

AS_OF = dt.date(2024, 5, 20)
D = Decimal
ALIASES = {"part_number": ["Part #", "Item"], "actual_comm_paid": ["Commission", "Commission Due"],
           "invoice_date": ["Date", "Sales Date"], "invoiced_dollars": ["Extended Resale", "Sales"],
           "ext_cost": ["Extended Cost"], "reported_customer": ["Customer", "Customer Name", "End Customer"],
           "reported_distributor": ["Distributor"], "commission_rate": ["Rep 1 %", "Rate"]}


def sheet(file, name, *rows, no=0):
    return [{"from_file": file, "sheet_name": name, "sheet_no": no, "row_idx": i, "cells": r} for i, r in enumerate(rows)]


def base(**cells):
    return {"Part #": "P1", "Date": "1/5/2024", "Commission": "10", **cells}


@pytest.fixture(scope="module")
def dims(spark):
    def table(rows, ddl):
        return spark.createDataFrame(rows, ddl)

    return flows.Dimensions(
        principals=table([(p, p) for p in ("ABR", "ISS", "ATS", "MIL", "OSR", "GLO", "QRF", "XMO", "LAT")],
                         "abbreviation string, full_name string"),
        lookup_master=table([("l1", "Acme", "P1", "AA", "BB", "n", None, "End", 30, None, None, None, "LAT")],
                            "lookup_id string, reported_customer string, part_number string, cm_sales string, "
                            "design_sales string, t_name string, cm string, t_end_cust string, cm_split int, city string, "
                            "last_used date, date_added date, principal string"),
        distributor_map=table([("Mouser", "mouser"), ("Digi", "digi")], "corrected_dist string, search_abbreviation string"),
        invoice_log=table([("1", "LOGGED"), ("2", "x"), ("2", "y")], "inv_no string, part_number string"),
        salespeople=table([("Ann", "AA", D(50), D(4)), ("Bob", "BB", D(40), D(4))],
                          "salesperson string, sales_initials string, sales_percentage decimal(9,6), qq_split decimal(9,6)"),
        accounts=table([("End", "BB")], "proper_name string, sls string"))


def raw(spark, *sheets):
    return spark.createDataFrame([r for s in sheets for r in s], schema.RAW_SHEETS)


def conformed(spark, dims, *sheets):
    return conform.conform(raw(spark, *sheets), ALIASES, dims.principals, dims.distributor_map, dims.invoice_log, fill_chunk=2)


def by_row(lines):
    return {(r.from_file, r.row_idx): r for r in lines.collect()}


def test_headings_are_trimmed_and_unnamed_ones_dropped(spark, dims):
    got, found = conformed(spark, dims, sheet("LAT 1", "s", {
        " Part # ": " 007 ", "Date": "2024-01-05", "Commission": "$1,234.50", "Unnamed: 3": "x", "Customer": "nan"}))
    row = got.first()
    assert (row.part_number, row.actual_comm_paid, row.reported_customer) == ("007", D("1234.50"), None)
    assert row.invoice_date == dt.date(2024, 1, 5) and row.principal == "LAT" and found.count() == 0


def test_lines_and_sheets_that_do_not_count(spark, dims):
    got, found = conformed(
        spark, dims, sheet("LAT 1", "s", base(), base(**{"Part #": ""}), base(Commission="0"), base(Commission="abc")),
        sheet("LAT 2", "nopart", {"Date": "1/5/2024", "Commission": "1"}),
        sheet("LAT 2", "nocomm", {"Part #": "P", "Date": "1/5/2024"}),
        sheet("LAT 2", "nodate", {"Part #": "P", "Commission": "1"}),
        sheet("ZZZ 1", "s", base()), sheet("LAT 3", "amb", base(**{"Commission Due": "3"})),
        sheet("LAT 3", "both", base(**{"Actual Comm Paid": "3"})), sheet("LAT 4", "clash", base(**{"Part # ": "x"})))
    assert [(r.from_file, r.row_idx) for r in got.collect()] == [("LAT 1", 0)]
    assert sorted((r.code, r.sheet_name) for r in found.collect()) == sorted([
        ("UNPARSED_MONEY", "s"), ("NO_PART_NUMBER_COLUMN", "nopart"), ("NO_COMMISSION_COLUMN", "nocomm"),
        ("NO_INVOICE_DATE_COLUMN", "nodate"), ("UNKNOWN_PRINCIPAL", None), ("AMBIGUOUS_MAPPING", "amb"),
        ("AMBIGUOUS_MAPPING", "both"), ("DUPLICATE_TARGET", "clash")])
    with pytest.raises(issues.FatalIssues, match="AMBIGUOUS_MAPPING"):
        issues.enforce(found)


def test_presence_is_a_matter_of_the_sheet(spark, dims):
    """The rule for sheets without a rate column looks at all rows, also where a row leaves the cell out."""
    got, _ = conformed(spark, dims, sheet("GLO 1", "s", {**base(Sales="100"), "Rate": "7%"}, base(Sales="100")),
                       sheet("GLO 2", "s", {"Part #": "P", "Date": "1/5/2024", "Sales": "100"}))
    rows = by_row(got)
    assert rows["GLO 1", 0].commission_rate == D("0.07") and rows["GLO 1", 1].commission_rate is None
    assert rows["GLO 2", 0].commission_rate == D("0.05") and rows["GLO 2", 0].actual_comm_paid == D(5)


def test_percent_scale_is_a_matter_of_the_sheet(spark, dims):
    got, _ = conformed(spark, dims, sheet("LAT 1", "a", base(Rate="1"), base(Rate="3")), sheet("LAT 2", "b", base(Rate="1")))
    rows = by_row(got)
    assert [rows["LAT 1", 0].commission_rate, rows["LAT 1", 1].commission_rate, rows["LAT 2", 0].commission_rate] == [
        D("0.01"), D("0.03"), D(1)]


def test_principal_rules(spark, dims):
    got, found = conformed(
        spark, dims,
        sheet("ABR 1", "x Adj", {"Part #": "P", "Date": "1/5/2024", "Sales": "100"}),
        sheet("ABR 2", "MoComm", base(Distributor="", Sales="0"), base(Distributor="D1", Sales="160"), base(Sales="3"),
              base(Distributor="", Sales="3")),
        sheet("ABR 3", "other", base()),
        sheet("ISS 1", "s", {**base(), "Name": "OEM x", "Sales Region": "West", "Customer": "Mouser Inc", "Commission Due": "9"},
              {**base(), "Name": "POS", "Sales Region": "West", "Customer": "Mouser Inc", "City": "Oslo"},
              {**base(), "Name": "OEM", "Sales Region": "West", "Customer": "Digi Mouser"}),
        sheet("ATS 1", "s", {**base(Distributor="DigiOne"), "Resale": "20", "Cost": "5"}, base(Distributor="Other")),
        sheet("MIL 1", "s", {**base(), "Ext. Cost": "9"}, {**base(**{"Part #": "Totals"}), "Ext. Cost": "99"}),
        sheet("MIL 2", "s", *[{"Invoice Number": i, "Date": "1/5/2024", "Commission": "1"} for i in ("1", "2", "3", "")]),
        sheet("OSR 1", "World POS", {**base(Distributor="x", Sales="8"), "Item": "no", "Rep 1 %": "", "Rep 2 %": "4%",
                                     "Customer Name": "no", "Sales Date": "no"}),
        sheet("QRF 1", "POS", {**base(Sales="8"), "Company": "Co", "BillDocNo": "5", "End Customer": "no"}),
        sheet("QRF 2", "OEM", {**base(Sales="8"), "Distributor": "Co", "Item": "no"}),
        sheet("XMO 1", "s", {"Part #": "P", "Date": "1/5/2024", "Amount": "6", "Commission Due": "7", "Sales": "n/a"}))
    rows = by_row(got)
    adj = rows["ABR 1", 0]
    assert (adj.commission_rate, adj.paid_on_revenue, adj.actual_comm_paid, adj.comm_source) == (D("0.03"), D(70), D("2.1"), "Resale")
    assert [rows["ABR 2", i].reported_distributor for i in range(4)] == [None, "D1", "D1", "D1"]
    assert rows["ABR 2", 0].commission_rate is None and rows["ABR 2", 1].commission_rate == D("0.062")
    assert rows["ABR 3", 0].comm_source is None
    assert [(rows["ISS 1", i].city, rows["ISS 1", i].reported_distributor) for i in range(3)] == [
        ("West", "Mouser Inc"), ("Oslo", None), ("West", None)]
    assert (rows["ATS 1", 0].paid_on_revenue, rows["ATS 1", 0].ext_cost, rows["ATS 1", 0].comm_source) == (D(20), D(5), "Cost")
    assert rows["ATS 1", 1].comm_source == "Resale" and rows["ATS 1", 1].paid_on_revenue == 0
    assert (rows["MIL 1", 0].paid_on_revenue, rows["MIL 1", 0].comm_source) == (D(9), "Cost") and ("MIL 1", 1) not in rows
    assert [rows["MIL 2", i].part_number for i in range(3)] == ["LOGGED", "NOT FOUND", "NOT FOUND"] and ("MIL 2", 3) not in rows
    osr = rows["OSR 1", 0]
    assert (osr.reported_distributor, osr.commission_rate, osr.paid_on_revenue, osr.part_number) == ("World Star", D("0.04"), D(8), "P1")
    assert osr.reported_customer is None and osr.invoice_date == dt.date(2024, 1, 5)
    assert rows["QRF 1", 0].reported_distributor == "Co" and rows["QRF 1", 0].reported_customer is None
    assert rows["QRF 2", 0].part_number == "P1" and rows["QRF 2", 0].paid_on_revenue == D(8)
    assert (rows["XMO 1", 0].actual_comm_paid, rows["XMO 1", 0].invoiced_dollars, rows["XMO 1", 0].paid_on_revenue) == (D(6), 0, 0)
    assert sorted(r.code for r in found.collect()) == ["UNPARSED_MONEY", "UNRECOGNISED_SHEET"]


EMPTY_LEDGER = "filename string, total_commissions string, date_added date, paid_date date"


def test_the_whole_month(spark, dims, tmp_path):
    stage = sinks.stager(str(tmp_path))
    files = raw(spark, sheet("LAT 1", "s", base(Customer="ACME", Distributor="Mouser"),
                             base(Customer="acme", Distributor="Mouser", Commission="20", Date="soon"),
                             base(Customer="nobody", Commission="30")), sheet("LAT 0", "s", base()))
    known = spark.createDataFrame([("LAT 0", "5", AS_OF, None)], EMPTY_LEDGER)
    out = flows.process_files(files, known, ALIASES, dims, AS_OF, stage=stage)
    out = {name: stage(df) for name, df in out.items()}
    running = out["running"]
    assert running.agg(F.sum("actual_comm_paid")).first()[0] == D(60)
    rows = {r.row_idx: r for r in running.collect()}
    assert rows[0].is_complete and (rows[0].sales_commission, rows[0].cm_sales_comm) == (D("4.5"), D("1.35"))
    assert rows[0].quarter_shipped == "2024Q1" and rows[0].distributor == "Mouser"
    assert not rows[1].is_complete and rows[1].sales_commission is None and len({r.unique_id for r in rows.values()}) == 3
    assert {r.filename: r.total_commissions for r in out["ledger"].collect()} == {"LAT 0": D(5), "LAT 1": D(60)}
    assert out["lookup_master"].first().last_used == AS_OF
    assert [tuple(r) for r in out["counters"].collect()] == [("LAT 1", 3, 3, 0, 2)]
    again = flows.process_files(files, out["ledger"], ALIASES, dims, AS_OF, stage=stage)
    assert again["running"].count() == 0

    entries = out["entries_need_fixing"]
    assert {r.row_idx for r in entries.collect()} == {1, 2}
    fixed = entries.withColumns({
        "invoice_date": F.lit(dt.date(2024, 2, 2)), "t_end_cust": F.when(F.col("row_idx") == 2, "New").otherwise("End"),
        "cm_sales": F.when(F.col("row_idx") == 1, "AA")})
    merged = flows.merge_fixed_entries(running, fixed, dims.lookup_master.withColumn("last_used", F.lit(AS_OF)),
                                       dims.lookup_master.limit(0), AS_OF)
    merged = {name: stage(df) for name, df in merged.items()}
    assert merged["check"].first().difference == 0
    assert merged["entries_need_fixing"].select("row_idx").first()[0] == 2
    done = {r.row_idx: r for r in merged["running"].collect()}
    assert done[1].sales_commission == D(9) and done[1].quarter_shipped == "2024Q1"

    month = merged["running"].select(*schema.ordered_columns())
    history = month.limit(0).unionByName(month.withColumn("actual_comm_paid", F.lit(D(1)).cast("decimal(18,2)"))).withColumn(
        "comm_month", F.lit(dt.date(2024, 2, 1)))
    month, history = stage(month), stage(history)
    old_files = spark.createDataFrame([("OLD", "1", AS_OF, None)], EMPTY_LEDGER)
    reports = flows.migrate_and_report(history, old_files, dims, AS_OF, running=month, running_files=out["ledger"], stage=stage)
    assert {r.comm_month for r in reports["lines"].collect()} == {dt.date(2024, 3, 1)}
    assert reports["history"].count() == 6 and reports["history_files"].count() == 3
    total = reports["principal_totals"].filter("level = 1").first()
    assert total.actual_comm_paid == D(60)
    assert reports["quarterly_principals"].filter("level = 1").first().actual_comm_paid == D(63)
    assert {r.salesperson for r in reports["salesperson_totals"].collect()} == {"AA", "BB"}
    assert {(r.t_end_cust, r.reported_customer) for r in reports["new_lookups"].collect()} >= {(None, "nobody")}
    assert reports["revenue_by_person"].filter("salesperson = 'BB'").count() > 0
    pivot = reports["revenue_pivot_by_person"]
    assert {"2024Q1"} <= set(pivot.columns) and pivot.filter("salesperson = 'BB'").count() > 0
    overall = reports["overall_revenue_pivot"].collect()
    assert {r.principal for r in overall} == {"LAT"} and "2024Q1" in {r.heading for r in overall}
    cells = reports["commission_pivot"].collect()
    assert {"2024-02", "2024-03"} <= {r.heading for r in cells} and "MISC POOL" in {r.t_end_cust for r in cells}
    paid = {r.salesperson: r.value for r in cells if r.level == 3 and r.all_headings == 1}
    assert paid == {r.salesperson: r.sales_commission for r in reports["salesperson_totals"].filter("level = 1").collect()}
    due = reports["statement"].filter("level = 0").groupBy("salesperson").count().collect()
    assert {(r.salesperson, r["count"]) for r in due} == {("AA", 9), ("BB", 9)}
    assert reports["lookup_master"].count() == 1 + reports["new_lookups"].count()
    with pytest.raises(ledger.FilesAlreadyReported):
        flows.migrate_and_report(history, out["ledger"], dims, AS_OF, running=month, running_files=out["ledger"])
    rerun = flows.migrate_and_report(stage(reports["history"]), old_files, dims, AS_OF)
    assert rerun["lines"].count() == 3


def test_insight_flow(spark, dims):
    people = spark.createDataFrame([("Ann", "AA", "Oslo"), ("Bob", "BB", "Oslo, Paris")],
                                   "salesperson string, sales_initials string, territory_cities string")
    more = flows.Dimensions(salespeople=people, accounts=spark.createDataFrame([("Acme", "AA", "Rome")],
                                                                              "proper_name string, sls string, city string"),
                            root_customers=spark.createDataFrame([("beta", "BB")], "root_customer string, salesperson string"))
    rows = spark.createDataFrame([("Acme", "Direct", "Rome", "3", "2.5"), ("Beta", "Direct", "x", "a", "1")],
                                 "root_customer string, root_customer_class string, customer_city string, qty_shipped string, unit_price string")
    out = flows.assign_insight(rows, more)
    assert {r.root_customer: (r.sales, r.invoiced_dollars) for r in out["insight_rows"].collect()} == {
        "Acme": ("AA", D("7.50")), "Beta": ("BB", None)}
    assert [r.detail for r in out["issues"].collect()] == ["Oslo"]
    feedback = spark.createDataFrame([("AA f", "Beta", "Direct", "AA"), ("AA f", "Acme", "Direct", "BB")],
                                     "from_file string, root_customer string, root_customer_class string, sales string")
    master = spark.createDataFrame([("Beta", "Direct", "BB", None)],
                                   "root_customer string, root_customer_class string, sales string, current_sales string")
    files = spark.createDataFrame([("old", None, AS_OF, None)], EMPTY_LEDGER)
    got = flows.compile_insight(feedback, master, files, more, AS_OF, F.col("from_file"))
    assert got["insight_master"].count() == 2 and got["files_processed"].count() == 2
    assert {r.root_customer: r.salesperson for r in got["root_customers"].collect()} == {"beta": "AA"}


def test_files_arriving_one_after_the_other(spark, dims, tmp_path):
    landing, work = tmp_path / "in", str(tmp_path / "work")
    landing.mkdir()

    def arrive(name, *rows):
        (landing / name).write_text("\n".join(json.dumps(r) for r in rows))

    def process(batch):
        local = conform.conform(batch, ALIASES, dims.principals, dims.distributor_map, dims.invoice_log)[0]
        return {"ledger": ledger.file_entries(local, AS_OF)}

    for n, name in enumerate(("LAT 1", "LAT 2")):
        arrive(f"{n}.json", *sheet(name, "s", base(), base()))
        for _ in range(2):
            ingest.run_available(ingest.raw_sheet_stream(spark, str(landing)), work, process)
        assert ingest.read_output(spark, work, "ledger").count() == n + 1
    batch = readers.read_raw_sheets(spark, str(landing))
    assert sorted((r.filename, r.total_commissions) for r in ingest.read_output(spark, work, "ledger").collect()) == sorted(
        (r.filename, r.total_commissions) for r in process(batch)["ledger"].collect())
    assert readers.first_sheet(batch).count() == 4
