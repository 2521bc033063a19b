"""Conforming sheets as they arrive, and counting what is dropped."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from test_flows import ALIASES, AS_OF, EMPTY_LEDGER, base, dims, raw, sheet  # noqa: F401

from repledger.operators import conform
from repledger.plans import flows
from repledger.sources import sinks
from repledger.streaming import ingest

D = Decimal


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def arrivals(spark, dims, tmp_path):  # noqa: F811
    landing, work = tmp_path / "in", str(tmp_path / "work")
    landing.mkdir()
    stage = sinks.stager(str(tmp_path / "stage"))

    def arrive(name, *sheets):
        (landing / name).write_text("\n".join(json.dumps(r) for s in sheets for r in s))

    def run():
        ingest.run_conform(ingest.raw_sheet_stream(spark, str(landing)), work, ALIASES, dims, AS_OF, stage)

    def out(name):
        return ingest.read_committed(spark, work, name, ingest.LEDGER if name == "ledger" else None)

    return arrive, run, out, stage, work


def test_deliveries_equal_the_batch_flow(spark, dims, arrivals):  # noqa: F811
    arrive, run, out, stage, _ = arrivals
    good, bad = sheet("LAT 1", "s", base(), base(Commission="abc")), sheet("LAT 2", "amb", base(**{"Commission Due": "3"}))
    mended, more = sheet("LAT 2", "amb", base(Commission="3")), sheet("ABR 3", "x Adj", base(Sales="100"), base(Sales="7"))
    arrive("1.json", good, bad)
    run()
    assert [r.from_file for r in out("refused").collect()] == ["LAT 2"]
    assert {r.filename: r.total_commissions for r in out("ledger").collect()} == {"LAT 1": D(10)}
    arrive("2.json", sheet("LAT 1", "s", base(Commission="999")), more)  # LAT 1 again: it is in the ledger
    run()
    arrive("3.json", mended)
    run()
    run()  # nothing new
    batch, read, found = flows.accepted_lines(raw(spark, good, mended, more), spark.createDataFrame([], EMPTY_LEDGER), ALIASES, dims, AS_OF, stage=stage)
    assert rows_of(out("lines").select(batch.columns)) == rows_of(batch)
    assert rows_of(out("ledger").select("filename")) == rows_of(read.toDF("filename"))
    assert {(r.code, r.from_file, r.fatal) for r in out("issues").collect()} == {
        ("UNPARSED_MONEY", "LAT 1", False), ("AMBIGUOUS_MAPPING", "LAT 2", True)}


@pytest.mark.parametrize("broken", ["lines", "ledger"])
def test_a_batch_that_breaks_off_is_repeated(spark, arrivals, monkeypatch, broken):
    arrive, run, out, _, work = arrivals
    arrive("1.json", sheet("LAT 1", "s", base()))
    run()
    arrive("2.json", sheet("LAT 2", "s", base(Commission="20")), sheet("LAT 3", "amb", base(**{"Commission Due": "3"})))
    plain = ingest.write_batch

    def write(table, workspace, name, batch_id):
        plain(table, workspace, name, batch_id)
        if name == broken:
            raise RuntimeError("executor lost")

    monkeypatch.setattr(ingest, "write_batch", write)
    with pytest.raises(Exception, match="executor lost"):
        run()
    assert ingest.committed(spark, work) == [0]
    assert {r.filename for r in out("ledger").collect()} == {"LAT 1"} and out("lines").count() == 1
    monkeypatch.setattr(ingest, "write_batch", plain)
    run()
    assert {r.filename: r.total_commissions for r in out("ledger").collect()} == {"LAT 1": D(10), "LAT 2": D(20)}
    assert out("lines").count() == 2 and [r.from_file for r in out("refused").collect()] == ["LAT 3"]


def test_rows_are_counted_by_reason_as_lines_are_stored(spark, dims, tmp_path):  # noqa: F811
    stage = sinks.stager(str(tmp_path))
    files = raw(spark, sheet("LAT 1", "s", base(), base(**{"Part #": ""}), base(Commission="0"), base(Commission="abc")),
                sheet("LAT 1", "nopart", {"Date": "1/5/2024", "Commission": "1"}, no=1),
                sheet("LAT 2", "nocomm", {"Part #": "P", "Date": "1/5/2024"}, {"Part #": "", "Date": "1/5/2024"}),
                sheet("LAT 2", "nodate", {"Part #": "P", "Commission": "1"}, no=1), sheet("ZZZ 1", "s", base(), base()),
                sheet("LAT 3", "amb", base(**{"Commission Due": "3"})), sheet("LAT 3", "good", base(), base(), no=1),
                sheet("MIL 1", "s", {**base(), "Ext. Cost": "9"}, {**base(**{"Part #": "Totals"}), "Ext. Cost": "99"}))
    drops = Observation()
    out = conform.conform_sheets(files, ALIASES, dims.principals, dims.distributor_map, dims.invoice_log, stage=stage, drops=drops)
    assert stage(out.lines).count() == 2
    assert {r.reason: r.n_rows for r in out.drop_reasons().collect()} == {
        "kept": 2, "refused": 5, "totals_line": 1, "no_part_number_column": 1, "no_commission_column": 2,
        "no_invoice_date_column": 1, "no_part_number": 1, "zero_commission": 2}
    flow = flows.process_files(files, spark.createDataFrame([], EMPTY_LEDGER), ALIASES, dims, AS_OF, stage=stage)
    assert rows_of(flow["drop_reasons"]) == rows_of(out.drop_reasons())
    with pytest.raises(ValueError, match="not counted"):
        conform.conform_sheets(files, ALIASES, dims.principals, dims.distributor_map, dims.invoice_log).drop_reasons()


def test_one_unreadable_cell_costs_one_cell(spark, dims, tmp_path):  # noqa: F811
    stage = sinks.stager(str(tmp_path))
    files = raw(spark, sheet("LAT 1", "s", base(Quantity="abc"), base(Quantity="2"), base(Quantity="")))
    out = flows.process_files(files, spark.createDataFrame([], EMPTY_LEDGER), ALIASES, dims, AS_OF, stage=stage)
    assert sorted((r.row_idx, r.quantity) for r in out["running"].collect()) == [(0, None), (1, 2), (2, None)]
    assert {r.filename: r.total_commissions for r in out["ledger"].collect()} == {"LAT 1": D(30)}
    assert [(r.code, r.fatal, r.row_ref, r.detail) for r in out["issues"].collect()] == [("UNPARSED_MONEY", False, "0", "quantity")]


def test_nothing_new_counts_nothing(spark, dims, tmp_path):  # noqa: F811
    stage = sinks.stager(str(tmp_path))
    known = spark.createDataFrame([("LAT 1", "5", AS_OF, None)], EMPTY_LEDGER)
    out = flows.process_files(raw(spark, sheet("LAT 1", "s", base())), known, ALIASES, dims, AS_OF, stage=stage)
    assert {r.n_rows for r in out["drop_reasons"].collect()} == {0} and out["running"].count() == 0
