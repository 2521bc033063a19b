"""How often lines are read and moved, and that fewer reads give the same rows."""

import datetime as dt
import os
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from repledger.catalog import merging, sheets
from repledger.catalog.tables import Tables
from repledger.operators import report
from repledger.sources import sinks

SF = "/root/testdata/sf0.001"


def reads(df):
    """How often the plan has the line items."""
    return len(re.findall(r"Relation \[l_orderkey", df._jdf.queryExecution().optimizedPlan().toString()))


@pytest.mark.parametrize("name", ["revenue_pivot", "revenue_pivot_by_person", "overall_revenue_pivot"])
def test_pivots_read_the_lines_once_for_the_known_quarters(spark, name):
    assert reads(entry.queries()[name](spark, SF)) == 1


def test_known_quarters_keep_the_same_lines(spark):
    df = spark.createDataFrame([("2023Q%d" % i,) for i in range(1, 5)] + [(None,), ("",), ("2024Q1",), ("2024Q1",)], "quarter_shipped string")
    for lines in (df, df.filter("quarter_shipped is null or quarter_shipped in ('', '2024Q1')"), df.filter("false")):
        quarters = report.newest_quarters(lines)
        got = report.revenue_history(lines, quarters=quarters).collect()
        assert sorted(map(str, got)) == sorted(map(str, report.revenue_history(lines).collect()))
        assert report.headings(quarters) == report.labels(report.last_quarters(lines), "quarter_shipped")


def test_merge_tables_read_the_lines_once(spark):
    target, source = merging.merge_tables(Tables(spark, SF))
    assert (reads(target), reads(source)) == (1, 1)


def test_merge_tables_rows(spark):
    new, old = dt.date(2001, 5, 1), dt.date(2000, 5, 1)
    lines = spark.createDataFrame(
        [("a", "1", 50, "X", 20, new), ("b", "2", 1, "Y", None, new), ("c", "3", None, None, 20, new), ("d", "4", 50, "Z", 20, old),
         (None, "5", 1, "W", 20, new)], "unique_id string, row_idx string, quantity long, t_end_cust string, cm_split int, comm_month date")
    target, source = merging.merge_tables(SimpleNamespace(lines=lines))
    assert target.columns == lines.columns
    assert sorted(str(r.unique_id) for r in target.collect()) == ["None", "a", "a", "b", "c", "d", "d"]
    assert source.columns == ["unique_id", "row_idx", "pass", "t_end_cust", "cm_split"]
    assert sorted(map(tuple, source.collect()), key=str) == sorted([
        ("a", "1", 1, "X *", 50), ("a", "1", 2, "X **", 30), ("b", "2", 1, "Y *", 50), ("new-b", "2", 1, "Y", 20),
        ("c", "3", 1, None, 50), (None, "5", 1, "W *", 50), (None, "5", 1, "W", 20)], key=str)


def test_compared_tables_come_from_one_read(spark):
    assert reads(merging.merge_difference(Tables(spark, SF))) == 0  # the lines are stored before


def test_second_delivery_is_not_made_anew(spark):
    t = Tables(spark, SF)
    mended = sheets.mended_sheets(t)
    assert reads(mended) == 0
    rows = sheets.exported_sheets(t, t.sheet_rows.filter(f"not {sheets.FAULTY} and from_file is not null"))
    cells = F.to_json(F.array_sort(F.map_entries("cells"))).alias("cells")

    def shown(df):
        return sorted(map(str, df.select("from_file", "sheet_name", "sheet_no", "row_idx", cells).collect()))

    assert shown(mended) == shown(rows)


def test_stored_tables_are_small_files(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2001, 1, 1)), (2, None)], "n int, comm_month date")
    sinks.stager(str(tmp_path / "stage"))(df)
    sinks.replace_months(df, str(tmp_path / "months"))
    names = [f for _, _, files in os.walk(tmp_path) for f in files if f.endswith(".parquet")]
    assert names and all(".zstd." in f for f in names)


def test_rows_to_be_clustered_are_moved_once(spark):
    df = spark.createDataFrame([(k, f"m{k % 3}") for k in range(30)], "n int, m string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = sinks.clustered(df, "m", 5)
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and sorted(map(tuple, dealt.collect())) == sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
