"""What must hold beyond the size of the test tables, and where flows must stop."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_flows import ALIASES, AS_OF, EMPTY_LEDGER, base, dims, raw, sheet  # noqa: F401

from repledger.catalog.tables import Tables
from repledger.functions import dates
from repledger.operators import conform, issues, report, rules
from repledger.plans import flows
from repledger.sources import ledger, readers, schema, sinks

D = Decimal
SF = "/root/testdata/sf0.001"


def test_row_keys_of_large_tables_neither_meet_nor_overflow(spark):
    t = Tables(spark, SF)
    keys = [(10**11, 1, 10**8 + 1, 1, 1.0), (10**11, 2, 1, 1, 1.0), (10**11, 1, 1, 10**8, 1.0), (10**18, 7, 10**15, 10**12, 50.0),
            (2 * 10**7, 1, 5, 6, 7.0), (1, 1, 100001, 1, 1.0), (1, 2, 1, 1, 1.0)]
    t.__dict__["lineitem"] = spark.createDataFrame(keys, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double")
    from repledger.catalog import tables
    rows = spark.sql(f"select *, {tables.ROW_IDX} as row_idx from {{l}}", l=t.lineitem).withColumn("chunk", tables.row_chunk()).collect()
    assert len({r.row_idx for r in rows}) == len(keys)
    by_key = sorted(rows, key=lambda r: (r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, r.l_quantity))
    assert [r.row_idx for r in by_key] == sorted(r.row_idx for r in rows)
    assert all(r.chunk == r.l_orderkey // 4096 for r in rows)


def test_fill_down_by_a_chunk_expression(spark):
    rows = [(f"{k:03}", "f", "s", "d" + str(k) if k % 7 == 2 else None) for k in range(40)]
    df = spark.createDataFrame(rows, "row_idx string, from_file string, sheet_name string, d string")
    got = {r.row_idx: r.d for r in rules.fill_down(df, "d", chunk=F.expr("cast(row_idx as int) div 3")).collect()}
    assert got == {f"{k:03}": None if k < 2 else f"d{(k - 2) // 7 * 7 + 2}" for k in range(40)}


def test_pivots_have_no_limit_and_keep_blanks(spark):
    rows = [("a", f"h{k:04}", 1) for k in range(1500)] + [("a", None, 5), ("b", None, 7)]
    df = spark.createDataFrame(rows, "r string, c string, v int")
    assert len(report.labels(df, "c")) == 1501 and report.labels(df, "c")[-1] == report.BLANK_HEADING
    long = report.pivot_long(df, ["r"], "c", "v", totals=True)
    totals = {r.r: r.value for r in long.filter("all_headings = 1").collect()}
    assert totals == {"a": 1505, "b": 7, None: 1512} and long.filter("level = 0 and all_headings = 0").count() == 1502
    wide = {r.r: (r.h0001, r.total) for r in report.pivot_sum(df, ["r"], "c", "v", values=["h0001"], totals=True).collect()}
    assert wide == {"a": (1, 1505), "b": (None, 7), None: (1, 1512)}
    blank = report.pivot_sum(df.filter("c is null"), ["r"], "c", "v").collect()
    assert {r.r: r[report.BLANK_HEADING] for r in blank} == {"a": 5, "b": 7}


def test_two_digit_years_follow_the_day(spark):
    df = spark.createDataFrame([("1/5/24",), ("1/5/70",), ("1/5/80",)], "d string")

    def years(as_of):
        return [r[0].year for r in df.select(dates.parse_date(F.col("d"), as_of)).collect()]

    assert years(dt.date(2024, 5, 1)) == [2024, 2070, 1980]
    assert years(dt.date(2035, 5, 1)) == [2024, 2070, 2080]
    assert years(dt.date(2001, 5, 1)) == [2024, 1970, 1980]


def test_all_known_files_are_named(spark):
    names = [(f"file {k}",) for k in range(12)]
    with pytest.raises(ledger.FilesAlreadyReported) as error:
        ledger.refuse_known_files(spark.createDataFrame(names, "filename string"), spark.createDataFrame(names, "filename string"))
    assert all(n in str(error.value) for n, in names)


def test_a_file_is_read_whole_or_not_at_all(spark, dims, tmp_path):  # noqa: F811
    stage = sinks.stager(str(tmp_path))
    empty = spark.createDataFrame([], EMPTY_LEDGER)
    files = raw(spark, sheet("LAT 1", "good", base()), sheet("LAT 1", "amb", base(**{"Commission Due": "3"}), no=1),
                sheet("LAT 2", "zero", base(Commission="0")), sheet("LAT 3", "s", base(Commission="7")))
    out = {k: stage(v) for k, v in flows.process_files(files, empty, ALIASES, dims, AS_OF, stage=stage).items()}
    assert {r.from_file for r in out["running"].collect()} == {"LAT 3"}
    assert {r.filename: r.total_commissions for r in out["ledger"].collect()} == {"LAT 2": D(0), "LAT 3": D(7)}
    assert [r.from_file for r in out["issues"].filter("fatal").collect()] == ["LAT 1"]
    assert {tuple(r) for r in out["counters"].collect()} == {("LAT 2", 1, 0, 1, 0), ("LAT 3", 1, 1, 0, 0)}
    mended = raw(spark, sheet("LAT 1", "good", base()), sheet("LAT 1", "amb", base(Commission="3"), no=1),
                 sheet("LAT 2", "zero", base()), sheet("LAT 3", "s", base()))
    again = flows.process_files(mended, out["ledger"], ALIASES, dims, AS_OF, stage=stage)
    assert sorted(r.actual_comm_paid for r in again["running"].collect()) == [D(3), D(10)]
    assert {r.filename: r.total_commissions for r in again["ledger"].collect()} == {"LAT 1": D(13), "LAT 2": D(0), "LAT 3": D(7)}
    with pytest.raises(issues.FatalIssues):
        flows.process_files(files, empty, ALIASES, dims, AS_OF, stage=stage, strict=True)
    for other in (out["running"].withColumn("stray", F.lit(1)), out["running"].drop("city")):
        with pytest.raises(schema.SchemaMismatch):
            flows.process_files(mended, out["ledger"], ALIASES, dims, AS_OF, running=other, stage=stage)
    grown = flows.process_files(mended, out["ledger"], ALIASES, dims, AS_OF, running=out["running"], stage=stage)
    assert grown["running"].count() == 3


def test_a_merge_that_loses_commission_stops(spark):
    def lines(*paid):
        return spark.createDataFrame([(D(p),) for p in paid], "actual_comm_paid decimal(18,2)")

    report.require_conserved(report.commission_difference(lines(5, 6), lines(6, 5)))
    with pytest.raises(report.NotConserved, match="was 11.00, is 10.00"):
        report.require_conserved(report.commission_difference(lines(5, 6), lines(5, 5)))


def test_insight_flows_can_stop(spark):
    people = spark.createDataFrame([("Ann", "AA", "Oslo"), ("Bob", "BB", "Oslo")],
                                   "salesperson string, sales_initials string, territory_cities string")
    more = flows.Dimensions(salespeople=people, accounts=spark.createDataFrame([], "proper_name string, sls string, city string"),
                            root_customers=spark.createDataFrame([("beta", "BB"), ("Beta", "AA")], "root_customer string, salesperson string"))
    rows = spark.createDataFrame([("Acme", "Direct", "Rome", "3", "2.5")],
                                 "root_customer string, root_customer_class string, customer_city string, qty_shipped string, unit_price string")
    with pytest.raises(issues.FatalIssues, match="DUPLICATE_CITY"):
        flows.assign_insight(rows, more, strict=True)
    feedback = spark.createDataFrame([("AA f", "Beta", "Direct", "AA")], "from_file string, root_customer string, root_customer_class string, sales string")
    master = spark.createDataFrame([], "root_customer string, root_customer_class string, sales string, current_sales string")
    with pytest.raises(issues.FatalIssues, match="DUPLICATE_CUSTOMER"):
        flows.compile_insight(feedback, master, spark.createDataFrame([], EMPTY_LEDGER), more, AS_OF, F.col("from_file"), strict=True)


DIMENSIONS = {"principals": {"abbreviation": " ABR "}, "accounts": {"sls": "AA", "proper_name": " End "},
              "root_customers": {"root_customer": "nan", "salesperson": "AA"},
              "distributor_map": {"corrected_dist": " Mouser", "search_abbreviation": "mouser"},
              "quarantined": {"last_used": "2020-01-01", "date_quarantined": ""},
              "invoice_log": {"inv_no": " 007", "part_number": "P"},
              "files_processed": {"filename": "f", "total_commissions": "5", "date_added": "", "paid_date": ""},
              "insight_rows": {"root_customer": "a", "root_customer_class": " ", "customer_city": "c", "sales": "AA"},
              "insight_master": {"root_customer": " a", "current_sales": "nan"}}


@pytest.mark.parametrize("name", list(DIMENSIONS))
def test_loaders_take_text_files(spark, tmp_path, name):
    row = DIMENSIONS[name]
    path = str(tmp_path / name)
    spark.createDataFrame([tuple(row.values())], list(row)).write.option("header", True).csv(path)
    got = readers.load_dimension(readers.read_table(spark, path, "csv"), name).first().asDict()
    assert got == {c: (v.strip() if v.strip() not in ("", "nan") else None) for c, v in row.items()}
    with pytest.raises(schema.MissingColumns):
        readers.load_dimension(spark.range(1), name)


def test_lookup_master_and_feedback_loaders(spark, tmp_path):
    columns = schema.REQUIRED["lookup_master"]
    values = {c: " x " for c in columns} | {"cm_split": "30.0", "last_used": "1/5/2024", "date_added": "soon"}
    got = readers.load_lookup_master(spark.createDataFrame([tuple(values[c] for c in columns)], list(columns))).first()
    assert (got.cm_split, got.last_used, got.date_added, got.city) == (30, dt.date(2024, 1, 5), None, "x")
    for name in ("AA feedback", "BB feedback"):
        spark.createDataFrame([(" Acme ", "AA")], ["Root Customer", "Sales"]).coalesce(1).write.option("header", True).csv(str(tmp_path / name))
    rows = readers.read_feedback(spark, [str(tmp_path / "AA feedback"), str(tmp_path / "BB feedback")]).collect()
    assert len(rows) == 2 and rows[0].asDict().keys() == {"root_customer", "sales", "from_file"}


def test_tables_are_published_as_versions(spark, tmp_path):
    root = str(tmp_path)
    for version, n in (("1", 2), ("2", 3)):
        sinks.write_tables({"a": spark.range(n), "b": spark.range(1)}, root, version)
    assert sinks.read_current(spark, root, "a").count() == 3 and spark.read.parquet(f"{root}/a/v=1").count() == 2
    many = spark.range(1000).select(F.lit("AA").alias("salesperson"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([("BB", 1), (None, 2)], "salesperson string, v long"))
    sinks.write_by_person(many, f"{root}/people", rows_per_file=100)
    files = spark.read.parquet(f"{root}/people").select("salesperson", F.input_file_name().alias("f"))
    counts = {r.salesperson: (r.rows, r.files) for r in files.groupBy("salesperson").agg(
        F.count("*").alias("rows"), F.countDistinct("f").alias("files")).collect()}
    assert {k: v[0] for k, v in counts.items()} == {"AA": 1000, "BB": 1, None: 1}


def test_ambiguity_is_an_issue_of_the_file(spark, dims):  # noqa: F811
    _, found = conform.conform(raw(spark, sheet("LAT 1", "amb", base(**{"Commission Due": "3"}))), ALIASES, dims.principals,
                               dims.distributor_map, dims.invoice_log)
    assert [(r.code, r.from_file, r.fatal) for r in found.collect()] == [("AMBIGUOUS_MAPPING", "LAT 1", True)]


def test_text_keys_of_a_left_join_are_spread(spark):
    lines = spark.range(2000).select(F.col("id").cast("string").alias("unique_id"), F.when(F.col("id") == 5, "Acme").alias("k"))
    from repledger.functions import text
    keys = lines.select(text.key_or_spread(F.col("k"), lines.columns).alias("k"))
    assert keys.distinct().count() == 2000 and keys.filter("k = 'Acme'").count() == 1
