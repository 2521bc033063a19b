import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from repledger.operators import calc, insight, issues, match, merge, report, rules
from repledger.sources import ledger, sinks

AS_OF = dt.date(2024, 5, 20)
D = Decimal
LINE = ("unique_id string, cm_sales string, design_sales string, cm_split int, actual_comm_paid decimal(18,2), "
        "paid_on_revenue decimal(18,2), principal string, t_end_cust string, from_file string")


def lines(spark, *rows):
    return spark.createDataFrame([r + (None,) * (9 - len(r)) for r in rows], LINE)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([("Ann", "AA", D(50), D(4)), ("Bob", "BB", D(40), D(0)), ("Cy", "CC", D(0), None)],
                                 "salesperson string, sales_initials string, sales_percentage decimal(9,6), "
                                 "qq_split decimal(9,6)")


# --- calculations ------------------------------------------------------------------------------------

def test_split_shares_add_up(spark):
    df = lines(spark, ("1", "AA", "BB", 50, D("10.01")), ("2", "AA", None, None, D("10")), ("3", None, "BB", 50, D("10")),
               ("4", "AA", "BB", 0, D("0.03")))
    got = {r.unique_id: r for r in calc.split_shares(df).collect()}
    assert got["1"].sales_commission == D("4.5045") and got["1"].cm_sales_comm == D("2.2523")
    assert got["2"].cm_sales_comm == D("0.9000") and got["2"].design_sales_comm == D("3.6000")
    assert got["3"].cm_sales_comm == 0 and got["3"].design_sales_comm == D("4.5000")
    assert all(r.cm_sales_comm + r.design_sales_comm == r.sales_commission for r in got.values())


def test_month_end_commission(spark, people):
    df = lines(spark, ("both", "AA", "BB", 25, D(100)), ("same", "AA", "AA", 25, D(100)), ("one", None, "BB", 20, D(100)),
               ("poolcm", "QQ", "BB", 20, D(100)), ("pool", "AA", "QQ", 20, D(100)), ("unknown", "AA", "ZZ", 20, D(100)),
               ("none", None, None, 20, D(100)), ("zero", "CC", None, 20, D(100)))
    df = df.withColumn("sales_commission", F.lit(D("7")).cast("decimal(18,4)"))
    got = {r.unique_id: (r.sales_commission, r.rate_issue) for r in calc.month_end_commission(df, people).collect()}
    assert got == {"both": (D("42.5"), None), "same": (D(50), None), "one": (D(40), None), "poolcm": (D(45), None),
                   "pool": (D(45), None), "unknown": (D(7), "NO_PERCENTAGE"), "none": (D(7), "NO_SALESPERSON"),
                   "zero": (D(7), "NO_SALESPERSON")}


def test_person_scaling_shares_out_the_whole_line(spark, people):
    df = lines(spark, ("both", "AA", "BB", 25, D(100)), ("same", "AA", "AA", 25, D(100)), ("one", None, "BB", 20, D(100)))
    df = df.withColumn("sales_commission", F.lit(D("7")).cast("decimal(18,4)"))
    got = {(r.unique_id, r.salesperson): (r.actual_comm_paid, r.sales_commission)
           for r in calc.by_person(df, people).collect()}
    assert got == {("both", "AA"): (D(25), D("12.5")), ("both", "BB"): (D(75), D(30)), ("same", "AA"): (D(100), D(50)),
                   ("one", "BB"): (D(100), D(7))}


def test_pool_line_needs_a_pool_share(spark, people):
    df = lines(spark, ("1", "AA", "QQ", 20, D(100)), ("2", "QQ", "AA", 20, D(50)))
    df = df.withColumn("sales_commission", F.lit(D("45")).cast("decimal(18,4)"))
    got = {r.salesperson: r.sales_commission for r in calc.pool_lines(df, people, AS_OF).collect()}
    assert got == {"AA": D("1.8"), "BB": D(0)}


def test_grand_total_is_the_sum_and_stands_once(spark):
    df = lines(spark, ("1", None, None, 20, D(1), D(10), "P1"), ("2", None, None, 20, D(2), D(0), "P2"),
               ("3", None, None, 20, D(4), D(30), None)).withColumn("sales_commission", F.col("actual_comm_paid"))
    rows = report.principal_totals(df, with_rate=True).orderBy("level", "principal").collect()
    assert [(r.principal, r.actual_comm_paid) for r in rows] == [(None, 4), ("P1", 1), ("P2", 2), ("Grand Total", 7)]
    assert rows[1].true_comm_pct == 0.1 and rows[2].true_comm_pct is None


def test_quarters(spark):
    df = spark.createDataFrame([("2023Q%d" % i,) for i in range(1, 5)] + [(None,), ("2024Q1",), ("2024Q2",)],
                               "quarter_shipped string")
    assert sorted(r[0] for r in report.last_quarters(df).collect()) == ["2023Q2", "2023Q3", "2023Q4", "2024Q1", "2024Q2"]
    few = df.filter("quarter_shipped is null or quarter_shipped >= '2024'")
    assert report.revenue_history(few).count() == 3
    assert report.revenue_history(df, df.limit(1)).count() == 6


def test_quarter_to_date_and_year_rollover(spark):
    months = [dt.date(2023, m, 1) for m in (9, 10, 11, 12)]
    df = spark.createDataFrame([(m,) for m in months] + [(None,)], "comm_month date")
    kept = report.quarter_to_date(df, F.lit(dt.date(2023, 11, 1)))
    assert {r[0] for r in kept.collect()} == set(months[1:3])
    assert report.tag_next_month(df.limit(1), df).first().comm_month == dt.date(2024, 1, 1)
    assert {r[0] for r in report.finished_quarter(df).collect()} == set(months[1:])
    assert report.remove_month(df, months[0]).count() == 4


def test_pivot_totals(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4)], "r string, c string, v int")
    got = {r.r: (r.x, r.y, r.total) for r in report.pivot_sum(df, ["r"], "c", "v", totals=True).collect()}
    assert got == {"a": (1, 2, 3), "b": (4, None, 4), None: (5, 2, 7)}


# --- matching ----------------------------------------------------------------------------------------

LOOKUP = ("lookup_id int, reported_customer string, part_number string, cm_sales string, design_sales string, "
          "t_name string, cm string, t_end_cust string, cm_split int, city string, last_used date")


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([
        (1, "Acme", "P1", "AA", None, "OOT x", None, "End", 20, None, dt.date(2020, 1, 1)),
        (2, "Soft", "P1", None, None, "n", None, "Unknown", 20, None, dt.date(2020, 1, 1)),
        (3, "Two", "P1", "BB", None, "n", None, "E2", 20, None, dt.date(2020, 1, 1)),
        (4, "TWO", "p1", "AA", None, "n", None, "E1", 50, None, dt.date(2020, 1, 1)),
        (5, "two", "P1", "BB", None, "n", None, "E2", 20, None, dt.date(2020, 1, 1)),
        (6, None, "P9", "AA", "BB", "n", None, "Blank", 20, None, dt.date(2020, 1, 1))], LOOKUP)


@pytest.fixture(scope="module")
def matched(spark, lookup):
    df = spark.createDataFrame([
        (0, "ACME", "p1", None, "Oslo"), (1, "soft", "P1", None, None), (2, "Two", "P1", None, None),
        (3, None, "p9", None, None), (4, "Acme", "P1", "A Correction", None), (5, "Acme", "P2", None, None),
        (6, "acme", "P1", None, "Rome")],
        "row_idx int, reported_customer string, part_number string, t_notes string, city string")
    return match.match_lookup(df, lookup, F.col("lookup_id"))


def test_lookup_match(matched):
    got = {r.row_idx: r for r in matched.collect()}
    assert [got[i].lookup_matches for i in range(7)] == [1, 0, 3, 1, 0, 0, 1]
    assert got[0].cm_sales == "AA" and got[0].lookup_id == 1
    assert got[1].t_end_cust == "Unknown" and got[1].found == 1
    assert got[2].cm_sales == "BB, AA" and got[2].t_end_cust == "E2, E1"
    assert got[2].cm_split is None and got[2].cm_split_options == "20, 50"
    assert got[3].t_end_cust == "Blank" and got[4].cm_sales is None


def test_lookup_usage(matched, lookup):
    got = {r.lookup_id: (r.last_used, r.city) for r in match.lookup_usage(matched, lookup, AS_OF, F.col("row_idx")).collect()}
    assert got[1] == (AS_OF, "Oslo") and got[2] == (AS_OF, None) and got[3][0] == dt.date(2020, 1, 1)


def test_distributor_match(spark):
    dist = spark.createDataFrame([("Digi-One", "digione"), ("Digi", "digi"), ("Mouser", "mouser"), ("Never", "Mouser")],
                                 "corrected_dist string, search_abbreviation string")
    names = ["Mouser Electronics", "DIGI-ONE corp", "Other", None, "--", "mo user mouser"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, reported_distributor string")
    got = {r.i: (r.distributor, r.distributor_matches) for r in match.match_distributor(df, dist).collect()}
    assert got == {0: ("Mouser", 1), 1: (None, 2), 2: (None, 0), 3: (None, 1), 4: (None, 1), 5: ("Mouser", 1)}


def test_current_design_sales(spark):
    accounts = spark.createDataFrame([("X", "AA"), ("Y", "AA"), ("Y", "BB"), ("Z", None)], "proper_name string, sls string")
    df = spark.createDataFrame([("X", "CC", "DD"), ("Y", "CC", "DD"), ("x", "CC", None), ("Z", "CC", "DD")],
                               "t_end_cust string, cm_sales string, design_sales string")
    got = [r.cds for r in match.tag_current_design_sales(df, accounts).orderBy("t_end_cust").collect()]
    assert got == ["AA", "DD", None, "CC"]


def test_relink_counts_ties_and_collisions(spark):
    ddl = ("unique_id string, reported_customer string, part_number string, from_file string, "
           "actual_comm_paid decimal(18,2), invoice_number string")
    rc = spark.createDataFrame([("r1", "c", "p", "f", D(1), "1"), ("r2", None, "p", "f", D(2), "1"),
                                ("r3", None, "p", "f", D(2), "2"), ("r4", "c", "q", "f", D(3), "1"),
                                ("r5", "c", "q", "f", D(3), "1")], ddl)
    enf = spark.createDataFrame([("e1", "c", "p", "f", D(1), "9"), ("e2", None, "p", "f", D(2), "2"),
                                 ("e3", "c", "q", "f", D(3), "1"), ("e4", "c", "z", "f", D(3), "1"),
                                 ("e5", "c", "p", "f", D(1), "8")], ddl)
    links, members = match.relink(enf, rc)
    got = {r.entry_id: (r.n_matches, r.line_id, r.collides) for r in links.collect()}
    assert got == {"e1": (1, "r1", True), "e2": (1, "r3", False), "e3": (2, None, False), "e4": (0, None, False),
                   "e5": (1, "r1", True)}
    assert {r.line_id for r in members.collect()} == {"r4", "r5"}


# --- merging -----------------------------------------------------------------------------------------

def test_merge_by_id(spark):
    target = spark.createDataFrame([("a", 1, "jan"), ("b", 2, "jan"), ("b", 3, "jan"), ("c", 4, "feb")],
                                   "unique_id string, v int, comm_month string")
    source = spark.createDataFrame([("a", 10, 1), ("a", 11, 2), ("b", 20, 1), ("x", 1, 1), (None, 5, 1)],
                                   "unique_id string, v int, n int")
    merged, outcome = merge.merge_by_id(target, source, F.col("n"))
    assert sorted(tuple(r) for r in merged.collect()) == [("a", 11, "jan"), ("b", 2, "jan"), ("b", 3, "jan"), ("c", 4, "feb")]
    assert {r.unique_id: r.code for r in outcome.collect()} == {"a": "MERGED", "b": "MULTIPLE_MATCHES", "x": "NO_MATCH"}


def test_new_lookups_are_learned_once(spark, lookup):
    cols = ("reported_customer string, part_number string, cm_sales string, design_sales string, cm string, t_name string, "
            "t_end_cust string, cm_split int, principal string, city string, row_idx int")
    df = spark.createDataFrame([
        ("acme", "p1", "AA", None, None, "OOT x", "End", 20, "P", None, 1),
        ("New", "p1", "AA", None, None, "n", "End", 30, "P", "c1", 3), ("new", "P1", "AA", None, None, "n", "End", 20, "P", "c0", 2),
        ("Acme", "P1", "AA", None, None, "n", "an Individual", 20, "P", None, 4)], cols)
    added = merge.new_lookups(df, lookup, AS_OF, F.col("row_idx"))
    rows = added.collect()
    assert [(r.reported_customer, r.cm_split, r.city, r.last_used) for r in rows] == [("new", 20, "c0", AS_OF)]
    again = merge.new_lookups(df, merge.extend_lookup(lookup, added), AS_OF, F.col("row_idx"))
    assert again.count() == 0


def test_quarantine_boundary(spark):
    days = [AS_OF - dt.timedelta(days=n) for n in (720, 721)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "last_used date")
    current, stale, rejects = merge.quarantine(df, AS_OF)
    assert [current.count(), stale.count(), rejects.count()] == [1, 1, 1]
    assert stale.first().date_quarantined == AS_OF


def test_root_customer_upsert_is_idempotent(spark):
    mapping = spark.createDataFrame([("Acme", "AA"), ("Dup", "AA"), ("dup", "BB"), ("Rest", "AA")],
                                    "root_customer string, salesperson string")
    feedback = spark.createDataFrame([("ACME ", "Direct", "BB", 1), ("acme", "Direct", "CC", 2), ("New", "Direct", "AA", 3),
                                      ("dup", "Direct", "CC", 4), ("Rest", "Individual", "CC", 5), ("", "x", "CC", 6)],
                                     "root_customer string, root_customer_class string, sales string, n int")
    once = merge.upsert_root_customers(mapping, feedback, F.col("n"))
    got = sorted(tuple(r) for r in once.collect())
    assert got == [("Acme", "CC", "updated"), ("Dup", "AA", "refused"), ("Rest", "AA", "unchanged"),
                   ("dup", "BB", "refused"), ("new", "AA", "inserted")]
    twice = merge.upsert_root_customers(once.drop("status"), feedback, F.col("n")).drop("status")
    assert sorted(map(tuple, twice.collect())) == sorted(r[:2] for r in got)


def test_current_sales(spark):
    master = spark.createDataFrame([("X", "old"), ("Y", "old"), ("Z", "old"), ("W", None)],
                                   "root_customer string, current_sales string")
    accounts = spark.createDataFrame([("X", "AA", 1), ("X", "BB", 2), ("Y", None, 1)], "proper_name string, sls string, n int")
    roots = spark.createDataFrame([("Y", "MM", 1), ("Z", "MM", 1)], "root_customer string, salesperson string, m int")
    got = merge.refresh_current_sales(master, accounts, roots, F.col("n"), F.col("m"))
    assert {r.root_customer: r.current_sales for r in got.collect()} == {"X": "AA", "Y": "old", "Z": "MM", "W": None}


# --- fill-down, insight, files ---------------------------------------------------------------------------

@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_fill_down_does_not_depend_on_chunks(spark, chunk):
    written = [None, "a", None, None, None, None, None, "b", None, "c"]
    df = spark.createDataFrame([("f", "s", i, v) for i, v in enumerate(written)] + [("f", "t", 0, None), ("f", "t", 1, "z")],
                               "from_file string, sheet_name string, row_idx long, d string")
    got = rules.fill_down(df, "d", chunk=chunk).orderBy("sheet_name", "row_idx").collect()
    assert [r.d for r in got] == [None] + ["a"] * 6 + ["b", "b", "c", None, "z"]


def test_insight_assignment(spark):
    people = spark.createDataFrame([("Ann", "AA", "Oslo, Rome"), ("Bob", "BB", "Paris"), ("Cy", "CC", None)],
                                   "salesperson string, sales_initials string, territory_cities string")
    accounts = spark.createDataFrame([("Acme", "AA", "Oslo"), ("Twice", "AA", "Oslo"), ("Twice", "BB", "Oslo"),
                                      ("Many", "BB", "Oslo, Rome")], "proper_name string, sls string, city string")
    roots = spark.createDataFrame([("twice", "BB"), ("Dup", "AA"), ("dup", "BB")], "root_customer string, salesperson string")
    rows = spark.createDataFrame([
        (0, "ACME ", "Direct", "Oslo"), (1, "acme", "Contract Mfg", "Paris"), (2, "Twice", "Direct", "x"),
        (3, "dup", "Direct", "Paris"), (4, "Nobody", "Direct", "paris"), (5, "Acme", "Individual", "Rome"),
        (6, "Many", "Direct", "Paris"), (7, None, "Direct", None)],
        "i int, root_customer string, root_customer_class string, customer_city string").withColumn("sales", F.lit("old"))
    got = {r.i: (r.sales, r.comments, r.new_customer, r.city_on_account_list, r.review, r.match_issue)
           for r in insight.assign_sales(rows, accounts, roots, people, F.col("sales_initials")).collect()}
    assert got == {
        0: ("AA", None, None, None, None, None), 1: ("AA", "Contract Manufacturer", None, "OSLO", "MOVED", None),
        2: ("BB", None, None, None, None, None), 3: ("old", None, None, None, None, "DUPLICATE_CUSTOMER"),
        4: ("BB", None, "Y", None, "NEW", None), 5: ("AA", "Individual", None, None, None, None),
        6: ("BB", None, None, "OSLO, ROME", "MOVED", None), 7: ("CC", None, "Y", None, None, None)}


def test_feedback_owner_checks(spark):
    people = spark.createDataFrame([("AA",), ("BB",)], "sales_initials string")
    rows = spark.createDataFrame([("aa one.csv", "AA"), ("aa one.csv", "BB"), ("aa one.csv", "aa"), ("BB 1", "BB"), ("BB 2", "BB"),
                                  ("zz", "ZZ")], "from_file string, sales string")
    own, found = insight.compile_feedback(rows, people)
    assert sorted(r.sales for r in own.collect()) == ["AA", "aa"]
    assert sorted((r.code, r.from_file) for r in found.collect()) == [
        ("DUPLICATE_OWNER", "BB 1"), ("DUPLICATE_OWNER", "BB 2"), ("UNKNOWN_OWNER", "zz")]
    with pytest.raises(issues.FatalIssues, match="DUPLICATE_OWNER x2"):
        issues.enforce(found)


def test_insight_columns_stand_in_their_places(spark):
    names = [f"c{i}" for i in range(24)]
    df = spark.createDataFrame([tuple("x" for _ in names) + ("r", "2", "1.5", "s")],
                               ", ".join(f"{n} string" for n in [*names, "root_customer", "qty_shipped", "unit_price", "send"]))
    out = insight.insight_columns(df)
    assert out.columns[4] == "sales" and out.columns[6:10] == list(insight.FEEDBACK_COLUMNS)
    assert out.columns[19] == "invoiced_dollars" and out.columns[25] == "city_on_account_list"
    assert "send" not in out.columns and out.columns[-2:] == ["comments", "new_customer"]
    assert out.first().invoiced_dollars == D("3.00")


def test_ledger(spark):
    df = lines(spark, ("1", None, None, None, D(1), None, None, None, "f1"), ("2", None, None, None, D(2), None, None, None, "f1"))
    entries = ledger.file_entries(df, AS_OF)
    assert [(r.filename, r.total_commissions) for r in entries.collect()] == [("f1", D(3))]
    assert ledger.new_files(df, entries).count() == 0
    with pytest.raises(ledger.FilesAlreadyReported, match="f1"):
        ledger.refuse_known_files(entries, entries)


def test_versions_and_months(spark, tmp_path):
    root = str(tmp_path)
    for version, n in (("2024-01", 1), ("2024-02", 2)):
        sinks.publish(spark.range(n), root, "t", version)
    assert sinks.current_version(spark, root, "t") == "2024-02"
    assert sinks.read_current(spark, root, "t").count() == 2
    assert spark.read.parquet(f"{root}/t/v=2024-01").count() == 1
    df = spark.createDataFrame([("jan", 1), ("feb", 2)], "comm_month string, v int")
    sinks.replace_months(df, f"{root}/h")
    for _ in range(2):
        sinks.replace_months(df.filter("v = 2").withColumn("v", F.lit(3)), f"{root}/h")
    assert {(r.comm_month, r.v) for r in spark.read.parquet(f"{root}/h").collect()} == {("jan", 1), ("feb", 3)}
    people = spark.createDataFrame([("AA", 1), ("BB", 2), ("AA", 3)], "salesperson string, v int")
    sinks.write_by_person(people, f"{root}/r", rows_per_file=1)
    assert spark.read.parquet(f"{root}/r/salesperson=AA").count() == 2
