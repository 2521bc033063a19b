import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from repledger.operators import compare
from repledger.sources import history, sinks

D = Decimal
DDL = "unique_id string, comm_month date, a string, b string, paid decimal(18,2)"
M = [dt.date(2000, k + 1, 1) for k in range(6)]


def found(before, after, **options):
    return {r[0]: tuple(r)[1:] for r in compare.merge_difference(before, after, **options).collect()}


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(2)
    return [(f"k{n}", M[n % 6], rng.choice([None, "x", "y"]), rng.choice([None, "x"]), D(n)) for n in range(600)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, DDL).repartition(parts)


def test_equal_tables_in_any_order(spark, lines):
    rows = [*lines, lines[5], lines[5], (None, None, None, None, None), (None, M[0], "x", None, D(1))]
    assert found(frame(spark, rows), frame(spark, rows[::-1], 5).select("paid", "b", "a", "comm_month", "unique_id")) == {}
    wider = frame(spark, rows).withColumn("paid", F.col("paid").cast("decimal(20,4)"))
    assert found(frame(spark, rows), wider) == {}
    assert found(frame(spark, []), frame(spark, [])) == {}
    digests = [sorted(map(tuple, compare.month_digests(frame(spark, r, p)).collect(), ), key=repr) for r, p in ((rows, 2), (rows[::-1], 7))]
    assert digests[0] == digests[1] != sorted(map(tuple, compare.month_digests(frame(spark, rows[1:])).collect()), key=repr)


def test_altered_lost_and_added(spark, lines):
    changed = {r[0]: r for r in lines}
    changed["k7"] = ("k7", M[1], "new", lines[7][3], lines[7][4])
    changed["k8"] = ("k8", M[4], *lines[8][2:])  # moved to another month
    del changed["k9"]
    more = [*changed.values(), ("k600", M[0], "x", None, D(1)), lines[10], (None, None, "x", None, None)]
    old = [*lines, ("two", M[0], "x", "x", D(1)), ("two", M[0], "y", "x", D(1))]
    got = found(frame(spark, old), frame(spark, [*more, ("two", M[0], "z", "x", D(1)), ("two", M[0], "y", "x", D(1))]))
    assert got == {
        "k7": ("altered", 1, 1, M[1], M[1], ["a"]), "k8": ("altered", 1, 1, M[2], M[4], ["comm_month"]),
        "k9": ("lost", 1, 0, M[3], None, None), "k600": ("added", 0, 1, None, M[0], None),
        "k10": ("added", 0, 1, None, M[4], None), None: ("added", 0, 1, None, None, None),
        "two": ("altered", 1, 1, M[0], M[0], ["a"])}


def test_values_that_change_places_and_blanks(spark):
    before = frame(spark, [("1", M[0], "x", None, None), ("2", M[0], "x", "y", None)])
    after = frame(spark, [("1", M[0], None, "x", None), ("2", M[0], "y", "x", None)])
    assert {k: v[-1] for k, v in found(before, after).items()} == {"1": ["a", "b"], "2": ["a", "b"]}
    with pytest.raises(ValueError, match="columns differ"):
        compare.merge_difference(before, after.drop("a"))


def test_against_multisets(spark):
    """Random multisets, few keys and one range, so that equal and different rows of a key meet everywhere."""
    rng = random.Random(8)
    for ranges in (1, 4096):
        sides = [[(rng.choice("abcde"), rng.choice([None, *M[:2]]), rng.choice("xy"), None, D(rng.randint(0, 1))) for _ in range(40)]
                 for _ in range(2)]
        old, new = map(Counter, sides)
        want = {}
        for k in "abcde":
            gone = sum((n for r, n in (old - new).items() if r[0] == k))
            come = sum((n for r, n in (new - old).items() if r[0] == k))
            if gone or come:
                want[k] = ("lost" if not come else "added" if not gone else "altered", gone, come)
        got = found(frame(spark, sides[0]), frame(spark, sides[1]), ranges=ranges)
        assert {k: v[:3] for k, v in got.items()} == want


def test_a_stored_history_prunes_the_months_that_agree(spark, lines, tmp_path):
    stores = []
    for n, rows in enumerate((lines, [(*r[:4], r[4] + 1) if r[0] == "k13" else r for r in lines])):
        stores.append(history.Store(spark, str(tmp_path / str(n))))
        sinks.replace_months(spark.createDataFrame(rows, DDL), stores[n].path("lines"))
    result = compare.merge_difference(stores[0].read(), stores[1].read())
    assert "dynamicpruning" in result._jdf.queryExecution().executedPlan().toString()
    assert [(r.unique_id, r.kind, r["columns"]) for r in result.collect()] == [("k13", "altered", ["paid"])]
