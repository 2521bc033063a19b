"""Row-level comparison of two tables of lines (A-15, U-1).

Tables are compared by digests first, which do not depend on the order of rows: sums of two row hashes and the number
of rows, for each month and range of keys. Only ranges whose digests differ are compared row by row, so two tables
that agree but for a few rows cost one aggregation each, and little more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges of keys that a month's rows fall into.
RANGES = 4096
_WIDE = "decimal(38,0)"


def row_hashes(columns: list[str]) -> list[Column]:
    """Two independent 64-bit hashes of a row. Blanks count with their place, so moved values change the hash."""
    shown = [F.col(f"`{c}`") for c in columns]
    blanks = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in shown])
    return [F.xxhash64(F.lit(seed), blanks, *shown) for seed in (17, 4099)]


def _shaped(df: DataFrame, columns: list[str], key: str, month: str, ranges: int) -> DataFrame:
    first, second = row_hashes(columns)
    return df.select(F.col(f"`{month}`").alias("_month"), F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(ranges)).alias("_range"),
                     F.col(f"`{key}`").alias("_key"), first.alias("_h1"), second.alias("_h2"),
                     F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))


def _signed(before: DataFrame, after: DataFrame) -> DataFrame:
    return (before.withColumn("_side", F.lit(-1).cast("long"))
            .unionByName(after.withColumn("_side", F.lit(1).cast("long"))))


def differing_ranges(before: DataFrame, after: DataFrame) -> DataFrame:
    """(_month, _range) in which two shaped tables do not hold the same rows equally often."""
    def total(c: Column) -> Column:
        return F.sum(c.cast(_WIDE) * F.col("_side").cast(_WIDE))

    return (_signed(before.drop("_row", "_key"), after.drop("_row", "_key")).groupBy("_month", "_range")
            .agg(total(F.col("_h1")).alias("_d1"), total(F.col("_h2")).alias("_d2"), F.sum("_side").alias("_n"))
            .filter("_d1 <> 0 or _d2 <> 0 or _n <> 0").select("_month", "_range"))


def month_digests(df: DataFrame, month: str = "comm_month") -> DataFrame:
    """Rows and a digest of each month, equal for two tables that hold the same rows in any order."""
    first, second = row_hashes(sorted(df.columns))
    return (df.select(F.col(f"`{month}`").alias(month), first.alias("_h1"), second.alias("_h2")).groupBy(month)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws("/", F.sum(F.col("_h1").cast(_WIDE)).cast("string"),
                                                                F.sum(F.col("_h2").cast(_WIDE)).cast("string")).alias("digest")))


def _in(shaped: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of some ranges. Two joins, as a month may be blank: the first lets a partitioned table prune its months."""
    dated = shaped.join(ranges.filter("_month is not null"), ["_month", "_range"], "left_semi")
    undated = shaped.filter("_month is null").join(ranges.filter("_month is null").select("_range"), "_range", "left_semi")
    return dated.unionByName(undated)


def merge_difference(before: DataFrame, after: DataFrame, key: str = "unique_id", month: str = "comm_month",
                     ranges: int = RANGES) -> DataFrame:
    """The keys whose rows differ between two tables of the same columns: none if both hold the same rows equally often.

    One row for each key: `kind` is `altered` where both tables have rows that the other lacks, `lost` where only
    `before` has, `added` where only `after` has; `n_before` and `n_after` count those rows, repeated ones included;
    `month_before` and `month_after` are the first months they are in; `columns` names what differs where one row
    stands against one. Rows without a key are compared as those of one key, NULL.
    """
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError(f"columns differ: {sorted(set(before.columns) ^ set(after.columns))}")
    columns = sorted(before.columns)
    kinds = dict(before.dtypes)
    after = after.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in columns])  # hashes depend on types
    old, new = (_shaped(df.select(*[F.col(f"`{c}`") for c in columns]), columns, key, month, ranges) for df in (before, after))
    wanted = differing_ranges(old, new)
    # Equal rows of both sides cancel out before keys are brought together.
    rows = (_signed(_in(old, wanted), _in(new, wanted)).groupBy("_key", "_month", "_h1", "_h2")
            .agg(F.sum("_side").alias("_n"), F.any_value("_row").alias("_row")).filter("_n <> 0"))
    lost, added = F.col("_n") < 0, F.col("_n") > 0
    by_key = rows.groupBy("_key").agg(
        F.coalesce(F.sum(F.when(lost, -F.col("_n"))), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum(F.when(added, F.col("_n"))), F.lit(0)).alias("n_after"),
        F.min(F.when(lost, F.col("_month"))).alias("month_before"), F.min(F.when(added, F.col("_month"))).alias("month_after"),
        F.any_value(F.when(lost, F.col("_row")), True).alias("_old"), F.any_value(F.when(added, F.col("_row")), True).alias("_new"))
    kind = F.when(F.col("n_after") == 0, F.lit("lost")).when(F.col("n_before") == 0, F.lit("added")).otherwise(F.lit("altered"))
    named = F.array_compact(F.array(*[F.when(~F.col("_old")[c].eqNullSafe(F.col("_new")[c]), F.lit(c)) for c in columns]))
    single = (F.col("n_before") == 1) & (F.col("n_after") == 1)
    return by_key.select(F.col("_key").alias(key), kind.alias("kind"), "n_before", "n_after", "month_before", "month_after",
                         F.when(single, named).alias("columns"))
