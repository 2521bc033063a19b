"""Versioned tables and report files (S-19..S-21, U-2)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repledger.session import remove_at_exit

#: How stored tables are compressed: by about a third smaller than by Spark's default.
CODEC = "zstd"


def stager(folder: str) -> Callable[[DataFrame], DataFrame]:
    """Stores a table in a new folder below `folder` and reads it back; a lost executor costs no recomputation.

    The folders are removed when the driver ends.
    """
    def stage(df: DataFrame) -> DataFrame:
        path = f"{folder.rstrip('/')}/stage-{uuid.uuid4().hex}"
        df.write.option("compression", CODEC).parquet(path)
        remove_at_exit(df.sparkSession, path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return stage


#: Rows that one task writes of one person or month.
ROWS_PER_FILE = 1_000_000


def clustered(df: DataFrame, key: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Rows dealt to tasks by `key`; a key with many rows gets a task for about every `rows_per_file` of them.

    The sizes go to the rows, one for each folder that is written: dealt by key for them, the rows would be moved twice.
    """
    sizes = df.groupBy(F.col(key).alias("_of")).agg((F.count(F.lit(1)) / rows_per_file).alias("_n")).select(
        "_of", F.ceil("_n").alias("_slots"))
    slot = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.coalesce("_slots", F.lit(1)))
    dealt = df.join(F.broadcast(sizes), F.col(key).eqNullSafe(F.col("_of")), "left").withColumn("_slot", slot)
    return dealt.repartition(F.col(key), F.col("_slot")).drop("_of", "_slots", "_slot")


def write_tables(tables: dict[str, DataFrame], root: str, version: str, fmt: str = "parquet") -> None:
    """A new version of every table, each in its folder (S-19)."""
    for name, df in tables.items():
        publish(df, root, name, version, fmt=fmt)


def write_by_person(report: DataFrame, path: str, person: str = "salesperson",
                    rows_per_file: int = ROWS_PER_FILE) -> None:
    """Every salesperson's report in one job, one folder per person, in as many files as its rows ask for (S-20)."""
    clustered(report, person, rows_per_file).write.mode("overwrite").partitionBy(person).parquet(path)


def publish(df: DataFrame, root: str, table: str, version: str, partition_by: list[str] | None = None,
            fmt: str = "parquet") -> str:
    """Write a new version folder, then add it to the version log; earlier versions stay as backups (S-21).

    Nothing is written over a folder that may be being read, so a failed or repeated attempt leaves the
    current version intact.
    """
    path = f"{root}/{table}/v={version}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    spark = df.sparkSession
    log = spark.createDataFrame([(version, dt.datetime.now(dt.timezone.utc))], "version string, published_at timestamp")
    log.coalesce(1).write.mode("append").parquet(f"{root}/{table}/_versions")
    return path


def current_version(spark: SparkSession, root: str, table: str) -> str:
    """Name of the version published last."""
    log = spark.read.schema("version string, published_at timestamp").parquet(f"{root}/{table}/_versions")
    return log.agg(F.max_by("version", "published_at").alias("v")).first().v


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}/v={current_version(spark, root, table)}")


def replace_months(changed: DataFrame, path: str, month: str = "comm_month") -> None:
    """Rewrite only the commission months present in `changed`; repeating the write changes nothing (U-2).

    `changed` must not be read from `path` itself.
    """
    (clustered(changed, month).write.mode("overwrite").option("compression", CODEC).option("partitionOverwriteMode", "dynamic")
     .partitionBy(month).parquet(path))
