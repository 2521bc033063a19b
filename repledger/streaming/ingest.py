"""Incremental ingest: each arriving file is processed once (T-1, F-5, S-22).

A file source with a checkpoint decides what is new; every micro-batch runs ordinary batch operators
and writes to a folder named after its batch id. A batch that is repeated after a failure overwrites its own
folder, so results are those of one run.

`run_conform` does so for the whole of conforming: lines, ledger, refusals and issues of a batch are written under its
id and count from the moment a last, empty folder says that all of them are there.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repledger.plans import flows
from repledger.sources import ledger as files
from repledger.sources.schema import RAW_SHEETS

DONE = "_done"
LEDGER = "filename string, total_commissions decimal(18,2), date_added date, paid_date date"
CONFORMED = ("lines", "refused", "issues", "ledger")


def raw_sheet_stream(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    """Stream of exported sheets arriving in `path`."""
    return file_stream(spark, path, fmt, T.StructType.fromDDL(RAW_SHEETS), **options)


def file_stream(spark: SparkSession, path: str, fmt: str, schema: T.StructType, **options) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def run_available(stream: DataFrame, workspace: str, process: Callable[[DataFrame], dict[str, DataFrame]]) -> None:
    """Process everything that has arrived and stop; call again when more has arrived.

    `process` turns a batch into named tables, written below `workspace/<name>/batch_id=<n>`.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        for name, table in process(batch).items():
            table.write.mode("overwrite").parquet(f"{workspace}/{name}/batch_id={batch_id}")

    _run(stream, workspace, handle)


def _run(stream: DataFrame, workspace: str, handle: Callable[[DataFrame, int], None]) -> None:
    query = (stream.writeStream.foreachBatch(handle).trigger(availableNow=True)
             .option("checkpointLocation", f"{workspace}/_checkpoint").start())
    try:
        query.awaitTermination()
    finally:
        query.stop()


def read_output(spark: SparkSession, workspace: str, name: str) -> DataFrame:
    """All batches of one output table."""
    return spark.read.parquet(f"{workspace}/{name}").drop("batch_id")


# --- conforming what arrives -------------------------------------------------------------------------

def committed(spark: SparkSession, workspace: str) -> list[int]:
    """Ids of the batches all of whose tables are there: names of folders."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{workspace}/{DONE}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def read_committed(spark: SparkSession, workspace: str, name: str, ddl: str | None = None, before: int | None = None) -> DataFrame:
    """One output table of the batches that are whole, or of those `before` a batch. Without any it is empty, by `ddl`."""
    batches = [n for n in committed(spark, workspace) if before is None or n < before]
    try:
        whole = spark.read.parquet(f"{workspace}/{name}")
    except AnalysisException:
        if ddl is None or batches:
            raise
        return spark.createDataFrame([], ddl)
    return whole.filter(F.col("batch_id").isin(batches)).drop("batch_id")


def _commit(spark: SparkSession, workspace: str, batch_id: int) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{workspace}/{DONE}/batch_id={batch_id}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def run_conform(stream: DataFrame, workspace: str, aliases: dict[str, list[str]], dims: flows.Dimensions, as_of: dt.date,
                stage: Callable[[DataFrame], DataFrame], **options) -> None:
    """Conform the sheets that have arrived, and stop (T-1, F-5, S-22, Q-1).

    Each batch leaves the accepted lines, its entries of the ledger, the refused files and the issues. It skips files
    that an earlier whole batch has entered, so a file delivered twice counts once, while a refused file has no entry
    and is read when its corrected copy arrives. The copies of a batch that broke off between two writes do not count:
    the batch runs again under its id, on the same ledger, and writes the same. All sheets of a workbook must arrive in
    one batch, as one file or in a folder that is moved in whole; a workbook refused and corrected within one batch
    would be refused. `stage` stores the mapped sheets and the lines.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id in committed(spark, workspace):
            return
        known = read_committed(spark, workspace, "ledger", LEDGER, before=batch_id)
        out, read = flows.accepted_sheets(batch, known, aliases, dims, as_of, stage=stage, **options)
        lines = stage(out.lines)
        tables = {"lines": lines, "ledger": files.file_entries(lines, as_of, read),
                  "refused": out.refused, "issues": out.issues}
        for name in CONFORMED:
            write_batch(tables[name], workspace, name, batch_id)
        _commit(spark, workspace, batch_id)

    _run(stream, workspace, handle)


def write_batch(table: DataFrame, workspace: str, name: str, batch_id: int) -> None:
    """One table of a batch, in place of what an attempt before has left."""
    table.write.mode("overwrite").parquet(f"{workspace}/{name}/batch_id={batch_id}")
