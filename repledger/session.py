"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Generated methods beyond 8000 bytes are not compiled by the JVM; split projections are faster then.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "repledger", master: str | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC; `extra` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compiled(spark: SparkSession) -> SparkSession:
    """The session, set to leave methods alone that the JVM would not compile: wide sheets make such methods."""
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, min(int(spark.conf.get(name)), int(SETTINGS[name])))
    return spark


def remove_at_exit(spark: SparkSession, folder: str) -> str:
    """Have the files below `folder`, in whatever store it lies, removed when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a session whose tasks run in the driver's own process falls back to a temporary folder without that setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="repledger-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
