"""What the operators of this folder share: stages in the shared folder, and words of whole Arrow columns at once."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repledger.session import remove_at_exit, shared_folder

#: A word is a run of other characters than these six: space, tab, line feed, vertical tab, form feed, return.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
_WHITE = np.zeros(256, bool)
_WHITE[[ord(c) for c in WHITE]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text taken by one pass of `word_blocks`; a longer document makes a pass of its own.
BLOCK_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting by which an execution removes its shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, held: list[DataFrame] | None = None) -> DataFrame:
    """Write `df` to a new folder of the shared folder and read it back, which cuts the lineage.

    The files outlive executors; the folder goes when the driver ends, or when `drop_stage` is called. With `held`, the
    stage is noted there, to be dropped with others. The shuffle files of the write go as it ends, as nothing reads them
    again; otherwise they would stay on the executors until the driver happens to collect garbage.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(remove_at_exit(spark, folder))
    out.stage_folder = folder
    if held is not None:
        held.append(out)
    return out


def drop_stage(df: DataFrame) -> None:
    """Remove what `stage` wrote, once nothing that is still to be computed reads it."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stage_folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def width(spark: SparkSession) -> int:
    """Tasks of a shuffle, as the session has them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: What a worker process remembers from task to task: functions that let it go.
REMEMBERED_BY: list[Callable[[], None]] = []


def let_go() -> None:
    for forget in REMEMBERED_BY:
        forget()


#: Spark's setting for the bytes of a batch that a task sends to Python, and the most that wide rows are sent at once. By
#: Spark's own value a task may hold 64 MB of them, with room to double, and its worker as many again.
BATCH_SETTING, BATCH_MOST = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def in_small_batches(spark: SparkSession) -> None:
    """Have the session send batches of `BATCH_MOST` bytes at most; a lower setting stays. No result depends on batches."""
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_SETTING))
    if not 0 < most <= BATCH_MOST:
        spark.conf.set(BATCH_SETTING, str(BATCH_MOST))


def in_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
             remembers: bool = False) -> DataFrame:
    """fn over the batches of each partition; Python workers on this machine find the package where the driver does.

    Workers outlive the operator that they began with. What they remember for it is let go as a task of another begins;
    the tasks of an operator that `remembers` keep it.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", root)

    def forgetful(batches):
        let_go()
        yield from fn(batches)

    return df.mapInArrow(fn if remembers else forgetful, schema)


def word_count(text: str = "text"):
    """Words of a text column; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def strings(column: pa.Array) -> pa.Array:
    """The column with null as empty, with 64-bit offsets."""
    return pc.fill_null(column, "").cast(pa.large_string())


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits depend on all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bases of the polynomial hashes, odd and otherwise arbitrary.
BASE, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of consecutive documents `first` to `last`: where each starts and ends in `data`, and its 64-bit hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, last: int, lower: bool):
        self.first, self.last = first, last
        base = offsets[first]
        self.data = data[base : offsets[last]]
        begin, end = offsets[first:last] - base, offsets[first + 1 : last + 1] - base
        if lower:
            self.data = _LOWER[self.data]
        inside = ~_WHITE[self.data]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        full = begin < end
        starts[begin[full]] = inside[begin[full]]
        ends[end[full] - 1] = inside[end[full] - 1]
        self.starts, self.ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        #: words of document k of the block are bounds[k] to bounds[k + 1]
        self.bounds = np.append(np.searchsorted(self.starts, begin), len(self.starts))
        if len(self.starts):
            gaps = np.diff(np.append(self.starts, len(self.data)))
            place = np.arange(self.starts[0], len(self.data)) - np.repeat(self.starts, gaps)
            value = (self.data[self.starts[0] :].astype(np.uint64) + np.uint64(1)) * powers(BASE, int(gaps.max()))[place]
            value[~inside[self.starts[0] :]] = 0
            self.hashes = mix(np.add.reduceat(value, self.starts - self.starts[0]))
        else:
            self.hashes = np.zeros(0, np.uint64)

    def of(self, k: int) -> slice:
        return slice(self.bounds[k], self.bounds[k + 1])

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on; the last n - 1 of the block are missing."""
        m = max(0, len(self.hashes) - n + 1)
        out, done = np.zeros(m, np.uint64), 0
        run, length = self.hashes, 1  # hashes of `length` words, doubled as long as n has bits left
        while True:
            if n & length:
                out = out * np.uint64(pow(STEP, length, 1 << 64)) + run[done : done + m]
                done += length
            if 2 * length > n:
                return mix(out)
            run = run[:-length] * np.uint64(pow(STEP, length, 1 << 64)) + run[length:]
            length *= 2

    def document_of(self) -> np.ndarray:
        """The document, from `first` on, of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def word_blocks(column: pa.Array, lower: bool = False, block_bytes: int = BLOCK_BYTES) -> Iterator[Words]:
    """The words of every document of an Arrow text column, about a block of text at a time."""
    column = strings(column)
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1)
        last = min(last, len(column))
        yield Words(data, offsets, first, last, lower)
        first = last
