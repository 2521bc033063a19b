"""Operator 8: content-defined chunks, their digests weighted by length, and containment between documents."""

from __future__ import annotations

import base64
import functools
from bisect import bisect_left
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import NumericType

from repledger.llm.common import in_arrow, mix, width

#: Bytes: the least of a chunk, where the easier condition starts, and the most.
LEAST, NORMAL, MOST = 8, 32, 128
#: Conditions on the bits of the gear hash from bit 31 on, which all of the last 32 bytes reach.
HARD, EASY = np.uint64(0x3F << 31), np.uint64(0x0F << 31)
_DIGEST_BITS, _LENGTH_BITS = 40, 24


@functools.cache
def gear() -> np.ndarray:
    """256 values by a rule, one for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text in UTF-8.

    A chunk ends after the first byte, `LEAST` bytes in at least, where the gear hash of the last 32 bytes meets the
    hard condition, or beyond `NORMAL` bytes the easy one, and after `MOST` bytes in any case.
    """
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = gear()[np.frombuffer(data, np.uint8)]
    for k in (1, 2, 4, 8, 16):
        if k < n:
            longer = h.copy()
            longer[k:] += h[:-k] << np.uint64(k)
            h = longer
    easy = np.flatnonzero((h & EASY) == 0)
    hard = easy[(h[easy] & HARD) == 0].tolist() + [n + MOST]
    easy = easy.tolist() + [n + MOST]
    out, at = [], 0
    while at < n:
        end = hard[bisect_left(hard, at + LEAST - 1)]
        if end >= at + NORMAL - 1:
            end = easy[bisect_left(easy, at + NORMAL - 1)]
        at = min(end + 1, at + MOST, n)
        out.append(at)
    return out


def chunk_set(text: str) -> np.ndarray:
    """The distinct chunks of a text in ascending order: 40 bits of digest, then 24 bits of length in bytes."""
    data = text.encode()
    at, out = 0, []
    for end in cuts(data):
        digest = xxhash.xxh3_64_intdigest(data[at:end]) >> (64 - _DIGEST_BITS)
        out.append(digest << _LENGTH_BITS | (end - at))
        at = end
    return np.unique(np.array(out, np.uint64))


def written(chunks: np.ndarray) -> str:
    return base64.b64encode(chunks.astype(">u8").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u8").astype(np.uint64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Length of the chunks that both have, as a share of the length of the smaller set; two empty sets are alike."""
    mask = np.uint64((1 << _LENGTH_BITS) - 1)
    least = min(int((a & mask).sum()), int((b & mask).sum()))
    if not least:
        return float(len(a) == len(b))
    return int((np.intersect1d(a, b, assume_unique=True) & mask).sum()) / least


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row, as it lies; null text counts as empty, whose fingerprint is ''."""
    def rows(batches):
        for batch in batches:
            held = [x.as_py() or "" for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in held], pa.int64()),
                 pa.array([written(chunk_set(x)) for x in held], pa.string())], ["doc_id", "n_chars", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs.select("doc_id", "text"), rows, f"doc_id {kind}, n_chars long, fingerprint string")


def _bounds(docs: DataFrame, ranges: int) -> list:
    """Ascending bounds of about equal ranges of doc_id: quantiles of numbers, or those of a sample of other ids.

    They decide how even the ranges are, and no result. The sample is about 20 ids for each range.
    """
    if isinstance(docs.schema["doc_id"].dataType, NumericType):
        shares = [k / ranges for k in range(1, ranges)]
        return sorted(set(docs.select(F.col("doc_id").cast("double").alias("id")).approxQuantile("id", shares, 0.2 / ranges)))
    ids = docs.select("doc_id").where("doc_id is not null")
    held = sorted(r[0] for r in ids.sample(min(1.0, 20 * ranges / max(1, ids.count())), seed=1).limit(100 * ranges).collect())
    return sorted({held[k * len(held) // ranges] for k in range(1, ranges)}) if held else []


def _range_of(bounds: list):
    """Ranges of doc_id by ascending bounds, -1 for null: a binary search of as many steps as the bounds have bits."""
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    values, n = F.array(*[F.lit(b) for b in bounds]), F.lit(len(bounds))

    def step(low, s):
        return F.when((low + s <= n) & (F.get(values, low + s - 1) < F.col("doc_id")), low + s).otherwise(low)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step) if steps else F.lit(0)
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(found)


def with_next(docs: DataFrame, fn: Callable[[tuple, tuple], tuple], schema: str, types: list[pa.DataType]) -> DataFrame:
    """fn(row, next row) for each row (doc_id, text), in descending doc_id order; the first follows the last.

    Documents are dealt to ranges of doc_id, each sorted by its task. The row that follows a range, the first of the
    next one, is sent along with it: one text for each range. The driver sees bounds and one id for each range only.
    fn gets for its first argument what `prepare` made of the row, so nothing is computed twice.
    Rows of one doc_id go by text; a null doc_id comes last, a null text last among its doc_id.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    ranges = 4 * width(spark)
    bounds = _bounds(docs, ranges)
    dealt = docs.withColumn("part", _range_of(bounds))
    heads = sorted(((r["part"], r["head"]) for r in dealt.groupBy("part").agg(F.max("doc_id").alias("head")).collect()),
                   reverse=True)
    if not heads:
        return spark.createDataFrame([], schema)
    kind = docs.schema["doc_id"].dataType.simpleString()
    follows = [(part, heads[(k + 1) % len(heads)][1]) for k, (part, _) in enumerate(heads)]
    follows = spark.createDataFrame(follows, f"part int, head {kind}")
    # One id for each range, of which there are four for each task.
    after = docs.join(F.broadcast(follows), F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "text", "part")
    rows = dealt.withColumn("after", F.lit(False)).unionByName(after.withColumn("after", F.lit(True)))
    rows = rows.repartition(width(spark), "part").sortWithinPartitions(
        "part", "after", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_last())

    def pairs(batches):
        held, part, done = None, None, False
        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "part", "after")]
            for doc_id, own, after, text in zip(*cols, batch.column("text")):
                if own != part:
                    held, part, done = None, own, False
                if done:
                    continue
                row = prepare(doc_id, text.as_py())
                if held is not None:
                    out.append(fn(held, row))
                held, done = row, after
            cols = list(zip(*out)) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    names = [x.split()[0] for x in schema.split(", ")]
    return in_arrow(rows, pairs, schema)


def prepare(doc_id, text: str | None) -> tuple:
    text = text or ""
    return doc_id, text, chunk_set(text)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many (or all) of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit by the next document, and the containment between them.

    Returns doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next. Null text counts as
    empty. Repeated rows each give a row. An empty table gives none. Other columns are left out.
    """
    def row(own, following):
        doc_id, text, chunks = own
        changed = edited(text, following[1])
        other = chunk_set(changed)
        return (doc_id, len(text), changed, written(chunks), written(other), containment(chunks, other),
                containment(chunks, following[2]))

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return with_next(docs, row, schema, [to_arrow_type(docs.schema["doc_id"].dataType), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()])
