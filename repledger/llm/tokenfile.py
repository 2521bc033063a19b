"""Operator 10: token ids in fixed-width bit packing, in blocks with offsets, read back by numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repledger.llm.common import in_arrow
from repledger.llm.packing import BATCH_BYTES, part_bases
from repledger.llm.tokens import encoder, texts

#: Ids of a block: it ends with the document that reaches this. 8 divides it, so slices of it end on whole bytes.
BLOCK_IDS = 1 << 16


def bits_for(vocabulary: int) -> int:
    """The least bits that hold ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other in `bits` bits each, most significant first; zero bits fill the last byte."""
    if bits in (8, 16, 32):  # whole bytes are the ids themselves
        return ids.astype(f">u{bits // 8}").tobytes()
    out = []
    for k in range(0, len(ids), BLOCK_IDS):
        wide = np.unpackbits(ids[k : k + BLOCK_IDS].astype(">u4").view(np.uint8)).reshape(-1, 32)
        out.append(np.packbits(wide[:, 32 - bits :]).tobytes())
    return b"".join(out)


def unpack_bits(data: bytes, bits: int, first: int, n: int) -> np.ndarray:
    """n ids from id `first` on; only the bytes that hold them are touched."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n, first * bits // 8).astype("<u4")
    out = []
    for k in range(first, first + n, BLOCK_IDS):
        m = min(BLOCK_IDS, first + n - k)
        low, skip = divmod(k * bits, 8)
        high = -(-(k + m) * bits // 8)
        flat = np.unpackbits(np.frombuffer(data, np.uint8, high - low, low))[skip : skip + m * bits]
        wide = np.zeros((m, 32), np.uint8)
        wide[:, 32 - bits :] = flat.reshape(m, bits)
        out.append(np.packbits(wide).view(">u4").astype("<u4"))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = 1, words_apart: bool = True) -> None:
    """Encode every text, add `end_id`, and write the ids to `folder` in ascending doc_id order.

    `folder/blocks` has one row for each block: shard, block, bits, start (ids of the shard before it), n_ids, the
    ids and lengths of its documents, and the packed ids. A block ends with a document, so a document lies in one.
    `folder/index` has (part, base): the ids before each shard. Shards are ranges of doc_id, and each is written by one
    task through Spark, so a lost executor costs its tasks only.

    Null ids come first; rows of one doc_id are ordered by text; null text counts as empty. An empty table gives empty
    files. Other columns are left out.
    """
    def blocks(batches):
        enc = encoder(path, words_apart)
        bits = bits_for(max(enc.size, end_id + 1))
        part, number, start, ids_of, sizes, ids = TaskContext.get().partitionId(), 0, 0, [], [], []
        held = 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
                own = np.append(enc.encode(text), np.uint32(end_id))
                ids_of.append(doc_id)
                sizes.append(len(own))
                ids.append(own)
                held += len(own)
                if held >= BLOCK_IDS:
                    yield _block(part, number, bits, start, ids_of, sizes, ids, kind)
                    number, start = number + 1, start + held
                    ids_of, sizes, ids, held = [], [], [], 0
        if held:
            yield _block(part, number, bits, start, ids_of, sizes, ids, kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = f"shard int, block int, bits int, start long, n_ids long, doc_ids array<{kind}>, sizes array<long>, ids binary"
    in_arrow(ordered, blocks, schema, remembers=True).write.parquet(f"{folder}/blocks")
    spark = docs.sparkSession
    totals = spark.read.parquet(f"{folder}/blocks").groupBy(F.col("shard").alias("part")).agg(F.sum("n_ids").alias("total"))
    part_bases(totals).write.parquet(f"{folder}/index")


def _block(part, number, bits, start, ids_of, sizes, ids, kind) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    cols = [([part], pa.int32()), ([number], pa.int32()), ([bits], pa.int32()), ([start], pa.int64()),
            ([len(flat)], pa.int64()), ([ids_of], pa.list_(kind)), ([sizes], pa.list_(pa.int64())),
            ([pack_bits(flat, bits)], pa.binary())]
    names = ["shard", "block", "bits", "start", "n_ids", "doc_ids", "sizes", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in cols], names)


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks with their place among all ids; the index has one row for each shard, so it is small enough to send."""
    index = spark.read.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/blocks").join(F.broadcast(index), F.col("shard") == F.col("part")).withColumn(
        "start", F.col("start") + F.col("base")).drop("part", "base")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document: doc_id, start (ids of all documents before it), n_tokens, ids (unsigned 32 bit)."""
    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at, held, size = 0, [], 0
                kind = batch.schema.field("doc_ids").type.value_type
                for doc_id, n in zip(row["doc_ids"], row["sizes"]):
                    held.append((doc_id, row["start"] + at, n, unpack_bits(row["ids"], row["bits"], at, n).tobytes()))
                    at, size = at + n, size + 4 * n
                    if size >= BATCH_BYTES:
                        yield _documents(held, kind)
                        held, size = [], 0
                yield _documents(held, kind)

    blocks = _blocks(spark, folder)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return in_arrow(blocks.select("start", "bits", "doc_ids", "sizes", "ids"), documents,
                    f"doc_id {kind}, start long, n_tokens long, ids binary", remembers=True)


def _documents(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 4
    types = [kind, pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "start", "n_tokens", "ids"])


def read_range(spark: SparkSession, folder: str, start: int, n: int) -> DataFrame:
    """(start, ids) of the blocks' parts that lie in ids start to start + n; other blocks' payloads are not unpacked."""
    low, high = F.lit(start), F.lit(start + n)
    cut = _blocks(spark, folder).where((F.col("start") < high) & (F.col("start") + F.col("n_ids") > low))

    def slices(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a, b = max(start, row["start"]), min(start + n, row["start"] + row["n_ids"])
                ids = unpack_bits(row["ids"], row["bits"], a - row["start"], b - a).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int64()), pa.array([ids], pa.binary())], ["start", "ids"])

    return in_arrow(cut.select("start", "bits", "n_ids", "ids"), slices, "start long, ids binary", remembers=True)
