"""Operator 7: concatenate and cut, with offsets from prefix sums over the token totals of partitions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repledger.llm.common import in_arrow, stage
from repledger.llm.tokens import encoder, texts

ID_TYPES = {2: "<u2", 4: "<u4"}
#: Bytes of ids in one Arrow batch that is handed back.
BATCH_BYTES = 4 << 20


def token_rows(docs: DataFrame, path: str, end_id: int, words_apart: bool) -> DataFrame:
    """(doc_id, part, at, n, ids) of every row, staged; `at` counts the part's ids before the row.

    A part is a partition of the read, so no row is shuffled. ids are 2 or 4 bytes each, the least that holds the
    vocabulary, as `id_bytes` says.
    """
    def rows(batches):
        enc = encoder(path, words_apart)
        kind = "<u2" if enc.size <= 1 << 16 and end_id < 1 << 16 else "<u4"
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            held, size = [], 0
            ids_of = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids_of, texts(batch.column("text"))):
                ids = np.append(enc.encode(text), np.uint32(end_id)).astype(kind)
                held.append((doc_id, part, at, len(ids), ids.itemsize, ids.tobytes()))
                at, size = at + len(ids), size + ids.nbytes
                if size >= BATCH_BYTES:
                    yield _batch(held, batch.schema.field("doc_id").type)
                    held, size = [], 0
            yield _batch(held, batch.schema.field("doc_id").type)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, part int, at long, n long, id_bytes int, ids binary"
    return stage(in_arrow(docs.select("doc_id", "text"), rows, schema, remembers=True), "tokens")


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 6
    types = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = ["doc_id", "part", "at", "n", "id_bytes", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def part_bases(parts: DataFrame) -> DataFrame:
    """(part, base): the ids of all parts before each, from (part, total); one row for each partition."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def pack(docs: DataFrame, path: str, end_id: int = 2, length: int = 4096, words_apart: bool = True) -> DataFrame:
    """Lay the ids of all documents end to end and cut the line into sequences of `length`.

    Two passes: the first encodes each text once, adds `end_id` and keeps the ids beside their place in their
    partition; totals of the partitions then give each partition its place in the line. The second cuts. A document
    that crosses a window's edge has a record on either side. Only the last sequence is not full.

    Returns a row for each piece: doc_id, start (ids of its document before it), length, ids (binary, unsigned 32 bit,
    little-endian), doc_tokens, sequence_id, offset. Null text counts as empty and gives the end id alone; rows that
    share a doc_id, or have a null one, are packed each for itself; an empty table gives no row. Other columns are
    left out, so their names can't clash.
    """
    rows = token_rows(docs, path, end_id, words_apart)
    totals = rows.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("total"))
    # One row of 12 bytes for each partition of the read, however large the partitions are.
    placed = rows.join(F.broadcast(part_bases(totals)), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("at"), "n", "id_bytes", "ids")

    def cut(batches):
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            held, size = [], 0
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "at", "n", "id_bytes")]
            for doc_id, at, n, width, ids in zip(*cols, batch.column("ids")):
                ids = np.frombuffer(ids.as_py(), ID_TYPES[width]).astype("<u4")
                edges = [0, *range(length - at % length, n, length), n]
                for a, b in zip(edges, edges[1:]):
                    held.append((doc_id, a, b - a, ids[a:b].tobytes(), n, (at + a) // length, (at + a) % length))
                    size += 4 * (b - a)
                    if size >= BATCH_BYTES:
                        yield _pieces(held, kind)
                        held, size = [], 0
            yield _pieces(held, kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return in_arrow(placed, cut, schema, remembers=True)


def _pieces(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 7
    types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
