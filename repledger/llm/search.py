"""Operator 11: ranked lexical search; documents in FP-trees, each item searched depth first by branch and bound."""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repledger.llm.common import drop_stage, in_arrow, stage, strings, width

#: Hits of each item.
TOP = 10
#: Items are searched in blocks of about so many characters; a block's terms are all that is broadcast of it.
BLOCK_CHARS = 1 << 20
#: (document, term) entries of one tree; a task builds one tree after the other.
TREE_ENTRIES = 1 << 16
#: BM25 in integers: a document of mean length has m = 100, one without words would have 100 - LENGTH.
LENGTH, SATURATION = 75, 8
# A term is a run of ASCII letters, digits and characters beyond ASCII; A to Z count as a to z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_FOLD).split()


def length_factor(n: int, docs: int, length: int) -> int:
    """m of a document of n terms among `docs` documents of `length` terms in all."""
    return 100 - LENGTH + (LENGTH * n * docs) // length


def weight(docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holders + 1)))


def gain(tf: int, m: int) -> int:
    """What an occurrence count adds for each unit of weight; grows with tf and falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + SATURATION * m)


def _texts(column: pa.Array):
    for value in strings(column).cast(pa.large_binary()):
        yield value.as_py()


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of each document with a term: n terms in all, and those of the vocabulary by number."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(batches):
        number = known.value
        for batch in batches:
            ids, counts, found, times = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id"), _texts(batch.column("text"))):
                split = terms(text)
                if split:
                    held = Counter(map(number.get, split))
                    held.pop(None, None)
                    ids.append(doc_id.as_py())
                    counts.append(len(split))
                    found.append(list(held))
                    times.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.column("doc_id").type), pa.array(counts, pa.int64()),
                 pa.array(found, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))],
                ["doc_id", "n", "terms", "tfs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs.select("doc_id", "text"), rows, f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


def paths(held: DataFrame, rank: np.ndarray, docs: int, length: int) -> DataFrame:
    """(doc_id, m, path, tfs): a document's terms by rank, the most frequent first, with their counts in that order."""
    ranks = held.sparkSession.sparkContext.broadcast(rank)

    def rows(batches):
        for batch in batches:
            path, tfs = [], []
            for found, times in zip(batch.column("terms").to_pylist(), batch.column("tfs").to_pylist()):
                own = ranks.value[found]
                order = np.argsort(own)
                path.append(own[order])
                tfs.append(np.array(times, np.int32)[order])
            m = [length_factor(n, docs, length) for n in batch.column("n").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(m, pa.int64()), pa.array(path, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int32()))], ["doc_id", "m", "path", "tfs"])

    kind = held.schema["doc_id"].dataType.simpleString()
    return in_arrow(held, rows, f"doc_id {kind}, m long, path array<int>, tfs array<int>")


class Node:
    """A branch of the trie: what all documents below it can give at most, its branches, and the documents that end at it."""

    __slots__ = ("most", "least_m", "branches", "ends")

    def __init__(self):
        self.most: dict[int, int] = {}  # term to its highest count in the subtree
        self.least_m = 0
        self.branches: list[Node] = []
        self.ends: list[tuple] = []  # (doc_id, m, {term: count})


def tree(rows: list[tuple]) -> Node:
    """The FP-tree of (path, doc_id, m, tfs) in path order. A run of terms without a fork is one branch."""
    made: list[tuple[Node, Node | None]] = []  # each node with the one above it, which comes earlier
    todo: list[tuple] = [(0, len(rows), 0, None)]
    while todo:
        first, last, depth, above = todo.pop()
        node = Node()
        made.append((node, above))
        # Paths are sorted, so what the first and the last share, all between them share.
        low, high = rows[first][0], rows[last - 1][0]
        while depth < len(low) and depth < len(high) and low[depth] == high[depth]:
            depth += 1
        while first < last and len(rows[first][0]) == depth:
            path, doc_id, m, tfs = rows[first]
            node.ends.append((doc_id, m, dict(zip(path, tfs))))
            first += 1
        while first < last:
            term, end = rows[first][0][depth], first + 1
            while end < last and rows[end][0][depth] == term:
                end += 1
            todo.append((first, end, depth + 1, node))
            first = end
    for node, above in reversed(made):
        most = node.most
        for held in [*(tf for _, _, tf in node.ends), *(b.most for b in node.branches)]:
            for term, tf in held.items():
                if tf > most.get(term, 0):
                    most[term] = tf
        node.least_m = min([*(m for _, m, _ in node.ends), *(b.least_m for b in node.branches)])
        if above is not None:
            above.branches.append(node)
    return made[0][0]


class _Last:
    """Ids turned round, so that of equal scores the greatest id leaves a heap first; null is the greatest."""

    __slots__ = ("id",)

    def __init__(self, doc_id):
        self.id = doc_id

    def __lt__(self, other):
        if self.id is None or other.id is None:
            return self.id is None and other.id is not None
        return self.id > other.id


def search(root: Node, item: dict[int, int], best: list[tuple], top: int = TOP) -> None:
    """Take the documents below `root` into `best`, a heap of the `top` highest (score, id) so far, as far as bounds allow.

    A branch is left if even its highest counts and its least m stay below the lowest hit.
    """
    def score(held: dict[int, int], m: int) -> int:
        return sum(w * gain(held[t], m) for t, w in item.items() if t in held)

    todo = [(score(root.most, root.least_m), root)]
    while todo:
        bound, node = todo.pop()
        if bound <= 0 or len(best) == top and bound < best[0][0]:
            continue
        for doc_id, m, held in node.ends:
            hit = (score(held, m), _Last(doc_id))
            if hit[0] > 0:
                if len(best) < top:
                    heapq.heappush(best, hit)
                elif best[0] < hit:
                    heapq.heapreplace(best, hit)
        lower = [(score(b.most, b.least_m), b) for b in node.branches]
        lower.sort(key=lambda x: x[0])  # the most promising last, so it is taken next
        todo += lower


def hits(held: DataFrame, items: list[dict[int, int]], top: int = TOP) -> DataFrame:
    """(item, doc_id, score) of the `top` highest of each item in each partition of `paths`."""
    weights = held.sparkSession.sparkContext.broadcast(items)

    def rows(batches):
        best: list[list[tuple]] = [[] for _ in weights.value]

        def grow(own: list[tuple]) -> None:
            root = tree(own)
            for heap, item in zip(best, weights.value):
                search(root, item, heap, top)

        own, entries = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("path", "doc_id", "m", "tfs"))):
                own.append(row)
                entries += len(row[0])
                if entries >= TREE_ENTRIES:
                    grow(own)
                    own, entries = [], 0
        if own:
            grow(own)
        found = [(k, last.id, score) for k, heap in enumerate(best) for score, last in heap]
        item, ids, scores = zip(*found) if found else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, id_type), pa.array(scores, pa.int64())],
                                         ["item", "doc_id", "score"])

    kind = held.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(kind)
    return in_arrow(held.sortWithinPartitions("path"), rows, f"item int, doc_id {kind.simpleString()}, score long")


def highest(found: DataFrame, slots: int, top: int = TOP) -> DataFrame:
    """`rank` 1 to `top` of each item: first within slots of its hits, then of all, so no task takes every partition's hits."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(slots))
    some = found.withColumn("slot", slot).withColumn(
        "rank", F.row_number().over(Window.partitionBy("item", "slot").orderBy(*order))).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(
        F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The `top` highest-scoring documents of every item: item_id, rank, doc_id, score.

    `docs` has doc_id and text, `items` has item_id and text; other columns are left out. Null and empty texts have no
    terms: such documents count nowhere and such items get no row, like items whose terms no document holds. Every row
    of either table counts, also repeated ones; equal items get the same rows each. Equal scores go by ascending doc_id,
    a null id last; rows of one id are told apart by score only. An empty table gives no rows.

    Items are a stated query set and go in blocks of `block_chars`; each block passes over all documents once.
    """
    spark = docs.sparkSession
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    blocks = 1 + (items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for k in range(blocks):
        asked = items.where(block == k).collect()
        split = [Counter(terms(r.text.encode())) for r in asked]
        vocabulary = {t: j for j, t in enumerate(sorted(set().union(*split)))}
        held = stage(vectors(docs, vocabulary), "vectors")
        n, length = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        # One row for each term of the block at most.
        holders = dict(held.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        order = sorted(range(len(vocabulary)), key=lambda j: (-holders.get(j, 0), j))
        ranks = np.empty(len(order), np.int32)
        ranks[order] = np.arange(len(order), dtype=np.int32)
        weights = [{int(ranks[vocabulary[t]]): times * weight(n, holders[vocabulary[t]])
                    for t, times in item.items() if vocabulary[t] in holders} for item in split]
        found = hits(paths(held.where(F.size("terms") > 0), ranks, n, max(length, 1)), weights, top)
        found = stage(found, "hits")
        drop_stage(held)
        names = spark.createDataFrame([(j, r.item_id) for j, r in enumerate(asked)],
                                      f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        best = highest(found, width(spark), top).join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    return out


#: The whole search in SQL, over all documents and items.
SEARCH_SQL = r"""
with words as (select r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
               from (select row_number() over () as r, * from documents) where text is not null),
sizes as (select r, doc_id, len(t) as n from words where len(t) > 0),
total as (select count(*) as docs, sum(n)::bigint as length from sizes),
asked as (select item, item_id, term, count(*) as times
          from (select row_number() over () as item, item_id,
                       unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
          group by all),
held as (select r, term, count(*) as tf from (select r, unnest(t) as term from words)
         where term in (select term from asked) group by all),
weights as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
            from held, total group by term, docs),
scores as (select item, item_id, doc_id, r,
                  sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // length))))::bigint as score
           from asked join held using (term) join weights using (term) join sizes using (r), total
           group by all having score > 0)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item order by score desc, doc_id) as rank from scores) where rank <= 10"""
