"""Operator 9: sources mixed to target weights by a min-cost flow from membership patterns to source quotas."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repledger.llm.common import in_arrow, stage, width

#: Times that a document may be taken; the k-th time costs 2 k - 1, so that the costs of k times add up to k squared.
MOST_TIMES = 3
#: About so many documents of a pattern meet in the group where its last, partial round is cut, and groups at most.
GROUP, MOST_GROUPS = 512, 1 << 20
SEED = 17


def weights_of(names: list[str | None], cycle: tuple[int, ...] = (5, 2, 1)) -> dict[str | None, int]:
    """Weights in turn over the sources by code point, null last."""
    ordered = sorted(names, key=lambda s: (s is None, s or ""))
    return {s: cycle[k % len(cycle)] for k, s in enumerate(ordered)}


def targets_of(sizes: dict, weights: dict, total: float | None = None, most: float = MOST_TIMES) -> dict:
    """Shares of `total` (all sizes, if none is given) by weight; what is above `most` times a source's size is shared
    anew among the others by weight, until none is above."""
    left = float(sum(sizes.values())) if total is None else total
    free, out = dict(weights), {}
    while free:
        share = left / sum(free.values())
        full = [s for s in free if free[s] * share > most * sizes[s]]
        if not full:
            return out | {s: w * share for s, w in free.items()}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            del free[s]
    return out


@dataclass
class Edge:
    to: int
    room: float
    cost: int
    back: int


def min_cost_flow(capacity: dict, quota: dict, most: int = MOST_TIMES) -> dict:
    """Tokens that each pattern, a tuple of sources, gives each of its sources: {(pattern, source): tokens}.

    A pattern can be taken `most` times over; each time is an edge of its own that costs more than the one before, so
    no pattern is repeated while another that serves the source is fresh. Shortest paths are found and filled one after
    the other (Dijkstra with potentials); the graph has one node for each pattern and source.
    """
    patterns, sources = sorted(capacity, key=str), sorted(quota, key=str)
    place = {p: k + 1 for k, p in enumerate(patterns)}
    end = {s: k + 1 + len(patterns) for k, s in enumerate(sources)}
    sink = len(patterns) + len(sources) + 1
    graph: list[list[Edge]] = [[] for _ in range(sink + 1)]

    def join(a: int, b: int, room: float, cost: int) -> Edge:
        graph[a].append(Edge(b, room, cost, len(graph[b])))
        graph[b].append(Edge(a, 0.0, -cost, len(graph[a]) - 1))
        return graph[a][-1]

    served = {}
    for p in patterns:
        for k in range(most):
            join(0, place[p], float(capacity[p]), 2 * k + 1)
        for s in p:
            if s in quota:
                served[p, s] = join(place[p], end[s], most * float(capacity[p]), 0), most * float(capacity[p])
    for s in sources:
        join(end[s], sink, float(quota[s]), 0)
    tiny = 1e-9 * (1 + sum(quota.values()))
    potential = [0] * (sink + 1)
    while True:
        far, came = [float("inf")] * (sink + 1), [(-1, -1)] * (sink + 1)
        far[0], heap = 0, [(0, 0)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for k, e in enumerate(graph[a]):
                new = d + e.cost + potential[a] - potential[e.to]
                if e.room > tiny and new < far[e.to]:
                    far[e.to], came[e.to] = new, (a, k)
                    heapq.heappush(heap, (new, e.to))
        if far[sink] == float("inf"):
            return {k: full - e.room for k, (e, full) in served.items() if full - e.room > tiny}
        potential = [p + min(f, far[sink]) for p, f in zip(potential, far)]
        path, b = [], sink
        while b:
            a, k = came[b]
            path.append(graph[a][k])
            b = a
        flow = min(e.room for e in path)
        for e in path:
            e.room -= flow
            graph[e.to][e.back].room += flow


def mix(docs: DataFrame, quota_of=None, seed: int = SEED, staged: bool = True) -> DataFrame:
    """What the mix takes of each row of (doc_id, sources, size): adds source_sizes, targets, times and taken.

    `sources` is the array of all sources that hold the document, sorted; `quota_of` gets the sizes of the sources and
    returns their targets (weights in turn, if none is given). Documents are summed by membership pattern, so the
    driver sees a row for each pattern, never for a document; the flow then says how many tokens each pattern gives.

    Every document of a pattern is taken as often as the pattern's tokens go into whole rounds. The last, partial round
    is taken in a seeded order: documents are dealt by hash to groups of about `GROUP`, whole groups are taken in
    order, and in the group where the round ends, each document is taken that still fits. A reader of that group alone
    sees its rows one by one. The same rows and seed give the same mix, however they are dealt out.

    A null size counts as 0, and null sources as a pattern of their own, of the source null. Documents of size 0 are
    taken as often as the whole rounds say, at 0 tokens. Repeated rows share one hash, each counts; an empty table
    gives no row. Other columns stay, but for those named above, which are replaced. With `staged` the rows are
    written once, as they are read three times; without it they are computed anew each time, which suits wide rows that
    already lie in a file.
    """
    quota_of = quota_of or (lambda sizes: targets_of(sizes, weights_of(list(sizes))))
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id",
        F.coalesce(F.col("size").cast("long"), F.lit(0).cast("long")).alias("size"),
        F.coalesce("sources", F.array(F.lit(None).cast("string"))).alias("sources"))
    rows = stage(rows, "mix") if staged else rows
    sums = rows.groupBy("sources").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    patterns = {tuple(r["sources"]): r for r in sums}
    sizes: dict = {}
    for p, r in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + r["size"]
    targets = quota_of(sizes) if sizes else {}
    flow = min_cost_flow({p: r["size"] for p, r in patterns.items() if r["size"]}, targets)
    given = {p: sum(v for (q, _), v in flow.items() if q == p) for p in patterns}
    plan = []
    for p, r in patterns.items():
        rounds = min(MOST_TIMES, int((given[p] + 1e-6) // r["size"])) if r["size"] else 0
        rest = max(0, round(given[p]) - rounds * r["size"]) if rounds < MOST_TIMES else 0
        plan.append((list(p), [sizes[s] for s in p], [float(targets[s]) for s in p], rounds, rest, min(MOST_GROUPS, -(-r["n"] // GROUP))))
    schema = ("sources array<string>, source_sizes array<long>, targets array<double>, rounds int, rest long, groups long")
    # One row for each pattern: what the driver has just solved the flow for.
    plan = spark.createDataFrame(plan, schema).withColumnRenamed("sources", "pattern")
    drawn = F.abs(F.xxhash64(F.lit(seed), "doc_id", "size") % (1 << 40))
    placed = rows.join(
        F.broadcast(plan), _same(F.col("sources"), F.col("pattern"))).withColumn("drawn", drawn).withColumn(
        "group", F.floor(F.col("drawn") * F.col("groups") / F.lit(1 << 40)))
    # Sums of the groups before each, by pattern: rows of groups, a few hundred times fewer than documents.
    groups = placed.where("rest > 0").groupBy("sources", "group").agg(F.sum("size").alias("group_size"))
    before = Window.partitionBy("sources").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("before", F.coalesce(F.sum("group_size").over(before), F.lit(0))).withColumnRenamed(
        "sources", "own").withColumnRenamed("group", "own_group")
    last = groups.join(F.broadcast(plan.select("pattern", "rest")), _same(F.col("own"), F.col("pattern"))).where(
        "before <= rest and before + group_size > rest").select("pattern", F.col("own_group").alias("cut"), "before")
    # One group for each pattern at most.
    cuts = placed.join(F.broadcast(last.withColumnRenamed("pattern", "last_of")), _same(F.col("sources"), F.col("last_of")),
                       "left").drop("last_of")
    whole = F.when((F.col("rest") > 0) & (F.col("cut").isNull() | (F.col("group") < F.col("cut"))), 1).otherwise(0)
    at_cut = (F.col("rest") > 0) & F.coalesce(F.col("group") == F.col("cut"), F.lit(False))
    decided = cuts.where(~at_cut).withColumn("more", whole)
    columns = decided.columns
    partial = cuts.where(at_cut).repartition(width(spark), "sources").sortWithinPartitions("sources", "drawn", "doc_id", "size")

    def fit(batches):
        of, left = object(), 0
        for batch in batches:
            more = []
            cols = [batch.column(c).to_pylist() for c in ("sources", "rest", "before", "size")]
            for sources, rest, before, size in zip(*cols):
                if sources != of:
                    of, left = sources, rest - before
                take = 0 < size <= left
                left -= size if take else 0
                more.append(int(take))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(more, pa.int32())], [*batch.schema.names, "more"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in partial.schema] + ["more int"]
    out = decided.unionByName(in_arrow(partial, fit, ", ".join(kinds)).select(*columns))
    times = (F.col("rounds") + F.col("more")).cast("int")
    new = {"size": F.col("size"), "sources": F.col("sources"), "source_sizes": F.col("source_sizes"),
           "targets": F.col("targets"), "times": times, "taken": F.col("size") * times}
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in new]
    return out.select(*kept, *[v.alias(k) for k, v in new.items()])


def _same(a, b):
    """Equality of arrays of sources that may hold null, as one key of a join."""
    return F.to_json(F.struct(a.alias("a"))) == F.to_json(F.struct(b.alias("a")))
