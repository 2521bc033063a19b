"""Operator 2: repeated substrings of words by prefix-partitioned suffix trees.

The suffixes that enter a tree begin at anchors: of the 8-word grams in a window, the one with the least hash (the first,
if equal). Equal windows have equal anchors at equal places, so whatever repeats meets at an anchor's prefix. Prefixes
that occur once are dropped, equal suffixes are counted and sent once, and the rest are dealt to groups by their prefix;
a prefix with too many suffixes for one group is lengthened to the whole window. A group's trees, one of the words from
the anchor on and one of the words before it, are held as sorted suffixes with the lengths that neighbours share: the
runs that share at least a length are the internal nodes at that depth. A window repeats if the node of its words after
the anchor and the node of its words before it have two leaves in common.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repledger.llm.common import STEP, Words, drop_stage, in_arrow, in_small_batches, mix, stage, word_blocks

WINDOW, PREFIX = 35, 8
#: Suffixes of one prefix that form one group; with more, their prefixes are lengthened.
GROUP = 4096
#: Suffixes that a task sorts at once, in whole groups.
BLOCK = 1 << 15


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Where the least of each n consecutive values is; the first, if several are equal."""
    def join(v, i, w, j):
        less = w < v
        return np.where(less, w, v), np.where(less, j, i)

    m = len(values) - n + 1
    run, at, length = values, np.arange(len(values)), 1
    while 2 * length <= n:
        run, at = join(run[:-length], at[:-length], run[length:], at[length:])
        length *= 2
    rest = n - length
    return at[:m] if not rest else join(run[:m], at[:m], run[rest : rest + m], at[rest : rest + m])[1]


def anchors_of(words: Words, window: int, prefix: int):
    """Of the block's anchors: document, place among its words, words of its windows before it, windows, prefix hash,
    and hash of all words of its windows."""
    n = len(words.hashes)
    if n < window:
        return None
    doc = words.document_of()
    starts = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
    if not len(starts):
        return None
    grams, full = words.grams(prefix), words.grams(window)
    anchor = _least(grams, window - prefix + 1)[starts]
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (np.diff(starts) != 1)))
    last = np.append(first[1:], len(starts)) - 1
    at, low, count = anchor[first], starts[first], last - first + 1
    place = (at - low).astype(np.uint64) * np.uint64(64) + count.astype(np.uint64)
    # The first and the last window cover all words between, as there are fewer windows than words in one.
    whole = mix(full[low] * np.uint64(STEP) + full[starts[last]] + mix(place))
    return doc[at], at - words.bounds[doc[at]], at - low, count, grams[at], whole


def _anchor_rows(docs: DataFrame, window: int, prefix: int) -> DataFrame:
    def rows(batches):
        for batch in batches:
            rid = batch.column("rid").to_numpy()
            for words in word_blocks(batch.column("text")):
                found = anchors_of(words, window, prefix)
                if found is None:
                    continue
                doc, at, before, count, gram, whole = found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(rid[doc + words.first]),
                     pa.array(at.astype(np.int32)), pa.array(before.astype(np.int32)), pa.array(count.astype(np.int32))],
                    ["gram", "whole", "rid", "at", "before", "windows"])

    return in_arrow(docs.select("rid", "text"), rows, "gram long, whole long, rid long, at int, before int, windows int")


def _cutter(window: int, prefix: int):
    """(gram, whole, copies, before, windows, words) from batches: the text of an anchor's windows, cut from its document."""
    def rows(batches):
        for batch in batches:
            wanted = batch.column("wanted")
            for words in word_blocks(batch.column("text")):
                grams = words.grams(prefix)
                out = []
                for k in range(words.last - words.first):
                    base, end = words.bounds[k], words.bounds[k + 1]
                    for x in wanted[words.first + k].as_py():
                        a = base + x["at"]
                        if a + prefix > end or int(grams[a].view(np.int64)) != x["gram"]:
                            continue  # another document of the same 64-bit id
                        low = a - x["before"]
                        high = low + x["windows"] + window - 2
                        cut = words.data[words.starts[low] : words.ends[high]].tobytes()
                        out.append((x["gram"], x["whole"], x["copies"], x["before"], x["windows"], cut))
                cols = list(zip(*out)) if out else [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                names = ["gram", "whole", "copies", "before", "windows", "words"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    return rows


class Hashes(NamedTuple):
    """Hashes of the words of many rows: those of row k are bounds[k] to bounds[k + 1]."""

    hashes: np.ndarray
    bounds: np.ndarray


def hashes_of(column: pa.Array) -> Hashes:
    """Of all rows at once; their bytes are taken a block at a time, as each needs some forty bytes while it is hashed."""
    hashes, bounds = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for words in word_blocks(column):
        hashes.append(words.hashes)
        bounds.append(bounds[-1][-1] + words.bounds[1:])
    return Hashes(np.concatenate(hashes), np.concatenate(bounds))


def _shared(order: np.ndarray, words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in order; -1 at the start of a group."""
    a = words[order]
    differs = np.append(a[1:] != a[:-1], np.ones((len(a) - 1, 1), bool), axis=1)
    out = np.append(-1, differs.argmax(axis=1))
    out[1:][group[order][1:] != group[order][:-1]] = -1
    return out


def repeated_windows(words: Hashes, group: np.ndarray, before: np.ndarray, windows: np.ndarray, copies: np.ndarray,
                     window: int) -> np.ndarray:
    """Of each suffix, a bit for each of its windows, the first lowest, that says if it is found elsewhere.

    Row k of the block is one suffix with its windows' words; `copies` says for how many equal ones it stands.
    """
    n = len(group)
    base, end = words.bounds[:-1], words.bounds[1:]
    anchor = base + before
    steps = np.arange(window)
    unlike = mix(np.arange(n, dtype=np.uint64) + np.uint64(1 << 40))[:, None] + np.arange(window, dtype=np.uint64)

    def matrix(places: np.ndarray, inside: np.ndarray) -> np.ndarray:
        return np.where(inside, words.hashes[np.clip(places, 0, len(words.hashes) - 1)], unlike[:, : places.shape[1]])

    after = anchor[:, None] + steps
    after = matrix(after, after < end[:, None])
    back = anchor[:, None] - 1 - steps
    back = matrix(back, back >= base[:, None])
    trees = []
    for side in (after, back):
        order = np.lexsort([*side.T[::-1], group])
        trees.append((order, _shared(order, side, group)))
    out = np.zeros(n, np.int64)
    for offset in range(int(before.max(initial=0)) + 1):
        bit = before - offset  # the window that begins `offset` words before the anchor
        own = np.flatnonzero((bit >= 0) & (bit < windows))
        if not len(own):
            continue
        nodes = []
        for (order, shared), depth in zip(trees, (window - offset, offset)):
            node = np.empty(n, np.int64)
            node[order] = np.cumsum(shared < depth)
            nodes.append(node[own])
        _, leaf = np.unique(nodes[0] * (n + 1) + nodes[1], return_inverse=True)
        twice = np.bincount(leaf, copies[own])[leaf] > 1
        out[own[twice]] |= np.int64(1) << bit[own[twice]]
    return out


def _tree_rows(marked: DataFrame, window: int, prefix: int) -> DataFrame:
    """(gram, whole, mask) from the trees of each prefix, in blocks of whole groups."""
    suffixes = in_arrow(marked, _cutter(window, prefix), "gram long, whole long, copies long, before int, windows int, words binary")
    dealt = suffixes.repartition("gram").sortWithinPartitions("gram")

    def solve(batch: pa.RecordBatch):
        columns = (batch.column(c).to_numpy() for c in ("gram", "before", "windows", "copies"))
        masks = repeated_windows(hashes_of(batch.column("words")), *columns, window)
        return pa.RecordBatch.from_arrays([batch.column("gram"), batch.column("whole"), pa.array(masks)],
                                          ["gram", "whole", "mask"])

    def rows(batches):
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if len(held) >= BLOCK:
                gram = held.column("gram").to_numpy()
                cut = int(np.searchsorted(gram, gram[-1]))  # the last group may go on
                if cut:
                    yield solve(held.slice(0, cut).combine_chunks().to_batches()[0])
                    held = held.slice(cut)
        if held is not None and len(held):
            yield solve(held.combine_chunks().to_batches()[0])

    return in_arrow(dealt, rows, "gram long, whole long, mask long")


def _counted_rows(marked: DataFrame, window: int, prefix: int) -> DataFrame:
    """(gram, whole, mask) for prefixes lengthened to the window: a node at that depth needs its leaves counted only."""
    cut = _cutter(window, prefix)

    def rows(batches):
        # One after the other in one worker: as two steps of a plan, each task would keep two workers.
        for batch in cut(batches):
            for words in word_blocks(batch.column("words")):
                full = words.grams(window)
                windows = batch.column("windows").to_numpy()[words.first : words.last]
                row = np.repeat(np.arange(len(windows)), windows)
                bit = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
                pick = pa.array(row + words.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("gram").take(pick), batch.column("whole").take(pick), batch.column("copies").take(pick),
                     pa.array(full[words.bounds[row] + bit].view(np.int64)),
                     pa.array(bit.astype(np.int32))], ["gram", "whole", "copies", "full", "bit"])

    # Not stored: what reads the leaves runs with the trees, so all share the one shuffle of the texts.
    leaves = in_arrow(marked, rows, "gram long, whole long, copies long, full long, bit int")
    nodes = leaves.groupBy("full").agg(F.sum("copies").alias("n")).where("n > 1").select("full")
    found = leaves.join(nodes, "full", "left_semi")
    return found.groupBy("gram", "whole").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))


def repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """The rows of `docs` (with a column text), each with n_words, n_removed, spans and kept.

    A word goes if a window of `window` consecutive words of its document covers it whose words also begin anywhere else,
    in the same document or another; windows are judged on the input. spans are the runs of words that go (first, stop);
    kept are the other words, unchanged, joined by one space. A word is a run of other characters than ASCII white space.
    Words are compared by 64-bit hashes, whole windows of them at a time.

    Null text has no word and keeps none; a text shorter than a window keeps all. Repeated rows are repeats of each
    other. An empty table gives no row. All columns stay, but for those named above, which are replaced.
    """
    if not prefix <= window <= 64 or window - prefix + 1 > 63:
        raise ValueError("a window has at most 64 words, and at most 62 more than its prefix")
    in_small_batches(docs.sparkSession)
    new = ("n_words", "n_removed", "spans", "kept")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (*new, "text")]
    rows = docs.select(F.xxhash64(*([F.col("doc_id")] if "doc_id" in docs.columns else []), "text").alias("rid"), "text",
                       F.struct(*rest).alias("rest"))
    anchors = stage(_anchor_rows(rows, window, prefix), "anchors")
    grams = stage(anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "grams")
    found = stage(anchors.join(grams, "gram", "left_semi"), "repeated")
    drop_stage(anchors)
    drop_stage(grams)
    # Equal suffixes are summed before they are shuffled; one of them stands for all.
    kinds = found.groupBy("gram", "whole").agg(
        F.count("*").alias("copies"), F.min(F.struct("rid", "at")).alias("one"), F.first("before").alias("before"),
        F.first("windows").alias("windows"))
    kinds = stage(kinds, "kinds")
    sizes = kinds.groupBy("gram").agg(F.count("*").alias("n_kinds")).where("n_kinds > 1")
    sizes = sizes.select("gram", (F.col("n_kinds") > group).alias("large"))
    sizes = stage(sizes, "sizes")
    several = stage(kinds.join(sizes, "gram"), "several")
    drop_stage(sizes)
    outcome = []
    for large, solve in ((False, _tree_rows), (True, _counted_rows)):
        part = several.where(F.col("large") if large else ~F.col("large"))
        if large and part.isEmpty():
            continue
        wanted = part.groupBy(F.col("one.rid").alias("rid")).agg(F.collect_list(F.struct(
            "gram", "whole", "copies", F.col("one.at").alias("at"), "before", "windows")).alias("wanted"))
        # What is wanted grows with the corpus, so it is never sent whole to every task.
        outcome.append(solve(rows.join(wanted.hint("merge"), "rid"), window, prefix))
    masks = outcome[0] if len(outcome) == 1 else outcome[0].unionByName(outcome[1])
    # A suffix with copies repeats in all its windows, with or without a tree.
    every = F.expr("shiftleft(1L, windows) - 1")
    masks = masks.where("mask <> 0").groupBy("gram", "whole").agg(F.expr("bit_or(mask)").alias("mask"))
    copied = kinds.where("copies > 1").select("gram", "whole", every.alias("mask"))
    known = kinds.where("copies = 1").select("gram", "whole").join(masks, ["gram", "whole"])
    hits = found.join(copied.unionByName(known), ["gram", "whole"])
    removed = hits.groupBy("rid").agg(F.collect_set(F.struct((F.col("at") - F.col("before")).alias("first"), "mask")).alias("marks"))
    return _kept(rows.join(removed.hint("merge"), "rid", "left"), docs, rest, window)


def _kept(marked: DataFrame, docs: DataFrame, rest: list, window: int) -> DataFrame:
    def rows(batches):
        for batch in batches:
            marks = batch.column("marks")
            for words in word_blocks(batch.column("text")):
                n_words, n_removed, spans, kept = [], [], [], []
                data = words.data.tobytes()
                for k in range(words.last - words.first):
                    own = words.of(k)
                    n = own.stop - own.start
                    starts, ends = words.starts[own], words.ends[own]
                    cover = np.zeros(n + 1, np.int64)
                    for x in marks[words.first + k].as_py() or ():
                        bits = np.array([b for b in range(x["mask"].bit_length()) if x["mask"] >> b & 1])
                        np.add.at(cover, x["first"] + bits, 1)
                        np.add.at(cover, x["first"] + bits + window, -1)
                    gone = np.cumsum(cover[:n]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                    n_words.append(n)
                    n_removed.append(int(gone.sum()))
                    spans.append([{"first": int(a), "stop": int(b)} for a, b in edges.reshape(-1, 2)])
                    stay = np.flatnonzero(~gone)
                    kept.append(b" ".join([data[a:b] for a, b in zip(starts[stay].tolist(), ends[stay].tolist())]))
                # A block at a time: the kept words of a whole batch would lie beside its texts.
                own = slice(words.first, words.last)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("text")[own], batch.column("rest")[own], pa.array(n_words, pa.int64()),
                     pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(SPAN)),
                     pa.array(kept, pa.binary()).cast(pa.string())],
                    ["text", "rest", "n_words", "n_removed", "spans", "kept"])

    kind = marked.schema["rest"].dataType.simpleString()
    schema = f"text string, rest {kind}, n_words long, n_removed long, spans array<struct<first:int,stop:int>>, kept string"
    out = in_arrow(marked.select("text", "rest", "marks"), rows, schema)
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "spans", "kept")]
    return out.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in names], "n_words", "n_removed",
                      "spans", "kept")


SPAN = pa.struct([("first", pa.int32()), ("stop", pa.int32())])
