"""Operator 13: tokens of two tokenizers over the same bytes, grouped by pointer jumping, and how often their ids meet."""

from __future__ import annotations

import functools
import hashlib
import json
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repledger.llm.common import drop_stage, in_arrow, stage
from repledger.llm.tokens import BYTE_CHARACTERS

#: Pairs held by at least one in FREQUENT of all (document, pair) links go to the workers, FREQUENT of them at most.
FREQUENT = 1 << 20
#: Words remembered by a worker; beyond it the memory starts anew, which changes no result.
REMEMBERED = 500_000
SPACE = "▁"
# Fixed value: how a byte-level tokenizer of this kind splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """Ids by a byte-level BPE file of the `tokenizers` library whose ids are the ranks of its merges."""

    def __init__(self, path: str):
        import tiktoken

        byte_of = {BYTE_CHARACTERS.get(b, chr(b)): b for b in range(256)}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if i not in special}
        self.encoding = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.bytes = [b""] * self.size
        for b, i in ranks.items():
            self.bytes[i] = b
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.joined = np.array(self.bytes, object)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; strings of special tokens are plain text."""
        return np.array(self.encoding.encode_ordinary(text), np.int64)


class Pieces:
    """Ids by a sentencepiece file that adds a space in front and has no piece with a space after another character.

    Such a tokenizer gives a text the ids of its words, each with the spaces before it, so a worker remembers words.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError(f"{path}: a piece goes over a space")
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
                      for i, p in enumerate(pieces)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        #: Ids of a run of spaces and the word after it, if any, by the word if there is one space; False if bytes differ.
        self.words: dict[str, bytes | bool] = {}

    def _learn(self, runs: list[str]) -> None:
        """Remember the ids of words, each with the one space before it left out, and of other runs."""
        if len(self.words) + len(runs) > REMEMBERED:
            self.words.clear()
        # Alone, spaces at the end of a text would get another one in front.
        ends = len(self.model.encode("a"))
        found = self.model.encode([r.removeprefix(" ") if r.strip(" ") else "a" + r for r in runs], num_threads=1)
        for run, ids in zip(runs, found):
            if not run.strip(" "):
                ids = ids[ends:]
            spaced = run if run[0] == " " else " " + run
            same = b"".join([self.bytes[i] for i in ids]) == spaced.encode()
            self.words[run] = same and array("i", ids).tobytes()

    def encode(self, text: str) -> np.ndarray | None:
        """Ids of `text` with a space in front; None if their bytes are others."""
        if SPACE in text:
            return None  # it would come back as a space
        split = text.split(" ")
        if not all(split):  # other than one space before each word
            runs, spaces = [], 1
            for word in split:
                if word:
                    runs.append(word if spaces == 1 else " " * spaces + word)
                    spaces = 1
                else:
                    spaces += 1
            split = runs + ([" " * (spaces - 1)] if spaces > 1 else [])
        found = list(map(self.words.get, split))
        if None in found:
            self._learn(list({w for w, ids in zip(split, found) if ids is None}))
            found = [self.words[w] if ids is None else ids for w, ids in zip(split, found)]
        if False in found:
            return None
        return np.frombuffer(b"".join(found), np.int32).astype(np.int64)


@functools.cache
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@functools.cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A and of B the last token that it reaches over overlaps, as the byte where that one ends.

    Both lists of ends must close at the same byte. Nodes are the tokens of A, then those of B. Each points to the
    farthest-right token that overlaps it: the other side's token that holds its last byte, or itself if that one ends no
    later. Pointers are doubled until none moves: each then holds the component's last token.
    """
    n_a = len(ends_a)
    ends = np.concatenate([ends_a, ends_b])
    over_a = n_a + np.searchsorted(ends_b, ends_a)  # the token of B that holds the last byte of each token of A
    over_b = np.searchsorted(ends_a, ends_b)
    to = np.concatenate([over_a, over_b])
    own = np.arange(len(ends))
    to = np.where(ends[to] > ends, to, own)
    # Where both end together, the token of B is the terminal of both.
    closed = ends[over_a] == ends_a
    to[:n_a][closed] = over_a[closed]
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return ends[to[:n_a]], ends[to[n_a:]]
        to = further


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token of A, token of B) of every two whose byte ranges overlap: one for each stretch between two ends of either."""
    ends = np.concatenate([ends_a, ends_b])
    ends.sort(kind="stable")  # two ascending runs are merged
    ends = ends[np.append(ends[1:] != ends[:-1], True)]
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


@functools.cache
def _written(size_a: int, size_b: int) -> np.ndarray:
    """Texts of ids with what follows them: A's inside a group and at its end, then B's."""
    out = [str(i).encode() + after for size, last in ((size_a, b"|"), (size_b, b";")) for after in (b",", last)
           for i in range(size)]
    return np.array(out, object)


def group_text(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, size_a: int, size_b: int) -> bytes:
    """`a1,a2|b1;a3|b2,b3`: the ids of each group, given ascending labels of groups for both sides."""
    last_a, last_b = np.append(of_a[1:] != of_a[:-1], True), np.append(of_b[1:] != of_b[:-1], True)
    out = np.empty(len(a) + len(b), np.int64)
    at_a = np.arange(len(a)) + np.searchsorted(of_b, of_a)  # tokens of B in earlier groups
    at_b = np.arange(len(b)) + np.searchsorted(of_a, of_b, "right")
    out[at_a] = a + size_a * last_a
    out[at_b] = b + 2 * size_a + size_b * last_b
    return b"".join(_written(size_a, size_b)[out].tolist())[:-1]


class Aligned:
    """Both encodings of one text, the groups of their tokens and the pairs of ids that overlap."""

    def __init__(self, text: str | None, a: ByteLevel, b: Pieces):
        self.a = self.b = self.of_a = self.of_b = self.pair = self.times = np.zeros(0, np.int64)
        self.n_groups = 0
        self.sizes = a.size, b.size
        ids_b = b.encode(text) if text else None
        if ids_b is None:
            return
        ids_a = a.encode(" " + text)
        ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
        data = (" " + text).encode()
        # The pieces' bytes were compared word by word; the other side's are compared here, whole.
        if ends_a[-1] != len(data) or ends_b[-1] != len(data) or b"".join(a.joined[ids_a]) != data:
            return
        self.a, self.b = ids_a, ids_b
        self.of_a, self.of_b = terminals(ends_a, ends_b)
        self.n_groups = 1 + int((self.of_a[1:] != self.of_a[:-1]).sum())
        at_a, at_b = links(ends_a, ends_b)
        self.pair, self.times = np.unique(ids_a[at_a] * b.size + ids_b[at_b], return_counts=True)

    def digest(self) -> str:
        if not len(self.a):
            return ""
        return hashlib.sha256(group_text(self.a, self.b, self.of_a, self.of_b, *self.sizes)).hexdigest()


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row, in one pass over the texts."""
    def rows(batches):
        a, b = byte_level(path_a), pieces(path_b)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            found = []
            for text in batch.column("text"):
                x = Aligned(text.as_py(), a, b)
                found.append((len(x.a), len(x.b), x.n_groups, int(x.times.sum()), x.digest(), x.pair, x.times))
                if len(found) == 512:
                    yield sent(batch.column("doc_id"), row, found)
            if found:
                yield sent(batch.column("doc_id"), row, found)
            row += len(batch)
            done[0] = 0

    done = [0]  # rows of the batch that were sent

    def sent(ids, row, found):
        first = done[0]
        done[0] += len(found)
        n_a, n_b, n_groups, n_links, digest, pair, times = zip(*found)
        found.clear()
        offsets = pa.array(np.cumsum([0, *map(len, pair)]), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(row + np.arange(first, done[0])), ids.slice(first, len(n_a)),
             *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)), pa.array(digest, pa.string()),
             pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(pair))),
             pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times), pa.int32()))],
            ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs.select("doc_id", "text"), rows, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
                                                         "groups_sha256 string, pairs array<bigint>, times array<int>")


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """(pair, count, best): documents that hold each pair linked, and whether no pair of its A id is held by more."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    counts = stage(counts.withColumn("a", (F.col("pair") - F.col("pair") % size_b) / size_b).withColumn("a", F.col("a").cast("int")), "pairs")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))  # as many rows as A has ids, at most
    return counts.join(F.broadcast(most), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT) -> DataFrame:
    """Alignment of every row's two encodings: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level BPE file and gets a space and the text, B a sentencepiece file, which adds the space. Null and empty
    texts, and those whose bytes come back otherwise from either, have zeros and an empty digest; they hold no pair.
    Repeated rows count as documents of their own and each give a row. An empty table gives none. Other columns are left out.

    Pairs that many documents hold are counted off in the tasks that hold the documents, by a table of `frequent` rows at
    most; a pair of the rest is in fewer than one in `frequent` of all links, so no task of the join gets many of one.
    """
    spark = docs.sparkSession
    found = stage(aligned(docs, path_a, path_b), "aligned")
    counts = stage(pair_counts(found, pieces(path_b).size), "counts")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    often = counts.where(F.col("count") * frequent >= total).toArrow()
    key, count, best = (often[c].to_numpy() for c in ("pair", "count", "best"))
    sort = np.argsort(key)
    table = spark.sparkContext.broadcast((key[sort], count[sort], best[sort]))
    fields = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def rows(batches):
        key, count, best = table.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            offsets = pairs.offsets.to_numpy()
            sizes = np.diff(offsets)
            of = np.repeat(np.arange(len(batch)), sizes)
            pair, n = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(key, pair)
            at[at == len(key)] = 0
            hit = key[at] == pair if len(key) else np.zeros(len(pair), bool)
            own = n[hit]
            n_best = np.bincount(of[hit], own * best[at[hit]] if len(key) else own, len(batch)).astype(np.int64)
            sums = np.zeros(len(batch), np.int64)
            np.add.at(sums, of[hit], own * count[at[hit]] if len(key) else own)
            rest = ~hit
            offsets = pa.array(np.append(0, np.cumsum(np.bincount(of[rest], minlength=len(batch)))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in fields), pa.array(n_best), pa.array(sums),
                 pa.ListArray.from_arrays(offsets, pa.array(pair[rest])), pa.ListArray.from_arrays(offsets, pa.array(n[rest]))],
                [*fields, "n_best", "count_sum", "rare", "n"])

    kind = found.schema["doc_id"].dataType.simpleString()
    seen = stage(in_arrow(found, rows, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                       "n_best long, count_sum long, rare array<bigint>, n array<bigint>"), "linked")
    drop_stage(found)
    rare = seen.select("row", F.explode(F.arrays_zip("rare", "n")).alias("x")).select("row", F.col("x.rare").alias("pair"), "x.n")
    rare = rare.join(counts.where(F.col("count") * frequent < total), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("count")).alias("more"))
    return seen.join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")
