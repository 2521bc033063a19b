"""Operator 12: language-model scores from a log-frequency Bloom filter of n-gram counts.

`fit` broadcasts the filter to the workers, for texts of any kind. `fit_and_score` scores the texts it learns from, and
others beside them: the filter grows with the corpus, so its parts stay where they are built and are asked there.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repledger.llm.common import drop_stage, in_arrow, mix, stage, strings, width, word_blocks

#: Counts are kept as levels: level j stands for the whole numbers from GROWTH ** (j - 1) up to below GROWTH ** j.
GROWTH = 1.5
#: Tokens of at least one in FREQUENT training tokens go to the workers with their exact counts, FREQUENT of them at most.
FREQUENT = 1 << 22
#: Bits of the filter for each event (an n-gram at one level), and how many bits of one 64-bit word an event sets.
BITS, SET = 14, 5
#: Additive smoothing of the single token.
ALPHA = 0.1
#: Strengths of the lower order, of which the one is taken that predicts the training texts best, each token left out.
STRENGTHS = (1.0, 8.0, 64.0, 512.0, 4096.0)
#: n-grams that a task counts before it sends what it has.
FLUSH = 1 << 22
#: Bytes of text whose n-grams are asked for together, each once.
SHEAF = 1 << 23
_LOG10_E = math.log10(math.e)
END = np.uint64(0x2545F4914F6CDD1D)
_SALTS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_TURN = np.uint64(0xD6E8FEB86659FD93)
_TAIL = 40
_TAIL_MASK = np.uint64((1 << _TAIL) - 1)


def held_out(column: str = "doc_id") -> Column:
    """True for one id in ten, by crc32 of its text; false for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def learnt(column: str = "doc_id") -> Column:
    """True for documents the model learns from; a null id is neither learnt from nor held out."""
    return F.col(column).isNotNull() & ~held_out(column)


class Tokens:
    """Tokens of some documents, an end after each: 64-bit hashes, and where each document starts."""

    def __init__(self, words):
        ends = words.bounds[1:]
        self.hashes = np.insert(words.hashes, ends, END)
        self.bounds = words.bounds + np.arange(len(words.bounds))
        self.first, self.last = words.first, words.last
        self.new = np.zeros(len(self.hashes) + 1, bool)  # a document starts here
        self.new[self.bounds] = True

    @functools.cached_property
    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The different tokens, and which of them each one is."""
        return np.unique(self.hashes, return_inverse=True)

    def keys(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of the last token, key) of every n-gram of `order` tokens within one document."""
        n, h = len(self.hashes), self.hashes
        key = h[: max(0, n - order + 1)] ^ _SALTS[order - 1]
        fits = np.ones(len(key), bool)
        for k in range(1, order):
            key = mix(key) * _TURN + h[k : k + len(key)]
            fits &= ~self.new[k : k + len(key)]
        place = np.flatnonzero(fits)
        return place + order - 1, mix(key[place])


def token_blocks(column: pa.Array) -> Iterator[Tokens]:
    for words in word_blocks(column, lower=True):
        yield Tokens(words)


def count_tokens(docs: DataFrame) -> DataFrame:
    """(token, n) of all texts: how often each token, by hash, occurs."""
    def rows(batches):
        def send():
            token, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], ["token", "n"])

        held, size = [], 0
        for batch in batches:
            for tokens in token_blocks(batch.column("text")):
                held.append(tokens.hashes)
                size += len(tokens.hashes)
                if size >= FLUSH:
                    yield send()
                    held, size = [], 0
        if size:
            yield send()

    return in_arrow(docs.select("text"), rows, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _cut(key: np.ndarray, part_bits: int) -> np.ndarray:
    """What is used of a key: its part and its tail."""
    return key >> np.uint64(64 - part_bits - _TAIL)


def _packed(key: np.ndarray, part_bits: int, asked: np.ndarray | None = None) -> Iterator[tuple[int, bytes, bytes]]:
    """(part, tails, counts) of n-gram keys: the first bits are the part, the next 40 the tail of five bytes.

    A count below 255 takes a byte; greater ones follow in eight bytes each. Keys that are only `asked` for count 0.
    """
    key, n = np.unique(_cut(key, part_bits), return_counts=True)
    if asked is not None:
        asked = np.unique(_cut(asked, part_bits))
        at = np.searchsorted(key, asked)
        absent = np.append(key, 0)[at] != asked
        absent |= at == len(key)
        key, n = np.insert(key, at[absent], asked[absent]), np.insert(n, at[absent], 0)
    part = (key >> np.uint64(_TAIL)).astype(np.int64)
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for first, last in zip(starts, np.append(starts[1:], len(key))):
        tails = (key[first:last] & _TAIL_MASK).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
        own = n[first:last]
        yield int(part[first]), tails, np.minimum(own, 255).astype(np.uint8).tobytes() + own[own >= 255].astype("<u8").tobytes()


def _unpacked(tails: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(tails, np.uint8).reshape(-1, 5)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw
    n = np.frombuffer(counts[: len(raw)], np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(counts[len(raw) :], "<u8")
    return wide.view("<u8").ravel(), n


def levels(n: np.ndarray) -> np.ndarray:
    """Level of each whole count from 1 on."""
    top = int(n.max(initial=1))
    steps = [math.ceil(GROWTH**j) for j in range(1 + math.ceil(math.log(top + 1, GROWTH)))]
    return np.searchsorted(steps, n, "right")


def level_counts(most: int, least: int) -> np.ndarray:
    """The count that each level, from none on, stands for: the middle of its whole numbers, of `least` n-grams each."""
    steps = [math.ceil(GROWTH**j) for j in range(most + 1)]
    middle = [(a + b - 1) / 2 for a, b in zip(steps, steps[1:])]
    return np.array([0.0] + [x * least + (least - 1) / 2 for x in middle])


def _event(tail: np.ndarray, level: np.ndarray | int, words: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """(word, bits of it) of the event that an n-gram reaches a level, in a part of so many 64-bit words."""
    x = mix((tail << np.uint64(8)) + np.asarray(level, np.uint64))
    bits = np.uint64(1) << (x & np.uint64(63))
    for k in range(1, SET):
        bits |= np.uint64(1) << (x >> np.uint64(6 * k) & np.uint64(63))
    return (x >> np.uint64(32)) * np.asarray(words, np.uint64) >> np.uint64(32), bits


def part_words(tail: np.ndarray, level: np.ndarray) -> np.ndarray:
    """One part of the filter: the events of its n-grams up to their levels, in 64-bit words."""
    out = np.zeros(max(1, -(-int(level.sum()) * BITS // 64)), np.uint64)
    for j in range(1, int(level.max(initial=0)) + 1):
        word, bits = _event(tail[level >= j], j, len(out))
        np.bitwise_or.at(out, word.astype(np.int64), bits)
    return out


def found_levels(words: np.ndarray, tail: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Highest level found for each tail, in its part of so many of the words; asks for level after level until one is not there."""
    out = np.zeros(len(tail), np.int64)
    alive, j = np.flatnonzero(size), 1
    while len(alive):
        word, bits = _event(tail[alive], j, size[alive])
        alive = alive[words[(start[alive] + word).astype(np.int64)] & bits == bits]
        out[alive] = j
        j += 1
    return out


class Filter:
    """The parts one after the other."""

    def __init__(self, parts: dict[int, np.ndarray], bits: int):
        self.bits = bits
        self.start = np.zeros(1 << bits, np.uint64)
        self.size = np.zeros(1 << bits, np.uint64)
        at = 0
        for part in sorted(parts):
            self.start[part], self.size[part] = at, len(parts[part])
            at += len(parts[part])
        self.words = np.concatenate([parts[p] for p in sorted(parts)]) if parts else np.zeros(0, np.uint64)

    def level(self, key: np.ndarray) -> np.ndarray:
        """Highest level found for each key; 0 for one that is not there. Never below the level that was put in."""
        part = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        return found_levels(self.words, _cut(key, self.bits) & _TAIL_MASK, self.start[part], self.size[part])


@dataclass
class Model:
    """What `fit` learns: the filter and the counts of frequent tokens with the workers, those of all tokens as a table.

    Without a `table` the filter's parts have been asked where they were built.
    """

    order: int
    tokens: DataFrame
    train_tokens: int
    distinct: int
    least: int
    table: Broadcast | None
    frequent: Broadcast


def count_grams(docs: DataFrame, order: int, bits: int) -> DataFrame:
    """(part, tails, counts): n-grams of up to `order` tokens, counted by each task before they are sent."""
    def rows(batches):
        def send():
            part, tails, counts = zip(*_packed(np.concatenate(held), bits))
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(tails, pa.binary()), pa.array(counts, pa.binary())],
                                              ["part", "tails", "counts"])

        held, size = [], 0
        for batch in batches:
            for tokens in token_blocks(batch.column("text")):
                for k in range(1, order + 1):
                    held.append(tokens.keys(k)[1])
                    size += len(held[-1])
                if size >= FLUSH:
                    yield send()
                    held, size = [], 0
        if size:
            yield send()

    return in_arrow(docs.select("text"), rows, "part int, tails binary, counts binary")


def build(grams: DataFrame, least: int) -> DataFrame:
    """(part, words): the parts of the filter, each from all counts of its n-grams; those below `least` stay out."""
    def rows(batches):
        def done():
            tail = np.concatenate([t for t, _ in held])
            n = np.concatenate([c for _, c in held])
            order = np.argsort(tail, kind="stable")
            tail, n = tail[order], n[order]
            starts = np.flatnonzero(np.append(True, tail[1:] != tail[:-1]))
            tail, n = tail[starts], np.add.reduceat(n, starts)
            tail, n = tail[n >= least], n[n >= least] // least
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([part_words(tail, levels(n)).tobytes()], pa.binary())],
                                              ["part", "words"])

        held, now = [], None
        for batch in batches:
            for part, tails, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "tails", "counts"))):
                if part != now and held:
                    yield done()
                    held = []
                now = part
                held.append(_unpacked(tails, counts))
        if held:
            yield done()

    return in_arrow(grams.repartition("part").sortWithinPartitions("part"), rows, "part int, words binary")


def _part_bits(docs: DataFrame) -> int:
    """Parts of the filter are as many as 16 times the tasks of a shuffle, so no task has to hold more of the corpus's
    n-grams than its share."""
    return max(8, (16 * width(docs.sparkSession) - 1).bit_length())


def _counted(docs: DataFrame, order: int, frequent: int) -> Model:
    """A model of the exact counts of the tokens of `docs`, without a filter."""
    tokens = stage(count_tokens(docs), "tokens")
    n, distinct = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    often = tokens.where(F.col("n") * frequent >= n).toArrow()
    keys, counts = often["token"].to_numpy().view(np.uint64), often["n"].to_numpy()
    sort = np.argsort(keys)
    known = docs.sparkSession.sparkContext.broadcast((keys[sort], counts[sort]))
    return Model(order, tokens.where(F.col("n") * frequent < n), n, distinct, 1, None, known)


def fit(docs: DataFrame, order: int = 3, share: int | None = None, frequent: int = FREQUENT) -> Model:
    """Learn from every text of `docs` (null: empty): exact token counts, and the filter of n-grams up to `order`.

    The filter goes to the workers whole. It has all n-grams, so it grows with the corpus; `fit_and_score` needs no worker
    to hold it. With `share` its size is bounded: only n-grams of at least one in `share` of the tokens come into it, so
    scores differ, as rarer ones are left to the lower order. An order then has at most `share` n-grams and, as their
    levels start at that share, at most `share * GROWTH / (GROWTH - 1)` events of `BITS` bits.
    """
    docs = docs.select("text")
    model, bits = _counted(docs, order, frequent), _part_bits(docs)
    if share is not None:
        model.least = max(1, -(-model.train_tokens // share))
    parts = build(count_grams(docs, order, bits), model.least).toArrow()
    data = {p: np.frombuffer(b, np.uint64) for p, b in zip(parts["part"].to_pylist(), parts["words"].to_pylist())}
    model.table = docs.sparkSession.sparkContext.broadcast(Filter(data, bits))
    return model


def estimates(tokens: Tokens, table: Filter | list[np.ndarray], order: int, least: int) -> list[np.ndarray]:
    """Counts by the filter of the n-grams that end at each token, for each order; 0 where the document starts later.

    An n-gram is only asked for if the two shorter ones within it are there, and has no more than either. Instead of the
    filter, the levels of all `asked` keys may be given.
    """
    stands_for, out = level_counts(64, least), []
    for k in range(1, order + 1):
        count = np.zeros(len(tokens.hashes))
        if not isinstance(table, Filter):
            told = stands_for[table[k - 1]]
            if k == 1:
                out.append(told[tokens.distinct[1]])
                continue
            place = tokens.keys(k)[0]
            count[place] = np.minimum(told, np.minimum(out[-1][place], out[-1][place - 1]))
            out.append(count)
            continue
        if k == 1:  # a token is asked for once however often it occurs here
            token, back = tokens.distinct
            out.append(stands_for[table.level(mix(token ^ _SALTS[0]))][back])
            continue
        place, key = tokens.keys(k)
        below = np.minimum(out[-1][place], out[-1][place - 1])
        held = np.flatnonzero(below)
        place, below = place[held], below[held]
        count[place] = np.minimum(stands_for[table.level(key[held])], below)
        out.append(count)
    return out


def asked(tokens: Tokens, order: int) -> list[np.ndarray]:
    """The keys that a block's texts ask for, by order: different tokens, and each occurrence of the longer n-grams."""
    return [mix(tokens.distinct[0] ^ _SALTS[0]), *(tokens.keys(k)[1] for k in range(2, order + 1))]


def log_probabilities(counts: list[np.ndarray], new: np.ndarray, n: int, distinct: int, less: int = 0) -> Iterator[np.ndarray]:
    """log10 of each token's probability by each of STRENGTHS: an order's counts, with so much of the order below as a prior.

    `new` marks the first token of each text, which has no history. `less` is taken off counts first: 1 leaves out the
    token itself, where the model has learnt from this text.
    """
    own = [np.maximum(c - less, 0) for c in counts] if less else counts
    alone = (own[0] + ALPHA) / (max(n - less, 0) + ALPHA * (distinct + 1))
    before = []
    for k in range(1, len(own)):
        history = np.append(0.0, own[k - 1][:-1])  # what ends at the token before
        history[new] = 0
        before.append(np.maximum(history, own[k]))
    for strength in STRENGTHS:
        p = alone
        for c, history in zip(own[1:], before):
            p = (c + strength * p) / (history + strength)
        yield np.log(p) * _LOG10_E


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All rows of `docs` (doc_id, text, others), without the text, with n_tokens, n_known (both long), base_score and score.

    Words are lower-cased (A to Z); the end of a text counts as a token, so a null or empty text has one. base_score adds
    log10((c + 0.1) / (N + 0.1 * (V + 1))) over the tokens with exact counts; n_known counts those with c > 0. score is
    the model's log10 probability of the text. Tokens and n-grams are told apart by 64-bit hashes. Repeated rows each
    give a row; an empty table gives none; columns named like a result are replaced.
    """
    given, solve, table = _given(docs), _scorer(model), model.table

    def rows(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for tokens in token_blocks(batch.column("text")):
                yield solve(tokens, batch, table.value, row)
                row += tokens.last - tokens.first

    return _summed(stage(in_arrow(given, rows, _scored_schema(given)), "scored"), model)


def _given(docs: DataFrame) -> DataFrame:
    rest = [c for c in docs.columns if c not in ("text", "n_tokens", "n_known", "base_score", "score")]
    return docs.select(F.struct(*rest).alias("_given"), "text", learnt().alias("_learnt"))


def _scored_schema(given: DataFrame) -> str:
    return (f"_given {given.schema['_given'].dataType.simpleString()}, _row long, n_tokens long, _known long, _base double, "
            "_scores array<double>, _apart array<double>, _rare array<long>, _times array<int>")


def _scorer(model: Model):
    """solve(tokens, batch, table, row): the scored documents of a block of `batch`, numbered from `row`."""
    order, n, distinct, least, frequent = model.order, model.train_tokens, model.distinct, model.least, model.frequent

    def solve(tokens: Tokens, batch: pa.RecordBatch, table: Filter | list[np.ndarray], row: int) -> pa.RecordBatch:
        known, counts = frequent.value
        size = tokens.last - tokens.first
        starts, lengths = tokens.bounds[:-1], np.diff(tokens.bounds)
        found = estimates(tokens, table, order, least)
        own = batch.column("_learnt").to_numpy(zero_copy_only=False)[tokens.first : tokens.last]
        new = tokens.new[:-1]
        scores = [np.add.reduceat(x, starts) for x in log_probabilities(found, new, n, distinct)]
        apart = [np.where(own, np.add.reduceat(x, starts), 0.0) for x in log_probabilities(found, new, n, distinct, 1)]
        different, back = tokens.distinct
        at = np.searchsorted(known, different)
        at[at == len(known)] = 0
        hit = known[at] == different if len(known) else np.zeros(len(at), bool)
        base = np.where(hit, np.log10((counts[at] if len(known) else 0) + ALPHA), 0.0)[back]
        hit = hit[back]
        # Other tokens go to the table of counts, each once for a document.
        place = np.flatnonzero(~hit)
        of = np.repeat(np.arange(size), lengths)[place]
        token = tokens.hashes[place]
        sort = np.lexsort((token, of))
        of, token = of[sort], token[sort]
        first = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (token[1:] != token[:-1]))) if len(of) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(of)))
        offsets = pa.array(np.searchsorted(of[first], np.arange(size + 1)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column("_given").slice(tokens.first, size), pa.array(row + np.arange(size)), pa.array(lengths, pa.int64()),
             pa.array(np.add.reduceat(hit.astype(np.int64), starts)), pa.array(np.add.reduceat(base, starts)),
             pa.FixedSizeListArray.from_arrays(pa.array(np.stack(scores, 1).ravel()), len(STRENGTHS)).cast(pa.list_(pa.float64())),
             pa.FixedSizeListArray.from_arrays(pa.array(np.stack(apart, 1).ravel()), len(STRENGTHS)).cast(pa.list_(pa.float64())),
             pa.ListArray.from_arrays(offsets, pa.array(token[first].view(np.int64))),
             pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
            ["_given", "_row", "n_tokens", "_known", "_base", "_scores", "_apart", "_rare", "_times"])

    return solve


def _summed(seen: DataFrame, model: Model) -> DataFrame:
    """The scored documents with the strength that suits best, and with the counts of their rare tokens."""
    n, distinct = model.train_tokens, model.distinct
    sums = seen.agg(*[F.sum(F.col("_apart")[k]) for k in range(len(STRENGTHS))]).first()
    best = max(range(len(STRENGTHS)), key=lambda k: sums[k] if sums[k] is not None else -math.inf)
    rare = seen.select("_row", F.explode(F.arrays_zip("_rare", "_times")).alias("x")).select("_row", F.col("x._rare").alias("token"), "x._times")
    count = F.coalesce("n", F.lit(0))
    rare = rare.join(model.tokens, "token", "left").groupBy("_row").agg(
        F.sum(F.col("_times") * F.log10(count + ALPHA)).alias("_more"),
        F.sum(F.when(count > 0, F.col("_times")).otherwise(0)).alias("_also"))
    scale = math.log10(n + ALPHA * (distinct + 1))
    return seen.drop("_rare", "_times", "_apart").join(rare, "_row", "left").select(
        "_given.*", "n_tokens", (F.col("_known") + F.coalesce("_also", F.lit(0))).alias("n_known"),
        (F.col("_base") + F.coalesce("_more", F.lit(0.0)) - F.col("n_tokens") * scale).alias("base_score"),
        F.col("_scores")[best].alias("score"))


def _sheaves(batches, size: int) -> Iterator[tuple[int, int, list[pa.RecordBatch]]]:
    """(name, check, documents): consecutive documents of a task, about `size` bytes of text at a time, however they come in
    batches. `check` tells what texts they are."""
    held, n, check, name = [], 0, 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        text = strings(batch.column("text"))
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
        data, first = memoryview(text.buffers()[2] or b""), 0
        while first < len(batch):
            last = min(len(batch), int(np.searchsorted(offsets[1:], offsets[first] + size - n)) + 1)
            held.append(batch.slice(first, last - first))
            check = zlib.crc32(data[offsets[first] : offsets[last]], zlib.crc32(np.diff(offsets[first : last + 1]).tobytes(), check))
            n += int(offsets[last] - offsets[first])
            first = last
            if n >= size:
                yield name, check, held
                held, n, check, name = [], 0, 0, name + 1
    if held:
        yield name, check, held


def _asked(given: DataFrame, order: int, bits: int, size: int) -> DataFrame:
    """(part, name, check, tails, counts): the n-grams of each sheaf, with their counts in the texts that are learnt from."""
    def rows(batches):
        for name, check, held in _sheaves(batches, size):
            own, others = [], []
            for batch in held:
                from_these = batch.column("_learnt").to_numpy(zero_copy_only=False)
                for tokens in token_blocks(batch.column("text")):
                    of = np.repeat(from_these[tokens.first : tokens.last], np.diff(tokens.bounds))
                    for k in range(1, order + 1):
                        place, key = tokens.keys(k)
                        own.append(key[of[place]])
                        others.append(key[~of[place]])
            part, tails, counts = zip(*_packed(np.concatenate(own), bits, np.concatenate(others)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array([name] * len(part), pa.int64()), pa.array([check] * len(part), pa.int64()),
                 pa.array(tails, pa.binary()), pa.array(counts, pa.binary())], ["part", "name", "check", "tails", "counts"])

    return in_arrow(given, rows, "part int, name long, check long, tails binary, counts binary")


def _answered(asked: DataFrame) -> DataFrame:
    """(name, check, part, found): the levels that each part of the filter, built from all counts, gives for what it is asked."""
    def rows(batches):
        def done():
            packs = [_unpacked(tails, counts) for _, _, tails, counts in held]
            tail, n = (np.concatenate(x) for x in zip(*packs))
            sort = np.argsort(tail, kind="stable")
            new = np.append(True, tail[sort][1:] != tail[sort][:-1])
            each, n = tail[sort][new], np.add.reduceat(n[sort], np.flatnonzero(new))
            words = part_words(each[n > 0], levels(n[n > 0]))
            found = found_levels(words, each, np.zeros(len(each), np.uint64), np.full(len(each), len(words), np.uint64))
            level = np.empty(len(tail), np.uint8)
            level[sort] = found[np.cumsum(new) - 1]
            ends = np.cumsum([len(t) for t, _ in packs])
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in held], pa.int64()), pa.array([x[1] for x in held], pa.int64()),
                 pa.array([now] * len(held), pa.int32()), pa.array([x.tobytes() for x in np.split(level, ends[:-1])], pa.binary())],
                ["name", "check", "part", "found"])

        held, now = [], None
        for batch in batches:
            for part, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "name", "check", "tails", "counts"))):
                if part != now and held:
                    yield done()
                    held = []
                now = part
                held.append(row)
        if held:
            yield done()

    return in_arrow(asked.repartition("part").sortWithinPartitions("part"), rows, "name long, check long, part int, found binary")


def fit_and_score(docs: DataFrame, order: int = 3, frequent: int = FREQUENT, sheaf: int = SHEAF) -> tuple[DataFrame, Model]:
    """All rows of `docs` as `score` gives them, by a model of those that are `learnt`, and the model, without its filter.

    The filter is that of `fit` with all n-grams, whatever the size of the corpus, and so are the scores. Its parts stay
    where they are built: the texts' n-grams go there to be counted and come back as levels, in sheaves of consecutive
    documents, which then meet their texts. So no worker holds more than a part and a sheaf.

    `docs` is read twice and must come in the same order, as stored tables do; if it does not, the run stops.
    """
    given = _given(docs)
    bits = _part_bits(docs)
    model = _counted(given.where("_learnt").select("text"), order, frequent)
    solve = _scorer(model)
    answers = stage(_answered(_asked(given, order, bits, sheaf)), "answers")

    def named(batches):
        for name, check, held in _sheaves(batches, sheaf):
            place = 0
            for batch in held:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(batch), name)), pa.array(np.full(len(batch), check)),
                     pa.array(place + np.arange(len(batch))), *(batch.column(c) for c in ("_given", "text", "_learnt"))],
                    ["name", "check", "place", "_given", "text", "_learnt"])
                place += len(batch)

    def scored(batches):
        row = TaskContext.get().partitionId() << 40
        now, checks, found, texts = None, set(), [], []

        def done():
            blocks = [(batch, tokens) for batch in texts for tokens in token_blocks(batch.column("text"))]
            keys = [x for _, tokens in blocks for x in asked(tokens, order)]
            ends = np.cumsum([len(x) for x in keys])
            different, back = np.unique(_cut(np.concatenate([np.zeros(0, np.uint64), *keys]), bits), return_inverse=True)
            level = np.frombuffer(b"".join(found), np.uint8)
            if len(checks) != 1 or len(level) != len(different):
                raise RuntimeError("the texts came in another order when they were read again; store them first")
            told = iter(np.split(level[back], ends[:-1]))
            at = row
            for batch, tokens in blocks:
                yield solve(tokens, batch, [next(told) for _ in range(order)], at)
                at += tokens.last - tokens.first

        for batch in batches:
            name = batch.column("name").to_numpy()
            starts = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
            for first, last in zip(starts, np.append(starts[1:], len(name))):
                if name[first] != now and now is not None:
                    yield from done()
                    row += sum(len(x) for x in texts)
                    checks, found, texts = set(), [], []
                now = name[first]
                own = batch.slice(first, last - first)
                checks.update(own.column("check").to_pylist())
                n = len(own) - own.column("part").null_count  # answers come before texts
                found += own.column("found").slice(0, n).to_pylist()
                if n < len(own):
                    texts.append(own.slice(n).select(["_given", "text", "_learnt"]))
        if now is not None:
            yield from done()

    kind = given.schema["_given"].dataType.simpleString()
    texts = in_arrow(given, named, f"name long, check long, place long, _given {kind}, text string, _learnt boolean")
    met = texts.unionByName(answers, allowMissingColumns=True).repartition("name").sortWithinPartitions(
        "name", F.col("part").asc_nulls_last(), "place")
    seen = stage(in_arrow(met, scored, _scored_schema(given)), "scored")
    drop_stage(answers)
    return _summed(seen, model), model
