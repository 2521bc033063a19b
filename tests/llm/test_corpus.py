"""Operators 11 to 13 against plain versions of themselves."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from repledger.llm import alignment, lm, search
from repledger.llm.tokens import BYTE_CHARACTERS

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def pairs(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# --- operator 11

def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_rank(docs, items, top=10):
    held = [(d, Counter(t), len(t)) for d, x in docs if (t := plain_terms(x))]
    n, length = len(held), sum(s for _, _, s in held)
    holders = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, tf, size in held:
            m = 25 + (75 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * holders[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                    for t in plain_terms(text) if t in tf)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


def test_ranked_search(spark, nasty):
    docs = pairs(nasty, "doc_id", "text")
    rng = random.Random(3)
    texts = [x for _, x in docs if x and len(x) < 3000]
    items = [(k, " ".join(rng.sample(rng.choice(texts).split() or ["x"], 1) * 2 + rng.choice(texts).split()[:25])) for k in range(30)]
    items += [(40, None), (41, ""), (42, "?!"), (43, "nowhereatall"), (44, "same"), (44, "same"), (None, "ONE two"), (45, "áİ ﬁx 1 2")]
    table = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, path string")
    want = plain_rank(docs, items)
    for chars in (search.BLOCK_CHARS, 300):
        got = search.rank(nasty, table, block_chars=chars)
        assert sorted(pairs(got, "item_id", "rank", "doc_id", "score"), key=repr) == want
    assert search.rank(nasty.where("false"), table).count() == 0
    assert search.rank(nasty, table.where("false")).count() == 0


def test_ids_of_text_and_small_trees(spark, nasty, monkeypatch):
    docs = nasty.where("doc_id is not null").withColumn("doc_id", F.concat(F.lit("d"), F.format_string("%03d", "doc_id")))
    items = [(k, t) for k, t in enumerate(["same x", "one two", "áİ 3 4 same same"])]
    monkeypatch.setattr(search, "TREE_ENTRIES", 40)
    got = search.rank(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(pairs(got, "item_id", "rank", "doc_id", "score"), key=repr) == plain_rank(pairs(docs, "doc_id", "text"), items)


def test_trees_bound_and_prune():
    """Bounds are never below a document's score; of a thousand documents that share paths most are left unseen."""
    rng = random.Random(1)
    rows = []
    for d in range(1000):
        path = sorted(rng.sample(range(30), rng.randint(1, 12)))
        rows.append((path, d, rng.randint(25, 400), [rng.randint(1, 5) for _ in path]))
    rows.sort()
    root = search.tree(rows)
    nodes, ends = [root], 0
    for node in nodes:
        nodes += node.branches
        ends += len(node.ends)
        below = [node]
        for x in below:
            below += x.branches
            for _, m, held in x.ends:
                assert m >= node.least_m and all(node.most[t] >= tf for t, tf in held.items())
    assert ends == 1000
    item = {t: rng.randint(1, 5000) for t in (3, 11, 17, 25)}
    seen = []

    def gain(tf, m, plain=search.gain):
        seen.append(1)
        return plain(tf, m)

    best: list = []
    search.gain, plain = gain, search.gain
    try:
        search.search(root, item, best)
    finally:
        search.gain = plain
    scores = sorted(((sum(w * plain(h[t], m) for t, w in item.items() if t in h), -d)
                     for p, d, m, tfs in rows for h in [dict(zip(p, tfs))]), reverse=True)
    assert sorted(((s, -x.id) for s, x in best), reverse=True) == scores[:10]
    assert len(seen) < len(nodes)


# --- operator 12

def plain_tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w] + [None]


def is_learnt(d):
    return d is not None and zlib.crc32(str(d).encode()) % 10 != 0


def plain_model(rows, order=3):
    counts = [Counter() for _ in range(order)]
    for d, x in rows:
        if is_learnt(d):
            t = plain_tokens(x)
            for k in range(order):
                counts[k].update(tuple(t[i - k : i + 1]) for i in range(k, len(t)))
    return counts


def about(c):
    """The middle of the whole numbers that share c's level."""
    j = 0
    while c >= math.ceil(lm.GROWTH ** (j + 1)):
        j += 1
    return (math.ceil(lm.GROWTH**j) + math.ceil(lm.GROWTH ** (j + 1)) - 1) / 2 if c else 0.0


def plain_score(text, counts, strength, less):
    n, distinct, t, out = sum(counts[0].values()), len(counts[0]), plain_tokens(text), 0.0
    for i in range(len(t)):
        c = [0.0] * len(counts)
        for k in range(min(i + 1, len(counts))):
            c[k] = min([about(counts[k][tuple(t[i - k : i + 1])]), *([c[k - 1], about(counts[k - 1][tuple(t[i - k : i])])] if k else [])])
        p = (max(c[0] - less, 0) + lm.ALPHA) / (n - less + lm.ALPHA * (distinct + 1))
        for k in range(1, min(i + 1, len(counts) - 1) + 1):
            own, before = max(c[k] - less, 0) if k <= i else 0, 0
            if k <= i:
                below = [about(counts[j][tuple(t[i - k : i])[k - 1 - j :]]) for j in range(k)]
                before = max(min(below) - less, 0)
            p = (own + strength * p) / (max(before, own) + strength)
        out += math.log10(p)
    return out


def test_scores_of_texts(nasty):
    rows = pairs(nasty, "doc_id", "text")
    counts = plain_model(rows)
    n, distinct = sum(counts[0].values()), len(counts[0])
    model = lm.fit(nasty.where(lm.learnt()))
    assert (model.train_tokens, model.distinct, model.least) == (n, distinct, 1)
    found = lm.score(nasty, model)
    assert set(nasty.columns) - {"text"} <= set(found.columns)
    got = pairs(found, "doc_id", "n_tokens", "n_known", "base_score", "score")
    apart = {s: sum(plain_score(x, counts, s, 1) for d, x in rows if is_learnt(d)) for s in lm.STRENGTHS}
    best = max(apart, key=apart.get)
    want = []
    for d, x in rows:
        t = plain_tokens(x)
        base = sum(math.log10((counts[0][(w,)] + 0.1) / (n + 0.1 * (distinct + 1))) for w in t)
        want.append((d, len(t), sum((w,) in counts[0] for w in t), base, plain_score(x, counts, best, 0)))
    by = lambda r: (r[0] is None, r[0] or 0, *r[1:3], round(r[3], 6))
    for a, b in zip(sorted(got, key=by), sorted(want, key=by), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-6)
        assert a[4] == pytest.approx(b[4], rel=0.02, abs=0.5)  # the filter's false answers are rare


def test_rare_tokens_and_rare_grams(nasty):
    """With room for few frequent tokens the table gives the rest; with few n-grams the rare ones stay out of the filter."""
    full, few = lm.fit(nasty.where(lm.learnt())), lm.fit(nasty.where(lm.learnt()), frequent=4, share=64)
    assert len(few.frequent.value[0]) <= 4 and few.least > 1
    assert len(few.table.value.words) < len(full.table.value.words) / 10
    cols = ("doc_id", "n_tokens", "n_known", F.round("base_score", 6))
    assert sorted(pairs(lm.score(nasty, few), *cols), key=repr) == sorted(pairs(lm.score(nasty, full), *cols), key=repr)


@pytest.mark.parametrize("sheaf", [lm.SHEAF, 1000, 1])
def test_scores_without_a_filter_on_the_workers(nasty, sheaf):
    """Texts that are learnt from and scored in one go, in sheaves of any size, have the scores of the filter of all n-grams;
    a filter of bounded size would give others."""
    cols = ("doc_id", "lang", "part", "n_tokens", "n_known", F.round("base_score", 6), F.round("score", 6))
    model = lm.fit(nasty.where(lm.learnt()))
    found, own = lm.fit_and_score(nasty, sheaf=sheaf)
    assert (own.train_tokens, own.distinct, own.least, own.table) == (model.train_tokens, model.distinct, 1, None)
    want = sorted(pairs(lm.score(nasty, model), *cols), key=repr)
    assert sorted(pairs(found, *cols), key=repr) == want
    few = lm.fit(nasty.where(lm.learnt()), share=64)
    assert sorted(pairs(lm.score(nasty, few), *cols), key=repr) != want


def test_no_text_or_none_to_learn_from(nasty, none):
    assert lm.fit_and_score(none)[0].count() == 0
    found, model = lm.fit_and_score(nasty.where("doc_id is null"))  # a null id is neither learnt from nor held out
    assert model.train_tokens == 0
    assert [r.n_known for r in found.collect()] == [0, 0, 0]


def test_texts_that_come_otherwise_are_refused(spark, monkeypatch):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"))
    sent = []

    def read_anew(df, *rest, in_arrow=lm.in_arrow):
        """Each reading of the texts has other ones."""
        sent.append(df)
        if "text" in df.columns and "_learnt" in df.columns and "name" not in df.columns:
            df = df.withColumn("text", F.concat_ws(" ", "text", F.lit(str(len(sent)))))
        return in_arrow(df, *rest)

    monkeypatch.setattr(lm, "in_arrow", read_anew)
    with pytest.raises(Exception, match="another order"):
        lm.fit_and_score(docs)


def test_empty_corpus(nasty, none):
    model = lm.fit(none)
    assert (model.train_tokens, model.distinct) == (0, 0)
    assert lm.score(none, model).count() == 0
    row = lm.score(nasty.where("doc_id = 7"), model).first()
    assert (row.n_tokens, row.n_known) == (3, 0) and row.base_score == pytest.approx(0)


def test_filter_keeps_every_level():
    rng = np.random.default_rng(2)
    key = np.unique(rng.integers(0, 1 << 63, 40_000).astype(np.uint64) * np.uint64(2))
    n = rng.geometric(0.3, len(key))
    n[:50] = 10 ** rng.integers(2, 7, 50)
    packed = {p: (t, c) for p, t, c in lm._packed(np.repeat(key[n < 300], n[n < 300]), 8)}
    parts, at = {}, 0
    for part, (tails, counts) in packed.items():
        tail, held = lm._unpacked(tails, counts)
        assert held.tolist() == n[n < 300][at : at + len(held)].tolist()
        at += len(held)
        parts[part] = lm.part_words(tail, lm.levels(held))
    table = lm.Filter(parts, 8)
    found, true = table.level(key[n < 300]), lm.levels(n[n < 300])
    assert (found >= true).all() and (found > true).mean() < 0.02
    assert (table.level(rng.integers(0, 1 << 63, 40_000).astype(np.uint64)) > 0).mean() < 0.01
    stands_for = lm.level_counts(60, 1)
    assert [stands_for[j] for j in lm.levels(np.arange(1, 30))] == [about(c) for c in range(1, 30)]


# --- operator 13

FILE_A, FILE_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "a", "a  b", " lead", "trail ", "tab\tnew\n\nline \r\n", "▁under", "x\u0000y", "<|endoftext|>", "</s><unk><0x41>",
       "é́", "ﬁ 𝔘 😀👍🏽", "﻿bom", "word" * 3000, "   " * 400 + "z", "١٢٣ שלום 漢字かな", "don't we'll I'm", "0123456789" * 50]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILE_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILE_B)
    byte_of = {BYTE_CHARACTERS.get(k, chr(k)): k for k in range(256)}

    def both(text):
        """(ids, bytes) of both sides, as the libraries give them; None if bytes differ."""
        if not text:
            return None
        found = a.encode(" " + text, add_special_tokens=False)
        bytes_a = [bytes(byte_of[c] for c in t) for t in found.tokens]
        ids_b = b.encode(text)
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        data = (" " + text).encode()
        return (found.ids, bytes_a, ids_b, bytes_b) if b"".join(bytes_a) == b"".join(bytes_b) == data else None

    return both


def plain_alignment(found):
    """(group text, list of linked id pairs), token by token."""
    a, bytes_a, b, bytes_b = found
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    starts_a, starts_b = [0, *ends_a], [0, *ends_b]
    linked, j = [], 0
    for i in range(len(a)):
        while ends_b[j] <= starts_a[i]:
            j += 1
        k = j
        while k < len(b) and starts_b[k] < ends_a[i]:
            linked.append((a[i], b[k]))
            k += 1
    cuts = sorted(set(ends_a) & set(ends_b))
    groups = [",".join(str(x) for x, e in zip(a, ends_a) if low < e <= high) + "|" + ",".join(str(x) for x, e in zip(b, ends_b) if low < e <= high)
              for low, high in zip([0, *cuts], cuts)] if len(a) < 2000 else None
    return groups, linked, len(cuts)


def test_alignment(spark, nasty, libraries):
    rng = random.Random(9)
    texts = ODD + ["".join(chr(rng.choice([rng.randint(1, 0x24F), rng.randint(0x370, 0xD7FF), rng.randint(0xE000, 0x1F9FF), 32, 32, 97, 101]))
                           for _ in range(rng.randint(1, 60))) for _ in range(150)]
    extra = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    docs = nasty.unionByName(extra, allowMissingColumns=True)
    rows = pairs(docs, "doc_id", "text")
    plain = [(d, found and plain_alignment(found), found) for d, x in rows for found in [libraries(x)]]
    count = Counter(p for _, x, _ in plain if x for p in set(x[1]))
    most: dict = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    want = []
    for d, x, found in plain:
        if not x:
            want.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        groups, linked, n_groups = x
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups is not None else None
        want.append((d, len(found[0]), len(found[2]), n_groups, len(linked), sum(count[p] == most[p[0]] for p in linked),
                     sum(count[p] for p in linked), digest))
    for frequent in (alignment.FREQUENT, 50):
        got = pairs(alignment.align(docs, FILE_A, FILE_B, frequent), "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
        for a, b in zip(sorted(got, key=lambda r: repr(r[:7])), sorted(want, key=lambda r: repr(r[:7])), strict=True):
            assert a[:7] == b[:7] and b[7] in (None, a[7])
    assert alignment.align(nasty.where("false"), FILE_A, FILE_B).count() == 0


def test_special_tokens_and_words_as_the_library_has_them(libraries):
    a, b = alignment.ByteLevel(FILE_A), alignment.Pieces(FILE_B)
    for text in [t for t in ODD if t and "▁" not in t]:
        found = libraries(text)
        assert a.encode(" " + text).tolist() == found[0] and b.encode(text).tolist() == found[2]
    assert alignment.Aligned("▁under", a, b).n_groups == 0


def test_pointers_end_at_the_component():
    """Random cuts of one stretch: labels are the next end that both share, however long the chain of overlaps."""
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 50, 3000):
        for share in (0.02, 0.5, 0.95):
            a, b = (np.append(np.flatnonzero(rng.random(n - 1) < share) + 1, n) for _ in range(2))
            both = np.intersect1d(a, b)
            of_a, of_b = alignment.terminals(a, b)
            assert of_a.tolist() == both[np.searchsorted(both, a)].tolist()
            assert of_b.tolist() == both[np.searchsorted(both, b)].tolist()
            at_a, at_b = alignment.links(a, b)
            starts_a, starts_b = np.append(0, a[:-1]), np.append(0, b[:-1])
            assert len(at_a) == sum(((starts_b < e) & (b > s)).sum() for s, e in zip(starts_a, a)) if n < 100 else True
            assert (np.maximum(starts_a[at_a], starts_b[at_b]) < np.minimum(a[at_a], b[at_b])).all()
    # A chain in which no two ends meet before the last byte.
    a, b = np.append(np.arange(2, 4000, 2), 4001), np.append(np.arange(1, 4000, 2), 4001)
    assert set(alignment.terminals(a, b)[0]) == set(alignment.terminals(a, b)[1]) == {4001}


def test_a_texts_new_words_are_encoded_together(monkeypatch):
    """One call of the library for all words of a text that are not remembered, with other runs of spaces among them."""
    text = "one two  three   one\n two four "
    plain = alignment.Pieces(FILE_B)
    for most in (alignment.REMEMBERED, 2):
        monkeypatch.setattr(alignment, "REMEMBERED", most)
        own, calls = alignment.Pieces(FILE_B), []

        class Model:
            encode = staticmethod(lambda texts, model=own.model, **how: calls.append(texts) or model.encode(texts, **how))

        own.model = Model
        first = own.encode(text)
        assert [x for x in calls if isinstance(x, list)] and len(calls) <= 2
        b = b"".join(own.bytes[i] for i in first.tolist())
        assert b == (" " + text).encode() and own.encode(text).tolist() == first.tolist()
        assert own.encode("two one five").tolist() == plain.model.encode("two one five")
