"""Operators 7 and 10 against the library's own encoding, and exact round trips."""

import tracemalloc
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from repledger.llm import packing, tokenfile
from repledger.llm.common import in_arrow
from repledger.llm.queries import tokenizer_file
from repledger.llm.tokens import Encoder, encoder
from tokenizers import Tokenizer

LIBRARY = Tokenizer.from_file(tokenizer_file())
OURS = Encoder(tokenizer_file(), True)
CHARACTERS = "abzAZéÉèßİıſΣσς'.,-!?$%&*#|0129  \t\n\x0b\x0c\r\x1c\x85\xa0 ́̈中文한กำﬁǅ😀"


def plain(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(CHARACTERS), max_size=60) | st.text(max_size=40))
def test_words_apart_gives_the_librarys_ids(text):
    try:
        data = text.encode()
    except UnicodeEncodeError:
        return
    assert OURS.encode(data).tolist() == plain(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr("repledger.llm.tokens.REMEMBERED", 3)
    small = Encoder(tokenizer_file(), True)
    text = "one, two three. four! five six seven, one two. three"
    assert [small.encode(text.encode()).tolist() for _ in range(3)] == [plain(text)] * 3


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=60), st.data())
def test_bits_round_trip(bits, ids, data):
    ids = np.array([i % (1 << bits) for i in ids], "<u4")
    packed = tokenfile.pack_bits(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    first = data.draw(st.integers(0, len(ids)))
    n = data.draw(st.integers(0, len(ids) - first))
    assert tokenfile.unpack_bits(packed, bits, first, n).tolist() == ids[first : first + n].tolist()


def test_bits_round_trip_beyond_a_slice():
    ids = np.arange(3 * tokenfile.BLOCK_IDS + 5, dtype="<u4") % 1000
    packed = tokenfile.pack_bits(ids, 10)
    assert tokenfile.unpack_bits(packed, 10, 0, len(ids)).tolist() == ids.tolist()
    assert tokenfile.unpack_bits(packed, 10, 70_001, 90_000).tolist() == ids[70_001:160_001].tolist()


@pytest.mark.parametrize("rows, bits", [(2, 1), (3, 2), (49408, 16), (65536, 16), (65537, 17)])
def test_least_bits(rows, bits):
    assert tokenfile.bits_for(rows) == bits


def test_pack(nasty, none):
    rows = packing.pack(nasty, tokenizer_file(), length=64).collect()
    texts = [(r.doc_id, plain(r.text) + [2]) for r in nasty.collect()]
    line = {}
    for r in rows:
        assert 0 < r.length <= 64 - r.offset and len(r.ids) == 4 * r.length
        line[r.sequence_id * 64 + r.offset] = r
    at, starts, whole = 0, 0, []
    while at in line:
        r = line[at]
        starts = starts if r.start else at
        assert r.start == at - starts
        if not r.start:
            whole.append((r.doc_id, []))
        whole[-1][1].extend(np.frombuffer(r.ids, "<u4").tolist())
        assert r.doc_tokens >= len(whole[-1][1])
        at += r.length
    key = repr
    assert at == sum(len(x) for _, x in texts) and sorted(whole, key=key) == sorted(texts, key=key)
    assert packing.pack(none, tokenizer_file()).count() == 0


def test_token_file(spark, nasty, none, tmp_path):
    folder = str(tmp_path / "tokens")
    tokenfile.write_tokens(nasty, folder, tokenizer_file())
    rows = sorted(tokenfile.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    want = sorted(nasty.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    at, line = 0, []
    for r, w in zip(rows, want, strict=True):
        ids = plain(w.text) + [1]
        assert (r.doc_id, r.start, r.n_tokens) == (w.doc_id, at, len(ids))
        assert zlib.crc32(r.ids) == zlib.crc32(np.array(ids, "<u4").tobytes())
        at, line = at + len(ids), line + ids
    pieces = sorted(tokenfile.read_range(spark, folder, 100, at - 150).collect(), key=lambda r: r.start)
    assert np.concatenate([np.frombuffer(p.ids, "<u4") for p in pieces]).tolist() == line[100 : at - 50]
    empty = str(tmp_path / "empty")
    tokenfile.write_tokens(none, empty, tokenizer_file())
    assert tokenfile.read_tokens(spark, empty).count() == 0


def test_another_operator_lets_remembered_words_go(spark):
    class Frame:
        sparkSession = spark

        def mapInArrow(self, fn, schema):
            return lambda: list(fn(iter([])))

    def held(batches):
        yield encoder.cache_info().currsize

    encoder(tokenizer_file(), True)
    assert in_arrow(Frame(), held, "n int", remembers=True)() == [1]
    assert in_arrow(Frame(), held, "n int")() == [0]


@pytest.mark.parametrize("bits", [8, 16, 32])
def test_whole_bytes_are_not_taken_apart(bits):
    """Ids of 8, 16 or 32 bits are packed and read as they are: taken apart, each would lie there as 32 bytes."""
    ids = (np.arange(tokenfile.BLOCK_IDS + 3) * 7919 % (1 << bits)).astype("<u4")
    tracemalloc.start()
    packed = tokenfile.pack_bits(ids, bits)
    read = tokenfile.unpack_bits(packed, bits, 1, len(ids) - 1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert packed == ids.astype(f">u{bits // 8}").tobytes() and read.dtype == np.dtype("<u4")
    assert read.tolist() == ids[1:].tolist() and most < 16 * len(ids)


def test_a_stem_is_remembered_as_a_word():
    """Words with endings share the memory of their stems, so each word is remembered once."""
    own = Encoder(tokenizer_file(), True)
    own.encode(b"alpha, alpha. alpha")
    assert set(own.words) == {b"alpha", b"alpha,", b"alpha.", b",", b"."}
    assert not [v for k, v in vars(own).items() if k != "words" and isinstance(v, dict) and v]
