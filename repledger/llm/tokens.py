"""Token ids of whole texts, each distinct word encoded once by each Python worker while it is remembered."""

from __future__ import annotations

import functools
import os
import unicodedata
from array import array

import numpy as np
import pyarrow as pa

from repledger.llm.common import REMEMBERED_BY

#: Words, their stems and endings remembered by a worker; beyond it the memory starts anew, which changes no result.
REMEMBERED = 500_000
#: Punctuation that may end a word and is then encoded apart from its letters; an apostrophe binds to letters.
_ENDINGS = b".,!?;:%&*#$|()[]\"-"


def byte_characters() -> dict[int, str]:
    """The byte-level alphabet: a printable byte stands for itself, the others for the characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(256 + k) for k, b in enumerate(others)}


BYTE_CHARACTERS = byte_characters()


class Remembered(dict):
    """What `find` gives for a key, found once while it is remembered."""

    def __init__(self, find, most: int):
        self.find, self.most = find, most

    def __missing__(self, key):
        found = self.find(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = found
        return found


class Encoder:
    """Ids of a text by a tokenizer file of the `tokenizers` library, without special tokens.

    With `words_apart`, the tokenizer must drop white space, and split letters from punctuation (as a pre-tokenizer
    of letter runs, digits and other runs does), compose and lower letters, and be byte-level; then the ids of a text are
    those of its words, one after the other, and a run of letters goes to the library's model as one piece.
    Without it each text is encoded as it is.
    """

    def __init__(self, path: str, words_apart: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words_apart = words_apart
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        #: Words, and the stems and endings of words, as a stem is a word without an ending.
        self.words = Remembered(self._word, REMEMBERED)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _one_piece(self, stem: str) -> str | None:
        """What the model gets for a run of letters, which is one piece: composed, in lower case, a character a byte."""
        if not stem.isalpha():
            return None
        if stem.isascii():
            return stem.lower()
        low = "".join([c.lower() for c in unicodedata.normalize("NFC", stem)])
        return low.encode().decode("latin-1").translate(BYTE_CHARACTERS) if low.isalpha() else None

    def _word(self, word: bytes) -> bytes:
        stem = word.rstrip(_ENDINGS)
        if stem and len(stem) < len(word) and stem.decode()[-1].lower().isalpha():
            return self.words[stem] + self.words[word[len(stem) :]]
        piece = self._one_piece(word.decode())
        if piece is None:
            return self._library([word.decode()])[0]
        return array("I", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()

    def encode(self, text: bytes) -> np.ndarray:
        """Ids of a text given as UTF-8."""
        if not self.words_apart:
            return np.frombuffer(self._library([text.decode()])[0], "<u4")
        # Bytes are split at the six white characters of ASCII only.
        return np.frombuffer(b"".join(map(self.words.__getitem__, text.split())), "<u4")


@functools.cache
def encoder(path: str, words_apart: bool) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(path, words_apart)


REMEMBERED_BY.append(encoder.cache_clear)


def texts(column: pa.Array):
    """UTF-8 of each text of an Arrow column; null as empty."""
    for value in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()):
        yield value.as_py() or b""
