"""Operator 6: language of texts and of spans of mixed text, by scripts, word scores and Viterbi."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repledger.llm.common import in_arrow, in_small_batches

#: Bound of the sample that the model is fitted on: so many documents of each language, drawn by a hash of their id.
SAMPLE_PER_LANGUAGE = 300
#: Cells of the table that character n-grams of a word are hashed to, and the count that each cell starts with.
CELLS, SMOOTHING = 1 << 16, 0.1
#: Loss of log-likelihood for a change of language from one word to the next.
SWITCH = 12.0
#: Code points that are scored at once.
BLOCK = 1 << 20

# Fixed values of Unicode: where blocks of a script begin and end, and its name.
SCRIPTS = [
    (0x0041, 0x024F, "latin"), (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"), (0x0530, 0x058F, "armenian"),
    (0x0590, 0x05FF, "hebrew"), (0x0600, 0x077F, "arabic"), (0x0900, 0x097F, "devanagari"), (0x0980, 0x09FF, "bengali"),
    (0x0A00, 0x0A7F, "gurmukhi"), (0x0A80, 0x0AFF, "gujarati"), (0x0B80, 0x0BFF, "tamil"), (0x0C00, 0x0C7F, "telugu"),
    (0x0C80, 0x0CFF, "kannada"), (0x0D00, 0x0D7F, "malayalam"), (0x0E00, 0x0E7F, "thai"), (0x0E80, 0x0EFF, "lao"),
    (0x10A0, 0x10FF, "georgian"), (0x1100, 0x11FF, "hangul"), (0x1E00, 0x1EFF, "latin"), (0x1F00, 0x1FFF, "greek"),
    (0x3040, 0x30FF, "kana"), (0x3400, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"), (0xF900, 0xFAFF, "han"),
]
_STARTS = np.array([s[0] for s in SCRIPTS])
_ENDS = np.array([s[1] for s in SCRIPTS])
_SCRIPT_NAMES = sorted({s[2] for s in SCRIPTS}) + ["other"]
_SCRIPT_IDS = np.array([_SCRIPT_NAMES.index(s[2]) for s in SCRIPTS], np.int8)
_OTHER = len(_SCRIPT_NAMES) - 1


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point of the first two planes: is it a letter, its lower case, its script."""
    chars = [chr(c) for c in range(1 << 17)]
    letter = np.array([c.isalpha() for c in chars])
    low = np.array([ord(l) if len(l := c.lower()) == 1 else ord(c) for c in chars], np.uint32)
    k = np.clip(np.searchsorted(_STARTS, np.arange(1 << 17), "right") - 1, 0, None)
    inside = (np.arange(1 << 17) >= _STARTS[k]) & (np.arange(1 << 17) <= _ENDS[k])
    return letter, low, np.where(inside, _SCRIPT_IDS[k], _OTHER).astype(np.int8)


_cache: list = []


def tables():
    if not _cache:
        _cache.append(_tables())
    return _cache[0]


@dataclass
class Letters:
    """Runs of letters of some texts: of each its text, first and last code point, script, and its n-gram cells."""

    text_of: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    script: np.ndarray
    cells: np.ndarray = field(repr=False)  # three for each code point: of one, two and three characters
    at: np.ndarray = field(repr=False)  # where a word's code points begin in `cells`


def words_of(texts: list[str]) -> Letters:
    """Every run of letters of the texts, in order. Texts are set apart, so no run spans two."""
    letter, low, script = tables()
    flat = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    plane = np.minimum(flat, 0x1FFFF)
    is_letter = letter[plane] | (flat > 0x1FFFF)  # beyond the first two planes: ideographs
    scripts = script[plane]
    starts = np.flatnonzero(is_letter & ~np.append(False, is_letter[:-1]))
    ends = np.flatnonzero(is_letter & ~np.append(is_letter[1:], False)) + 1
    lengths = ends - starts
    chars = np.where(is_letter, np.where(flat > 0x1FFFF, flat, low[plane]), 32).astype(np.uint64)
    # A space stands on either side of each run, so n-grams know the ends of words.
    before, after = np.append(np.uint64(32), chars[:-1]), np.append(chars[1:], np.uint64(32))
    a, b, c = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    two = before * a + chars * b
    grams = np.stack([chars * c, two, two * a + after * c], axis=1)[is_letter]
    cells = ((grams ^ (grams >> np.uint64(29))) * b >> np.uint64(48)).astype(np.uint16)
    return Letters(np.searchsorted(first, starts, "right") - 1, starts, lengths, scripts[starts], cells,
                   np.cumsum(lengths) - lengths)


class Model:
    """Log-probabilities of n-gram cells in each language, and the scripts that each language is written in."""

    def __init__(self, texts: list[str], labels: list[str], switch: float = SWITCH):
        self.languages = sorted(set(labels))
        self.switch = switch
        n = len(self.languages)
        counts = np.full((CELLS, n), SMOOTHING)
        used = np.zeros((len(_SCRIPT_NAMES), n), np.int64)
        for k, language in enumerate(self.languages):
            own = words_of([t for t, x in zip(texts, labels) if x == language])
            counts[:, k] += np.bincount(own.cells.ravel(), minlength=CELLS)
            used[:, k] = np.bincount(own.script, minlength=len(_SCRIPT_NAMES))
        # Words with more letters have more n-grams, which overlap; a third of each keeps their sum a fair score.
        self.log = (np.log(counts / counts.sum(axis=0)) / 3).astype(np.float32)
        share = used / np.maximum(1, used.sum(axis=0))
        #: A script's candidates: languages that write a hundredth of their words in it; all, if none does.
        self.allowed = share >= 0.01
        self.allowed[~self.allowed.any(axis=1)] = True

    def scores(self, words: Letters) -> np.ndarray:
        """One row of log-likelihoods for each word; languages that don't use its script are put far behind."""
        if not len(words.starts):
            return np.zeros((0, len(self.languages)), np.float32)
        each = self.log[words.cells[:, 0]] + self.log[words.cells[:, 1]] + self.log[words.cells[:, 2]]
        out = np.add.reduceat(each, words.at, axis=0)
        out[~self.allowed[words.script]] -= 2 * self.switch
        return out

    def paths(self, words: Letters) -> np.ndarray:
        """The language of each word: Viterbi over the words of each text, all texts of the block side by side.

        The totals run from the last word to the first; the choices are then followed from the first word on.
        """
        score = self.scores(words)
        path = np.zeros(len(score), np.int64)
        if not len(score):
            return path
        _, first, count = np.unique(words.text_of, return_index=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        first, count = first[order], count[order]
        steps = int(count[0])
        active = np.searchsorted(-count, -np.arange(1, steps + 1), "right")  # texts that have a word at each step
        to, stay = np.zeros(len(score), np.int64), np.zeros(score.shape, bool)
        total = np.zeros((len(first), score.shape[1]), np.float32)
        each = np.arange(len(first))
        for t in range(steps - 1, -1, -1):
            m = active[t]
            row, after = first[:m] + t, total[:m]
            best = after.argmax(axis=1)
            changed = (after[each[:m], best] - self.switch)[:, None]
            to[row], stay[row] = best, after >= changed
            total[:m] = np.maximum(after, changed) + score[row]
        state = total.argmax(axis=1)
        path[first] = state
        for t in range(1, steps):
            m = active[t]
            came, own = first[:m] + t - 1, state[:m]
            state[:m] = np.where(stay[came, own], own, to[came])
            path[first[:m] + t] = state[:m]
        return path

    def label(self, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        """Language with most letters, its share of the letters, and the spans of one language each, for each text."""
        none = ("und", 0.0, [])
        if not self.languages:
            return [none for _ in texts]
        words = words_of(texts)
        path = self.paths(words)
        n = len(self.languages)
        letters = np.bincount(words.text_of * n + path, words.lengths, minlength=len(texts) * n).reshape(len(texts), n)
        best, sums = letters.argmax(axis=1), letters.sum(axis=1)
        fresh = np.ones(len(path), bool)
        fresh[1:] = (words.text_of[1:] != words.text_of[:-1]) | (path[1:] != path[:-1])
        begin = np.flatnonzero(fresh)
        end = np.append(begin[1:], len(path)) - 1
        out = [none if not s else (self.languages[b], float(row[b] / s), []) for b, s, row in zip(best, sums, letters)]
        base = np.cumsum([0, *(len(t) + 1 for t in texts)])
        rows = zip(words.text_of[begin].tolist(), path[begin].tolist(), words.starts[begin].tolist(),
                   (words.starts[end] + words.lengths[end]).tolist())
        for k, language, a, b in rows:
            out[k][2].append({"lang": self.languages[language], "start": int(a - base[k]), "stop": int(b - base[k])})
        return out


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from texts and labels of at most `per_language` rows of each language (doc_id, text, lang).

    The rows are those with the least hash of their id. They are found on ids alone; only their texts reach the driver.
    Rows without text or label don't count.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("doc_id", "lang", "text", F.xxhash64("doc_id").alias("drawn"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("drawn"))
    drawn = rows.select("lang", "drawn").withColumn("n", first).where(F.col("n") <= per_language).drop("n").distinct()
    sample = rows.join(F.broadcast(drawn), ["lang", "drawn"], "left_semi")
    again = F.row_number().over(Window.partitionBy("lang").orderBy("drawn", "text"))  # where an id is repeated
    sample = sample.withColumn("n", again).where(F.col("n") <= per_language).select("text", "lang").collect()
    return Model([r["text"] for r in sample], [r["lang"] for r in sample])


def identify(docs: DataFrame, model: Model, keep: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every row; with `keep`, all columns of the row, less any of these names.

    lang_pred is the language of most letters of the whole text, score its share of them; spans are the stretches of
    one language, from its first letter to behind its last. A text that is null or has no letter gets `und`, 0 and no
    span, as does any text if the model knows no language. Repeated and null ids stay; an empty table gives no row.
    """
    in_small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # CELLS rows for each language, however large the table

    def rows(batches):
        own = held.value
        block = BLOCK // max(1, len(own.languages) // 4)
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column("text")]
            # Texts of like length go side by side, so a block takes about as many steps as each of its texts has words.
            order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
            out: list = [None] * len(texts)
            held_back, size = [], 0
            for k in order + [-1]:
                if k >= 0:
                    held_back.append(k)
                    size += len(texts[k])
                if held_back and (k < 0 or size >= block):
                    for i, x in zip(held_back, own.label([texts[i] for i in held_back])):
                        out[i] = x
                    held_back, size = [], 0
            cols = list(zip(*out)) if out else [[]] * 3
            new = [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.list_(SPAN)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *new], [*names, "lang_pred", "score", "spans"])

    names = [c for c in docs.columns if c not in ("lang_pred", "score", "spans")] if keep else ["doc_id"]
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names]
    schema = ", ".join([*kinds, "lang_pred string", "score double", "spans array<struct<lang:string,start:int,stop:int>>"])
    return in_arrow(docs.select(*dict.fromkeys([*names, "text"])), rows, schema)


SPAN = pa.struct([("lang", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])


def held_out():
    """The third of the documents that no model learns from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1
