"""Language identification by prediction by partial matching.

Each learned language has a byte context tree of order ``ORDER``: for every
context of up to that many bytes, how often each byte followed it. With method
C escapes, a context seen n times before d different bytes gives a byte seen c
times the probability c / (n + d) and the escape d / (n + d); an escape goes to
the context one byte shorter, the last one to a uniform byte. The statistics
are frozen after training, so a byte's code length in the longest context is a
table value, the same for every text; a text's code length is a sum of table
values, kept as integers of 1/4096 bit and hence exact and independent of how
the texts are batched. The language with the shortest code wins (ties: the
first in name order); the score is its posterior under equal priors.

Training takes a bounded sample of labelled rows: about ``TRAIN_ROWS`` rows of
each language, chosen by hash whatever their length, the first ``TRAIN_BYTES``
bytes of each.

Bytes A-Z count as a-z, and spaces stand before a text. A null text or one
without a letter is ``und`` with score 0, as is everything when no labelled row
exists. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_rows, text_buffer

ORDER = 4
TRAIN_ROWS = 400
TRAIN_BYTES = 20_000
UNDETERMINED = "und"
UNIT = 4096
CHUNK = 1 << 19
_MASKS = [np.uint64((1 << 8 * k) - 1) for k in range(ORDER + 2)]
_SPACES = np.uint64(int.from_bytes(b" " * (ORDER + 1), "big"))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_LETTER = (_FOLD >= 97) & (_FOLD <= 122)


def grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """For bytes lo..hi: the byte and the ORDER before it in its text as one number; spaces stand before a text."""
    base = max(0, lo - ORDER)
    part = data[base:hi].astype(np.uint64)
    code = part.copy()
    for k in range(1, ORDER + 1):
        code[k:] |= part[:-k] << np.uint64(8 * k)
    code = code[lo - base:]
    near = starts[(starts > lo - ORDER) & (starts < hi)]
    limit = ends[(starts > lo - ORDER) & (starts < hi)]
    for k in range(ORDER):
        at = near + k
        at = at[(at < limit) & (at >= lo) & (at < hi)] - lo
        code[at] = (code[at] & _MASKS[k + 1]) | (_SPACES & ~_MASKS[k + 1])
    return code


class HashTable:
    """Row numbers of distinct keys by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(4 * len(keys)).bit_length())
        self.key = np.full(1 << self.bits, np.uint64((1 << 64) - 1))
        self.row = np.zeros(1 << self.bits, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = np.flatnonzero(self.key[at[todo]] == np.uint64((1 << 64) - 1))
            _, first = np.unique(at[todo[free]], return_index=True)
            won = todo[free[first]]
            self.key[at[won]], self.row[at[won]] = keys[won], won
            todo = np.setdiff1d(todo, won, assume_unique=True)
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is unknown."""
        at = self._slot(keys)
        found = self.key[at]
        out = np.where(found == keys, self.row[at], np.int32(-1))
        todo = np.flatnonzero((found != keys) & (found != np.uint64((1 << 64) - 1)))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            found = self.key[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.row[at[todo[hit]]]
            todo = todo[~hit & (found != np.uint64((1 << 64) - 1))]
        return out


class ContextTrees:
    """Code-length tables of all languages, one row of lengths (a column per language) for each known string."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(samples)
        codes = []
        for name in self.languages:
            texts = samples[name]
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
            data = _FOLD[np.frombuffer(b"".join(texts), np.uint8)]
            codes.append(grams(data, offsets[:-1], offsets[1:], 0, len(data)) if len(data) else np.zeros(0, np.uint64))
        width = len(self.languages)
        lower = np.full((1, width), 8.0)  # bits of a uniform byte
        lower_keys = np.zeros(1, np.uint64)
        self.tables, self.lengths, self.escapes = [], [], []
        for order in range(ORDER + 1):
            own = [np.unique(c & _MASKS[order + 1], return_counts=True) for c in codes]
            if order == 0:
                keys = np.arange(256, dtype=np.uint64)
            else:
                keys = np.unique(np.concatenate([k for k, _ in own])) if own else np.zeros(0, np.uint64)
            contexts = np.unique(keys >> np.uint64(8))
            of = np.searchsorted(contexts, keys >> np.uint64(8))
            short = keys & _MASKS[order]
            base = lower[np.searchsorted(lower_keys, short)] if order else np.repeat(lower, len(keys), 0)
            length, escape = np.empty((len(keys), width)), np.zeros((len(contexts), width))
            for k, (own_keys, own_counts) in enumerate(own):
                count = np.zeros(len(keys))
                count[np.searchsorted(keys, own_keys)] = own_counts
                n = np.bincount(of, count, len(contexts))
                d = np.bincount(of, count > 0, len(contexts))
                seen = n > 0
                escape[seen, k] = np.log2((n + d)[seen] / d[seen])
                with np.errstate(divide="ignore", invalid="ignore"):
                    direct = np.log2((n + d)[of]) - np.log2(count)
                length[:, k] = np.where(count > 0, direct, escape[of, k] + base[:, k])
            self.tables.append((HashTable(keys), HashTable(contexts)))
            self.lengths.append(np.rint(length * UNIT).astype(np.int32))
            self.escapes.append(np.rint(escape * UNIT).astype(np.int32))
            lower, lower_keys = length, keys

    def lengths_of(self, code: np.ndarray) -> np.ndarray:
        """Code lengths (bytes x languages) in units, of ORDER + 1 byte strings."""
        out = np.zeros((len(code), len(self.languages)), np.int32)
        todo = np.arange(len(code))
        for order in reversed(range(ORDER + 1)):
            own = code[todo] & _MASKS[order + 1]
            row = self.tables[order][0].find(own)
            known = row >= 0
            at = todo[known]
            out[at] += self.lengths[order][row[known]]
            todo, own = todo[~known], own[~known]
            if not len(todo):
                break
            context = self.tables[order][1].find(own >> np.uint64(8))
            there = context >= 0
            out[todo[there]] += self.escapes[order][context[there]]
        return out

    def score(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Code length of each text in each language, in units."""
        data = _FOLD[data]
        starts, ends = offsets[:-1], offsets[1:]
        total = np.zeros((len(starts), len(self.languages)), np.int64)
        for lo in range(0, len(data), CHUNK):
            hi = min(lo + CHUNK, len(data))
            lengths = self.lengths_of(grams(data, starts, ends, lo, hi))
            own = np.flatnonzero((ends > lo) & (starts < hi) & (ends > starts))
            total[own] += np.add.reduceat(lengths, np.maximum(starts[own] - lo, 0), axis=0, dtype=np.int64)
        return total


def held_out_remainder(doc_id="doc_id"):
    """crc32 of the id as text, modulo 3 (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def train(documents: DataFrame, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> ContextTrees:
    """Context trees from labelled rows whose id's remainder is not 1."""
    fit = documents.where(F.col("lang").isNotNull() & (held_out_remainder() != 1) & (F.octet_length("text") > 0))
    counts = fit.groupBy("lang").count()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # twice the rows by hash first, so that the window below never sees a whole language
    near = fit.select("lang", F.substring("text", 1, most_bytes).alias("text"), "doc_id", place.alias("place")).join(F.broadcast(counts), "lang")
    near = near.where(F.col("place") * F.col("count") < 2 * rows)
    best = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    sample = near.withColumn("k", F.row_number().over(best)).where(F.col("k") <= rows)
    texts: dict[str, list[bytes]] = {}
    for r in sorted(sample.select("lang", "k", "text").collect(), key=lambda r: (r["lang"], r["k"])):
        texts.setdefault(r["lang"], []).append(r["text"].encode()[:most_bytes].decode(errors="ignore").encode())
    return ContextTrees(texts)


PREDICTED = "lang_pred string, score double"


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _letters(column: pa.Array, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Whether each text has a letter."""
    letter, some = np.zeros(len(column), bool), np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(some):
        letter[some] = np.logical_or.reduceat(_LETTER[data], offsets[some])
    for k in np.flatnonzero(~letter & (offsets[1:] > offsets[:-1])):
        letter[k] = _has_letter(column[int(k)].as_py())
    return letter


def _letters_task(batches):
    for batch in batches:
        column = batch.column("text")
        yield batch.filter(pa.array(_letters(column, *text_buffer(column)), pa.bool_()))


def with_letters(documents: DataFrame) -> DataFrame:
    """The documents whose text has a letter; needs no learned language."""
    arrow_rows(documents.sparkSession)
    return documents.mapInArrow(_letters_task, documents.schema)


def _predict_task(shared, keep: list[str]):
    def run(batches):
        trees = shared.value
        for batch in batches:
            column = batch.column("text")
            offsets, data = text_buffer(column)
            n = batch.num_rows
            names, scores = np.full(n, UNDETERMINED, object), np.zeros(n)
            letter = _letters(column, offsets, data)
            if trees.languages and n:
                bits = trees.score(offsets, data) / UNIT
                best = bits.argmin(1)
                gap = np.minimum(bits - bits[np.arange(n), best][:, None], 1000.0)
                names[letter] = np.array(trees.languages, object)[best[letter]]
                scores[letter] = (1 / np.exp2(-gap).sum(1))[letter]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(names, pa.string()), pa.array(scores)],
                                             names=[*keep, "lang_pred", "score"])
    return run


def identify(documents: DataFrame, trees: ContextTrees, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``documents`` with lang_pred and score; only ``text`` is looked at."""
    spark = documents.sparkSession
    arrow_rows(spark)
    rows = documents.select(*keep, *([] if "text" in keep else ["text"]))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(_predict_task(spark.sparkContext.broadcast(trees), keep), f"{schema}, {PREDICTED}")
