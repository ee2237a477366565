"""Best-fit packing of tokenised documents into sequences by linear grouping.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.
The number of pieces of every length (at most ``capacity`` rows at any input
size) goes to the driver, which plans the packing on those counts:

1. lengths over ``capacity / SMALL_PART`` are large: in descending order they
   are cut into ``GROUPS`` groups of equal cardinality, and each group's
   lengths are rounded up to its largest;
2. configurations (which rounded sizes share a sequence) are chosen one after
   another: the largest size left, completed to the fullest sum that a
   knapsack over the few sizes allows, repeated as often as the counts allow;
3. actual lengths take the slots of their group;
4. small lengths go, longest first, into the fullest sequence that still
   holds them; new sequences open when none does.

The plan is a table of intervals of the rank of a piece in length order, and
every piece finds its sequence and offset from its rank: the data are sorted
once, by (length, hash), and no length meets in one task.

A null or empty text has the closing id only; a longer document than the
capacity is cut; repeated rows are packed each; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_rows, materialize, ranked

CAPACITY = 2048
END_ID = 0
GROUPS = 512
SMALL_PART = 10
CACHE_WORDS = 400_000
LEARN_WORDS = 500


class WordEncoder:
    """Token ids of whole texts, equal to the tokenizer's, from ids of their distinct words.

    Within ``PLAIN`` characters the tokenizer's normaliser is lower-casing
    and its pre-tokeniser the pattern below, so a text's ids are its words'
    ids in a row. Other texts, and texts with a special token, go through
    the tokenizer whole. Both take the tokenizer's own encoding.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a process on each core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        chars = [chr(c) for c in [9, 10, 13, *range(0x20, 0x7F), *range(0xA0, 0x130), *range(0x131, 0x180)]]
        self.plain = re.compile("[" + re.escape("".join(chars)) + "]*")
        letters, numbers = ("".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == k) for k in "LN")
        # fixed values: the pre-tokeniser's pattern
        self.words = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+")
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}  # two generations of at most CACHE_WORDS words and a batch's new ones
        self.older: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        # the form that keeps no character offsets
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[str]) -> None:
        ids = self._ids(" ".join(words))
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) == len(words):
            data, at = ids.tobytes(), 0
            for word, end in zip(words, (4 * ends).tolist()):
                self.cache[word] = data[at:end]
                at = end
        else:  # a word that is not one run of pieces
            for word in words:
                self.cache[word] = self._ids(word).tobytes()

    def forget(self) -> None:
        """Give back the words learned so far; a worker outlives the tasks that need them."""
        self.cache, self.older = {}, {}

    def encode(self, texts: list[str], most: int | None = None) -> list[bytes]:
        """Little-endian 32-bit ids of each text; a generation of the cache holds ``most`` words (``CACHE_WORDS``) and a batch's new ones."""
        split = []
        for text in texts:
            plain = self.plain.fullmatch(text) and not any(s in text for s in self.special)
            split.append(self.words.findall(text.lower()) if plain else None)
        if len(self.cache) > (CACHE_WORDS if most is None else most):
            self.older, self.cache = self.cache, {}
        new = list(filterfalse(self.cache.__contains__, set().union(*(w for w in split if w))))
        if self.older:
            again = list(filter(self.older.__contains__, new))
            self.cache.update(zip(again, map(self.older.__getitem__, again)))
            new = list(filterfalse(self.cache.__contains__, new))
        for k in range(0, len(new), LEARN_WORDS):
            self._learn(new[k:k + LEARN_WORDS])
        get = self.cache.__getitem__
        return [self._ids(t).tobytes() if w is None else b"".join(map(get, w)) for t, w in zip(texts, split)]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ENCODERS: dict[str, WordEncoder] = {}


def encoder(tokenizer_json: str) -> WordEncoder:
    """One encoder per worker process."""
    if tokenizer_json not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer_json] = WordEncoder(tokenizer_json)
    return _ENCODERS[tokenizer_json]


def _pieces_task(shared, capacity: int):
    def run(batches):
        words = encoder(shared.value)
        close = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc, ids in zip(part.column("doc_id").to_pylist(), words.encode(texts)):
                    ids += close
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at:at + 4 * capacity]
                        out["doc_id"].append(doc), out["piece"].append(k), out["start"].append(at // 4)
                        out["length"].append(len(own) // 4), out["ids_crc32"].append(zlib.crc32(own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[k], pa.int32() if k == "piece" else pa.int64()) for k in out], names=list(out))
    return run


def _configurations(sizes: list[int], counts: list[int], capacity: int):
    """(times, number of each size) until no large piece is left; sizes descend."""
    left = list(counts)
    while any(left):
        seed = next(k for k, n in enumerate(left) if n)
        room = capacity - sizes[seed]
        usable = [(k, min(left[k] - (k == seed), room // sizes[k])) for k in range(seed, len(sizes)) if left[k] and sizes[k] <= room]
        best = {0: ()}  # sum -> one way to reach it; bounded by the room
        for k, most in usable:
            for total, way in list(best.items()):
                for m in range(1, most + 1):
                    s = total + m * sizes[k]
                    if s > room:
                        break
                    best.setdefault(s, (*way, (k, m)))
        number = dict(best[max(best)])
        number[seed] = number.get(seed, 0) + 1
        times = min(left[k] // m for k, m in number.items())
        for k, m in number.items():
            left[k] -= times * m
        yield times, number


def plan(histogram: dict[int, int], capacity: int = CAPACITY):
    """Classes of equal sequences, (how many, [(length, how many in each)]), that hold every piece once."""
    small = capacity // SMALL_PART
    large = sorted((n for n in histogram if n > small), reverse=True)
    total = sum(histogram[n] for n in large)
    groups: list[list[list[int]]] = []
    share, taken = max(1, -(-total // GROUPS)), 0
    for n in large:
        left = histogram[n]
        while left:
            if taken % share == 0:
                groups.append([])
            take = min(left, share - taken % share)
            groups[-1].append([n, take])
            taken += take
            left -= take
    sizes = [g[0][0] for g in groups]
    classes: list[tuple[int, list[tuple[int, int]]]] = []
    for times, number in _configurations(sizes, [sum(c for _, c in g) for g in groups], capacity):
        slots = [k for k in sorted(number) for _ in range(number[k])]
        while times:  # runs in which every slot has one actual length
            took, run = [], times
            use: dict[int, int] = {}
            for k in slots:
                use[k] = use.get(k, 0) + 1
            for k, m in use.items():
                n, have = groups[k][0]
                run = min(run, max(1, have // m))
            for k, m in use.items():
                need = m * run
                while need:
                    n, have = groups[k][0]
                    take = min(need, have)
                    took.append((k, n, take))
                    groups[k][0][1] -= take
                    if not groups[k][0][1]:
                        groups[k].pop(0)
                    need -= take
            content: dict[int, int] = {}
            for _, n, take in took:  # run > 1 only where one length fills all of a group's slots
                content[n] = content.get(n, 0) + take // run
            classes.append((run, sorted(content.items(), reverse=True)))
            times -= run
    by_room: dict[int, list] = {}
    for times, content in classes:
        by_room.setdefault(capacity - sum(n * m for n, m in content), []).append((times, content))
    for n in sorted((n for n in histogram if 0 < n <= small), reverse=True):
        left = histogram[n]
        for room in sorted(r for r in by_room if r >= n):
            if not left:
                break
            fits, again = room // n, []
            for times, content in by_room.pop(room):
                full = min(times, left // fits)
                if full:
                    by_room.setdefault(room - fits * n, []).append((full, [*content, (n, fits)]))
                    left -= full * fits
                    times -= full
                if times and left:
                    by_room.setdefault(room - left * n, []).append((1, [*content, (n, left)]))
                    times, left = times - 1, 0
                if times:
                    again.append((times, content))
            if again:
                by_room.setdefault(room, []).extend(again)
        fits = capacity // n
        if left // fits:
            by_room.setdefault(capacity - fits * n, []).append((left // fits, [(n, fits)]))
        if left % fits:
            by_room.setdefault(capacity - left % fits * n, []).append((1, [(n, left % fits)]))
    return [c for room in sorted(by_room) for c in by_room[room]]


def _intervals(histogram: dict[int, int], classes) -> np.ndarray:
    """Rows (first rank, length, pieces in each sequence, first sequence, first offset), by rank."""
    place, at = {}, 0
    for n in sorted(histogram):
        place[n] = at
        at += histogram[n]
    rows, sequence = [], 0
    for times, content in classes:
        offset = 0
        for n, m in content:
            rows.append((place[n], n, m, sequence, offset))
            place[n] += times * m
            offset += n * m
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place_task(shared):
    def run(batches):
        rows = shared.value
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            first, n, m, sequence, offset = rows[np.searchsorted(rows[:, 0], rank, "right") - 1].T if len(rank) else np.zeros((5, 0), np.int64)
            at = rank - first
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence + at // m), pa.array(offset + at % m * n)],
                                             names=[*batch.schema.names[:5], "sequence_id", "offset"])
    return run


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece of a document (doc_id, text): its ids' place and CRC, its sequence and offset there."""
    spark = documents.sparkSession
    arrow_rows(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())
    pieces = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pieces_task(tokenizer, capacity), PIECES)
    keys = ["length", F.xxhash64("doc_id", "start", "ids_crc32"), "doc_id", "start", "ids_crc32"]
    pieces = ranked(materialize(pieces, "pieces"), keys, "sorted_pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    rows = spark.sparkContext.broadcast(_intervals(histogram, plan(histogram, capacity)))
    columns = [c.split()[0] for c in PIECES.split(", ")]
    return pieces.select(*columns, "rank").mapInArrow(_place_task(rows), PIECES + ", sequence_id long, offset long")
