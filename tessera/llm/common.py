"""Shared by the operators: shared-folder tables and vectorised word scanning.

:class:`WordScanner` splits the UTF-8 bytes of a whole Arrow batch into words
with numpy, a bounded slice at a time, and gives every word a 64-bit hash. It
never looks at a text in Python, so the cost is a few nanoseconds a byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

SLICE_BYTES = 1 << 19
ROW_GROUP_BYTES = 32 << 20
READER_ROWS = 256
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def arrow_rows(spark: SparkSession, rows: int = 500) -> str:
    """Bound what a task holds at once, as rows carry whole texts; returns the old bound of an Arrow batch.

    Arrow batches get ``rows`` rows. Unless the session has sizes of its own,
    Parquet readers make batches of ``READER_ROWS`` rows and writers buffer row
    groups of ``ROW_GROUP_BYTES``; the defaults need hundreds of MB a task.
    """
    old = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(rows))
    for key, value in (("spark.sql.parquet.columnarReaderBatchSize", READER_ROWS), ("parquet.block.size", ROW_GROUP_BYTES)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(value))
    return old


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to Parquet under the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = 64 << 20) -> DataFrame:
    """Hint a broadcast when ``rows * row_bytes`` is at most ``limit``; a shuffle hint beyond.

    ``df`` must be cheap to count (a materialized table) and ``row_bytes`` a
    bound of a row's size in a hash table.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df.hint("shuffle_hash")


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string column; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = at.astype(np.int64)
    return at - at[0], body[at[0]:at[-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every input bit over 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordScanner:
    """Words are maximal runs of bytes with ``is_word``; A-Z counts as a-z.

    A word's hash is the sum of one 64-bit number for each of its bytes,
    drawn for the byte and its place in the word, mixed with the length. For
    numbers drawn at random any two different words collide with probability
    2^-64, whatever they are made of; powers of one base do not have that
    property (long words of two exchanged halves collide for any base).
    """

    PLACES = 32

    def __init__(self, is_word: np.ndarray):
        self.is_word = is_word
        self.fold = np.arange(256)
        self.fold[65:91] += 32
        # the numbers of the first places, by place and byte
        self.table = self._draw(np.repeat(np.arange(self.PLACES), 256), np.tile(self.fold, self.PLACES))

    @staticmethod
    def _draw(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = place.astype(np.uint64) * np.uint64(256) + byte.astype(np.uint64) + np.uint64(1)
        return mix(mix(key * np.uint64(0xD1342543DE82EF95)) + np.uint64(0x9E3779B97F4A7C15))

    def _slices(self, offsets: np.ndarray, data: np.ndarray):
        """Cut points that no word crosses, about SLICE_BYTES apart."""
        at, n = 0, len(data)
        while at < n:
            end = min(at + SLICE_BYTES, n)
            if end < n:
                gaps = np.flatnonzero(~self.is_word[data[at:end]])
                doc = offsets[np.searchsorted(offsets, end, "right") - 1]
                cut = max(at + gaps[-1] + 1 if len(gaps) else at, doc)
                while cut <= at:  # one word fills the slice: go on to its end
                    doc = offsets[np.searchsorted(offsets, end - 1, "right")]
                    step = min(end + SLICE_BYTES, n, doc)
                    gaps = np.flatnonzero(~self.is_word[data[end:step]])
                    cut = end + gaps[0] + 1 if len(gaps) else step if step in (n, doc) else at
                    end = step
                end = cut
            yield at, end
            at = end

    def scan(self, offsets: np.ndarray, data: np.ndarray):
        """Word starts and ends (byte positions), hashes, and each document's first word (n + 1)."""
        starts, ends, hashes = [], [], []
        breaks = np.zeros(len(data) + 1, bool)
        breaks[offsets] = True
        for lo, hi in self._slices(offsets, data):
            part = data[lo:hi]
            word, cut = self.is_word[part], breaks[lo:hi]
            first = word.copy()
            first[1:] &= ~word[:-1] | cut[1:]
            last = word.copy()
            last[:-1] &= ~word[1:] | cut[1:]
            a, b = np.flatnonzero(first), np.flatnonzero(last)
            place = np.zeros(hi - lo, np.int64)
            place[a] = a
            np.subtract(np.arange(hi - lo), np.maximum.accumulate(place), out=place)
            total = self.table[np.minimum(place, self.PLACES - 1) * 256 + part]
            late = np.flatnonzero((place >= self.PLACES) & word)
            total[late] = self._draw(place[late], self.fold[part[late]])
            np.cumsum(total, out=total)
            h = total[b] - np.where(a > 0, total[a - 1], np.uint64(0))
            h ^= (b - a).astype(np.uint64) << np.uint64(40)
            starts.append(a + lo)
            ends.append(b + lo + 1)
            hashes.append(mix(h))
        if not starts:
            empty = np.zeros(0, np.int64)
            return empty, empty, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        starts = np.concatenate(starts)
        return starts, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(starts, offsets)

    def hashes(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The hash of each of the words that lie at the offsets (n + 1)."""
        size = np.diff(offsets)
        place = np.arange(len(data)) - np.repeat(offsets[:-1], size)
        total = self.table[np.minimum(place, self.PLACES - 1) * 256 + data]
        late = np.flatnonzero(place >= self.PLACES)
        total[late] = self._draw(place[late], self.fold[data[late]])
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(total, dtype=np.uint64)])
        return mix((total[offsets[1:]] - total[offsets[:-1]]) ^ (size.astype(np.uint64) << np.uint64(40)))


def byte_class(*ranges: tuple[int, int], invert: bool = False) -> np.ndarray:
    """A table of 256 flags, set in the given closed ranges."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a:b + 1] = True
    return ~table if invert else table


def ranked(df: DataFrame, keys: list, name: str) -> DataFrame:
    """``df`` as a table with ``rank``, its place (from 0) in the order of ``keys``.

    A range partitioning and a sort of each partition fix the order; the
    partitions' sizes, one row for each, give the offsets. Equal rows may
    swap places. ``keys`` should end with columns that tell rows apart, so
    that no key's rows fall into one partition.
    """
    place = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    place = materialize(place, name).withColumn("_part", F.shiftright("_place", 33))
    sizes = place.groupBy("_part").count().collect()  # one row per partition
    total, offsets = 0, []
    for r in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((r["_part"], total))
        total += r["count"]
    offsets = df.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    place = place.join(F.broadcast(offsets), "_part")
    return place.withColumn("rank", F.col("_offset") + F.col("_place") - F.shiftleft("_part", 33)).drop("_place", "_part", "_offset")
