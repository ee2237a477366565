"""Phrase collocations by the layout of external stream estimation.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends,
and pieces into words at spaces and tabs. Counts are kept per language as
streams of phrases of one word, two words and so on:

1. A task counts the phrases of a bounded run of words on exact word codes
   and sends each distinct one once; equal phrases of all runs are added up.
   First words and word pairs, then longer phrases: a phrase can reach the
   least count only where both its parts of one word less do. A bit table of
   bounded size says of a part that it does not; it never errs that way.
2. The counts stand in **prefix order** (words first to last), cut into
   ranges. A phrase follows its own prefixes there, so one pass with the last
   count seen of each length in hand gives every phrase the counts of its
   first words. A range starts with what the ranges before it end with (one
   row a range), so a first word that begins a third of all phrases is cut
   into ranges like any other.
3. The same in **suffix order** (words last to first) gives the counts of its
   last words. Nothing is looked up by hash in either pass.
4. In the same passes a phrase sees the counts of the phrases it extends to
   the left and to the right, and names those that it makes up for.

A count of less than ``least`` cannot be part of a candidate's counts, so the
streams hold only phrases that reach it, and each language's count of words.

Null and empty texts have no words; a null language is ``und``. A very long
text is read in slices of whole pieces. Repeated rows count each. Extra
columns are ignored. An empty table gives no rows. Ties in score and count go
by the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_rows, byte_class, materialize, mix, text_buffer
from tessera.llm.words import encode, slice_documents, slices, word_array, word_spans

LEAST = 10
LONGEST = 3
TOP = 2000
SCALE = 1_000_000
#: A phrase goes where a longer one that holds it has at least this percentage of its count.
COVERED = 50
UNKNOWN = "und"
#: Words of a run; the runs' distinct phrases are what is shuffled.
RUN_WORDS = 2 << 20
#: The bit table of pairs: chunks of bits, each filled by one task; 16 MB in all at any input size.
CHUNKS = 256
CHUNK_BITS = 1 << 19
PROBES = 4

_BREAK = byte_class((0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"])
_WORD = ~(_BREAK | byte_class((0x20, 0x20), (0x09, 0x09)))
COUNTED = "key string, count long"


def _join(left, right, by: bytes) -> pa.Array:
    return pc.binary_join_element_wise(left, right, pa.scalar(by, pa.large_binary()))


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit numbers of words for the bit table; equal words have equal numbers."""
    offsets, data = text_buffer(words)
    at = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mix(data.astype(np.uint64) + (at.astype(np.uint64) << np.uint64(8)) + np.uint64(1)), out=total[1:])
    return mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64))


def _chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(3) + right)


def _probes(h: np.ndarray) -> np.ndarray:
    """Bit positions (probe x phrase) in the chunk ``h % CHUNKS``."""
    step = mix(h ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    return ((h >> np.uint64(8)) + np.arange(PROBES, dtype=np.uint64)[:, None] * step) % np.uint64(CHUNK_BITS)


def _held(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bit table may hold the phrases; False is certain."""
    at = (h % np.uint64(CHUNKS)) * np.uint64(CHUNK_BITS) + _probes(h)
    return ((table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(0)


class _Run:
    """Words of up to ``RUN_WORDS`` before their phrases are counted."""

    def __init__(self):
        self.words, self.piece, self.lang, self.n, self.pieces = [], [], [], 0, 0

    def add(self, part: np.ndarray, docs: np.ndarray, at: np.ndarray, langs: np.ndarray) -> None:
        fresh = np.zeros(len(part) + 1, bool)
        fresh[at] = True
        starts, ends = word_spans(part, _WORD, fresh[:-1])
        if not len(starts):
            return
        piece = np.cumsum(_BREAK[part] | fresh[:-1])[starts] + self.pieces
        self.pieces = int(piece[-1]) + 1
        self.words.append(word_array(part, starts, ends, _WORD))
        self.piece.append(piece)
        self.lang.append(langs[docs[np.searchsorted(at, starts, "right") - 1]])
        self.n += len(starts)

    def phrases(self, lengths: list[int], names: list[str], table: np.ndarray | None):
        """(keys, counts) of the distinct phrases of each of the lengths; length 0 is the language's words."""
        codes, words = encode(self.words)
        piece, lang = np.concatenate(self.piece), np.concatenate(self.lang)
        names = pa.array([n.encode() for n in names], pa.large_binary())
        known = None
        if table is not None:
            h = _hashes(words)[codes]
            known = _held(table, _chain(_chain(_hashes(names)[lang[:-1]], h[:-1]), h[1:]))
        for n in lengths:
            if n == 0:
                count = np.bincount(lang, minlength=len(names))
                used = np.flatnonzero(count)
                yield _join(names.take(pa.array(used)), pa.scalar(b"", pa.large_binary()), b"\t"), count[used]
                continue
            if len(codes) < n:
                continue
            alive = piece[n - 1:] == piece[:len(piece) - n + 1]
            for k in range(n - 1 if known is not None else 0):
                alive &= known[k:len(alive) + k]
            at = np.flatnonzero(alive)
            key = lang[at] * len(words) + codes[at]
            for k in range(1, n):
                if k > 1 or len(names) * len(words) ** 2 >= 1 << 62:  # numbered anew, so that the next word fits 64 bits
                    key = np.unique(key, return_inverse=True)[1].astype(np.int64)
                key = key * len(words) + codes[at + k]
            _, where, count = np.unique(key, return_index=True, return_counts=True)
            first = at[where]
            text = _join(names.take(pa.array(lang[first])), words.take(pa.array(codes[first])), b"\t")
            for k in range(1, n):
                text = _join(text, words.take(pa.array(codes[first + k])), b" ")
            yield text, count


def _count_task(lengths: list[int], bits):
    def run(batches):
        table = np.frombuffer(bits.value, np.uint8) if bits is not None else None
        names: dict[str, int] = {}
        held = _Run()

        def flush():
            for text, count in held.phrases(lengths, list(names), table):
                for lo in range(0, len(text), 100_000):
                    keys = text.slice(lo, 100_000).cast(pa.large_string()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([keys, pa.array(count[lo:lo + 100_000], pa.int64())], ["key", "count"])

        for batch in batches:
            offsets, data = text_buffer(batch.column("text"))
            langs = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], np.int64)
            for lo, hi in slices(offsets, data, _BREAK):
                held.add(data[lo:hi], *slice_documents(offsets, lo, hi), langs)
                if held.n >= RUN_WORDS:
                    yield from flush()
                    held = _Run()
        if held.n:
            yield from flush()
    return run


def _counts(documents: DataFrame, lengths: list[int], least: int, bits=None) -> DataFrame:
    """(lang, words, count) of the phrases of the lengths that reach the least count."""
    found = documents.mapInArrow(_count_task(lengths, bits), COUNTED)
    # a run sends a phrase once, so adding up before the shuffle would find little to add
    found = found.repartition("key").groupBy("key").agg(F.sum("count").alias("count"))
    found = found.where((F.col("count") >= least) | F.endswith("key", F.lit("\t")))
    phrase = F.substring_index("key", "\t", -1)  # words hold no tab
    lang = F.expr("left(key, char_length(key) - char_length(substring_index(key, '\t', -1)) - 1)")
    words = F.when(phrase == "", F.array().cast("array<string>")).otherwise(F.split(phrase, " ", -1))
    return found.select(lang.alias("lang"), words.alias("words"), "count")


def _bit_rows(batches):
    for batch in batches:
        langs, first, second = (batch.column(k).cast(pa.large_binary()) for k in ("lang", "w1", "w2"))
        h = _chain(_chain(_hashes(langs), _hashes(first)), _hashes(second))
        yield pa.RecordBatch.from_arrays([pa.array((h % np.uint64(CHUNKS)).astype(np.int32)), pa.array(h.view(np.int64))], ["chunk", "h"])


def _fill_chunk(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(CHUNK_BITS, bool)
    for batch in batches:
        bits[_probes(batch.column("h").to_numpy().view(np.uint64)).ravel()] = True
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())],
                                     ["chunk", "bits"])


def _bit_table(pairs: DataFrame):
    """The pairs' bit table as a broadcast of ``CHUNKS * CHUNK_BITS`` bits."""
    rows = pairs.select("lang", F.col("words")[0].alias("w1"), F.col("words")[1].alias("w2")).mapInArrow(_bit_rows, "chunk int, h long")
    filled = rows.groupBy("chunk").applyInArrow(_fill_chunk, "chunk int, bits binary").collect()  # at most CHUNKS rows
    table = np.zeros((CHUNKS, CHUNK_BITS // 8), np.uint8)
    for r in filled:
        table[r["chunk"]] = np.frombuffer(r["bits"], np.uint8)
    return pairs.sparkSession.sparkContext.broadcast(table.tobytes())


def _stream(table: DataFrame, order: list, below: int, name: str, out: str) -> DataFrame:
    """Adds an array ``out`` with the counts of the 0 to ``below`` words that a phrase starts with in the order."""
    size = F.size("words")
    held = [F.when(size == k, F.col("count")) for k in range(below + 1)]
    placed = materialize(table.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    place = F.struct(*order)
    ends = placed.groupBy("_range").agg(*[F.max_by(F.when(size == k, F.col("count")), F.when(size == k, place)).alias(f"e{k}")
                                          for k in range(below + 1)]).collect()  # one row a range
    last, before = [None] * (below + 1), []
    for r in sorted(ends, key=lambda r: r["_range"]):
        before.append((r["_range"], *last))
        last = [r[f"e{k}"] if r[f"e{k}"] is not None else last[k] for k in range(below + 1)]
    schema = "_range int, " + ", ".join(f"_e{k} long" for k in range(below + 1))
    before = F.broadcast(table.sparkSession.createDataFrame(before, schema))
    seen = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counts = [F.coalesce(F.last(held[k], ignorenulls=True).over(seen), F.col(f"_e{k}")) for k in range(below + 1)]
    return placed.join(before, "_range").select(*table.columns, F.array(*counts).alias(out))


def collocations(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases of two to ``longest`` words."""
    old = arrow_rows(documents.sparkSession)
    try:
        return _collocations(documents, least, longest, top)
    finally:
        documents.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def _collocations(documents: DataFrame, least: int, longest: int, top: int) -> DataFrame:
    documents = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"))
    streams = materialize(_counts(documents, [0, 1, 2], least), "counts")
    if longest > 2:
        bits = _bit_table(streams.where(F.size("words") == 2))
        longer = _counts(documents, list(range(3, longest + 1)), least, bits)
        streams = streams.unionByName(materialize(longer, "longer_counts"))
    # the words by place; a missing one is null and sorts first, so a phrase follows its prefixes
    forward = [F.get("words", F.lit(k)) for k in range(longest)]
    backward = [F.get(F.reverse("words"), F.lit(k)) for k in range(longest)]
    done = _stream(streams, ["lang", *forward], longest - 1, "prefix_order", "starts")
    done = _stream(done, ["lang", *backward], longest - 1, "suffix_order", "ends")
    done = materialize(done, "stream_counts")

    size = F.size("words")
    big = "cast({} as decimal(19,0))"
    cuts = [F.when(size > k, F.struct(F.expr(
        f"{big.format('count')} * {big.format('count')} * {SCALE} div ({big.format(f'get(starts, {k})')} * {big.format(f'get(ends, size(words) - {k})')})"
    ).alias("score"), F.lit(k).alias("k"), F.get("starts", F.lit(k)).alias("l"), F.get("ends", size - k).alias("r"))) for k in range(1, longest)]
    scored = done.where(size > 1).select("lang", "words", F.col("count").alias("a"), F.col("starts")[0].alias("n"),
                                         F.array_min(F.array_compact(F.array(*cuts))).alias("cut"))
    # A phrase is made up for by a longer one if by one that is a word longer, as that holds the rest of any other.
    gone = []
    for words, count in ((F.slice("words", 1, size - 1), F.get("starts", size - 1)), (F.slice("words", 2, size - 1), F.get("ends", size - 1))):
        covers = F.expr(f"{big.format('count')} * 100") >= count.cast("decimal(19,0)") * COVERED
        gone.append(done.where(size > 2).where(covers).select("lang", words.alias("words")))
    kept = scored
    for some in gone:
        kept = kept.join(some.hint("merge"), ["lang", "words"], "left_anti")
    kept = kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                       F.col("cut.score").alias("score"))
    # first within parts of a language, so that no task sorts a whole one
    first = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for keys in (["lang", "_part"], ["lang"]):
        if "_part" in keys:
            kept = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(256)))
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*first))).where(F.col("rank") <= top)
    return kept.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
