"""Sharding along a Hilbert curve over several metadata dimensions.

Language, source and size are quantised to ``BITS`` bits each at approximate
quantiles (names by their first seven bytes), so that a step of a coordinate
is a range of values and holds about as many rows as any other; a document's
cell gets its index on the Hilbert curve, and the documents are sorted by it
(then by hashes and id, which spreads a cell of any size over partitions). The
order is cut into runs of equal row counts, one for each shard, so a shard
covers a compact region and a reader that filters on any of the dimensions can
skip shards by their minima and maxima.

Only light columns are sorted; the texts stay where they are. Null metadata
have a cell of their own; a null text has no bytes; equal rows may swap slots;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tessera.llm.common import ranked

BITS = 5
SHARDS = 24


def hilbert_index(cells: list[np.ndarray], bits: int) -> np.ndarray:
    """The place of cells (one array of coordinates for each dimension) on the Hilbert curve.

    Coordinates become the curve's transposed index by undoing, bit by bit, the
    rotations and reflections of the sub-cubes, then a Gray decoding.
    """
    x = [c.astype(np.int64).copy() for c in cells]
    n = len(x)
    for bit in reversed(range(1, bits)):
        q = 1 << bit
        for k in range(n):
            flip = (x[k] & q) != 0
            x[0] = np.where(flip, x[0] ^ (q - 1), x[0])
            swap = np.where(flip, 0, (x[0] ^ x[k]) & (q - 1))
            x[0], x[k] = (x[0] ^ swap, x[k] ^ swap) if k else (x[0], x[k])
    for k in range(1, n):
        x[k] ^= x[k - 1]
    gray = np.zeros_like(x[0])
    for bit in reversed(range(1, bits)):
        gray = np.where(x[-1] & (1 << bit), gray ^ ((1 << bit) - 1), gray)
    out = np.zeros_like(x[0])
    for bit in reversed(range(bits)):
        for k in range(n):
            out = out << 1 | ((x[k] ^ gray) >> bit & 1)
    return out


@F.pandas_udf(LongType())
def _hilbert(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
    return pd.Series(hilbert_index([a.to_numpy(), b.to_numpy(), c.to_numpy()], BITS))


def _by_quantiles(documents: DataFrame, values: dict, steps: int) -> list:
    """Coordinates 1 to ``steps`` of numbers, 0 for null: how many of the ``steps - 1`` approximate quantiles a value passes.

    A value that is several quantiles passes them all at once, so that the coordinates of few values lie far apart.
    """
    at = F.array(*[F.lit(k / steps) for k in range(1, steps)])
    cuts = documents.agg(*[F.percentile_approx(v, at, 10_000).alias(c) for c, v in values.items()]).first()
    out = []
    for c, v in values.items():
        over = F.lit(1)
        for cut in cuts[c] or ():
            over = over + (v > F.lit(cut)).cast("int")
        out.append(F.when(v.isNull(), 0).otherwise(over).cast("int"))
    return out


def _name_order(c: str):
    """A string's first seven bytes as a number: in byte order."""
    return F.conv(F.rpad(F.hex(F.substring(F.col(c).cast("string").cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per document (doc_id, text, lang, source): size, CRC, curve cell, shard and slot; counts differ by one at most."""
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long") + 8
    most = (1 << BITS) - 1
    cells = _by_quantiles(documents, {"lang": _name_order("lang"), "source": _name_order("source"), "size": size}, most)
    light = documents.select(F.col("doc_id").cast("long"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                             _hilbert(*cells).alias("curve"))
    keys = ["curve", F.xxhash64("doc_id", "text_crc32"), "doc_id", "size", "text_crc32"]
    placed = ranked(light, keys, "curve_order")
    total = max(1, placed.count())
    number = F.expr(f"rank * {shards}L div {total}L")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", number.cast("int")).withColumn("slot", F.col("rank") - first).drop("rank")


def write_shards(documents: DataFrame, places: DataFrame, path: str) -> None:
    """Write ``documents`` in curve order, a folder for each shard; ``places`` is :func:`shard` of them (unique ids)."""
    rows = documents.join(places.select("doc_id", "shard", "slot"), "doc_id")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
