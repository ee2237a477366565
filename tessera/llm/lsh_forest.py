"""Approximate nearest neighbours by a hash-prefix forest.

Every vector gets, for each of ``TREES`` trees, a hash string of ``BITS`` bits
(the sides of random hyperplanes through the vectors' centre). A tree is the
sorted array of its strings. A query descends in every tree to the longest
prefix that some vector shares with it, then ascends in all trees at once, bit
by bit, until the subtrees above it hold ``candidates`` entries; these are
ranked by exact Euclidean distance in double precision.

The rows are dealt over blocks by a hash of their id, each with a forest of its
own of bounded size, and the stated queries go to every block in blocks of
``QUERY_ROWS``; every block returns its nearest, and those are merged. So every
row is indexed, and recall does not fall as the table grows. Equal vectors of a
block share an entry, so copies cost nothing and ties go to smaller ids.

Vectors that are null, zero or hold a null or non-finite component take no
part. Vectors of other lengths than the query's are no candidates. A row with
the query's id is its own; repeated candidates with one id count once, repeated
queries once. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize

TREES = 24
BITS = 32
BLOCK_ROWS = 4096
QUERY_ROWS = 20_000
NEAREST = 10
#: Entries to gather in a block over all trees, as a share of the block's entries times the trees, for any number of rows
#: and any length; the ascent goes by halves, so a share over 1/16 takes about 1/8 in the trees that are cut evenly.
SHARE = 0.064
SEED = 7


class Forest:
    """Sorted hash strings of the distinct vectors of a block."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS):
        rng = np.random.default_rng(SEED)
        self.vectors, self.bits = vectors, bits
        self.centre = vectors.mean(0)
        self.planes = rng.standard_normal((trees, bits, vectors.shape[1]))
        codes = self.codes(vectors)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, 1)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Hash strings (tree x vector) as numbers, the first bit the highest."""
        out = np.zeros((len(self.planes), len(vectors)), np.uint64)
        for t, planes in enumerate(self.planes):
            for bit in ((vectors - self.centre) @ planes.T > 0).T:
                out[t] = out[t] << np.uint64(1) | bit.astype(np.uint64)
        return out

    def candidates(self, queries: np.ndarray, enough: int):
        """For each query the numbers of the vectors below the prefixes it ascends to."""
        codes = self.codes(queries)
        low = np.zeros((self.bits + 1, *codes.shape), np.int32)
        high = np.full_like(low, len(self.vectors))
        for level in range(1, self.bits + 1):
            cut = np.uint64(self.bits - level)
            for t, row in enumerate(self.sorted):
                prefix = codes[t] >> cut
                low[level, t] = np.searchsorted(row, prefix << cut)
                high[level, t] = np.searchsorted(row, (prefix + np.uint64(1)) << cut)
        held = (high - low).sum(1)  # level x query, falling with the level
        level = (held >= min(enough, len(self.planes) * len(self.vectors))).sum(0) - 1
        for q, x in enumerate(level):
            yield np.unique(np.concatenate([self.order[t, low[x, t, q]:high[x, t, q]] for t in range(len(self.planes))]))


FOUND = "query_id long, vec_id long, score double"


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def _search_block(nearest: int, share: float):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        none = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not rows.num_rows or not queries.num_rows:
            return none
        ids, vectors = rows.column("vec_id").to_numpy(), _vectors(rows.column("vector"))
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        vectors += 0.0  # one zero only
        _, first, entry = np.unique(vectors.view([("", vectors.dtype)] * vectors.shape[1]).ravel(), return_index=True, return_inverse=True)
        members = np.argsort(entry, kind="stable")  # an entry's ids ascend
        start = np.searchsorted(entry[members], np.arange(len(first) + 1))
        forest = Forest(vectors[first])
        query_ids, query_vectors = queries.column("vec_id").to_numpy(), _vectors(queries.column("vector"))
        enough = int(share * TREES * len(first))
        out_query, out_id, out_score = [], [], []
        for base in range(0, len(query_ids), 512):
            part = query_vectors[base:base + 512]
            for k, near in enumerate(forest.candidates(part, enough)):
                own = query_ids[base + k]
                distance = np.sqrt(((forest.vectors[near] - part[k]) ** 2).sum(1))
                keep = near
                if len(near) > nearest + 1:
                    limit = np.partition(distance, nearest)[nearest]
                    keep, distance = near[distance <= limit], distance[distance <= limit]
                got = [(d, i) for d, e in zip(distance.tolist(), keep.tolist())
                       for i in np.unique(ids[members[start[e]:start[e + 1]]])[:nearest + 1].tolist() if i != own]
                for d, i in sorted(got)[:nearest]:
                    out_query.append(own), out_id.append(i), out_score.append(d)
        return pa.table({"query_id": pa.array(out_query, pa.int64()), "vec_id": pa.array(out_id, pa.int64()), "score": pa.array(out_score, pa.float64())})
    return run


def search(embeddings: DataFrame, is_query, nearest: int = NEAREST, share: float = SHARE) -> DataFrame:
    """For the rows of ``embeddings`` (vec_id, embedding) where ``is_query``: query_id, rank, vec_id, score."""
    number = F.col("embedding").cast("array<double>")
    sound = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~F.exists(
        number, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(number, lambda x: x != 0)
    rows = embeddings.where(F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long"), number.alias("vector"), F.size("embedding").alias("d"))
    counts = {r["d"]: r["count"] for r in rows.groupBy("d").count().collect()}  # one row for each length of vectors
    queries = materialize(rows.where(is_query).distinct(), "queries")
    asked = {r["d"]: r["count"] for r in queries.groupBy("d").count().collect()}
    sizes = [(d, -(-n // BLOCK_ROWS), max(1, -(-asked.get(d, 0) // QUERY_ROWS))) for d, n in counts.items()]
    sizes = F.broadcast(rows.sparkSession.createDataFrame(sizes, "d int, blocks int, sets int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = F.xxhash64("vec_id")
    index = rows.join(sizes, "d").withColumn("block", F.pmod(place, "blocks").cast("int")).withColumn("set", every("sets"))
    asks = queries.join(sizes, "d").withColumn("set", F.pmod(place, "sets").cast("int")).withColumn("block", every("blocks"))
    keys = ["d", "block", "set"]
    found = index.select(*keys, "vec_id", "vector").groupBy(*keys).cogroup(asks.select(*keys, "vec_id", "vector").groupBy(*keys)).applyInArrow(
        _search_block(nearest, share), FOUND)
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
