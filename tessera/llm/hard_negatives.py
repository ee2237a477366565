"""Hard negatives by a vertical scan with branch and bound (BOND).

Rows are kept in blocks, dimension after dimension, with every dimension's
minimum and maximum in the block. For an anchor the dimensions are read in the
descending order of the anchor's own magnitudes. After each few of them, the
products read so far plus the least and most that the unread dimensions can
add (from the minima and maxima) bound every row's score, and rows whose
bounds decide against them leave the candidate bitmap. The few rows that stay
to the end have exact scores.

Two scans for each set of at most ``ANCHOR_ROWS`` anchors, the only thing that
is broadcast: the first finds the nearest rows of the anchor's label (the
positives), the second, in the score windows that these open, the nearest rows
of other labels. A task keeps the best of its blocks for each anchor; the
tasks' short lists are merged by anchor.

Components become ``floor(256 * x)`` and scores are integers: exact in double
precision while no score can reach 2^53, in 64-bit integers while none can
reach 2^63; beyond, a ValueError says so. Vectors of another length than the
anchor's are no candidates. Rows with a null label or vector or a null or
non-finite component take no part. A null id is no anchor and comes after all
other ids in ties. Repeated rows are rows of their own: an anchor is only not
its own candidate. Anchors with one id and equal results show them once each.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_rows, materialize, ranked

POSITIVES = 5
NEGATIVES = 5
#: Negatives score from this percentage of the positive's score up to the whole of it.
WINDOW = (80, 100)
LEVELS = 256
ANCHOR_ROWS = 2048
BLOCK_VALUES = 1 << 19
#: Dimensions read between two tests of the bounds.
STEP = 8
NO_ID = (1 << 63) - 1

BLOCKS = "d int, n int, ids binary, rows binary, labels binary, columns binary"
_KINDS = {2: np.int16, 4: np.int32, 8: np.int64}


def _block_task(batches):
    """Blocks of up to ``BLOCK_VALUES`` components of equal vector lengths, dimension after dimension."""
    for batch in batches:
        lengths = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
        for d in np.unique(lengths):
            some = batch.filter(pa.array(lengths == d))
            rows = max(1, BLOCK_VALUES // max(1, int(d)))
            for lo in range(0, some.num_rows, rows):
                part = some.slice(lo, rows)
                n = part.num_rows
                values = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, d)
                values = np.floor(LEVELS * values)
                most = np.abs(values).max(initial=0)
                if most >= 2.0 ** 62:
                    raise ValueError("a quantised component does not fit 64 bits")
                kind = next(k for k in (2, 4, 8) if most < 2.0 ** (8 * k - 1))
                out = [part.column(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "rank", "label")]
                columns = np.ascontiguousarray(values.T.astype(_KINDS[kind])).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([n], pa.int32()), *[
                    pa.array([x], pa.binary()) for x in (*out, columns)]], ["d", "n", "ids", "rows", "labels", "columns"])


class Block:
    """Rows of one vector length, dimension after dimension."""

    def __init__(self, d: int, n: int, ids: bytes, rows: bytes, labels: bytes, columns: bytes):
        self.ids, self.rows, self.labels = (np.frombuffer(x, np.int64) for x in (ids, rows, labels))
        kind = _KINDS[len(columns) // (d * n)] if d else np.int16
        self.columns = np.frombuffer(columns, kind).reshape(d, n)
        self.least, self.most = (f(1).astype(np.int64) if d else np.zeros(0, np.int64) for f in (self.columns.min, self.columns.max))

    def number_kind(self, anchor: np.ndarray):
        """The narrowest type in which no partial score of the anchor can overflow."""
        bound = sum(abs(int(a)) * max(abs(int(x)), abs(int(y))) for a, x, y in zip(anchor, self.least, self.most))
        if bound >= 1 << 63:
            raise ValueError("a score does not fit 64 bits")
        return np.float64 if bound < 1 << 53 else np.int64

    def scan(self, anchor: np.ndarray, alive: np.ndarray, keep):
        """(rows left, their exact scores); ``keep(low, high)`` says which rows of the bounds may still matter."""
        kind = self.number_kind(anchor)
        a, least, most = anchor.astype(kind), self.least.astype(kind), self.most.astype(kind)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([a * least, a * most])[:, order]
        # what the unread dimensions add at least and at most, by the number of dimensions read
        rest = np.zeros((2, len(order) + 1), kind)
        rest[0, :-1], rest[1, :-1] = ends.min(0)[::-1].cumsum()[::-1], ends.max(0)[::-1].cumsum()[::-1]
        left = np.flatnonzero(alive)
        score = np.zeros(len(left), kind)
        for at in range(0, len(order), STEP):
            if not len(left):
                break
            dims = order[at:at + STEP]
            whole = len(left) > self.columns.shape[1] // 2
            for k in dims:  # a dimension is one run of memory
                column = self.columns[k]
                score += (column if whole and len(left) == len(column) else column[left]) * a[k]
            done = min(at + STEP, len(order))
            stay = keep(score + rest[0, done], score + rest[1, done], left)
            if not stay.all():
                left, score = left[stay], score[stay]
        return left, score.astype(np.int64)


class Best:
    """The first ``k`` rows by descending score and ascending (id, row)."""

    def __init__(self, k: int):
        self.k, self.items = k, []

    def floor(self):
        """A score under which no row gets in."""
        return self.items[-1][0] * -1 if len(self.items) == self.k else None

    def add(self, scores, ids, rows) -> None:
        if len(scores) > self.k:  # all ties of the last place stay
            limit = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            some = scores >= limit
            scores, ids, rows = scores[some], ids[some], rows[some]
            if len(scores) > 4 * self.k:
                some = np.lexsort((rows, ids, -scores))[:self.k]
                scores, ids, rows = scores[some], ids[some], rows[some]
        self.items = sorted(self.items + list(zip((-scores).tolist(), ids.tolist(), rows.tolist())))[:self.k]


def _blocks(batches):
    for batch in batches:
        for r in batch.to_pylist():
            yield r["d"], Block(**r)


def _same_label(block: Block, vector, label, row, best: Best):
    def keep(low, high, left):
        floor = best.floor()
        if len(low) > best.k:
            least = np.partition(low, len(low) - best.k)[len(low) - best.k]
            floor = least if floor is None else max(floor, least)
        return np.ones(len(high), bool) if floor is None else high >= floor
    left, score = block.scan(vector, (block.labels == label) & (block.rows != row), keep)
    best.add(score, block.ids[left], block.rows[left])


def _other_label(block: Block, vector, label, windows: list[tuple[int, int]], best: list[Best]):
    def keep(low, high, left):
        stay = np.zeros(len(low), bool)
        for (least, most), b in zip(windows, best):
            floor = b.floor()
            stay |= (high >= (least if floor is None else max(least, floor))) & (low <= most)
        return stay
    left, score = block.scan(vector, block.labels != label, keep)
    for (least, most), b in zip(windows, best):
        some = (score >= least) & (score <= most)
        b.add(score[some], block.ids[left[some]], block.rows[left[some]])


FOUND = "anchor long, positive long, score long, id long, row long"


def _rows(found) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["anchor", "positive", "score", "id", "row"])


def _positive_task(anchors, positives: int):
    def run(batches):
        asked = anchors.value
        best = [Best(positives) for _ in asked]
        for d, block in _blocks(batches):
            for (row, label, vector), b in zip(asked, best):
                if len(vector) == d:
                    _same_label(block, vector, label, row, b)
        yield _rows([(a[0], 0, -s, i, r) for a, b in zip(asked, best) for s, i, r in b.items])
    return run


def _negative_task(anchors, windows, negatives: int):
    def run(batches):
        asked, opened = anchors.value, windows.value
        best = [[Best(negatives) for _ in opened.get(a[0], ())] for a in asked]
        for d, block in _blocks(batches):
            for (row, label, vector), b in zip(asked, best):
                if b and len(vector) == d:
                    _other_label(block, vector, label, [w[1:] for w in opened[row]], b)
        yield _rows([(a[0], w[0], -s, i, r) for a, bs in zip(asked, best) for w, b in zip(opened.get(a[0], ()), bs) for s, i, r in b.items])
    return run


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def window_of(score: int, window: tuple[int, int] = WINDOW) -> tuple[int, int]:
    """Least and most whole score within the percentages of a positive's score."""
    return -(-window[0] * score // 100), window[1] * score // 100


def hard_negatives(embeddings: DataFrame, is_anchor, label=None, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int] = WINDOW) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows (vec_id, embedding, label) where ``is_anchor``."""
    spark = embeddings.sparkSession
    label = F.col("label") if label is None else label
    old = arrow_rows(spark, 4096)
    try:
        number = F.col("embedding").cast("array<double>")
        sound = F.col("embedding").isNotNull() & label.isNotNull() & ~F.exists(
            number, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        rows = embeddings.where(F.coalesce(sound, F.lit(False))).select(
            F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"), label.cast("long").alias("label"), number.alias("vector"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.xxhash64(number).alias("h"))
        rows = materialize(ranked(rows, ["id", "h"], "rows"), "ranked_rows")
        blocks = materialize(rows.select("id", "rank", "label", "vector").mapInArrow(_block_task, BLOCKS), "blocks")
        anchors = materialize(ranked(rows.where("anchor").select(F.col("rank").alias("row"), "id", "label", "vector"), ["row"], "anchors"), "anchor_rows")
        n = anchors.count()
        out = None
        for lo in range(0, n, ANCHOR_ROWS):
            got = _mine(blocks, anchors.where((F.col("rank") >= lo) & (F.col("rank") < lo + ANCHOR_ROWS)), positives, negatives, window)
            got = materialize(got, "negatives")
            out = got if out is None else out.unionByName(got)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    if out is None:
        out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return out.select("anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")


def _mine(blocks: DataFrame, anchors: DataFrame, positives: int, negatives: int, window) -> DataFrame:
    """The negatives of a set of at most ``ANCHOR_ROWS`` anchors."""
    spark = blocks.sparkSession
    some = anchors.collect()  # at most ANCHOR_ROWS
    ids = {r["row"]: r["id"] for r in some}
    asked = [(r["row"], r["label"], np.floor(LEVELS * np.array(r["vector"], np.float64)).astype(np.int64)) for r in some]
    asked = spark.sparkContext.broadcast(asked)
    found = _first(blocks.mapInArrow(_positive_task(asked, positives), FOUND), ["anchor"], positives).collect()  # as many for each anchor
    opened: dict[int, list] = {}
    for r in sorted(found, key=lambda r: (r["anchor"], r["place"])):
        least, most = window_of(r["score"], window)
        opened.setdefault(r["anchor"], []).append((r["place"], least, most))
    places = [(ids[r["anchor"]], r["anchor"], r["place"], r["id"], r["score"]) for r in found]
    places = spark.createDataFrame(places, "anchor_id long, anchor long, positive int, positive_id long, positive_score long")
    shared = spark.sparkContext.broadcast(opened)
    found = _first(blocks.mapInArrow(_negative_task(asked, shared, negatives), FOUND), ["anchor", "positive"], negatives)
    found = found.select("anchor", F.col("positive").cast("int"), F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(F.broadcast(places), ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
