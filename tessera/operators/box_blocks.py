"""Lengths of many segments in many boxes, tile by tile in blocks of arrays.

The rows of a tile (boxes first, then segments) lie together in a sorted
partition. The boxes of a tile are held, its segments stream past in Arrow
batches, and every block of boxes and segments is measured at once and summed
by what is kept of the segments. No row is made for a pair, and what leaves a
tile are sums: one row for each box and kept value, not one for each segment.

The arithmetic is that of ``spatial_join._clip_columns`` for boxes, operation
by operation, so that a segment that only touches a box has length 0 here too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Pairs measured at once, few enough for their arrays to stay in the processor's cache.
BLOCK_PAIRS = 1 << 15
#: Rows of a batch that leaves a task.
OUT_ROWS = 20_000
#: Rows measured together at least, whatever size the session gives its Arrow batches.
IN_ROWS = 10_000

#: The columns that boxes (xmin, ymin, xmax, ymax) and segments (x1, y1, x2, y2) share.
SHAPE = ["a", "b", "c", "d"]


def _axis_range(p: np.ndarray, d: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parameter ranges (box x segment) of ``lo <= p + t*d <= hi``; empty as (+inf, -inf)."""
    flat = d == 0
    by = np.where(flat, 1.0, d)
    a, b = (lo[:, None] - p) / by, (hi[:, None] - p) / by
    t_lo, t_hi = np.fmin(a, b), np.maximum(a, b)
    some = np.flatnonzero(flat)
    if len(some):
        inside = (p[some] >= lo[:, None]) & (p[some] <= hi[:, None])
        t_lo[:, some], t_hi[:, some] = np.where(inside, -np.inf, np.inf), np.where(inside, np.inf, -np.inf)
    return t_lo, t_hi


def _lengths(boxes: list[np.ndarray], segs: list[np.ndarray], t0, t1, border) -> np.ndarray:
    """Length of every segment between ``t0`` and ``t1`` in every closed box; border copies count on the box's own border only."""
    xmin, ymin, xmax, ymax = boxes
    x1, y1, x2, y2 = segs
    dx, dy = x2 - x1, y2 - y1
    x_lo, x_hi = _axis_range(x1, dx, xmin, xmax)
    y_lo, y_hi = _axis_range(y1, dy, ymin, ymax)
    lo, hi = np.maximum(np.maximum(x_lo, y_lo), t0), np.fmin(np.fmin(x_hi, y_hi), t1)
    out = np.maximum(hi - lo, 0.0) * np.sqrt(dx ** 2 + dy ** 2)
    if border.any():
        out[((border == 1) & (xmax[:, None] != x1)) | ((border == 2) & (ymax[:, None] != y1))] = 0.0
    return out


def _codes(batch: pa.RecordBatch, keep: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row's kept values, and a row that has them for each number."""
    code = np.zeros(batch.num_rows, np.int64)
    for k in keep:
        d = batch.column(k).dictionary_encode(null_encoding="encode")
        code = code * max(1, len(d.dictionary)) + d.indices.to_numpy(zero_copy_only=False)
        code = np.unique(code, return_inverse=True)[1]
    row = np.zeros(int(code.max(initial=-1)) + 1, np.int64)
    row[code] = np.arange(len(code))
    return code, row


class _Tile:
    """The boxes of the tile that is being read."""

    def __init__(self):
        self.boxes, self.ids = [], []

    def add(self, shape: list[np.ndarray], ids: pa.Array) -> None:
        self.boxes.append(shape), self.ids.append(ids)

    def whole(self) -> tuple[list[np.ndarray], pa.Array]:
        if len(self.ids) > 1:
            self.boxes, self.ids = [[np.concatenate(x) for x in zip(*self.boxes)]], [pa.concat_arrays(self.ids)]
        return self.boxes[0], self.ids[0]


def _sums(boxes, segs, t0, t1, border, code) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(boxes, codes, lengths summed over the segments of the code) for the sums that are not 0."""
    order = np.argsort(code, kind="stable")
    segs, t0, t1, border, code = [x[order] for x in segs], t0[order], t1[order], border[order], code[order]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1])
    step = max(1, BLOCK_PAIRS // len(code))
    for lo in range(0, len(boxes[0]), step):
        got = np.add.reduceat(_lengths([x[lo:lo + step] for x in boxes], segs, t0, t1, border), starts, axis=1)
        box, at = np.nonzero(got)
        if len(box):
            yield lo + box, code[starts[at]], got[box, at]


def _at_least(batches, rows: int) -> Iterator[pa.RecordBatch]:
    """The batches, small ones joined to at least so many rows: sums are made for each."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield held[0] if len(held) == 1 else pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield held[0] if len(held) == 1 else pa.concat_batches(held)


def box_lengths(keys: list[str], keep: list[str], names: list[str]):
    """For ``mapInArrow`` over rows sorted by ``keys`` and ``is_seg``: grid_id, ``keep`` and the lengths' sums."""
    def run(batches):
        tile, last = _Tile(), None
        held, rows = [], 0
        for batch in _at_least(batches, IN_ROWS):
            if not batch.num_rows:
                continue
            key = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            is_seg = batch.column("is_seg").to_numpy(zero_copy_only=False).astype(bool)
            shape = [batch.column(c).to_numpy(zero_copy_only=False) for c in SHAPE]
            t0, t1 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("t0", "t1"))
            border = batch.column("border").to_numpy(zero_copy_only=False)
            code, code_row = _codes(batch, keep)
            change = is_seg[1:] != is_seg[:-1]
            for k in key:
                change |= k[1:] != k[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                here = tuple(k[lo] for k in key)
                if here != last:
                    tile, last = _Tile(), here
                if not is_seg[lo]:
                    tile.add([x[lo:hi] for x in shape], batch.column("grid_id").slice(lo, hi - lo))
                elif tile.ids:
                    boxes, ids = tile.whole()
                    for box, at, length in _sums(boxes, [x[lo:hi] for x in shape], t0[lo:hi], t1[lo:hi], border[lo:hi], code[lo:hi]):
                        of = pa.array(code_row[at])
                        held.append([ids.take(pa.array(box)), *[batch.column(k).take(of) for k in keep], pa.array(length)])
                        rows += len(length)
                        if rows >= OUT_ROWS:
                            yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(*held)], names)
                            held, rows = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(*held)], names)
    return run
