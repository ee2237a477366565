"""Brute force for polygons of any shape: even-odd runs over all crossings with the edges, in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd

EPS = 1e-9


def _pad(series: pd.Series, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ragged arrays -> (n, E) float matrix (nan padded) and a validity mask."""
    lens = np.fromiter((0 if v is None else len(v) for v in series.values), dtype=np.int64, count=n)
    width = int(lens.max()) if n else 0
    out = np.full((n, max(width, 1)), np.nan)
    if width:
        flat = np.concatenate([np.asarray(v, dtype=float) for v in series.values if v is not None and len(v)])
        rows = np.repeat(np.arange(n), lens)
        starts = np.repeat(np.cumsum(lens) - lens, lens)
        cols = np.arange(len(flat)) - starts
        out[rows, cols] = flat
    return out, ~np.isnan(out)


#: Most elements of one working array (rows x breakpoints x edges): 8 bytes each, about ten such arrays at a time.
WORK_ELEMENTS = 2_000_000


def _covered(mx: np.ndarray, my: np.ndarray, edges, closed: bool) -> np.ndarray:
    """Which points (rows x points) lie in their row's polygon (rows x edges)."""
    a1, b1, a2, b2, ok = (z[:, None, :] for z in edges)
    mx, my = mx[:, :, None], my[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        straddle = (b1 > my) != (b2 > my)
        x_at = (a2 - a1) * (my - b1) / (b2 - b1) + a1
        inside = (straddle & (mx < x_at) & ok).sum(axis=2) % 2 == 1
        ddx, ddy = a2 - a1, b2 - b1
        cr = ddx * (my - b1) - ddy * (mx - a1)
        tol = EPS * (np.abs(ddx) + np.abs(ddy)) * (1 + np.abs(mx) + np.abs(my))
        on = ((np.abs(cr) <= tol) & (mx >= np.minimum(a1, a2)) & (mx <= np.maximum(a1, a2))
              & (my >= np.minimum(b1, b2)) & (my <= np.maximum(b1, b2)) & ok).any(axis=2)
    return inside | on if closed else inside & ~on


def _fraction_rows(seg: list[np.ndarray], edges, closed: bool) -> np.ndarray:
    """The measure for some rows; the runs of a row go through the even-odd test a bounded block at a time."""
    x1, y1, x2, y2, t0, t1 = seg
    a1, b1, a2, b2, ok = edges
    dx, dy = x2 - x1, y2 - y1
    ex, ey = a2 - a1, b2 - b1
    with np.errstate(divide="ignore", invalid="ignore"):
        den = dx * ey - dy * ex
        tc = ((a1 - x1) * ey - (b1 - y1) * ex) / den
        dd = dx * dx + dy * dy
        tp1 = ((a1 - x1) * dx + (b1 - y1) * dy) / dd
        tp2 = ((a2 - x1) * dx + (b2 - y1) * dy) / dd
    par = den == 0
    cuts = np.concatenate([np.where(par, tp1, tc), np.where(par, tp2, np.nan)], axis=1)
    cuts = np.where(np.concatenate([ok, ok], axis=1), cuts, np.nan)
    cuts = np.where((cuts > t0) & (cuts < t1), cuts, np.nan)
    cuts = np.sort(np.concatenate([t0, t1, cuts], axis=1), axis=1)  # nan sorts last
    cuts = cuts[:, :max(2, int((~np.isnan(cuts)).sum(axis=1).max()))]
    total = np.zeros(len(x1))
    step = max(1, WORK_ELEMENTS // max(1, a1.size))
    for k in range(0, cuts.shape[1] - 1, step):
        part = cuts[:, k:k + step + 1]
        u, v = part[:, :-1], part[:, 1:]
        width = np.where(np.isnan(v), 0.0, v - u)
        mid = (u + v) / 2
        covered = _covered(x1 + mid * dx, y1 + mid * dy, edges, closed)
        total += np.where(covered & (width > 0), width, 0.0).sum(axis=1)
    return np.where(t1[:, 0] > t0[:, 0], total, 0.0)


def _slices(edge_lists: pd.Series):
    """Row numbers with edges, fewest first, in slices whose working arrays are bounded."""
    lens = np.fromiter((0 if v is None else len(v) for v in edge_lists.values), dtype=np.int64, count=len(edge_lists))
    order = np.argsort(lens, kind="stable")
    order = order[edge_lists.notna().to_numpy()[order]]
    at = 0
    while at < len(order):
        # widths ascend: take rows while a rows x edges array leaves room for a block of runs
        widest = lens[order[at:]] + 1
        fits = np.arange(1, len(widest) + 1) * widest * 8 <= WORK_ELEMENTS
        n = max(1, len(fits) if fits.all() else int(np.argmin(fits)))
        yield order[at:at + n]
        at += n


def _fraction(x1, y1, x2, y2, t0, t1, ex1, ey1, ex2, ey2, closed: bool) -> pd.Series:
    res = np.full(len(x1), np.nan)
    for idx in _slices(ex1):
        seg = [s.to_numpy(dtype=float)[idx][:, None] for s in (x1, y1, x2, y2, t0, t1)]
        a1, ok = _pad(ex1.iloc[idx], len(idx))
        edges = (a1, *[_pad(s.iloc[idx], len(idx))[0] for s in (ey1, ex2, ey2)], ok)
        res[idx] = _fraction_rows(seg, edges, closed)
    return pd.Series(res)


def fraction(x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series, t0: pd.Series, t1: pd.Series,
             ex1: pd.Series, ey1: pd.Series, ex2: pd.Series, ey2: pd.Series) -> pd.Series:
    """Measure of ``[t0, t1]`` in the closed polygon; null without edges."""
    return _fraction(x1, y1, x2, y2, t0, t1, ex1, ey1, ex2, ey2, True)


def open_fraction(x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series, t0: pd.Series, t1: pd.Series,
                  ex1: pd.Series, ey1: pd.Series, ex2: pd.Series, ey2: pd.Series) -> pd.Series:
    """Measure of ``[t0, t1]`` strictly inside the polygon; null without edges."""
    return _fraction(x1, y1, x2, y2, t0, t1, ex1, ey1, ex2, ey2, False)


def strictly_inside(px: pd.Series, py: pd.Series, ex1: pd.Series, ey1: pd.Series,
                    ex2: pd.Series, ey2: pd.Series) -> pd.Series:
    """Point strictly inside the polygon (even-odd, not on an edge); null without edges."""
    res = pd.Series([None] * len(px), dtype=object)
    for idx in _slices(ex1):
        a1, ok = _pad(ex1.iloc[idx], len(idx))
        edges = (a1, *[_pad(s.iloc[idx], len(idx))[0] for s in (ey1, ex2, ey2)], ok)
        x, y = (s.to_numpy(dtype=float)[idx][:, None] for s in (px, py))
        res.iloc[idx] = list(_covered(x, y, edges, False)[:, 0])
    return res
