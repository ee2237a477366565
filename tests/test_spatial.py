"""Border semantics and shapes of the tile-keyed spatial joins (hand-made cases)."""

import math
import random

import numpy as np
import pytest
from conftest import boxes, lines, points, polygons
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.operators import spatial_join as sj


def _lengths(spark, grid, lns, **kw):
    idx = sj.index_cells(grid, **kw)
    pieces = sj.clip_lines_to_cells(idx, lns, "geom", ["id"])
    return {(r["grid_id"], r["id"]): r["seg_len"] for r in sj.pair_lengths(pieces, ["id"]).collect()}


def _counts(spark, grid, pts, **kw):
    idx = sj.index_cells(grid, **kw)
    got = sj.points_in_cells(idx, pts, "geom", ["id"])
    return sorted((r["grid_id"], r["id"]) for r in got.collect())


TWO = [(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0)]


def test_point_on_shared_border_is_in_neither_cell(spark):
    pts = points(spark, [(1, 10.0, 5.0), (2, 5.0, 5.0), (3, 15.0, 0.0)])
    assert _counts(spark, boxes(spark, TWO), pts) == [(1, 2)]


def test_line_along_shared_border_counts_in_both(spark):
    got = _lengths(spark, boxes(spark, TWO), lines(spark, [(7, [(10, 2), (10, 8)])]))
    assert got == {(1, 7): pytest.approx(6.0), (2, 7): pytest.approx(6.0)}


def test_line_touching_a_corner_has_no_row(spark):
    got = _lengths(spark, boxes(spark, [(1, 0.0, 0.0, 10.0, 10.0)]), lines(spark, [(1, [(10, 10), (20, 20)])]))
    assert got == {}


def test_line_across_a_cell(spark):
    got = _lengths(spark, boxes(spark, [(1, 0.0, 0.0, 10.0, 10.0)]), lines(spark, [(1, [(-5, 5), (20, 5)])]))
    assert got == {(1, 1): pytest.approx(10.0)}


def test_zero_length_line_is_dropped(spark):
    got = _lengths(spark, boxes(spark, [(1, 0.0, 0.0, 10.0, 10.0)]), lines(spark, [(1, [(3, 3), (3, 3)])]))
    assert got == {}


def test_polygon_cell_with_hole(spark):
    outer = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    hole = [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]
    grid = polygons(spark, [(1, [outer, hole])])
    got = _lengths(spark, grid, lines(spark, [(1, [(0, 5), (10, 5)])]))
    assert got == {(1, 1): pytest.approx(8.0)}
    pts = points(spark, [(1, 5.0, 5.0), (2, 2.0, 2.0), (3, 4.0, 5.0)])
    assert _counts(spark, grid, pts) == [(1, 2)]


def test_concave_cell_sums_both_arms(spark):
    # U shape: arms x in [0,3] and [7,10], joined below y = 3
    u = [(0, 0), (10, 0), (10, 10), (7, 10), (7, 3), (3, 3), (3, 10), (0, 10), (0, 0)]
    grid = polygons(spark, [(1, [u])])
    got = _lengths(spark, grid, lines(spark, [(1, [(-1, 5), (11, 5)]), (2, [(5, -1), (5, 11)]),
                                              (3, [(3, 5), (3, 8)])]))
    assert got[(1, 1)] == pytest.approx(6.0)   # 3 + 3 inside the two arms
    assert got[(1, 2)] == pytest.approx(3.0)   # base only
    assert got[(1, 3)] == pytest.approx(3.0)   # along the inner border of the left arm


def test_triangle_cells_split_a_box(spark):
    tri_lo = [(0, 0), (10, 0), (10, 10), (0, 0)]
    tri_up = [(0, 0), (10, 10), (0, 10), (0, 0)]
    grid = polygons(spark, [(1, [tri_lo]), (2, [tri_up])])
    got = _lengths(spark, grid, lines(spark, [(1, [(0, 5), (10, 5)]), (2, [(0, 0), (10, 10)])]))
    assert got[(1, 1)] == pytest.approx(5.0)
    assert got[(2, 1)] == pytest.approx(5.0)
    diag = math.sqrt(200)
    assert got[(1, 2)] == pytest.approx(diag) and got[(2, 2)] == pytest.approx(diag)
    pts = points(spark, [(1, 8.0, 2.0), (2, 2.0, 8.0), (3, 5.0, 5.0)])
    assert _counts(spark, grid, pts) == [(1, 1), (2, 2)]


def test_overlapping_cells_count_a_point_in_each(spark):
    grid = boxes(spark, [(1, 0.0, 0.0, 10.0, 10.0), (2, 5.0, 5.0, 15.0, 15.0)])
    assert _counts(spark, grid, points(spark, [(1, 7.0, 7.0)])) == [(1, 1), (2, 1)]


def test_long_diagonal_in_small_tiles_keeps_its_length(spark):
    cells = [(i * 10 + j + 1, 10.0 * i, 10.0 * j, 10.0 * i + 10, 10.0 * j + 10)
             for i in range(10) for j in range(10)]
    grid = boxes(spark, cells)
    ln = lines(spark, [(1, [(0.5, 1.5), (99.0, 97.25)]), (2, [(0, 100), (100, 0)]), (3, [(0, 30), (100, 30)])])
    got = _lengths(spark, grid, ln, tile=7.0)
    total = {}
    for (_, lid), v in got.items():
        total[lid] = total.get(lid, 0.0) + v
    assert total[1] == pytest.approx(math.hypot(98.5, 95.75))
    assert total[2] == pytest.approx(math.hypot(100, 100))
    # a line on the shared border y = 30 counts in the cells above and below
    assert total[3] == pytest.approx(200.0)


def test_salted_shuffle_path_equals_broadcast_path(spark):
    cells = [(i * 4 + j + 1, 10.0 * i, 10.0 * j, 10.0 * i + 10, 10.0 * j + 10) for i in range(4) for j in range(4)]
    grid = boxes(spark, cells)
    pts = points(spark, [(k, 1.0 + (k % 7), 2.0 + (k % 5)) for k in range(300)]
                 + [(1000 + k, 15.0 + (k % 20) * 0.9, 25.0 + (k % 3)) for k in range(60)])
    ln = lines(spark, [(k, [(k % 40, 0.5), (40 - k % 37, 39.5)]) for k in range(50)])
    small = dict(broadcast_bytes=0, hot_tile_rows=20)
    assert _counts(spark, grid, pts) == _counts(spark, grid, pts, **small)
    a = _lengths(spark, grid, ln)
    b = _lengths(spark, grid, ln, **small)
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k])


def test_shuffled_path_plan_has_no_broadcast_of_cells(spark):
    grid = boxes(spark, TWO)
    idx = sj.index_cells(grid, broadcast_bytes=0, hot_tile_rows=10)
    pts = points(spark, [(1, 5.0, 5.0)])
    plan = sj.points_in_cells(idx, pts, "geom", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan


def test_null_geometry_rows_are_ignored(spark):
    grid = boxes(spark, TWO)
    pts = points(spark, [(1, 5.0, 5.0)]).unionByName(
        spark.createDataFrame([(2,)], "id long").withColumn("geom", F.lit(None).cast(
            "struct<kind:string,parts:array<array<struct<x:double,y:double>>>,poly_rings:array<int>>")))
    assert _counts(spark, grid, pts) == [(1, 1)]


def test_border_lines_with_cell_aligned_tiles(spark):
    cells = [(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0),
             (3, 0.0, 10.0, 10.0, 20.0), (4, 10.0, 10.0, 20.0, 20.0)]
    grid = boxes(spark, cells)
    ln = lines(spark, [(1, [(10, 5), (10, 15)]),      # vertical on the inner border
                       (2, [(5, 10), (15, 10)]),      # horizontal on the inner border
                       (3, [(20, 2), (20, 8)]),       # on the outer right border
                       (4, [(2, 20), (4, 20)]),       # on the outer top border
                       (5, [(0, 3), (0, 4)])])        # on the outer left border
    for tile in (10.0, 5.0, 20.0, 3.0):
        got = _lengths(spark, grid, ln, tile=tile)
        want = {(1, 1): 5.0, (2, 1): 5.0, (3, 1): 5.0, (4, 1): 5.0,
                (1, 2): 5.0, (3, 2): 5.0, (2, 2): 5.0, (4, 2): 5.0,
                (2, 3): 6.0, (3, 4): 2.0, (1, 5): 1.0}
        assert got.keys() == want.keys(), tile
        for k, v in want.items():
            assert got[k] == pytest.approx(v), (tile, k)


def _perimeters(spark, grid, areas, **kw):
    idx = sj.index_cells(grid, **kw)
    pieces = sj.clip_lines_to_cells(idx, areas, "geom", ["area"], areas=True)
    return {(r["grid_id"], r["area"]): r["seg_len"] for r in sj.pair_lengths(pieces, ["area"]).collect()}


def _box_ring(x1, y1, x2, y2):
    return [(x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1)]


@pytest.mark.parametrize("kw", [{}, {"broadcast_bytes": 0, "hot_tile_rows": 1}])
def test_area_counts_the_cell_border_inside_it(spark, kw):
    rows = [(1, [_box_ring(5, 2, 15, 6)]),       # over both cells
            (2, [_box_ring(0, 0, 10, 10)]),      # equal to the first cell, touches the second
            (3, [_box_ring(-5, -5, 25, 15)]),    # covers both
            (4, [_box_ring(2, 2, 4, 4)]),        # inside the first
            (5, [_box_ring(10, 10, 12, 12)]),    # touches the second from above
            (6, [_box_ring(-5, -5, 25, 15), _box_ring(2, 2, 4, 4)])]  # a hole in the first
    areas = polygons(spark, rows).withColumnRenamed("id", "area")
    got = _perimeters(spark, boxes(spark, TWO), areas, **kw)
    want = {(1, 1): 18.0, (2, 1): 18.0, (1, 2): 40.0, (2, 2): 10.0, (1, 3): 40.0, (2, 3): 40.0, (1, 4): 8.0,
            (2, 5): 2.0, (1, 6): 48.0, (2, 6): 40.0}
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_areas_in_a_concave_cell_and_concave_areas(spark):
    ell = [(0, 0), (10, 0), (10, 5), (5, 5), (5, 10), (0, 10), (0, 0)]
    areas = polygons(spark, [(1, [_box_ring(3, 3, 8, 8)]), (2, [ell])]).withColumnRenamed("id", "area")
    got = _perimeters(spark, polygons(spark, [(1, [ell])]), areas)
    assert got == {(1, 1): pytest.approx(20.0), (1, 2): pytest.approx(40.0)}
    got = _perimeters(spark, boxes(spark, [(1, 3.0, 3.0, 8.0, 8.0)]), areas)
    assert got == {(1, 1): pytest.approx(20.0), (1, 2): pytest.approx(20.0)}


def test_areas_need_the_flag(spark):
    areas = polygons(spark, [(1, [_box_ring(5, 2, 15, 6)])])
    with pytest.raises(Exception, match="areas=True"):
        _lengths(spark, boxes(spark, TWO), areas)


def test_a_line_layer_with_areas_keeps_its_lines(spark):
    both = lines(spark, [(7, [(2, 2), (5, 2)])]).unionByName(polygons(spark, [(8, [_box_ring(2, 2, 4, 4)])]))
    got = _perimeters(spark, boxes(spark, TWO), both.withColumnRenamed("id", "area"))
    assert got == {(1, 7): pytest.approx(3.0), (1, 8): pytest.approx(8.0)}


def _multipoints(spark, rows):
    df = spark.createDataFrame([(i, [[{"x": float(x), "y": float(y)}] for x, y in pts]) for i, pts in rows],
                               "id long, parts array<array<struct<x:double,y:double>>>")
    return df.select("id", G.make_geometry("MultiPoint", F.col("parts")).alias("geom"))


@pytest.mark.parametrize("shape", ["box", "triangles", "ell"])
def test_multipoints_are_contained_as_a_whole(spark, shape):
    if shape == "box":
        grid = boxes(spark, TWO)
    elif shape == "triangles":
        grid = polygons(spark, [(1, [[(0, 0), (10, 0), (0, 20), (0, 0)]])])
    else:
        grid = polygons(spark, [(1, [[(0, 0), (10, 0), (10, 5), (5, 5), (5, 10), (0, 10), (0, 0)]])])
    pts = _multipoints(spark, [(1, [(1, 1), (2, 2), (15, 5)]),    # a member outside
                               (2, [(1, 1), (2, 2), (2, 2)]),      # all inside, one twice
                               (3, [(0, 1), (2, 2)]),              # a member on the border
                               (4, [(0, 1), (0, 2)]),              # only on the border
                               (5, [(3, 1)]), (6, [])])
    assert _counts(spark, grid, pts, tile=1.5) == [(1, 2), (1, 3), (1, 5)]


def test_points_in_cells_takes_points_only(spark):
    with pytest.raises(Exception, match="takes points, not LineString"):
        _counts(spark, boxes(spark, TWO), lines(spark, [(1, [(1, 1), (2, 2), (3, 3)])]))


def test_polygon_udf_stays_within_its_memory():
    import tracemalloc

    import even_odd as P
    import pandas as pd
    n, k = 3000, 500
    turn = np.linspace(0, 2 * np.pi, k + 1)
    r = np.where(np.arange(k + 1) % 2 == 0, 10.0, 6.0)
    r[-1] = r[0]
    x, y = r * np.cos(turn), r * np.sin(turn)
    edges = [pd.Series([a] * n) for a in (x[:-1], y[:-1], x[1:], y[1:])]
    rng = np.random.default_rng(1)
    ends = [pd.Series(rng.uniform(-12, 12, n)) for _ in range(4)]
    zero, one = pd.Series(np.zeros(n)), pd.Series(np.ones(n))
    tracemalloc.start()
    got = P.fraction(*ends, zero, one, *edges).to_numpy()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 30
    some = np.arange(0, n, 100)
    alone = np.concatenate([P.fraction(*[s.iloc[[i]] for s in (*ends, zero, one, *edges)]).to_numpy() for i in some])
    assert np.allclose(got[some], alone)
    t = (np.arange(2000) + 0.5) / 2000  # sampled measure
    for i in some[:5]:
        x1, y1, x2, y2 = (s[i] for s in ends)
        px, py = x1 + t * (x2 - x1), y1 + t * (y2 - y1)
        inside = np.array([P.strictly_inside(pd.Series([a]), pd.Series([b]), *[s.iloc[[0]] for s in edges])[0] for a, b in zip(px, py)])
        assert abs(inside.mean() - got[i]) < 0.02


def test_retraced_lines_count_each_stretch_once(spark):
    grid = boxes(spark, TWO)
    rows = lines(spark, [(1, [(2, 5), (8, 5), (2, 5)]),              # there and back
                         (2, [(2, 2), (18, 2), (6, 2)]),             # part of the way back, over both cells
                         (3, [(1, 1), (4, 4), (2, 2), (7, 7)]),      # back and further on
                         (4, [(3, 3), (3, 3), (3, 7)]),              # a vertex twice
                         (5, [(1, 8), (5, 8), (5, 9), (1, 9), (1, 8), (5, 8)]),  # a ring that goes on along its first side
                         (6, [(1, 1), (9, 1), (9, 6), (1, 6)]),      # nothing twice
                         (7, [(10, 2), (10, 6), (10, 4)])])          # on the shared border
    got = _lengths(spark, grid, rows)
    want = {(1, 1): 6.0, (1, 2): 8.0, (2, 2): 8.0, (1, 3): 6 * 2 ** 0.5, (1, 4): 4.0, (1, 5): 10.0, (1, 6): 21.0, (1, 7): 4.0, (2, 7): 4.0}
    assert got == {k: pytest.approx(v) for k, v in want.items()}
    # two equal lines are two lines
    idx = sj.index_cells(grid)
    twice = rows.where("id = 1").unionByName(rows.where("id = 1"))
    assert sj.clip_lines_to_cells(idx, twice, "geom", ["id"]).groupBy("id").sum("piece_len").first()[1] == pytest.approx(12.0)


def test_a_multi_line_that_repeats_a_stretch(spark):
    parts = [[{"x": 1.0, "y": 1.0}, {"x": 9.0, "y": 1.0}], [{"x": 5.0, "y": 1.0}, {"x": 3.0, "y": 1.0}], [{"x": 8.0, "y": 1.0}, {"x": 8.0, "y": 5.0}]]
    df = spark.createDataFrame([(1, parts)], "id long, parts array<array<struct<x:double,y:double>>>")
    got = _lengths(spark, boxes(spark, TWO), df.select("id", G.make_geometry("MultiLineString", F.col("parts")).alias("geom")))
    assert got == {(1, 1): pytest.approx(12.0)}


@pytest.mark.parametrize("kw", [{}, {"tile": 3.0}, {"broadcast_bytes": 0, "hot_tile_rows": 1}])
def test_cells_of_mixed_sizes(spark, kw):
    cells = [(i, 10.0 * (i % 3), 10.0 * (i // 3), 10.0 * (i % 3) + 10, 10.0 * (i // 3) + 10) for i in range(9)]
    cells += [(20, -5000.0, -5000.0, 5000.0, 5000.0), (21, 0.0, 0.0, 30.0, 30.0), (22, 5.0, 5.0, 105.0, 25.0)]
    rng = np.random.default_rng(3)
    ends = rng.integers(-10, 40, (60, 4)).astype(float)
    grid = boxes(spark, cells)
    pts = points(spark, [(k, x, y) for k, (x, y, _, _) in enumerate(ends.tolist())])
    rows = lines(spark, [(k, [(a, b), (c, d)]) for k, (a, b, c, d) in enumerate(ends.tolist())])
    idx = sj.index_cells(grid, **kw)
    assert len(idx.levels) > 1
    found = {(r["grid_id"], r["id"]) for r in sj.points_in_cells(idx, pts).collect()}
    assert found == {(i, k) for i, x1, y1, x2, y2 in cells for k, (x, y, _, _) in enumerate(ends.tolist()) if x1 < x < x2 and y1 < y < y2}
    got = {(r["grid_id"], r["id"]): r["seg_len"] for r in sj.pair_lengths(sj.clip_lines_to_cells(idx, rows, "geom", ["id"]), ["id"]).collect()}
    want = {}
    for i, x1, y1, x2, y2 in cells:
        for k, (a, b, c, d) in enumerate(ends.tolist()):
            lo, hi = 0.0, 1.0
            for p, v, least, most in ((a, c - a, x1, x2), (b, d - b, y1, y2)):
                if v == 0:
                    lo, hi = (lo, hi) if least <= p <= most else (1.0, 0.0)
                else:
                    lo, hi = max(lo, min((least - p) / v, (most - p) / v)), min(hi, max((least - p) / v, (most - p) / v))
            if (hi - lo) * np.hypot(c - a, d - b) > 1e-9:
                want[i, k] = (hi - lo) * np.hypot(c - a, d - b)
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def _star(rng, n, x, y, least, most):
    turn = np.sort(rng.uniform(0, 2 * np.pi, n))
    r = rng.uniform(least, most, n)
    ring = [(float(np.round(x + a * np.cos(t))), float(np.round(y + a * np.sin(t)))) for a, t in zip(r, turn)]
    return ring + ring[:1]


def test_trapezoids_against_even_odd(spark):
    """Frames, combs and stars with holes on a lattice, so that points and lines meet vertices, edges and the cuts between trapezoids."""
    import even_odd as P
    import pandas as pd
    frame = [_box_ring(0, 0, 12, 12), _box_ring(3, 3, 9, 9)]
    comb = [[(20, 0), (32, 0), (32, 8), (30, 8), (30, 3), (28, 3), (28, 8), (26, 8), (26, 3), (24, 3), (24, 8), (20, 8), (20, 0)]]
    arrow = [[(40, 0), (46, 6), (40, 12), (43, 6), (40, 0)]]
    two_holes = [_box_ring(0, 20, 20, 40), _box_ring(2, 22, 8, 38), [(12, 24), (18, 30), (12, 36), (12, 24)]]
    rng = np.random.default_rng(8)
    cells = [(1, frame), (2, comb), (3, arrow), (4, two_holes), (5, [_star(rng, 9, 35, 30, 6, 9)])]
    grid = polygons(spark, cells)
    for kw in ({}, {"tile": 4.0}, {"broadcast_bytes": 0, "hot_tile_rows": 1}):
        idx = sj.index_cells(grid, **kw)
        lattice = [(k, float(x) / 2, float(y) / 2) for k, (x, y) in enumerate((x, y) for x in range(-2, 96) for y in range(-2, 84))]
        found = {(r["grid_id"], r["id"]) for r in sj.points_in_cells(idx, points(spark, lattice)).collect()}
        ends = [tuple(map(float, e)) for e in rng.integers(-2, 48, (150, 4))]
        ends += [(0.0, y, 50.0, y) for y in map(float, range(0, 40))] + [(x, -1.0, x, 41.0) for x in map(float, range(0, 48))]
        got = {(r["grid_id"], r["id"]): r["seg_len"] for r in sj.pair_lengths(sj.clip_lines_to_cells(
            idx, lines(spark, [(k, [(a, b), (c, d)]) for k, (a, b, c, d) in enumerate(ends)]), "geom", ["id"]), ["id"]).collect()}
        for i, rings in cells:
            e = np.array([(*p, *q) for r in rings for p, q in zip(r, r[1:]) if p != q], float)
            same = lambda n: [pd.Series([c] * n) for c in e.T]
            px, py = (pd.Series([p[k] for p in lattice]) for k in (1, 2))
            inside = P.strictly_inside(px, py, *same(len(lattice))).to_numpy()
            assert {k for g, k in found if g == i} == set(np.flatnonzero(inside).tolist()), (i, kw)
            x = [pd.Series(c) for c in zip(*ends)]
            part = P.fraction(*x, pd.Series(np.zeros(len(ends))), pd.Series(np.ones(len(ends))), *same(len(ends))).to_numpy()
            for k, (a, b, c, d) in enumerate(ends):
                assert got.get((i, k), 0.0) == pytest.approx(part[k] * np.hypot(c - a, d - b), abs=1e-7), (i, k, ends[k], kw)


@pytest.mark.parametrize("kw", [{}, {"tile": 3.0}, {"tile": 2.5, "broadcast_bytes": 0, "hot_tile_rows": 1}])
def test_intersecting_lines_touch_or_cross(spark, kw):
    ell = [(0, 20), (10, 20), (10, 25), (5, 25), (5, 30), (0, 30), (0, 20)]
    grid = boxes(spark, TWO).select("id", "geom").unionByName(polygons(spark, [(3, [ell]), (4, [[(20, 20), (30, 20), (20, 30), (20, 20)]])]))
    rows = lines(spark, [(1, [(10, 10), (20, 20)]),              # a corner of both boxes, a corner of the triangle
                         (2, [(-5, 5), (0, 5)]),                 # ends on a border
                         (3, [(12, 3), (14, 4), (16, 3)]),       # inside
                         (4, [(10, -3), (10, -1)]),              # outside, on the border's line
                         (5, [(7, 28), (5, 28)]),                # ends on an inner border of the L
                         (6, [(6, 26), (9, 29)]),                # in the notch of the L
                         (7, [(5, 25), (8, 28)]),                # from the inner corner of the L
                         (8, [(25, 25), (30, 30)]),              # from the sloped side
                         (9, [(26, 25), (30, 30)]),              # beside it
                         (10, [(20, 10), (20, 10)]),             # a point on a corner
                         (11, [(-1, 11), (21, 11)]),             # passes above
                         (12, [(2, 20), (2, 10)])])              # from a box to the L
    idx = sj.index_cells(grid, **kw)
    got = sorted((r["grid_id"], r["id"]) for r in sj.intersecting_lines(idx, rows).collect())
    assert got == [(1, 1), (1, 2), (1, 12), (2, 1), (2, 3), (2, 10), (3, 5), (3, 7), (3, 12), (4, 1), (4, 8)]


def test_tiles_inside_a_many_edged_cell_take_no_exact_test(spark):
    ring = [(60 * math.cos(2 * math.pi * k / 40) + 100, 60 * math.sin(2 * math.pi * k / 40) + 100) for k in range(40)]
    cells = [(k, 10.0 * k, 0.0, 10.0 * k + 8, 8.0) for k in range(6)]
    grid = polygons(spark, [(100, [ring + ring[:1]])]).unionByName(boxes(spark, cells).select("id", "geom"))
    rng = np.random.default_rng(12)
    ends = rng.uniform(20, 180, (300, 4))
    idx = sj.index_cells(grid, tile=15.0)
    cover = {(r["is_box"], r["is_convex"]): r["count"] for r in idx.tiles().where("grid_id = 100").groupBy("is_box", "is_convex").count().collect()}
    assert cover[True, False] > 20 and idx.tiles().where("grid_id = 100 and is_box and edges is not null").count() == 0
    plain = sj.index_cells(grid, tile=15.0)
    plain.fine = False
    pts = points(spark, [(k, x, y) for k, (x, y, _, _) in enumerate(ends.tolist())])
    rows = lines(spark, [(k, [(a, b), (c, d)]) for k, (a, b, c, d) in enumerate(ends.tolist())])
    found, lengths = [], []
    for i in (idx, plain):
        found.append(sorted((r["grid_id"], r["id"]) for r in sj.points_in_cells(i, pts).collect()))
        lengths.append({(r["grid_id"], r["id"]): r["seg_len"] for r in sj.pair_lengths(sj.clip_lines_to_cells(i, rows, "geom", ["id"]), ["id"]).collect()})
    assert found[0] == found[1] and len(found[0]) > 50
    assert lengths[0] == {k: pytest.approx(v) for k, v in lengths[1].items()} and len(lengths[0]) > 100


def test_tiles_of_a_many_edged_cell_keep_the_edges_that_cut_them(spark):
    """Lengths and points are those of the whole ring, of which every tile keeps less than half."""
    import dataclasses
    import random
    ring = [(10 + 9.5 * math.cos(math.pi * k / 16), 10 + 9.5 * math.sin(math.pi * k / 16)) for k in range(32)]
    cells = polygons(spark, [(1, [ring + ring[:1]]), (2, [[(x + 7, y + 3) for x, y in ring + ring[:1]]])])
    idx = sj.index_cells(cells)
    assert idx.fine
    left = [r["n"] for r in idx.tiles().select(F.size("edges").alias("n")).where("edges is not null").collect()]
    assert left and 0 < min(left) and max(left) < 16
    plain = dataclasses.replace(idx, fine=False)
    rng = random.Random(5)
    rows = [(k, *(float(rng.randrange(-4, 60)) / 2 for _ in range(4))) for k in range(300)]
    rows += [(1000 + k, *ring[k], *ring[(k + 1) % 32]) for k in range(32)]  # along the border
    lines = spark.createDataFrame(rows, "k long, x1 double, y1 double, x2 double, y2 double").select(
        "k", G.linestring(("x1", "y1"), ("x2", "y2")).alias("geom"))

    def lengths(i, closed):
        pieces = sj.clip_pieces(i, sj.explode_segments(lines, "geom", ["k"]), ["k"], closed=closed)
        return {(r[0], r[1]): r[2] for r in sj.pair_lengths(pieces, ["k"]).collect() if r[2] > 1e-9}
    for closed in (True, False):
        got, want = lengths(idx, closed), lengths(plain, closed)
        assert got.keys() == want.keys() and len(got) > 100
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    points = spark.createDataFrame([(k, x, y) for k, x, y, _, _ in rows], "k long, x double, y double").select("k", G.point("x", "y").alias("geom"))
    inside = lambda i: sorted(tuple(r) for r in sj.points_in_cells(i, points).select("grid_id", "k").collect())
    assert inside(idx) == inside(plain)


def _many_boxes_and_segments():
    """Small overlapping boxes, one twice, and lattice segments: on borders, along tiles, of no length, some twice."""
    rng = random.Random(7)
    grid = [(k % 150, x, y, x + 7.0, y + 5.0) for k, x, y in ((k, float(rng.randrange(40)), float(rng.randrange(40))) for k in range(160))]
    grid += [(500, 7.0, 7.0, 14.0, 14.0), (501, -7.0, 0.0, 0.0, 7.0), grid[0]]
    rows = []
    for k in range(400):
        a = (rng.randrange(50), rng.randrange(50))
        b = (a[0] + rng.choice([0, 0, -12, 5, 9]), a[1] + rng.choice([0, 0, -8, 7, 13]))
        rows.append((k % 390, [a, b], [None, "a", "b", "c"][k % 4]))
    rows += [(900, [(7, 0), (7, 40)], "a"), (901, [(0, 14), (40, 14)], "b"), (902, [(14, 30), (14, -3), (20, 5)], "c")]
    return grid, rows


@pytest.mark.parametrize("keep", [[], ["kind"], ["id", "kind"]])
@pytest.mark.parametrize("hot_boxes, hot_pairs, hot_rows", [(100_000, 1 << 28, 2_000_000), (5, 40, 3)])
def test_blocks_of_boxes_measure_like_the_join(spark, monkeypatch, keep, hot_boxes, hot_pairs, hot_rows):
    grid, rows = _many_boxes_and_segments()
    monkeypatch.setattr(sj, "HOT_BOXES", hot_boxes)
    monkeypatch.setattr(sj, "HOT_PAIRS", hot_pairs)
    cells, roads = boxes(spark, grid), lines(spark, rows, "kind string").repartition(3)

    def sums(**how):
        pieces = sj.clip_lines_to_cells(sj.index_cells(cells, **how), roads, "geom", keep, positive_only=False)
        return {tuple(r[:-1]): r[-1] for r in sj.pair_lengths(pieces, keep).collect()}
    want, got = sums(), sums(broadcast_bytes=0, hot_tile_rows=hot_rows)
    assert want and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_only_sums_leave_a_tile_of_many_segments(spark):
    cells = boxes(spark, [(k, 0.0, 0.0, 8.0, 8.0) for k in range(20)])
    roads = lines(spark, [(k, [(1, 1 + k % 5), (5, 2)], "ab"[k % 2]) for k in range(600)], "kind string").repartition(2)
    idx = sj.index_cells(cells, tile=8.0, broadcast_bytes=0, hot_tile_rows=50)
    pieces = sj.clip_lines_to_cells(idx, roads, "geom", ["kind"])
    assert pieces.count() == 20 * 2  # 12,000 pairs


def test_sums_do_not_grow_with_the_number_of_batches(spark):
    """Other operators leave the session with Arrow batches of 500 rows."""
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(conf)
    cells = boxes(spark, [(k, 0.0, 0.0, 8.0, 8.0) for k in range(20)])
    roads = lines(spark, [(k, [(1, 1 + k % 5), (5, 2)], "ab"[k % 2]) for k in range(600)], "kind string")
    spark.conf.set(conf, "100")
    try:
        idx = sj.index_cells(cells, tile=8.0, broadcast_bytes=0)
        got = sj.clip_lines_to_cells(idx, roads, "geom", ["kind"]).collect()
    finally:
        spark.conf.set(conf, old)
    assert len(got) == 20 * 2
    want = sum(math.hypot(4, 1 - k % 5) for k in range(600)) * 20
    assert sum(r["piece_len"] for r in got) == pytest.approx(want, rel=1e-12)


def test_blocks_skip_what_is_null_and_take_text_ids(spark):
    cells = boxes(spark, [(1, 0.0, 0.0, 8.0, 8.0), (None, 0.0, 0.0, 4.0, 4.0)]).select(F.concat(F.lit("c"), "id").alias("id"), "geom")
    roads = lines(spark, [(1, [(1, 1), (3, 1)], None), (2, [(1, 1), (6, 1)], "a")], "kind string")
    none = roads.limit(1).withColumn("geom", F.lit(None).cast(roads.schema["geom"].dataType))
    idx = sj.index_cells(cells, tile=8.0, broadcast_bytes=0)
    got = sj.clip_lines_to_cells(idx, roads.unionByName(none), "geom", ["kind"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("c1", None, 2.0), ("c1", "a", 5.0), (None, None, 2.0), (None, "a", 3.0)], key=str)
