"""Physical plans have the shape the design relies on."""

import os

import pytest

from tessera.plans import fixtures as fx
from tessera.operators import features as ft
from tessera.operators import spatial_join as sj

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_line_job_is_broadcast_equi_join_with_pruned_scan(spark):
    idx = sj.index_cells(fx.grid(spark))
    plan = _plan(ft.road_speed_long(idx, fx.roads(spark, SF), "speed"))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    # only the two columns the job needs are read from the orders table
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    # attribute filter (speed not null and > 0) runs below (before) the join;
    # the only filter above it is the one on the summed lengths
    assert plan.rindex("Filter") > plan.index("BroadcastHashJoin")
    assert plan.count("Filter") >= 2
    # two-phase aggregation: partial aggregate below the exchange
    assert plan.count("HashAggregate") >= 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_point_job_pushes_sign_filters_into_scan_side(spark):
    from pyspark.sql import functions as F
    idx = sj.index_cells(fx.grid(spark))
    plan = _plan(ft.sign_groups_long(idx, fx.signs(spark, SF), "mutcddescd"))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    assert "l_extendedprice" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_large_grid_switches_to_salted_shuffle_join(spark):
    from conftest import boxes, points
    grid = boxes(spark, [(1, 0.0, 0.0, 10.0, 10.0)])
    idx = sj.index_cells(grid, broadcast_bytes=0, hot_tile_rows=1)
    plan = _plan(sj.points_in_cells(idx, points(spark, [(1, 5.0, 5.0), (2, 6.0, 6.0)]), "geom", ["id"]))
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_large_cover_is_never_broadcast(spark):
    from conftest import points
    from pyspark.sql import functions as F

    from tessera.functions import geometry as G
    grid = spark.range(50).select("id", G.box(F.lit(0.0), F.lit(0.0), F.lit(30.0), F.lit(30.0)).alias("geom"))
    idx = sj.index_cells(grid, tile=1.0, broadcast_bytes=100_000)
    assert idx.point_bytes > 100_000  # the cover's rows count, not the cells
    pairs = sj.points_in_cells(idx, points(spark, [(k, 0.5 + k, 0.5) for k in range(20)]), "geom", ["id"])
    plan = _plan(pairs)
    assert "SortMergeJoin" in plan and pairs.count() == 50 * 20


def test_cells_that_are_not_convex_take_no_python_step(spark):
    idx = sj.index_cells(fx.l_grid(spark))
    lines = _plan(ft.road_speed_long(idx, fx.roads(spark, SF), "speed"))
    points = _plan(ft.crash_counts(idx, fx.l_grid(spark), fx.crashes(spark, SF), "id", "objectid"))
    for plan in (lines, points):
        assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_one_large_cell_adds_a_handful_of_cover_rows(spark):
    small, mixed = sj.index_cells(fx.grid(spark)), sj.index_cells(fx.mixed_grid(spark))
    assert small.levels == (0,) and mixed.tile == small.tile and len(mixed.levels) == 4
    assert mixed.tiles().count() - small.tiles().count() <= 3 * sj.COVER_TILES
    assert mixed.point_bytes <= small.point_bytes * 1.05
