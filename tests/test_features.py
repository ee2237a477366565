"""Feature operators, pivots, sign classes and the model."""

import os
import sys

import duckdb
import pytest
from conftest import boxes, lines, points
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.functions import signs
from tessera.operators import features as ft
from tessera.operators import model as ml
from tessera.operators import spatial_join as sj

GRID = [(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0), (3, 0.0, 10.0, 10.0, 20.0)]


def test_sign_group_rules(spark):
    codes = ["W1_8___CHEVRON_ALIGNMENT", "R9_50", "R9_50_1___BIKE", "R2-1___SPEED", "OM1", "W10_1",
             "R15_1_X", "S1_1_A", "S1_2_A", "W13_1", "Q_1"]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = dict(df.select("c", signs.sign_group(signs.normalize_code(F.col("c")))).collect())
    assert got == {"W1_8___CHEVRON_ALIGNMENT": "curve_turn", "R9_50": None, "R9_50_1___BIKE": "ped_bike_animal",
                   "R2-1___SPEED": "speed_limit", "OM1": "object_marker", "W10_1": "railroad",
                   "R15_1_X": "railroad", "S1_1_A": "school_zone", "S1_2_A": None, "W13_1": "curve_turn",
                   "Q_1": None}


def test_sign_cleaning(spark):
    vals = [None, "", "   ", "_", "null", "999___MISC._OTHER_SIGN", "R1_1", " R1_1"]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    kept = [r[0] for r in df.where(signs.is_usable_code(F.col("c"))).collect()]
    assert kept == ["R1_1", " R1_1"]


def test_sign_groups_wide_counts_and_cells(spark):
    grid = boxes(spark, GRID)
    s = points(spark, [(1, 5.0, 5.0, "R1-1___STOP"), (2, 6.0, 5.0, "R1_2___YIELD"), (3, 15.0, 5.0, "W2_1"),
                       (4, 10.0, 5.0, "R1_1"), (5, 5.0, 15.0, "Q9"), (5, 5.0, 16.0, "R2_1")],
               "MUTCDDESCD string")
    idx = sj.index_cells(grid)
    wide = ft.sign_groups_wide(idx, s)
    assert wide.columns == ["grid_id", "intersection_warning", "speed_limit", "stop_yield"]
    assert dict(wide.dtypes)["stop_yield"] == "bigint"
    got = {r["grid_id"]: tuple(r)[1:] for r in wide.collect()}
    assert got == {1: (0, 0, 2), 2: (1, 0, 0), 3: (0, 1, 0)}


def test_road_speed_pivot_order_and_filters(spark):
    grid = boxes(spark, GRID)
    roads = lines(spark, [(1, [(0, 5), (20, 5)], 25), (2, [(0, 2), (10, 2)], 100), (3, [(0, 3), (10, 3)], 0),
                          (4, [(0, 4), (10, 4)], None), (5, [(2, 12), (4, 12)], 25)], "SPEED int")
    wide = ft.road_speed_wide(sj.index_cells(grid), roads)
    assert wide.columns == ["grid_id", "road_len_mph_100", "road_len_mph_25"]
    got = {r["grid_id"]: (r["road_len_mph_100"], r["road_len_mph_25"]) for r in wide.collect()}
    assert got == {1: (10.0, 10.0), 2: (0.0, 10.0), 3: (0.0, 2.0)}


def test_pivot_name_collision_adds_up_and_keeps_all_cells(spark):
    grid = boxes(spark, GRID)
    g = lines(spark, [(1, [(0, 5), (4, 5)], "A B"), (2, [(0, 6), (3, 6)], "A-B"), (3, [(12, 5), (13, 5)], "C/D"),
                      (4, [(1, 1), (2, 1)], ""), (5, [(1, 1), (2, 1)], None)], "MATERIALD string")
    wide = ft.guardrail_wide(sj.index_cells(grid), grid, g)
    assert sorted(wide.columns) == ["grid_id", "guardrail_len_A_B", "guardrail_len_C_D"]
    got = {r["grid_id"]: (r["guardrail_len_A_B"], r["guardrail_len_C_D"]) for r in wide.collect()}
    assert got == {1: (7.0, 0.0), 2: (0.0, 1.0), 3: (0.0, 0.0)}


def test_crash_counts_all_cells_null_ids_not_counted(spark):
    grid = boxes(spark, GRID)
    c = spark.createDataFrame([(1, 5.0, 5.0), (None, 6.0, 6.0), (3, 7.0, 7.0), (4, 10.0, 5.0)],
                              "OBJECTID long, x double, y double")
    from tessera.functions import geometry as G
    c = c.withColumn("geom", G.point("x", "y"))
    got = dict(ft.crash_counts(sj.index_cells(grid), grid, c).collect())
    assert got == {1: 2, 2: 0, 3: 0}


def test_sidewalk_lengths_multi_vertex(spark):
    grid = boxes(spark, GRID)
    sw = lines(spark, [(1, [(5, 5), (15, 5), (15, 8)])])
    got = dict(ft.sidewalk_lengths(sj.index_cells(grid), sw).collect())
    assert got == {1: pytest.approx(5.0), 2: pytest.approx(8.0)}


def _feature_inputs(spark):
    grid = boxes(spark, GRID + [(4, 10.0, 10.0, 20.0, 20.0)])
    roads = lines(spark, [(1, [(0, 5), (20, 5)], 30), (2, [(1, 15), (3, 15)], 45)], "SPEED int")
    sg = points(spark, [(1, 5.0, 5.0, "R1_1"), (2, 5.0, 15.0, "W2_1"), (3, 15.0, 15.0, "W3_1")],
                "MUTCDDESCD string").withColumnRenamed("id", "OBJECTID")
    gr = lines(spark, [(1, [(11, 1), (12, 1)], "STEEL")], "MATERIALD string")
    md = lines(spark, [(1, [(1, 16), (2, 16)], "GRASS")], "TYPED string")
    sw = lines(spark, [(1, [(15, 15), (16, 15)])])
    cr = points(spark, [(1, 2.0, 2.0), (2, 3.0, 3.0), (3, 12.0, 2.0)]).withColumnRenamed("id", "OBJECTID")
    return grid, roads, sg, gr, md, sw, cr


def test_feature_table_anchored_on_road_cells(spark):
    grid, roads, sg, gr, md, sw, cr = _feature_inputs(spark)
    idx = sj.index_cells(grid)
    wide = ft.feature_table(idx, roads, sg, gr, md, sw, cr)
    assert wide.columns == ["grid_id", "road_len_mph_30", "road_len_mph_45", "advance_condition",
                            "intersection_warning", "stop_yield", "guardrail_len_STEEL", "median_len_GRASS",
                            "sidewalk_len", "crash_count"]
    types = dict(wide.dtypes)
    assert types["stop_yield"] == "bigint" and types["crash_count"] == "bigint"
    assert types["road_len_mph_30"] == "double"
    got = {r["grid_id"]: tuple(r)[1:] for r in wide.collect()}
    assert got == {1: (10.0, 0.0, 0, 0, 1, 0.0, 0.0, 0.0, 2),
                   2: (10.0, 0.0, 0, 0, 0, 1.0, 0.0, 0.0, 1),
                   3: (0.0, 2.0, 0, 1, 0, 0.0, 1.0, 0.0, 0)}
    audit = ft.label_audit(wide).first()
    assert (audit["rows"], audit["null_crashes"], audit["zero_crashes"]) == (3, 0, 1)


def test_hash_split_is_independent_of_partitioning(spark):
    df = spark.range(1, 401).select(F.col("id").alias("grid_id"))
    a = {r[0]: r[1] for r in ml.assign_split(df.repartition(2)).collect()}
    b = {r[0]: r[1] for r in ml.assign_split(df.repartition(7)).collect()}
    assert a == b and 250 < sum(a.values()) < 380


def test_model_scores_every_cell_and_nulls_cells_without_roads(spark):
    grid, roads, sg, gr, md, sw, cr = _feature_inputs(spark)
    idx = sj.index_cells(grid)
    wide = ft.feature_table(idx, roads, sg, gr, md, sw, cr)
    assert ml.feature_columns(wide)[:2] == ["road_len_mph_30", "road_len_mph_45"]
    fit = ml.fit_forest(wide, num_trees=5, train_fraction=1.0)
    scored = ml.scored_grid(grid, ml.score_all(fit))
    got = {r["id"]: r["prediction"] for r in scored.collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[4] is None and all(got[i] is not None for i in (1, 2, 3))


ORACLE_QUERIES = ["road_length_by_speed", "crash_count", "concave_crash_count", "sign_count_by_group_wide", "sidewalk_length",
                  "polygon_cells", "concave_cells", "feature_table", "wkb_roundtrip", "geojson_parse"]


@pytest.mark.parametrize("name", ORACLE_QUERIES)
def test_registered_query_matches_oracle_at_sf0001(spark, name):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test data")
    df = entry.queries()[name](spark, sf)
    con = duckdb.connect()
    for t in ["customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    o = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(o.columns)
    cols = sorted(df.columns)
    mine = sorted(tuple(r[c] for c in cols) for r in df.collect())
    idx = [o.columns.index(c) for c in cols]
    theirs = sorted(tuple(r[i] for i in idx) for r in o.fetchall())
    assert mine == theirs


def test_sign_group_regex_equals_rule_chain(spark):
    from tessera.plans.fixtures import SIGN_TEXTS
    extra = ["W1_8___CHEVRON_ALIGNMENT", "W13_", "W1", "R15_1", "R15_1_", "OM", "O", "S5_", "R9_5_", "W11_X",
             "w1_2", "R2_*", "R1.1", "\\Q", "W1_8___CHEVRON_ALIGNMENTX"]
    df = spark.createDataFrame([(c,) for c in SIGN_TEXTS + extra], "c string")
    code = signs.normalize_code(F.col("c"))
    rows = df.select(signs.sign_group(code).alias("a"), signs.sign_group_chain(code).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)
    assert sum(r["a"] is not None for r in rows) > 20


def test_sidewalk_column_without_sidewalks(spark):
    grid = boxes(spark, [(1, 0.0, 0.0, 10.0, 10.0)])
    road = lines(spark, [(1, [(1, 1), (5, 1)], 30)], "SPEED int")
    none = lines(spark, [], "MATERIALD string, TYPED string")
    signs = points(spark, [], "MUTCDDESCD string")
    crash = points(spark, [], "OBJECTID long")
    out = ft.feature_table(sj.index_cells(grid), road, signs, none, none, none, crash).first().asDict()
    assert out["sidewalk_len"] == 0.0 and out["crash_count"] == 0 and out["road_len_mph_30"] == 4.0


def test_long_form_has_no_limit_of_categories(spark):
    grid = boxes(spark, [(1, 0.0, 0.0, 10.0, 10.0)])
    many = spark.range(10_001).select(F.col("id").cast("string").alias("kind"), G.point(F.lit(5.0), F.lit(5.0)).alias("geom"))
    long = ft.count_by_category(sj.index_cells(grid), many, F.col("kind"))
    assert long.count() == 10_001
