"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query runs the library's operators over layers derived from the
driver tables (:mod:`tessera.plans.fixtures`), so its work grows with the
scale factor. Floating-point results are rounded to 6 digits because float
sums depend on the order of addition, which differs between engines.
:mod:`tessera.plans.oracle` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import geometry as G
from tessera.functions import signs as S
from tessera.operators import features as ft
from tessera.operators import model as ml
from tessera.operators import spatial_join as sj
from tessera.plans import fixtures as fx
from tessera.plans import grid_model
from tessera.session import persist_shared, scratch_path
from tessera.sources import geojson, layers, wkb

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


_INDEXES: dict = {}


def _index(spark: SparkSession, name: str, build_grid) -> sj.CellIndex:
    """One prepared cell index per session and grid, shared by the queries.

    A job over one grid prepares its cells once (as ``grid_model.build``
    does); the registered queries share the fixture grids the same way.
    """
    key = (spark.sparkContext.applicationId, name)
    if key not in _INDEXES:
        _INDEXES[key] = sj.index_cells(build_grid(spark), "id", "geom")
    return _INDEXES[key]


def _idx(spark: SparkSession) -> sj.CellIndex:
    return _index(spark, "grid", fx.grid)


# --------------------------------------------------------------------------
# line features
# --------------------------------------------------------------------------

def road_length_by_speed(spark, sf_dir):
    """Road length per cell and posted speed (long form)."""
    return rounded(ft.road_speed_long(_idx(spark), fx.roads(spark, sf_dir), "speed"))


def road_length_by_speed_wide(spark, sf_dir):
    """Road length per cell, one ``road_len_mph_<speed>`` column per speed."""
    return rounded(ft.road_speed_wide(_idx(spark), fx.roads(spark, sf_dir), "speed"))


def guardrail_length_by_material(spark, sf_dir):
    return rounded(ft.category_length_long(_idx(spark), fx.guardrails(spark, sf_dir),
                                           "materiald", "material"))


def guardrail_length_by_material_wide(spark, sf_dir):
    return rounded(ft.guardrail_wide(_idx(spark), fx.grid(spark), fx.guardrails(spark, sf_dir),
                                     "materiald"))


def median_length_by_type(spark, sf_dir):
    return rounded(ft.category_length_long(_idx(spark), fx.medians(spark, sf_dir),
                                           "typed", "median_type"))


def median_length_by_type_wide(spark, sf_dir):
    return rounded(ft.median_wide(_idx(spark), fx.grid(spark), fx.medians(spark, sf_dir), "typed"))


def sidewalk_length(spark, sf_dir):
    """Three-vertex sidewalks: summed clipped length per cell."""
    return rounded(ft.sidewalk_lengths(_idx(spark), fx.sidewalks(spark, sf_dir)))


def clip_segments(spark, sf_dir):
    """Raw (cell, road) pairs with their clipped length (> 0), every road."""
    pieces = sj.clip_lines_to_cells(_idx(spark), fx.roads(spark, sf_dir), "geom", ["road_id"],
                                    positive_only=False)
    return rounded(sj.pair_lengths(pieces, ["road_id"]))


def polygon_cells(spark, sf_dir):
    """Road length per triangular cell and speed: the convex-polygon path."""
    idx = _index(spark, "triangles", fx.triangle_grid)
    return rounded(ft.road_speed_long(idx, fx.roads(spark, sf_dir), "speed"))


def concave_cells(spark, sf_dir):
    """Road length per L-shaped cell and speed: the even-odd path for non-convex cells."""
    idx = _index(spark, "l_shapes", fx.l_grid)
    return rounded(ft.road_speed_long(idx, fx.roads(spark, sf_dir), "speed"))


def frame_road_length(spark, sf_dir):
    """Road length per cell with a hole and speed: cells cut into trapezoids."""
    return rounded(ft.road_speed_long(_index(spark, "frames", fx.frame_grid), fx.roads(spark, sf_dir), "speed"))


def road_length_mixed_grid(spark, sf_dir):
    """Road length per cell and speed where one cell is a thousand times as wide as the median: tiles of several levels."""
    return rounded(ft.road_speed_long(_index(spark, "mixed", fx.mixed_grid), fx.roads(spark, sf_dir), "speed"))


def disc_road_length(spark, sf_dir):
    """Road length per round cell of 24 edges and speed: tiles wholly inside take no exact test."""
    return rounded(ft.road_speed_long(_index(spark, "discs", fx.disc_grid), fx.roads(spark, sf_dir), "speed"))


def intersecting_roads(spark, sf_dir):
    """(triangular cell, road) pairs that share a point, those that only touch included."""
    return sj.intersecting_lines(_index(spark, "triangles", fx.triangle_grid), fx.roads(spark, sf_dir), "geom", ["road_id"])


def retraced_lines(spark, sf_dir):
    """Length per cell and kind of lines that go part of their way back: each stretch counts once."""
    return rounded(ft.category_length_long(_idx(spark), fx.shuttles(spark, sf_dir), "kind", "kind"))


# --------------------------------------------------------------------------
# point features
# --------------------------------------------------------------------------

def crash_count(spark, sf_dir):
    """Identified crashes strictly inside each cell; every cell, 0 if none."""
    return ft.crash_counts(_idx(spark), fx.grid(spark), fx.crashes(spark, sf_dir), "id", "objectid")


def concave_crash_count(spark, sf_dir):
    """Identified crashes strictly inside each L-shaped cell (non-convex point path)."""
    return ft.crash_counts(_index(spark, "l_shapes", fx.l_grid), fx.l_grid(spark),
                           fx.crashes(spark, sf_dir), "id", "objectid")


def frame_crash_count(spark, sf_dir):
    """Identified crashes strictly inside each cell with a hole."""
    return ft.crash_counts(_index(spark, "frames", fx.frame_grid), fx.frame_grid(spark), fx.crashes(spark, sf_dir), "id", "objectid")


def disc_crash_count(spark, sf_dir):
    """Identified crashes strictly inside each round cell of 24 edges."""
    return ft.crash_counts(_index(spark, "discs", fx.disc_grid), fx.disc_grid(spark), fx.crashes(spark, sf_dir), "id", "objectid")


def crash_count_mixed_grid(spark, sf_dir):
    """Identified crashes strictly inside each cell of a grid of mixed sizes."""
    return ft.crash_counts(_index(spark, "mixed", fx.mixed_grid), fx.mixed_grid(spark), fx.crashes(spark, sf_dir), "id", "objectid")


def _large(spark, sf_dir):
    """A grid that grows with the tables, indexed so that the salted shuffle join runs."""
    grid = fx.customer_grid(spark, sf_dir)
    return grid, sj.index_cells(grid, broadcast_bytes=0, hot_tile_rows=50, materialize=False)


def crash_count_large_grid(spark, sf_dir):
    """Identified crashes in each of the customers' cells, by the shuffled join with salted hot tiles."""
    grid, idx = _large(spark, sf_dir)
    return ft.crash_counts(idx, grid, fx.crashes(spark, sf_dir), "id", "objectid")


def road_length_large_grid(spark, sf_dir):
    """Road length per customer's cell and speed, by tiles shuffled and measured in blocks."""
    _, idx = _large(spark, sf_dir)
    return rounded(ft.road_speed_long(idx, fx.roads(spark, sf_dir), "speed"))


def _all_signs(spark, sf_dir) -> DataFrame:
    """Panels and mounts united (duplicates kept), as the feature job does."""
    cols = ["objectid", "mutcddescd", "geom"]
    return fx.sign_panels(spark, sf_dir).select(*cols).unionByName(
        fx.sign_mounts(spark, sf_dir).select(*cols))


def sign_count_by_group(spark, sf_dir):
    return ft.sign_groups_long(_idx(spark), _all_signs(spark, sf_dir), "mutcddescd")


def sign_count_by_group_wide(spark, sf_dir):
    return ft.sign_groups_wide(_idx(spark), _all_signs(spark, sf_dir), "mutcddescd")


def sign_classify(spark, sf_dir):
    """Cleaning and grouping of sign codes, without the spatial join."""
    s = fx.signs(spark, sf_dir)
    raw = F.col("mutcddescd")
    code = S.normalize_code(raw)
    return s.where(S.is_usable_code(raw)).select(
        "objectid", "source", raw.alias("sign_type"), code.alias("sign_code"),
        S.sign_group(code).alias("sign_group"))


def points_in_cells(spark, sf_dir):
    """Raw (cell, sign) pairs: strict containment, border points in no cell."""
    pairs = sj.points_in_cells(_idx(spark), fx.signs(spark, sf_dir), "geom",
                               ["objectid", "source", "mutcddescd"])
    return rounded(pairs)


def multipoint_in_cells(spark, sf_dir):
    """(cell, multi-point) pairs: every member in the closed cell, one strictly inside."""
    return sj.points_in_cells(_idx(spark), fx.groups(spark, sf_dir), "geom", ["group_id"]).select("grid_id", "group_id")


# --------------------------------------------------------------------------
# areas
# --------------------------------------------------------------------------

def area_length(spark, sf_dir):
    """Perimeter of the clipped areas per cell and material."""
    return rounded(ft.category_length_long(_idx(spark), fx.areas(spark, sf_dir), "material", "material", areas=True))


def area_length_triangles(spark, sf_dir):
    """Perimeter of the clipped areas per (triangular cell, area)."""
    idx = _index(spark, "triangles", fx.triangle_grid)
    pieces = sj.clip_lines_to_cells(idx, fx.areas(spark, sf_dir), "geom", ["area_id"], positive_only=False, areas=True)
    return rounded(sj.pair_lengths(pieces, ["area_id"]))


# --------------------------------------------------------------------------
# whole-job tables
# --------------------------------------------------------------------------

def layer_profile(spark, sf_dir):
    return layers.profile_layers(fx.layers(spark, sf_dir))


def written_layer_profile(spark, sf_dir):
    """Profiles of the nine layers, counted by the passes that write them."""
    base = scratch_path(spark, "profiled")
    return layers.profile_rows(spark, [layers.write_layer(df, f"{base}/{name}", name=name) for name, df in fx.layers(spark, sf_dir).items()])


def _features(spark, sf_dir) -> DataFrame:
    lay = fx.layers(spark, sf_dir)
    idx = _idx(spark)
    signs_all = lay["sign_panels"].select("objectid", "mutcddescd", "geom").unionByName(
        lay["sign_mounts"].select("objectid", "mutcddescd", "geom"))
    return ft.feature_table(idx, lay["roads"], signs_all, lay["guardrails"], lay["medians"],
                            lay["sidewalks"], lay["crashes"], speed_col="speed",
                            desc_col="mutcddescd", material_col="materiald", type_col="typed",
                            objectid_col="objectid")


def feature_table(spark, sf_dir):
    """The wide table of all features, anchored on cells with roads."""
    return rounded(_features(spark, sf_dir))


def label_audit(spark, sf_dir):
    return ft.label_audit(_features(spark, sf_dir))


def split_assignment(spark, sf_dir):
    f = _features(spark, sf_dir).where(F.col("crash_count").isNotNull())
    return ml.assign_split(f.select("grid_id", "crash_count"))


def _grid_job(spark, sf_dir) -> grid_model.Result:
    """The whole job over layers written as WKB under the default file names and loaded from there."""
    base = scratch_path(spark, "layers")
    for name, df in fx.layers(spark, sf_dir).items():
        layers.write_layer(df, f"{base}/{layers.LAYER_FILES[name]}")
    cols = grid_model.Columns(speed="speed", sign_code="mutcddescd", object_id="objectid",
                              material="materiald", median_type="typed")
    return grid_model.build(spark, layers.load_layers(spark, base), cols)


def model_rmse(spark, sf_dir):
    """Held-out rows of the 100-tree forest; whether the RMSE equals Spark's evaluator and is below the label's range.

    The forest itself has no SQL form: the error's value is not part of the result.
    """
    res = _grid_job(spark, sf_dir)
    held_out = persist_shared(res.held_out.select("grid_id", ml.LABEL, "prediction"))
    again = RegressionEvaluator(labelCol=ml.LABEL, metricName="rmse").evaluate(held_out)
    spread = held_out.agg((F.max(ml.LABEL) - F.min(ml.LABEL)).alias("label_range"))
    return ml.rmse(held_out).crossJoin(spread).select(
        "n", (F.abs(F.col("rmse") - again) <= 1e-9 * (again + 1)).alias("rmse_is_formula"),
        (F.col("rmse") < F.col("label_range")).alias("rmse_below_range"))


def scored_grid(spark, sf_dir):
    """The scored grid as written to Parquet: which cells have a prediction, and whether it lies in the labels' range."""
    res = _grid_job(spark, sf_dir)
    out = scratch_path(spark, "scored.parquet")
    layers.write_layer(res.scored_grid, out)
    labels = res.features.agg(F.min(ml.LABEL).alias("lo"), F.max(ml.LABEL).alias("hi"))  # one row
    return layers.read_layer(spark, out).crossJoin(F.broadcast(labels)).select(
        "id", F.col("prediction").isNotNull().alias("has_prediction"),
        F.col("prediction").between(F.col("lo"), F.col("hi")).alias("in_label_range"))


def forest_against_mean(spark, sf_dir):
    """Held-out error of the training mean, in value, and whether the forest's is at most a tenth above it."""
    res = _grid_job(spark, sf_dir)
    split = ml.assign_split(res.features.select("grid_id", ml.LABEL))
    mean = split.where("is_train").agg(F.avg(ml.LABEL).alias("mean"))  # one row
    err = F.col(ml.LABEL) - F.col("mean")
    constant = split.where("not is_train").crossJoin(F.broadcast(mean)).agg(F.sqrt(F.avg(err * err)).alias("constant_rmse"), F.count("*").alias("n"))
    return rounded(constant.crossJoin(F.broadcast(res.rmse.select("rmse"))).select(
        "n", "constant_rmse", (F.col("rmse") <= 1.1 * F.col("constant_rmse")).alias("forest_keeps_up")))


def prediction_by_label_group(spark, sf_dir):
    """Scored cells by quarters of the label: rows, mean label and the place of the group's mean prediction among the four."""
    res = _grid_job(spark, sf_dir)
    scored = res.scored_grid.select(F.col("id").alias("grid_id"), "prediction").join(res.features.select("grid_id", ml.LABEL), "grid_id")
    quarter = Window.orderBy(ml.LABEL, "grid_id")  # one row a cell of the fixture grid
    groups = scored.withColumn("quarter", F.ntile(4).over(quarter)).groupBy("quarter").agg(
        F.count("*").alias("n"), F.avg(ml.LABEL).alias("mean_label"), F.avg("prediction").alias("_p"))
    return rounded(groups.withColumn("place", F.rank().over(Window.orderBy("_p"))).drop("_p"))


# --------------------------------------------------------------------------
# ingest
# --------------------------------------------------------------------------

def _geom_variants(spark, sf_dir) -> DataFrame:
    """Roads re-shaped into mixed geometry kinds (input for the codec queries)."""
    r = fx.roads(spark, sf_dir)
    p = r["geom"]["parts"][0]
    a, b = p[0], p[1]
    k = F.pmod(F.col("road_id"), F.lit(5))
    rev = F.array(b, a)
    tri = F.array(a, G.xy(b["x"], a["y"]), b, a)
    geom = (F.when(k == 0, r["geom"])
            .when(k == 1, G.make_geometry("MultiLineString", F.array(p, rev)))
            .when(k == 2, G.point(a["x"], a["y"]))
            .when(k == 3, G.polygon_from(F.array(tri)))
            .otherwise(G.make_geometry("MultiPolygon", F.array(tri, F.array(b, a, G.xy(a["x"], b["y"]), b)),
                                       F.array(F.lit(1), F.lit(1)))))
    return r.select("road_id", "speed", geom.alias("geom"))


def _collections(spark, sf_dir) -> DataFrame:
    """Roads as collections of a point, the road, a triangle and two triangles, some of the members by the road's number."""
    r = fx.roads(spark, sf_dir)
    p = r["geom"]["parts"][0]
    a, b = p[0], p[1]
    k = F.pmod(F.col("road_id"), F.lit(4))
    tri, other = F.array(a, G.xy(b["x"], a["y"]), b, a), F.array(b, a, G.xy(a["x"], b["y"]), b)
    two = G.make_geometry("MultiPolygon", F.array(tri, other), F.array(F.lit(1), F.lit(1)))
    members = F.array(*[m.cast(G.GEOMETRY) for m in (G.point(a["x"], a["y"]), r["geom"], G.polygon_from(F.array(tri)), two)])
    return r.select("road_id", G.collect_members(F.slice(members, 1, (k + 1).cast("int"))).alias("geom"))


def _member_rows(df: DataFrame) -> DataFrame:
    """One row a member: its kind, parts, polygons and length."""
    m = F.col("m")
    members = df.select("road_id", F.col("geom.kind").alias("of"), F.posexplode(G.collection_members("geom")).alias("member", "m"))
    return rounded(members.select("road_id", "of", "member", m["kind"].alias("kind"), F.size(m["parts"]).alias("n_parts"),
                                  F.coalesce(F.size(m["poly_rings"]), F.lit(0)).alias("n_polys"), G.length(m).alias("length")))


def collection_parse(spark, sf_dir):
    """The members of geometry collections written as GeoJSON text and parsed back."""
    text = _collections(spark, sf_dir).select("road_id", geojson.to_geojson("geom").alias("gj"))
    return _member_rows(text.select("road_id", geojson.parse_geojson("gj").alias("geom")))


def collection_roundtrip(spark, sf_dir):
    """The members of geometry collections written as WKB (both byte orders) to Parquet and loaded."""
    path = scratch_path(spark, "collections.parquet")
    _collections(spark, sf_dir).select("road_id", wkb.to_wkb("geom", F.pmod(F.col("road_id"), F.lit(2)) == 0).alias("geometry")).write.parquet(path)
    return _member_rows(layers.read_layer(spark, path))


def _geom_summary(df: DataFrame, key: str) -> DataFrame:
    g = F.col("geom")
    bb = G.bbox(g)
    return rounded(df.select(key, g["kind"].alias("kind"), F.size(g["parts"]).alias("n_parts"),
                             G.n_vertices(g).alias("n_vertices"),
                             F.coalesce(F.size(g["poly_rings"]), F.lit(0)).alias("n_polys"),
                             bb["xmin"].alias("xmin"), bb["ymin"].alias("ymin"),
                             bb["xmax"].alias("xmax"), bb["ymax"].alias("ymax"),
                             F.array_join(F.transform(G.vertices(g), lambda p: F.concat_ws(
                                 " ", p["x"].cast("long"), p["y"].cast("long"))), ",").alias("coords"),
                             G.length(g).alias("length")))


def geojson_parse(spark, sf_dir):
    """Geometries to GeoJSON text and parsed back (mixed kinds)."""
    v = _geom_variants(spark, sf_dir)
    text = v.select("road_id", geojson.to_geojson("geom").alias("gj"))
    return _geom_summary(text.select("road_id", geojson.parse_geojson("gj").alias("geom")), "road_id")


def wkb_roundtrip(spark, sf_dir):
    """Geometries written as WKB (both byte orders) to Parquet, loaded and decoded."""
    v = _geom_variants(spark, sf_dir)
    path = scratch_path(spark, "wkb_layer.parquet")
    (v.select("road_id", "speed",
              wkb.to_wkb("geom", F.pmod(F.col("road_id"), F.lit(2)) == 0).alias("geometry"))
      .write.mode("overwrite").parquet(path))
    back = layers.read_layer(spark, path)
    return _geom_summary(back, "road_id")


#: What is read of the layer that is written for pruning.
WINDOW = (210.0, 300.0, 395.0, 455.0)


def layer_window(spark, sf_dir):
    """Roads written along a curve with their boxes, and those read back whose box meets a window."""
    path = scratch_path(spark, "roads_by_place.parquet")
    layers.write_layer(fx.roads(spark, sf_dir), path, pruned=True)
    back = layers.read_layer(spark, path, WINDOW)
    return rounded(back.select("road_id", "speed", G.length("geom").alias("length")))


def geojson_convert(spark, sf_dir):
    """Guardrails written as multi-line FeatureCollection files, converted to Parquet, read back."""
    src = fx.guardrails(spark, sf_dir)
    gj_path = scratch_path(spark, "guardrails_geojson")
    geojson.write_feature_collections(src, gj_path, features_per_file=500)
    out = geojson.convert(spark, gj_path, scratch_path(spark, "guardrails.parquet"))
    g = F.col("geom")
    return rounded(out.select("guardrail_id", "materiald", g["kind"].alias("kind"),
                              G.n_vertices(g).alias("n_vertices"),
                              g["parts"][0][0]["x"].alias("x1"), g["parts"][0][0]["y"].alias("y1"),
                              g["parts"][0][1]["x"].alias("x2"), g["parts"][0][1]["y"].alias("y2")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "road_length_by_speed": road_length_by_speed,
    "crash_count_large_grid": crash_count_large_grid,
    "road_length_large_grid": road_length_large_grid,
    "road_length_by_speed_wide": road_length_by_speed_wide,
    "guardrail_length_by_material": guardrail_length_by_material,
    "guardrail_length_by_material_wide": guardrail_length_by_material_wide,
    "median_length_by_type": median_length_by_type,
    "median_length_by_type_wide": median_length_by_type_wide,
    "sidewalk_length": sidewalk_length,
    "crash_count": crash_count,
    "concave_crash_count": concave_crash_count,
    "sign_count_by_group": sign_count_by_group,
    "sign_count_by_group_wide": sign_count_by_group_wide,
    "sign_classify": sign_classify,
    "points_in_cells": points_in_cells,
    "multipoint_in_cells": multipoint_in_cells,
    "area_length": area_length,
    "area_length_triangles": area_length_triangles,
    "clip_segments": clip_segments,
    "layer_profile": layer_profile,
    "written_layer_profile": written_layer_profile,
    "feature_table": feature_table,
    "label_audit": label_audit,
    "split_assignment": split_assignment,
    "polygon_cells": polygon_cells,
    "concave_cells": concave_cells,
    "geojson_parse": geojson_parse,
    "geojson_convert": geojson_convert,
    "collection_parse": collection_parse,
    "collection_roundtrip": collection_roundtrip,
    "wkb_roundtrip": wkb_roundtrip,
    "frame_road_length": frame_road_length,
    "frame_crash_count": frame_crash_count,
    "road_length_mixed_grid": road_length_mixed_grid,
    "crash_count_mixed_grid": crash_count_mixed_grid,
    "retraced_lines": retraced_lines,
    "disc_road_length": disc_road_length,
    "disc_crash_count": disc_crash_count,
    "intersecting_roads": intersecting_roads,
    "layer_window": layer_window,
    "forest_against_mean": forest_against_mean,
    "prediction_by_label_group": prediction_by_label_group,
    "model_rmse": model_rmse,
    "scored_grid": scored_grid,
}
