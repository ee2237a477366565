"""Per-cell features: counts of points and clipped lengths of lines.

Two generic operators do the spatial work:

* :func:`count_by_category` - points strictly inside cells, counted per
  ``(grid_id, category)``;
* :func:`length_by_category` - lines clipped to closed cells, lengths summed
  per ``(grid_id, category)``.

Both return a *long* table. Attribute filters run before the spatial join
(they only read layer columns), and the aggregations are two-phase, so a cell
or category holding a large share of the rows is pre-aggregated on the map
side and never lands whole in one task.

The layer-specific features of the reference are thin configurations of
these two, each with a long and a wide (pivoted) form; :func:`feature_table`
builds the combined wide table with one spatial join per geometry kind and
one pivot aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import names, signs
from tessera.operators.spatial_join import CellIndex, clip_lines_to_cells, points_in_cells
from tessera.session import persist_shared


# --------------------------------------------------------------------------
# generic operators
# --------------------------------------------------------------------------

def count_by_category(idx: CellIndex, points: DataFrame, category: Column | None = None,
                      weight: Column | None = None, geom_col: str = "geom",
                      name: str = "count") -> DataFrame:
    """``(grid_id, category, <name>)``: points strictly inside each cell.

    ``weight`` (default 1) is summed, e.g. ``objectid IS NOT NULL`` to count
    only identified points. With ``category=None`` the result has no
    category column.
    """
    w = (weight if weight is not None else F.lit(1)).cast("long")
    cols = [w.alias("_w"), F.col(geom_col).alias("geom")]
    if category is not None:
        cols.insert(0, category.alias("category"))
    pts = points.select(*cols)
    if category is not None:
        pts = pts.where(F.col("category").isNotNull())
    keep = ["category", "_w"] if category is not None else ["_w"]
    pairs = points_in_cells(idx, pts, "geom", keep)
    keys = ["grid_id", "category"] if category is not None else ["grid_id"]
    return pairs.groupBy(*keys).agg(F.sum("_w").alias(name))


def length_by_category(idx: CellIndex, lines: DataFrame, category: Column | None = None,
                       geom_col: str = "geom", name: str = "total_length", areas: bool = False) -> DataFrame:
    """``(grid_id, category, <name>)``: summed clipped length per cell (of areas, with ``areas``: perimeter).

    Only cells where the clipped length is positive appear. Rows with a null
    category are dropped before the join.
    """
    cols = [F.col(geom_col).alias("geom")]
    if category is not None:
        cols.insert(0, category.alias("category"))
    ln = lines.select(*cols)
    if category is not None:
        ln = ln.where(F.col("category").isNotNull())
    keep = ["category"] if category is not None else []
    pieces = clip_lines_to_cells(idx, ln, "geom", keep, positive_only=False, areas=areas)
    keys = ["grid_id", "category"] if category is not None else ["grid_id"]
    return pieces.groupBy(*keys).agg(F.sum("piece_len").alias(name)).where(F.col(name) > 0)


def pivot_wide(long: DataFrame, value: str, category: str = "category",
               values: list | None = None, fill=0) -> DataFrame:
    """One row per ``grid_id``, one column per category (sum), nulls filled.

    Without ``values`` the long table is first written to the checkpoint
    directory, so that finding the values and pivoting read it instead of
    running the spatial join twice. Spark's own setting
    (``spark.sql.pivotMaxValues``) says how many columns are too many.
    """
    if values is None:
        long = persist_shared(long)
    wide = long.groupBy("grid_id").pivot(category, values).agg(F.sum(value))
    return wide.na.fill(fill)


def grid_ids(grid: DataFrame, id_col: str = "id") -> DataFrame:
    return grid.select(F.col(id_col).alias("grid_id")).distinct()


def with_all_cells(grid: DataFrame, wide: DataFrame, id_col: str = "id", fill=0.0) -> DataFrame:
    """Left join from every distinct grid id; missing features become ``fill``."""
    return grid_ids(grid, id_col).join(wide, "grid_id", "left").na.fill(fill)


# --------------------------------------------------------------------------
# layer features (long form, then wide)
# --------------------------------------------------------------------------

def sign_groups_long(idx: CellIndex, signs_df: DataFrame, desc_col: str = "MUTCDDESCD",
                     geom_col: str = "geom") -> DataFrame:
    """``(grid_id, sign_group, count)``: cleaned, grouped signs per cell."""
    raw = F.col(desc_col)
    usable = signs_df.where(signs.is_usable_code(raw))
    grp = signs.sign_group(signs.normalize_code(raw))
    out = count_by_category(idx, usable, grp, geom_col=geom_col)
    return out.withColumnRenamed("category", "sign_group")


def sign_groups_wide(idx: CellIndex, signs_df: DataFrame, desc_col: str = "MUTCDDESCD",
                     geom_col: str = "geom") -> DataFrame:
    """``grid_id`` + one bigint count per sign group present; cells with a grouped sign only."""
    long = sign_groups_long(idx, signs_df, desc_col, geom_col)
    return pivot_wide(long, "count", "sign_group", fill=0)


def road_speed_long(idx: CellIndex, roads: DataFrame, speed_col: str = "SPEED",
                    geom_col: str = "geom") -> DataFrame:
    """``(grid_id, speed_str, total_length)``: road length per cell and posted speed (> 0)."""
    sp = F.col(speed_col)
    usable = roads.where(sp.isNotNull() & (sp > 0))
    out = length_by_category(idx, usable, sp.cast("string"), geom_col)
    return out.withColumnRenamed("category", "speed_str")


def road_speed_wide(idx: CellIndex, roads: DataFrame, speed_col: str = "SPEED",
                    geom_col: str = "geom") -> DataFrame:
    """``grid_id`` + ``road_len_mph_<speed>`` doubles; cells with a usable road only."""
    long = road_speed_long(idx, roads, speed_col, geom_col)
    named = long.select("grid_id", names.feature_name("road_len_mph_", F.col("speed_str"),
                                                      names.ROAD_NAME_CHARS).alias("feature"),
                        "total_length")
    return pivot_wide(named, "total_length", "feature", fill=0.0)


def category_length_long(idx: CellIndex, lines: DataFrame, category_col: str,
                         out_name: str, geom_col: str = "geom", areas: bool = False) -> DataFrame:
    """``(grid_id, <out_name>, total_length)`` for non-null, non-empty categories."""
    c = F.col(category_col)
    usable = lines.where(c.isNotNull() & (c != ""))
    return (length_by_category(idx, usable, c, geom_col, areas=areas)
            .withColumnRenamed("category", out_name))


def category_length_wide(idx: CellIndex, grid: DataFrame, lines: DataFrame, category_col: str,
                         prefix: str, id_col: str = "id", geom_col: str = "geom", areas: bool = False) -> DataFrame:
    """All grid ids + ``<prefix><clean category>`` doubles, 0.0 where absent."""
    long = category_length_long(idx, lines, category_col, "category", geom_col, areas)
    named = long.select("grid_id", names.feature_name(prefix, F.col("category")).alias("feature"),
                        "total_length")
    wide = pivot_wide(named, "total_length", "feature", fill=0.0)
    return with_all_cells(grid, wide, id_col, 0.0)


def guardrail_wide(idx, grid, guardrails, material_col="MATERIALD", id_col="id", geom_col="geom"):
    return category_length_wide(idx, grid, guardrails, material_col, "guardrail_len_", id_col, geom_col)


def median_wide(idx, grid, medians, type_col="TYPED", id_col="id", geom_col="geom", areas=False):
    return category_length_wide(idx, grid, medians, type_col, "median_len_", id_col, geom_col, areas)


def sidewalk_lengths(idx: CellIndex, sidewalks: DataFrame, geom_col: str = "geom", areas: bool = False) -> DataFrame:
    """``(grid_id, sidewalk_len)`` for cells with a sidewalk piece of positive length.

    The grid ids of the result already come from the grid, so the inner
    join with the distinct grid ids adds nothing and is left out.
    """
    return length_by_category(idx, sidewalks, None, geom_col, "sidewalk_len", areas)


def crash_counts(idx: CellIndex, grid: DataFrame, crashes: DataFrame, id_col: str = "id",
                 objectid_col: str = "OBJECTID", geom_col: str = "geom") -> DataFrame:
    """``(grid_id, crash_count)`` for every grid id; points with a null id are not counted."""
    counted = count_by_category(idx, crashes, None, F.col(objectid_col).isNotNull(),
                                geom_col, "crash_count")
    return with_all_cells(grid, counted, id_col, 0)


# --------------------------------------------------------------------------
# the combined wide table
# --------------------------------------------------------------------------

ROAD_MARK = "_has_road"
LAYER_ORDER = ["road", "sign", "guardrail", "median", "sidewalk", "crash"]


def feature_long(idx: CellIndex, roads: DataFrame, signs_df: DataFrame, guardrails: DataFrame,
                 medians: DataFrame, sidewalks: DataFrame, crashes: DataFrame, *,
                 speed_col: str = "SPEED", desc_col: str = "MUTCDDESCD",
                 material_col: str = "MATERIALD", type_col: str = "TYPED",
                 objectid_col: str = "OBJECTID", geom_col: str = "geom", areas: bool = False) -> DataFrame:
    """``(grid_id, layer, feature, value)`` for all six feature layers.

    ``areas`` says that a line layer holds polygons (measured by perimeter). The four line layers go through one tile join and the two point layers
    through another; one two-phase aggregation per kind.
    """
    g = F.col(geom_col)
    sp = F.col(speed_col)
    mat = F.col(material_col)
    typ = F.col(type_col)
    lines = (
        roads.where(sp.isNotNull() & (sp > 0))
             .select(F.lit("road").alias("layer"),
                     names.feature_name("road_len_mph_", sp, names.ROAD_NAME_CHARS).alias("feature"),
                     g.alias("geom"))
        .unionByName(guardrails.where(mat.isNotNull() & (mat != ""))
                     .select(F.lit("guardrail").alias("layer"),
                             names.feature_name("guardrail_len_", mat).alias("feature"), g.alias("geom")))
        .unionByName(medians.where(typ.isNotNull() & (typ != ""))
                     .select(F.lit("median").alias("layer"),
                             names.feature_name("median_len_", typ).alias("feature"), g.alias("geom")))
        .unionByName(sidewalks.select(F.lit("sidewalk").alias("layer"),
                                      F.lit("sidewalk_len").alias("feature"), g.alias("geom")))
    )
    lengths = (clip_lines_to_cells(idx, lines, "geom", ["layer", "feature"], positive_only=False, areas=areas)
               .groupBy("grid_id", "layer", "feature")
               .agg(F.sum("piece_len").alias("value"))
               .where(F.col("value") > 0))
    raw = F.col(desc_col)
    pts = (
        signs_df.where(signs.is_usable_code(raw))
                .select(F.lit("sign").alias("layer"),
                        signs.sign_group(signs.normalize_code(raw)).alias("feature"),
                        F.lit(1).cast("long").alias("w"), g.alias("geom"))
                .where(F.col("feature").isNotNull())
        .unionByName(crashes.select(F.lit("crash").alias("layer"), F.lit("crash_count").alias("feature"),
                                    F.col(objectid_col).isNotNull().cast("long").alias("w"),
                                    g.alias("geom")))
    )
    counts = (points_in_cells(idx, pts, "geom", ["layer", "feature", "w"])
              .groupBy("grid_id", "layer", "feature")
              .agg(F.sum("w").cast("double").alias("value")))
    return lengths.unionByName(counts)


def feature_columns_from(long: DataFrame) -> list[tuple[str, str]]:
    """(layer, feature) pairs present, in layer order then name order."""
    # one row per column of the wide table; as many as Spark's own pivot allows
    most = int(long.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    pairs = [(r["layer"], r["feature"]) for r in long.select("layer", "feature").distinct().limit(most + 1).collect()]
    if len(pairs) > most:
        raise ValueError(f"more than {most} feature columns (spark.sql.pivotMaxValues)")
    return sorted(pairs, key=lambda p: (LAYER_ORDER.index(p[0]), p[1]))


def feature_table(idx: CellIndex, roads: DataFrame, signs_df: DataFrame, guardrails: DataFrame,
                  medians: DataFrame, sidewalks: DataFrame, crashes: DataFrame, **cols) -> DataFrame:
    """Wide table: one row per cell with a usable road, every feature, 0 where absent.

    Equivalent to the road features left-joined with the sign, guardrail,
    median, sidewalk and crash features, but computed as a single pivot
    aggregation over the long table (written once to the checkpoint
    directory), keeping only cells that have a road feature. Counts are
    bigint, lengths double; ``crash_count`` is the label.
    """
    long = persist_shared(feature_long(idx, roads, signs_df, guardrails, medians, sidewalks,
                                       crashes, **cols))
    pairs = feature_columns_from(long)
    feats = [f for _, f in pairs]
    # one pivot over the values found; the mark of a road is a column of the same pivot
    with_road = F.when(F.col("layer") == "road", F.lit(ROAD_MARK))
    marked = long.select("grid_id", F.explode(F.filter(F.array(F.struct(F.col("feature").alias("f"), F.col("value").alias("v")),
                                                               F.struct(with_road.alias("f"), F.lit(1.0).alias("v"))),
                                                       lambda r: r["f"].isNotNull())).alias("_r")).select("grid_id", "_r.*")
    wide = marked.groupBy("grid_id").pivot("f", [*feats, ROAD_MARK]).agg(F.sum("v")).where(F.col(ROAD_MARK).isNotNull())
    kinds = {f: "long" if layer in ("sign", "crash") else "double" for layer, f in pairs}
    wide = wide.select("grid_id", *[F.coalesce(F.col(f"`{f}`"), F.lit(0.0)).cast(kinds[f]).alias(f) for f in feats])
    # two columns are always there, whatever the layers hold
    if "sidewalk_len" not in feats:
        wide = wide.withColumn("sidewalk_len", F.lit(0.0))
    if "crash_count" not in feats:
        wide = wide.withColumn("crash_count", F.lit(0).cast("long"))
    return wide


def label_audit(features: DataFrame, label: str = "crash_count") -> DataFrame:
    """One row: rows, null labels, zero labels."""
    y = F.col(label)
    return features.agg(F.count(F.lit(1)).alias("rows"),
                        F.sum(y.isNull().cast("int")).cast("long").alias("null_crashes"),
                        F.sum((y == 0).cast("int")).cast("long").alias("zero_crashes"))
