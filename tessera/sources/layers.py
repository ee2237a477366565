"""Parquet map layers: load, resolve the geometry column, profile, write.

On disk a layer is Parquet with its geometry in one of two forms:

* ``geom``     - used as it is (our GEOMETRY struct; a binary ``geom`` is
                 taken as WKB and decoded);
* ``geometry`` - WKB bytes, decoded into a new ``geom`` column.

A layer with neither fails with an error naming the path. Layers are written
with their geometry as a WKB ``geometry`` column, so other tools can read
them.

A layer can be written **for pruning**: its rows ordered along a Z-order curve
of their boxes' centres, and each row's box beside its geometry as a struct
column ``bbox``. Row groups then cover small parts of the plane, and reading
with a box pushes four comparisons to the Parquet reader, which skips the row
groups that lie elsewhere by their minima and maxima.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import geometry as G
from tessera.sources import wkb

# The file names of the nine layers under one base directory.
LAYER_FILES = {
    "grid": "Grid.parquet",
    "roads": "RoadCenterLines.parquet",
    "crashes": "Crashes.parquet",
    "curbs": "CurbsAndGutters.parquet",
    "guardrails": "Guardrails.parquet",
    "medians": "Medians.parquet",
    "sidewalks": "Sidewalks.parquet",
    "sign_panels": "SignPanels.parquet",
    "sign_mounts": "SignMounts.parquet",
}


class MissingGeometryError(ValueError):
    pass


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer splits than the cluster has cores.

    Parquet splits by row group, so a small file with one row group is read
    by one task and everything downstream (segment explode, clipping) would
    run on one core. Only then are rows dealt round-robin over
    ``defaultParallelism`` partitions; a large input already has more splits
    than cores and is left alone (no shuffle). Call it on scans (plans
    without an exchange), where counting partitions runs nothing.
    """
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        # Hash on a row number: balanced even for many identical rows, and,
        # unlike round-robin, needs no sort to stay deterministic on retry.
        return (df.withColumn("_spread", F.monotonically_increasing_id())
                  .repartition(par, "_spread").drop("_spread"))
    return df


def resolve_geometry(df: DataFrame, path: str = "<dataframe>") -> DataFrame:
    """Ensure a GEOMETRY ``geom`` column: keep ``geom``, else decode WKB ``geometry``."""
    cols = df.columns
    if "geom" in cols:
        if isinstance(df.schema["geom"].dataType, T.BinaryType):
            return df.withColumn("geom", wkb.from_wkb("geom"))
        return df
    if "geometry" in cols:
        return df.withColumn("geom", wkb.from_wkb("geometry"))
    raise MissingGeometryError(f"{path}: a layer needs a geometry in column `geom`, or as WKB in `geometry`")


BBOX = "bbox"
PROFILED = "_profiled_box"
BOX_TYPE = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"
CURVE_BITS = 16


def _has_boxes(df: DataFrame) -> bool:
    return BBOX in df.columns and df.schema[BBOX].dataType.simpleString() == BOX_TYPE


def read_layer(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """The layer at ``path``; with ``box`` (xmin, ymin, xmax, ymax) only rows whose box meets it.

    Where the layer was written for pruning the comparison reaches the
    Parquet reader; elsewhere every row is decoded and compared.
    """
    rows = spark.read.parquet(path)
    boxes = _has_boxes(rows)
    if boxes and box:
        rows = rows.where(_meets_box(F.col(BBOX), box))
    rows = resolve_geometry(spread(rows), path)
    if boxes:
        return rows.drop(BBOX)
    return rows.where(_meets_box(G.bbox("geom"), box)) if box else rows


def _meets_box(own, box):
    x1, y1, x2, y2 = (float(v) for v in box)
    return (own["xmin"] <= x2) & (own["xmax"] >= x1) & (own["ymin"] <= y2) & (own["ymax"] >= y1)


def load_layers(spark: SparkSession, base: str,
                files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All layers under ``base``, keyed by layer name."""
    files = files or LAYER_FILES
    return {name: read_layer(spark, f"{base.rstrip('/')}/{fn}") for name, fn in files.items()}


def write_layer(df: DataFrame, path: str, geom_col: str = "geom", mode: str = "overwrite",
                pruned: bool = False, row_group_bytes: int | None = None, name: str | None = None) -> dict | None:
    """Write a layer as Parquet with its geometry as WKB ``geometry``.

    With a ``name`` the pass that writes the layer also counts it: the
    layer's profile comes back as a dict of the fields of ``PROFILE_SCHEMA``
    (:func:`profile_rows` makes a table of them), with no scan of its own.

    ``pruned`` orders the rows along a curve and writes their boxes, for
    reads limited to a box; ``row_group_bytes`` sets the size of what such a
    read can skip. The order costs one pass for the layer's extent and a sort
    by ranges.
    """
    seen = None
    if name is not None:
        seen = Observation()
        # the box once a row, not once for each of its four ends
        boxed = df.withColumn(PROFILED, G.bbox(geom_col))
        df = boxed.observe(seen, *_profile_columns(F.col(PROFILED), F.col(geom_col).isNull())).drop(PROFILED)
    if pruned:
        df = _along_curve(df.drop(BBOX).withColumn(BBOX, G.bbox(geom_col).cast(BOX_TYPE)))
    out = df.withColumn("geometry", wkb.to_wkb(geom_col))
    if geom_col != "geometry":
        out = out.drop(geom_col)
    writer = out.write.mode(mode)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    return {"layer": name, **seen.get} if seen else None


def profile_rows(spark: SparkSession, profiles: list[dict]) -> DataFrame:
    """Profiles of written layers, one row each."""
    rows = [tuple(p[c.split()[0]] for c in PROFILE_SCHEMA.split(", ")) for p in profiles]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def _spaced(v):
    """The bits of a number below 2^16, one apart."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def _along_curve(df: DataFrame) -> DataFrame:
    """``df`` in ranges of the Z-order of its boxes' centres; rows without a box come first."""
    x = (F.col(f"{BBOX}.xmin") + F.col(f"{BBOX}.xmax")) / 2
    y = (F.col(f"{BBOX}.ymin") + F.col(f"{BBOX}.ymax")) / 2
    r = df.agg(F.min(x).alias("x1"), F.max(x).alias("x2"), F.min(y).alias("y1"), F.max(y).alias("y2")).first()
    steps = (1 << CURVE_BITS) - 1

    def place(v, lo, hi):
        return F.floor((v - F.lit(lo)) / F.lit((hi - lo) or 1.0) * steps).cast("long")
    if r["x1"] is None:
        return df
    curve = _spaced(place(x, r["x1"], r["x2"])).bitwiseOR(F.shiftleft(_spaced(place(y, r["y1"], r["y2"])), 1))
    # the second key spreads rows of one place over ranges
    keys = ["_curve", F.xxhash64(*[f"{BBOX}.{c}" for c in ("xmin", "ymin", "xmax", "ymax")])]
    return df.withColumn("_curve", curve).repartitionByRange(*keys).sortWithinPartitions("_curve").drop("_curve")


PROFILE_SCHEMA = "layer string, rows bigint, null_geom bigint, xmin double, ymin double, xmax double, ymax double"


def _profile_columns(box, missing) -> list:
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(missing.cast("long")), F.lit(0)).cast("long").alias("null_geom"),
            F.min(box["xmin"]).alias("xmin"), F.min(box["ymin"]).alias("ymin"), F.max(box["xmax"]).alias("xmax"), F.max(box["ymax"]).alias("ymax")]


def profile(name: str, df: DataFrame, geom_col: str = "geom") -> DataFrame:
    """One row: layer name, row count, null geometries, extent."""
    g = F.col(geom_col)
    bb = G.bbox(g)
    return df.select(bb.alias("_bb"), g.isNull().alias("_null")).agg(*_profile_columns(F.col("_bb"), F.col("_null"))).select(
        F.lit(name).alias("layer"), "rows", "null_geom", "xmin", "ymin", "xmax", "ymax")


def profile_layers(layers: dict[str, DataFrame], geom_col: str = "geom") -> DataFrame:
    """Profiles of all layers, one row each (one job)."""
    out = None
    for name, df in layers.items():
        p = profile(name, df, geom_col)
        out = p if out is None else out.unionByName(p)
    return out
