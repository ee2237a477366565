"""Map layers derived from the driver's tables, for the registered queries.

The layers have the shape the feature jobs expect (an id, attribute columns
and a ``geom`` geometry column) and are computed from the driver tables, so
their size grows with the scale factor. Coordinates are integers on a
1000 x 1000 square, cut into 20 x 20 cells of side 50; multiples of 50 put
points and lines on cell borders on purpose. The same derivations are
written as plain SQL in :mod:`tessera.plans.oracle` for DuckDB.

These builders only shape input rows; all spatial work happens in the
operators that consume them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.sources.layers import spread

GRID_SIDE = 20      # cells per row and column
CELL = 50.0         # cell side


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _m(c: Column, k: int) -> Column:
    return F.pmod(c, F.lit(k))


def grid(spark: SparkSession) -> DataFrame:
    """400 square cells with ids 1..400: columns id, xmin, ymin, xmax, ymax, geom."""
    i = F.col("id") - 1
    xmin = F.lit(CELL) * _m(i, GRID_SIDE)
    ymin = F.lit(CELL) * F.floor(i / F.lit(float(GRID_SIDE)))
    return (spark.range(1, GRID_SIDE * GRID_SIDE + 1)
            .select(F.col("id").cast("long").alias("id"))
            .select("id", xmin.cast("double").alias("xmin"), ymin.cast("double").alias("ymin"),
                    (xmin + CELL).cast("double").alias("xmax"), (ymin + CELL).cast("double").alias("ymax"))
            .withColumn("geom", G.box("xmin", "ymin", "xmax", "ymax")))


def customer_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small cell per customer (overlapping, off the tile lattice): a grid that grows with the tables."""
    k = F.col("c_custkey")
    xmin, ymin = _m(k * 7919, 990).cast("double"), _m(k * 104729, 990).cast("double")
    return (table(spark, sf_dir, "customer").select(k.cast("long").alias("id"), xmin.alias("xmin"), ymin.alias("ymin"))
            .withColumn("geom", G.box("xmin", "ymin", F.col("xmin") + 7, F.col("ymin") + 5)).select("id", "geom"))


def triangle_grid(spark: SparkSession) -> DataFrame:
    """Each square cell cut along its rising diagonal into two triangles.

    Ids ``2*id - 1`` (lower-right triangle) and ``2*id`` (upper-left).
    """
    sq = grid(spark)
    a = G.xy("xmin", "ymin")
    b = G.xy("xmax", "ymin")
    c = G.xy("xmax", "ymax")
    d = G.xy("xmin", "ymax")
    low = sq.select((F.col("id") * 2 - 1).alias("id"),
                    G.polygon_from(F.array(F.array(a, b, c, a))).alias("geom"))
    up = sq.select((F.col("id") * 2).alias("id"),
                   G.polygon_from(F.array(F.array(a, c, d, a))).alias("geom"))
    return low.unionByName(up)


def l_grid(spark: SparkSession) -> DataFrame:
    """Each square cell minus its upper-right quarter: concave L-shaped cells, same ids."""
    sq = grid(spark)
    xm = (F.col("xmin") + F.col("xmax")) / 2
    ym = (F.col("ymin") + F.col("ymax")) / 2
    ring = F.array(G.xy("xmin", "ymin"), G.xy("xmax", "ymin"), G.xy("xmax", ym), G.xy(xm, ym),
                   G.xy(xm, "ymax"), G.xy("xmin", "ymax"), G.xy("xmin", "ymin"))
    return sq.select("id", G.polygon_from(F.array(ring)).alias("geom"))


def frame_grid(spark: SparkSession) -> DataFrame:
    """Each square cell with a square hole of side 30 in its middle: cells that are not convex, same ids."""
    sq = grid(spark)

    def ring(inset):
        x1, y1, x2, y2 = F.col("xmin") + inset, F.col("ymin") + inset, F.col("xmax") - inset, F.col("ymax") - inset
        return F.array(G.xy(x1, y1), G.xy(x2, y1), G.xy(x2, y2), G.xy(x1, y2), G.xy(x1, y1))
    return sq.select("id", G.polygon_from(F.array(ring(0), ring(10))).alias("geom"))


#: Edge steps of a quarter of a round lattice polygon; the other quarters are its turns.
QUARTER = [(4, 0), (3, 1), (2, 1), (1, 1), (1, 2), (1, 3)]


def disc_ring() -> list[tuple[int, int]]:
    """A convex ring of 24 edges between lattice points, 40 wide, from its lowest left vertex (0, 0) counter-clockwise."""
    ring, (x, y) = [(0, 0)], (0, 0)
    for turn in range(4):
        for dx, dy in QUARTER:
            for _ in range(turn):
                dx, dy = -dy, dx
            x, y = x + 2 * dx, y + 2 * dy
            ring.append((x, y))
    return ring


def disc_grid(spark: SparkSession) -> DataFrame:
    """A round cell of 24 edges inside each square cell, same ids; lattice vertices, and twice as fine as other cells."""
    sq = grid(spark)
    corners = [G.xy(F.col("xmin") + 21 + x, F.col("ymin") + 5 + y) for x, y in disc_ring()]
    return sq.select("id", G.polygon_from(F.array(F.array(*corners))).alias("geom"))


#: Cells besides the square ones (id, xmin, ymin, side): one a thousand times as wide, one over them all, one between the sizes.
MIXED = [(1001, -24500.0, -24500.0, 50000.0), (1002, 0.0, 0.0, 1000.0), (1003, 110.0, 130.0, 270.0)]


def mixed_grid(spark: SparkSession) -> DataFrame:
    """The square cells and those of ``MIXED``: sizes from 50 to 50,000, overlapping."""
    more = spark.createDataFrame(MIXED, "id long, xmin double, ymin double, side double")
    more = more.select("id", G.box("xmin", "ymin", F.col("xmin") + F.col("side"), F.col("ymin") + F.col("side")).alias("geom"))
    return grid(spark).select("id", "geom").unionByName(more)


def shuttles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """shuttle_id, kind and a line there, half the way back and aside, from ``orders``; retraced on half its first stretch."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    x, y = _m(k * 7919, 1000), _m(k * 104729, 1000)
    a, b = _m(F.col("o_custkey"), 13) - 6, _m(F.col("o_custkey"), 11) - 5
    return o.select(k.alias("shuttle_id"), F.concat(F.lit("S"), _m(k, 3).cast("string")).alias("kind"),
                    G.linestring((x, y), (x + 4 * a, y + 4 * b), (x + 2 * a, y + 2 * b), (x + 2 * a, y + 2 * b + 20)).alias("geom"))


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """road_id, speed (int, null or 0 for some), two-vertex line from ``orders``."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    x1 = _m(k * 7919, 1000)
    y1 = _m(k * 104729, 1000)
    x2 = x1 + _m(F.col("o_custkey"), 121) - 60
    y2 = y1 + _m(F.col("o_custkey"), 97) - 48
    speed = F.when(_m(k, 14) == 13, F.lit(None)).otherwise(5 * _m(k, 14))
    return o.select(k.alias("road_id"), speed.alias("speed"),
                    G.linestring((x1, y1), (x2, y2)).alias("geom"))


SIGN_TEXTS = [
    # index = l_partkey mod 32; None is a null code
    None, "", "   ", "_", "null", "999___MISC._OTHER_SIGN",
    "R_999___MISC._REGULATORY_SIGNS", "R2-1___SPEED_LIMIT", "R2_1___SPEED_LIMIT",
    "S4_3___SCHOOL", "S5-1___SCHOOL_SPEED", "R1_1___STOP", "R1-2___YIELD",
    "R3_1___NO_RIGHT_TURN", "R4_7___KEEP_RIGHT", "W1_2___CURVE", "W1_8___CHEVRON_ALIGNMENT",
    "W13_1___ADVISORY_SPEED", "W2_1___CROSS_ROAD", "W3_1___STOP_AHEAD", "W7_1___HILL",
    "W8_1___BUMP", "W11-2___PEDESTRIAN", "R9_50_1___BIKE", "S1_1___SCHOOL",
    "OM3_L___OBJECT_MARKER", "W10_1___RAILROAD", "R15_1___CROSSBUCK",
    "W_999___MISC._WARNING_SIGNS", "INFO___GENERAL_INFORMATION_SIGNS",
    "REC___RECREATIONAL_AND_CULTURAL_INTEREST_AREA_SIGNS", "SERVICES___GENERAL_SERVICE_SIGNS",
]


def signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """objectid, source ('panel' | 'mount'), mutcddescd, point geom from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    code = F.element_at(F.array(*[F.lit(t).cast("string") for t in SIGN_TEXTS]),
                        (_m(F.col("l_partkey"), 32) + 1).cast("int"))
    x = _m(F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 31, 1000)
    y = _m(F.col("l_partkey") * 104729 + F.col("l_suppkey") * 17, 1000)
    return li.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("objectid"),
                     F.when(F.col("l_linestatus") == "O", "panel").otherwise("mount").alias("source"),
                     code.alias("mutcddescd"),
                     G.point(x, y).alias("geom"))


def sign_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signs(spark, sf_dir).where(F.col("source") == "panel").drop("source")


def sign_mounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signs(spark, sf_dir).where(F.col("source") == "mount").drop("source")


def guardrails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """guardrail_id, materiald, two-vertex line from ``part``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    mat = (F.when(_m(F.col("p_size"), 6) == 0, "STEEL BEAM")
           .when(_m(F.col("p_size"), 6) == 1, "W-BEAM/CABLE")
           .when(_m(F.col("p_size"), 6) == 2, "CONCRETE")
           .when(_m(F.col("p_size"), 6) == 3, "TIMBER.2")
           .when(_m(F.col("p_size"), 6) == 4, ""))
    x1 = _m(k * 7919, 1000)
    y1 = _m(k * 611953, 1000)
    return p.select(k.alias("guardrail_id"), mat.alias("materiald"),
                    G.linestring((x1, y1), (x1 + _m(k, 83) - 41, y1 + _m(k, 59) - 29)).alias("geom"))


def medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """median_id, typed, horizontal two-vertex line from ``customer``."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    typed = (F.when(_m(k, 17) == 0, F.lit(None).cast("string"))
             .when(_m(k, 17) == 1, F.lit(""))
             .otherwise(F.col("c_mktsegment")))
    x1 = _m(k * 15485863, 1000)
    y1 = _m(k * 32452843, 1000)
    return c.select(k.alias("median_id"), typed.alias("typed"),
                    G.linestring((x1, y1), (x1 + _m(k, 73) - 36, y1)).alias("geom"))


def sidewalks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sidewalk_id and a three-vertex line from ``part``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    x = _m(k * 49979687, 1000)
    y = _m(k * 86028121, 1000)
    return p.select(k.alias("sidewalk_id"),
                    G.linestring((x, y), (x + 30, y + _m(k, 41) - 20), (x + 30, y + 40)).alias("geom"))


def crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """objectid (null for some) and a point from ``events``."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    oid = F.when(_m(k, 50) == 0, F.lit(None)).otherwise(k)
    x = _m(k * 7919 + F.col("user_id"), 1000)
    y = _m(k * 104729 + F.col("user_id") * 13, 1000)
    return e.select(oid.alias("objectid"), G.point(x, y).alias("geom"))


def curbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """curb_id and a horizontal line from ``supplier`` (profiled only)."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    x1 = _m(k * 7919, 1000)
    y1 = _m(k * 104729, 1000)
    return s.select(k.alias("curb_id"), G.linestring((x1, y1), (x1 + 25, y1)).alias("geom"))


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """area_id, material and an axis-parallel rectangle from ``part``; many share edges with the cells."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    x, y = _m(k * 49979687, 1000), _m(k * 86028121, 1000)
    snapped = _m(k, 4) == 0
    x, y = F.when(snapped, x - _m(x, 50)).otherwise(x), F.when(snapped, y - _m(y, 50)).otherwise(y)
    w, h = F.when(snapped, 50).otherwise(_m(k, 83) + 10), _m(k, 47) + 10
    return p.select(k.alias("area_id"), F.concat(F.lit("A"), _m(k, 3).cast("string")).alias("material"),
                    G.box(x, y, x + w, y + h).alias("geom"))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """group_id and a multi-point of one to three members from ``events``."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    x, y = _m(k * 7919 + F.col("user_id"), 1000), _m(k * 104729 + F.col("user_id") * 13, 1000)
    members = F.array(F.array(G.xy(x, y)), F.array(G.xy(x + _m(k, 7) * 4, y)), F.array(G.xy(x, y + _m(k, 5) * 6)))
    return e.select(k.alias("group_id"), G.make_geometry("MultiPoint", F.slice(members, 1, (_m(k, 3) + 1).cast("int"))).alias("geom"))


def layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine layers of the feature job, keyed like :func:`tessera.sources.layers.load_layers`."""
    return {
        "grid": grid(spark),
        "roads": roads(spark, sf_dir),
        "crashes": crashes(spark, sf_dir),
        "curbs": curbs(spark, sf_dir),
        "guardrails": guardrails(spark, sf_dir),
        "medians": medians(spark, sf_dir),
        "sidewalks": sidewalks(spark, sf_dir),
        "sign_panels": sign_panels(spark, sf_dir),
        "sign_mounts": sign_mounts(spark, sf_dir),
    }
