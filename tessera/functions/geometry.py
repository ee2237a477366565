"""Geometry as plain Spark columns.

A geometry is a struct ``GEOMETRY``::

    kind        string   Point | LineString | Polygon | MultiPoint |
                         MultiLineString | MultiPolygon | GeometryCollection
    parts       array<array<struct<x double, y double>>>
                         one vertex list per point, line or polygon ring
    poly_rings  array<int>  MultiPolygon: rings per polygon;
                         GeometryCollection: three numbers a part (see
                         collect_members); else null

Every function here returns a ``Column`` built from built-in Spark
expressions (higher-order functions for vertex and edge lists), so the
spatial work runs inside whole-stage code generation on the executors.

Semantics follow the usual planar predicates:

* ``contains(cell, point)`` is strict: a point on the cell border is not
  contained.
* clipping is against the *closed* cell: a line lying on a shared border
  belongs to both cells.
* lengths are planar, in the units of the input coordinates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()),
                      T.StructField("y", T.DoubleType())])
GEOMETRY = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("parts", T.ArrayType(T.ArrayType(POINT))),
    T.StructField("poly_rings", T.ArrayType(T.IntegerType())),
])
PARTS = GEOMETRY["parts"].dataType

INF = float("inf")
# Relative tolerance of the on-border test for sloped edges.
EPS = 1e-9


_MEMO: dict = {}


def memo(key: tuple, build: Callable[[], object]):
    """Build a (tuple of) Column expression(s) once per SparkContext.

    Columns are immutable expression trees, reusable in any DataFrame of the
    same JVM. The large clipping and cell-shape expressions take thousands
    of Py4J calls to build, so the operators build them once per parameter
    set (column names, tile side) instead of once per query.
    """
    sc = SparkContext._active_spark_context
    k = (id(sc._jsc) if sc is not None else None,) + tuple(key)
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def _c(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.lit(v)


def _d(v) -> Column:
    return _c(v).cast("double")


def nonzero(d: Column) -> Column:
    """Divisor guard: ANSI mode raises on x / 0 even in an unused branch."""
    return F.when(d == 0, F.lit(1.0)).otherwise(d)


# --------------------------------------------------------------------------
# constructors
# --------------------------------------------------------------------------

def xy(x, y) -> Column:
    return F.struct(_d(x).alias("x"), _d(y).alias("y"))


def make_geometry(kind: str | Column, parts: Column,
                  poly_rings: Column | None = None) -> Column:
    rings = poly_rings if poly_rings is not None else F.lit(None).cast("array<int>")
    return F.struct(_c(kind).alias("kind") if isinstance(kind, Column) else F.lit(kind).alias("kind"),
                    parts.alias("parts"), rings.alias("poly_rings"))


def point(x, y) -> Column:
    return make_geometry("Point", F.array(F.array(xy(x, y))))


def linestring(*coords) -> Column:
    """``linestring((x1, y1), (x2, y2), ...)`` from columns or numbers."""
    return make_geometry("LineString", F.array(F.array(*[xy(a, b) for a, b in coords])))


def linestring_from(points: Column) -> Column:
    """LineString from an ``array<struct<x, y>>`` column."""
    return make_geometry("LineString", F.array(points))


def polygon_from(rings: Column) -> Column:
    """Polygon from an ``array<array<struct<x, y>>>`` column (outer ring first)."""
    return make_geometry("Polygon", rings)


def box(xmin, ymin, xmax, ymax) -> Column:
    """Closed rectangle polygon, counter-clockwise from (xmin, ymin)."""
    ring = F.array(xy(xmin, ymin), xy(xmax, ymin), xy(xmax, ymax),
                   xy(xmin, ymax), xy(xmin, ymin))
    return polygon_from(F.array(ring))


# The WKB codes of the kinds.
KIND_CODES = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6}
COLLECTION = "GeometryCollection"


def collect_members(members: Column) -> Column:
    """A GeometryCollection of an array of geometries that are none themselves.

    Every part keeps its own kind: ``poly_rings`` has for each part its
    member's number, the code of the member's kind and the number of its
    polygon, all counted from 0. Members without parts leave no trace.
    """
    codes = F.create_map(*[F.lit(v) for k, c in KIND_CODES.items() for v in (k, c)])

    def parts_of(m, i):
        # the polygon of each ring: rings of a Polygon are of polygon 0
        rings = F.when(m["kind"] == "MultiPolygon", F.flatten(F.transform(m["poly_rings"], lambda n, k: F.array_repeat(k, n))))
        n = F.size(m["parts"])
        polygon = F.coalesce(rings, F.array_repeat(F.lit(0), n))
        # zipped, so that the inner lambda holds nothing of the outer one
        three = F.arrays_zip(F.array_repeat(i, n).alias("i"), F.array_repeat(codes[m["kind"]], n).alias("c"), polygon.alias("p"))
        return F.flatten(F.transform(three, lambda t: F.array(t["i"], t["c"], t["p"])))
    return make_geometry(COLLECTION, F.flatten(F.transform(members, lambda m: m["parts"])), F.flatten(F.transform(members, parts_of)))


def collection_members(g) -> Column:
    """The geometries of a collection as an array; of any other geometry itself alone."""
    g = _c(g)
    three = F.transform(g["parts"], lambda p, i: F.struct(
        p.alias("part"), F.get(g["poly_rings"], 3 * i).alias("member"), F.get(g["poly_rings"], 3 * i + 1).alias("code"), F.get(g["poly_rings"], 3 * i + 2).alias("polygon")))
    kinds = F.create_map(*[F.lit(v) for k, c in KIND_CODES.items() for v in (c, k)])

    def member(i):
        own = F.filter(three, lambda t: t["member"] == i)
        code = F.get(own, F.lit(0))["code"]
        polygons = F.array_distinct(F.transform(own, lambda t: t["polygon"]))
        rings = F.transform(polygons, lambda p: F.size(F.filter(own, lambda t: t["polygon"] == p)))
        return F.struct(kinds[code].alias("kind"), F.transform(own, lambda t: t["part"]).alias("parts"), F.when(code == 6, rings).alias("poly_rings"))
    many = F.transform(F.array_distinct(F.transform(three, lambda t: t["member"])), member)
    return F.when(g["kind"] == COLLECTION, many).when(g.isNotNull(), F.array(g.cast(GEOMETRY)))


def holds_areas(g) -> Column:
    """A (multi-)polygon, or a collection with one among its members."""
    g = _c(g)
    codes = F.filter(g["poly_rings"], lambda c, i: (i % 3 == 1) & c.isin(3, 6))
    return g["kind"].isin("Polygon", "MultiPolygon") | ((g["kind"] == COLLECTION) & F.coalesce(F.size(codes) > 0, F.lit(False)))


# --------------------------------------------------------------------------
# accessors
# --------------------------------------------------------------------------

def vertices(g) -> Column:
    return F.flatten(_c(g)["parts"])


def bbox(g) -> Column:
    """struct(xmin, ymin, xmax, ymax) of all vertices; null for null geometry."""
    pts = vertices(g)
    xs, ys = pts["x"], pts["y"]  # of all points at once, in generated code
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def n_vertices(g) -> Column:
    return F.size(vertices(g))


def part_segments(part: Column) -> Column:
    """Consecutive vertex pairs of one vertex list."""
    m = F.greatest(F.size(part) - 1, F.lit(0))
    return F.zip_with(F.slice(part, 1, m), F.slice(part, 2, m),
                      lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"),
                                            b["x"].alias("x2"), b["y"].alias("y2")))


def segments(g) -> Column:
    """All segments of a geometry: line parts, or polygon rings (boundary).

    Points give an empty array.
    """
    return F.flatten(F.transform(_c(g)["parts"], part_segments))


def is_rectangle(g, bb: Column | None = None) -> Column:
    """True for a one-ring Polygon that is an axis-aligned rectangle of positive area.

    ``bb`` may pass an already computed :func:`bbox` column.
    """
    g = _c(g)
    ring = F.get(g["parts"], 0)
    bb = bb if bb is not None else bbox(g)
    edges = part_segments(ring)
    corner_ok = F.forall(ring, lambda p: ((p["x"] == bb["xmin"]) | (p["x"] == bb["xmax"]))
                         & ((p["y"] == bb["ymin"]) | (p["y"] == bb["ymax"])))
    horiz = F.transform(edges, lambda e: (e["y1"] == e["y2"]) & (e["x1"] != e["x2"]))
    vert = F.transform(edges, lambda e: (e["x1"] == e["x2"]) & (e["y1"] != e["y2"]))
    h = [F.get(horiz, i) for i in range(4)]
    v = [F.get(vert, i) for i in range(4)]
    alternating = (h[0] & v[1] & h[2] & v[3]) | (v[0] & h[1] & v[2] & h[3])
    first, last = F.get(ring, 0), F.get(ring, 4)
    return F.coalesce(
        (g["kind"] == "Polygon") & (F.size(g["parts"]) == 1) & (F.size(ring) == 5)
        & (first["x"] == last["x"]) & (first["y"] == last["y"])
        & (bb["xmax"] > bb["xmin"]) & (bb["ymax"] > bb["ymin"])
        & corner_ok & alternating,
        F.lit(False))


def length(g) -> Column:
    """Planar length: sum of segment lengths (perimeter for polygons)."""
    return F.aggregate(segments(g), F.lit(0.0),
                       lambda acc, s: acc + F.sqrt((s["x2"] - s["x1"]) ** 2
                                                   + (s["y2"] - s["y1"]) ** 2))


# --------------------------------------------------------------------------
# segment clipping (Liang-Barsky parameter ranges)
# --------------------------------------------------------------------------

def axis_range(p1: Column, d: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
    """Parameter range of ``lo <= p1 + t*d <= hi``; empty as (+inf, -inf)."""
    ta = (lo - p1) / nonzero(d)
    tb = (hi - p1) / nonzero(d)
    inside = (p1 >= lo) & (p1 <= hi)
    t_lo = F.when(d == 0, F.when(inside, F.lit(-INF)).otherwise(F.lit(INF))) \
        .otherwise(F.least(ta, tb))
    t_hi = F.when(d == 0, F.when(inside, F.lit(INF)).otherwise(F.lit(-INF))) \
        .otherwise(F.greatest(ta, tb))
    return t_lo, t_hi


def tile_axis_range(p1: Column, d: Column, k: Column, side: float) -> tuple[Column, Column]:
    """Parameter range inside the half-open tile column ``[k*side, (k+1)*side)``.

    A segment parallel to the axis belongs to the tile that holds its
    coordinate, so that tiles partition every segment exactly once.
    """
    lo = k * F.lit(side)
    hi = (k + 1) * F.lit(side)
    own = F.floor(p1 / F.lit(side)) == k
    t_lo = F.when(d == 0, F.when(own, F.lit(-INF)).otherwise(F.lit(INF))) \
        .otherwise(F.least((lo - p1) / nonzero(d), (hi - p1) / nonzero(d)))
    t_hi = F.when(d == 0, F.when(own, F.lit(INF)).otherwise(F.lit(-INF))) \
        .otherwise(F.greatest((lo - p1) / nonzero(d), (hi - p1) / nonzero(d)))
    return t_lo, t_hi


def seg_len(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)


# --------------------------------------------------------------------------
# general polygons: even-odd rule over edge lists
# --------------------------------------------------------------------------

def polygon_edges(g) -> Column:
    """Edges of all rings of a (Multi)Polygon as array<struct<x1, y1, x2, y2>>."""
    return segments(g)


def _on_edge(e: Column, px: Column, py: Column) -> Column:
    dx = e["x2"] - e["x1"]
    dy = e["y2"] - e["y1"]
    cross = dx * (py - e["y1"]) - dy * (px - e["x1"])
    scale = (F.abs(dx) + F.abs(dy)) * (F.lit(1.0) + F.abs(px) + F.abs(py))
    return ((F.abs(cross) <= F.lit(EPS) * scale)
            & (px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
            & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"])))


def _crosses(e: Column, px: Column, py: Column) -> Column:
    straddles = (e["y1"] > py) != (e["y2"] > py)
    x_at = (e["x2"] - e["x1"]) * (py - e["y1"]) / nonzero(e["y2"] - e["y1"]) + e["x1"]
    return straddles & (px < x_at)


def on_boundary(edges: Column, px, py) -> Column:
    px, py = _d(px), _d(py)
    return F.exists(edges, lambda e: _on_edge(e, px, py))


def inside_even_odd(edges: Column, px, py) -> Column:
    px, py = _d(px), _d(py)
    return F.aggregate(edges, F.lit(False), lambda acc, e: acc != F.coalesce(_crosses(e, px, py), F.lit(False)))


def contains_point(edges: Column, px, py) -> Column:
    """Strict containment of (px, py) in the polygon with these edges."""
    return inside_even_odd(edges, px, py) & ~on_boundary(edges, px, py)


def covers_point(edges: Column, px, py) -> Column:
    """Closed containment: interior or border."""
    return inside_even_odd(edges, px, py) | on_boundary(edges, px, py)


# --------------------------------------------------------------------------
# convex polygons: half-plane intersection (Cyrus-Beck)
# --------------------------------------------------------------------------

def _edge_cross(e: Column, px: Column, py: Column) -> Column:
    """Cross product of the edge direction with (p - edge start); > 0 left of the edge."""
    return (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])


def _edge_tol(e: Column, px: Column, py: Column) -> Column:
    return F.lit(EPS) * (F.abs(e["x2"] - e["x1"]) + F.abs(e["y2"] - e["y1"])) \
        * (F.lit(1.0) + F.abs(px) + F.abs(py))


def signed_area2(edges: Column) -> Column:
    """Twice the signed area of the rings whose edges these are (> 0: counter-clockwise)."""
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + e["x1"] * e["y2"] - e["x2"] * e["y1"])


def ccw_edges(g) -> Column:
    """Non-degenerate edges of a one-ring polygon, oriented counter-clockwise."""
    es = F.filter(segments(g), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))
    flipped = F.transform(es, lambda e: F.struct(e["x2"].alias("x1"), e["y2"].alias("y1"),
                                                 e["x1"].alias("x2"), e["y1"].alias("y2")))
    return F.when(signed_area2(es) < 0, flipped).otherwise(es)


def is_convex(g, edges: Column) -> Column:
    """One-ring polygon of positive area whose CCW ``edges`` only turn left, winding once."""
    g = _c(g)
    n = F.size(edges)
    nxt = F.concat(F.slice(edges, 2, F.greatest(n - 1, F.lit(0))), F.slice(edges, 1, 1))
    turns = F.zip_with(edges, nxt, lambda a, b: (a["x2"] - a["x1"]) * (b["y2"] - b["y1"])
                       - (a["y2"] - a["y1"]) * (b["x2"] - b["x1"]))

    def changes(sel):
        s = F.filter(F.transform(edges, lambda e: F.signum(sel(e))), lambda v: v != 0)
        m = F.size(s)
        s_next = F.concat(F.slice(s, 2, F.greatest(m - 1, F.lit(0))), F.slice(s, 1, 1))
        return F.size(F.filter(F.zip_with(s, s_next, lambda a, b: a != b), lambda c: c))

    return F.coalesce(
        (g["kind"] == "Polygon") & (F.size(g["parts"]) == 1) & (n >= 3)
        & (signed_area2(edges) > 0) & F.forall(turns, lambda t: t >= 0)
        & (changes(lambda e: e["x2"] - e["x1"]) <= 2) & (changes(lambda e: e["y2"] - e["y1"]) <= 2),
        F.lit(False))


def convex_contains_point(edges: Column, px, py) -> Column:
    """Strictly inside a convex polygon given by CCW edges."""
    px, py = _d(px), _d(py)
    return F.forall(edges, lambda e: _edge_cross(e, px, py) > _edge_tol(e, px, py))


def convex_covers_point(edges: Column, px, py) -> Column:
    """Inside a convex polygon given by CCW edges, or on its border."""
    px, py = _d(px), _d(py)
    return F.forall(edges, lambda e: _edge_cross(e, px, py) >= -_edge_tol(e, px, py))


def on_edge_line(e: Column, px: Column, py: Column) -> Column:
    """(px, py) lies on the line through edge ``e``."""
    return F.abs(_edge_cross(e, px, py)) <= _edge_tol(e, px, py)


def convex_clip_fraction(edges: Column, x1: Column, y1: Column, x2: Column, y2: Column,
                         t0: Column, t1: Column) -> Column:
    """Measure of ``{t in [t0, t1]}`` inside the closed convex polygon (CCW edges)."""
    dx = x2 - x1
    dy = y2 - y1

    def step(acc, e):
        a = _edge_cross(e, x1, y1)
        b = (e["x2"] - e["x1"]) * dy - (e["y2"] - e["y1"]) * dx
        keep = a >= -_edge_tol(e, x1, y1)
        lo = F.when(b > 0, -a / nonzero(b)).when(b == 0, F.when(keep, F.lit(-INF)).otherwise(F.lit(INF))) \
            .otherwise(F.lit(-INF))
        hi = F.when(b < 0, -a / nonzero(b)).when(b == 0, F.when(keep, F.lit(INF)).otherwise(F.lit(-INF))) \
            .otherwise(F.lit(INF))
        return F.struct(F.greatest(acc["lo"], lo).alias("lo"), F.least(acc["hi"], hi).alias("hi"))

    r = F.aggregate(edges, F.struct(t0.alias("lo"), t1.alias("hi")), step)
    return F.greatest(r["hi"] - r["lo"], F.lit(0.0))


def convex_range(edges: Column, x1: Column, y1: Column, x2: Column, y2: Column, t0: Column, t1: Column) -> Column:
    """(lo, hi): the parameters in [t0, t1] of the segment inside the closed convex polygon; lo > hi when none is."""
    def step(acc, e):
        lo, hi = _half_plane_range(e, x1, y1, x2 - x1, y2 - y1)
        return F.struct(F.greatest(acc["lo"], lo).alias("lo"), F.least(acc["hi"], hi).alias("hi"))
    return F.aggregate(edges, F.struct(t0.alias("lo"), t1.alias("hi")), step)


# Convex cells with at most this many edges use the unrolled forms below,
# which stay in generated code (lambda functions are interpreted).
UNROLL_EDGES = 8


def _half_plane_range(e: Column, x1: Column, y1: Column, dx: Column, dy: Column) -> tuple[Column, Column]:
    """Parameter range of the segment left of (or on) edge ``e``; nulls for a missing edge."""
    a = _edge_cross(e, x1, y1)
    b = (e["x2"] - e["x1"]) * dy - (e["y2"] - e["y1"]) * dx
    keep = a >= -_edge_tol(e, x1, y1)
    lo = F.when(b > 0, -a / nonzero(b)).when(b == 0, F.when(keep, F.lit(-INF)).otherwise(F.lit(INF)))
    hi = F.when(b < 0, -a / nonzero(b)).when(b == 0, F.when(keep, F.lit(INF)).otherwise(F.lit(-INF)))
    return lo, hi


def convex_clip_fraction_unrolled(edges: Column, x1: Column, y1: Column, x2: Column, y2: Column,
                                  t0: Column, t1: Column, k: int = UNROLL_EDGES) -> Column:
    """:func:`convex_clip_fraction` for polygons of at most ``k`` edges, without lambdas."""
    dx = x2 - x1
    dy = y2 - y1
    los, his = [t0], [t1]
    for i in range(k):
        lo, hi = _half_plane_range(F.get(edges, i), x1, y1, dx, dy)
        los.append(lo)
        his.append(hi)
    return F.greatest(F.least(*his) - F.greatest(*los), F.lit(0.0))


def convex_contains_point_unrolled(edges: Column, px, py, k: int = UNROLL_EDGES) -> Column:
    """:func:`convex_contains_point` for polygons of at most ``k`` edges, without lambdas."""
    px, py = _d(px), _d(py)
    cond = None
    for i in range(k):
        e = F.get(edges, i)
        c = e.isNull() | (_edge_cross(e, px, py) > _edge_tol(e, px, py))
        cond = c if cond is None else cond & c
    return cond


# --------------------------------------------------------------------------
# lines that pass a stretch more than once
# --------------------------------------------------------------------------

def supporting_segments(parts: Column) -> Column:
    """The segments of positive length, each as (k1, k2, lo, hi, a, b), sorted.

    ``k1, k2`` name the supporting line (slope and intercept; for a vertical
    one infinity and x), ``lo, hi`` the interval on it, ``a, b`` its ends. Segments
    on one line have equal keys when their coordinate differences and
    products are exact, as on any integer lattice; a stretch passed again
    between the same two vertices always has.
    """
    def keyed(s):
        flip = (s["x1"] > s["x2"]) | ((s["x1"] == s["x2"]) & (s["y1"] > s["y2"]))
        a, b = xy(s["x1"], s["y1"]), xy(s["x2"], s["y2"])
        a, b = F.when(flip, b).otherwise(a), F.when(flip, a).otherwise(b)
        # differences of the ordered ends: dx is not negative
        dx, dy = F.abs(s["x2"] - s["x1"]), F.when(flip, s["y1"] - s["y2"]).otherwise(s["y2"] - s["y1"])
        upright = dx == 0
        return F.struct(F.when(upright, F.lit(INF)).otherwise(dy / nonzero(dx) + 0.0).alias("k1"),
                        F.when(upright, s["x1"]).otherwise((s["x1"] * dy - s["y1"] * dx) / nonzero(dx) + 0.0).alias("k2"),
                        F.when(upright, a["y"]).otherwise(a["x"]).alias("lo"), F.when(upright, b["y"]).otherwise(b["x"]).alias("hi"),
                        a.alias("a"), b.alias("b"))
    whole = F.filter(F.flatten(F.transform(parts, part_segments)), lambda s: (s["x1"] != s["x2"]) | (s["y1"] != s["y2"]))
    return F.array_sort(F.transform(whole, keyed))


def _one_line(p: Column, q: Column) -> Column:
    return (p["k1"] == q["k1"]) & (p["k2"] == q["k2"])


def is_retraced(segs: Column) -> Column:
    """Some two of the sorted supporting segments share a stretch; then two neighbours do."""
    m = F.greatest(F.size(segs) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(segs, 1, m), F.slice(segs, 2, m), lambda p, q: _one_line(p, q) & (q["lo"] < p["hi"]))
    return F.exists(pairs, lambda c: c)


def merged_segments(segs: Column) -> Column:
    """Parts of two vertices each that cover what the sorted supporting segments cover, every stretch once."""
    kind = "struct<k1:double,k2:double,lo:double,hi:double,a:struct<x:double,y:double>,b:struct<x:double,y:double>>"

    def step(acc, s):
        now = acc["now"]
        joins = F.coalesce(_one_line(now, s) & (s["lo"] <= now["hi"]), F.lit(False))
        longer = F.struct(now["k1"].alias("k1"), now["k2"].alias("k2"), now["lo"].alias("lo"), F.greatest(now["hi"], s["hi"]).alias("hi"),
                          now["a"].alias("a"), F.when(s["hi"] > now["hi"], s["b"]).otherwise(now["b"]).alias("b"))
        return F.struct(F.when(joins | now.isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(now))).alias("done"),
                        F.when(joins, longer).otherwise(s).cast(kind).alias("now"))
    start = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("now"))
    merged = F.aggregate(segs, start, step, lambda acc: F.concat(acc["done"], F.array(acc["now"])))
    return F.transform(merged, lambda s: F.array(s["a"], s["b"]))


# --------------------------------------------------------------------------
# polygons that are not convex: trapezoids between two edges
# --------------------------------------------------------------------------

EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def x_at(e: Column, y: Column) -> Column:
    """Where an upward edge is at height ``y``; exact at its ends and on upright edges."""
    return (F.when((y == e["y1"]) | (e["x1"] == e["x2"]), e["x1"]).when(y == e["y2"], e["x2"])
            .otherwise(e["x1"] + (y - e["y1"]) * ((e["x2"] - e["x1"]) / nonzero(e["y2"] - e["y1"]))))


def slab_trapezoids(edges: Column) -> Column:
    """The polygon of these edges (rings of any nesting) as (l, r, lo, hi): between upward edges l and r from height lo to hi.

    Heights are cut at every vertex; between two of them the edges that cross
    the slab, sorted by place, bound the inside by even-odd pairs. Sorted so
    that trapezoids between the same two edges follow one another upward.
    """
    up = F.transform(F.filter(edges, lambda e: e["y1"] != e["y2"]), lambda e: F.when(e["y1"] < e["y2"], e).otherwise(F.struct(
        e["x2"].alias("x1"), e["y2"].alias("y1"), e["x1"].alias("x2"), e["y1"].alias("y2"))).cast(EDGE))
    heights = F.array_sort(F.array_distinct(F.concat(F.transform(up, lambda e: e["y1"]), F.transform(up, lambda e: e["y2"]))))
    m = F.greatest(F.size(heights) - 1, F.lit(0))

    def slab(lo, hi):
        crossing = F.filter(up, lambda e: (e["y1"] <= lo) & (e["y2"] >= hi))
        placed = F.array_sort(F.transform(crossing, lambda e: F.struct(x_at(e, (lo + hi) / 2).alias("x"), e.alias("e"))))
        pairs = F.filter(F.transform(placed, lambda p, k: F.struct(p["e"].alias("l"), F.get(placed, k + 1)["e"].alias("r"), k.alias("k"))),
                         lambda p: (p["k"] % 2 == 0) & p["r"].isNotNull() & (p["l"] != p["r"]))
        return F.transform(pairs, lambda p: F.struct(p["l"].alias("l"), p["r"].alias("r"), lo.alias("lo"), hi.alias("hi")))
    return F.array_sort(F.flatten(F.zip_with(F.slice(heights, 1, m), F.slice(heights, 2, m), slab)))


def merged_trapezoids(slabs: Column) -> Column:
    """Trapezoids between the same two edges, one on top of the other, as one."""
    kind = f"struct<l:{EDGE},r:{EDGE},lo:double,hi:double>"

    def step(acc, t):
        now = acc["now"]
        joins = F.coalesce((now["l"] == t["l"]) & (now["r"] == t["r"]) & (now["hi"] == t["lo"]), F.lit(False))
        taller = F.struct(now["l"].alias("l"), now["r"].alias("r"), now["lo"].alias("lo"), t["hi"].alias("hi"))
        return F.struct(F.when(joins | now.isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(now))).alias("done"),
                        F.when(joins, taller).otherwise(t).cast(kind).alias("now"))
    start = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("now"))
    return F.aggregate(slabs, start, step, lambda acc: F.when(acc["now"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["now"]))))


def trapezoids_below(t: Column, all_of_them: Column) -> Column:
    """The side edges (l, r) of the trapezoids on which ``t`` stands along a stretch."""
    under = F.filter(all_of_them, lambda b: (b["hi"] == t["lo"]) & (x_at(b["l"], t["lo"]) < x_at(t["r"], t["lo"]))
                     & (x_at(b["r"], t["lo"]) > x_at(t["l"], t["lo"])))
    return F.transform(under, lambda b: F.struct(b["l"].alias("l"), b["r"].alias("r")))


def between(l: Column, r: Column, px: Column, py: Column) -> Column:
    """(px, py) lies strictly between two upward edges (right of ``l``, left of ``r``)."""
    return (_edge_cross(l, px, py) < -_edge_tol(l, px, py)) & (_edge_cross(r, px, py) > _edge_tol(r, px, py))


def between_range(l: Column, r: Column, x1: Column, y1: Column, x2: Column, y2: Column, t0: Column, t1: Column) -> tuple[Column, Column]:
    """Parameter range within [t0, t1] of a segment between two upward edges, the edges included."""
    down = F.struct(l["x2"].alias("x1"), l["y2"].alias("y1"), l["x1"].alias("x2"), l["y1"].alias("y2"))
    lo_l, hi_l = _half_plane_range(down, x1, y1, x2 - x1, y2 - y1)
    lo_r, hi_r = _half_plane_range(r, x1, y1, x2 - x1, y2 - y1)
    return F.greatest(t0, lo_l, lo_r), F.least(t1, hi_l, hi_r)
