"""Spatial joins between grid cells and layers, as tile-keyed equi-joins.

The plane is cut into half-open square tiles ``[k*s, (k+1)*s)`` of side
``s``. Cells, points and line segments each get the tiles they touch, the two
sides are equi-joined on ``(tx, ty)`` and the exact test runs on the joined
pairs only. Spark therefore plans an ordinary hash join instead of a nested
loop, and the join partitions by tile.

Tiles come in levels, each four times as wide as the one below: a cell is
listed at the level whose tiles are about its own size (at most nine of
them), and an item probes each level in use. A grid of like cells has one
level; a cell a thousand times as wide as the others adds one more level
and a few rows, not a million.

Cells that are not convex are cut once, when the grid is indexed, into
trapezoids between two of their edges, holes included. A trapezoid joins
like a cell of its own and keeps the id of its cell. Trapezoids touch along
level stretches only: a stretch that a trapezoid shares with one below is
counted by the lower one, and a point on it is inside when it is strictly
between the side edges of both.

* **Points** fall in exactly one tile of a level. A cell lists the tiles its interior
  touches, so a point strictly inside a cell meets it in exactly one tile:
  no pair repeats and no de-duplication is needed.
* **Lines** are cut into segments; each segment lists the tiles it crosses,
  walking column by column (cost grows with length, not with the area of
  its box). The piece of a segment counted in a tile is its part inside
  ``cell AND tile``; the half-open tiles partition the segment, so summing
  pieces gives the exact clipped length without a de-duplication shuffle.
  Cells list only the tiles their interior touches (one tile per cell when
  cells and tiles align). The one piece this misses - a vertical or
  horizontal segment lying on a tile boundary that is also a cell's right
  or top border - is caught by a flagged copy of the segment in the tile
  to the left or below, counted only for cells whose border it lies on; so
  a line on a shared border counts in both cells.
* A **retraced line**, one that passes a stretch more than once, is first
  replaced by segments that cover each stretch once, so that its length in
  a cell is that of the points it covers.

Join strategy. The cell side is broadcast only after a measured size check
(an upper bound of the rows and edges of its tile cover against
``broadcast_bytes``). Above the limit the join is a shuffled equi-join in
which *hot tiles* - tiles holding more than ``hot_tile_rows`` items - are
salted: their items are spread round-robin over ``ceil(count / hot_tile_rows)``
salt values and their few cells are replicated once per salt. The hot-tile
list is at most ``total_items / hot_tile_rows`` rows, so broadcasting it
has a proven bound. AQE's skew-join splitting stays on as a second line.

Lengths in boxes take no join above the limit: boxes and segments are sorted
by tile and measured in blocks (:mod:`tessera.operators.box_blocks`), and
only sums leave a tile. Of the hot tiles those of very many pairs are cut into
parts, their boxes one way and their segments the other.
"""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import geometry as G
from tessera.operators import box_blocks
from tessera.session import persist_shared

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_HOT_TILE_ROWS = 2_000_000
# Upper bounds of the bytes of a broadcast cell-tile row (14 fields, their hash
# table entry) without its key's text, and of a polygon edge, for the size check.
ROW_BYTES = 320
EDGE_BYTES = 64
# Widening of a segment's per-column y range, relative to the tile side, so
# that rounding never drops a tile the segment touches (extra tiles only add
# zero-length candidates).
COVER_SLACK = 1e-9

#: Boxes of a hot tile held at once, and pairs of its boxes and segments that one task measures.
HOT_BOXES = 100_000
HOT_PAIRS = 1 << 28

#: Each level's tiles are so many times as wide as those of the level below.
LEVEL_STEP = 4
#: A cell is at the lowest level whose tiles are at least this part of its width and height.
LEVEL_FIT = 0.5 * (1 - 1e-6)
#: Tiles that a cell lists at its own level at most, three each way.
COVER_TILES = 9
#: Convex cells of more edges use the level below, whose tiles are mostly either outside or wholly inside them.
FINE_EDGES = 16
FINE_TILES = (2 * LEVEL_STEP + 1) ** 2


@dataclass
class CellIndex:
    """Grid cells prepared for tile joins.

    ``cells`` has a row for each cell, or for each trapezoid of a cell that is
    not convex: ``grid_id``, the box, ``is_box`` (axis-aligned rectangle: box
    arithmetic only), ``is_convex`` (half-plane intersection over its
    counter-clockwise edges), ``edges`` (null for boxes) and ``below`` (null
    but for trapezoids: the side edges of those it stands on). ``levels`` are
    the tile levels in use. ``point_bytes`` / ``line_bytes`` bound the size of
    the tile cover and decide the join strategy. ``whole`` indexes the
    undivided cells where any was cut.
    """

    cells: DataFrame
    tile: float
    point_bytes: int
    line_bytes: int
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
    hot_tile_rows: int = DEFAULT_HOT_TILE_ROWS
    levels: tuple = (0,)
    whole: "CellIndex | None" = None
    fine: bool = False
    boxes_only: bool = False

    @property
    def keys(self) -> list[str]:
        """The columns of the tile join."""
        return ["tx", "ty"] if len(self.levels) == 1 else ["level", "tx", "ty"]

    @property
    def shape(self) -> tuple:
        """What the join's expressions depend on."""
        return self.tile, self.levels, self.whole is not None, self.boxes_only

    def side(self):
        """The side of the tiles of a row's level."""
        if len(self.levels) == 1:
            return F.lit(self.tile * float(LEVEL_STEP) ** self.levels[0])
        return F.lit(self.tile) * F.pow(F.lit(float(LEVEL_STEP)), F.col("level"))

    def at_each_level(self, items: DataFrame) -> DataFrame:
        """The items, once for each level in use."""
        return items if len(self.levels) == 1 else items.withColumn("level", F.explode(F.array(*[F.lit(k) for k in self.levels])))

    def tiles(self) -> DataFrame:
        """Cells exploded over the tiles of their level that their interior touches.

        Used for points and lines alike; lines lying exactly on a tile
        boundary that is also a cell's right or top border get an extra row
        in the neighbouring tile (see :func:`segment_tiles`).

        A tile wholly inside a many-edged cell becomes a box: what is in the
        tile is in the cell. In the other tiles such a cell keeps the edges
        whose lines touch the tile: the whole tile is strictly on the inner
        side of the others, so the few kept ones decide for all that is in it.
        """
        s = self.side()
        tx0 = F.floor(F.col("cxmin") / s)
        tx1 = F.greatest(F.ceil(F.col("cxmax") / s) - 1, tx0)
        ty0 = F.floor(F.col("cymin") / s)
        ty1 = F.greatest(F.ceil(F.col("cymax") / s) - 1, ty0)
        cover = self._over(tx0, tx1, ty0, ty1)
        if not self.fine:
            return cover
        corners = [((F.col("tx") + i) * s, (F.col("ty") + j) * s) for i in (0, 1) for j in (0, 1)]

        def cuts(e):
            return ~reduce(operator.and_, [G.convex_contains_point(F.array(e), x, y) for x, y in corners])
        cover = cover.withColumn("_near", F.when(_is_fine(), F.filter("edges", cuts)))
        cover = cover.withColumn("_inside", F.coalesce(F.size("_near") == 0, F.lit(False)))
        cover = cover.withColumn("edges", F.coalesce("_near", "edges")).drop("_near")
        return (cover.withColumn("is_box", F.col("is_box") | F.col("_inside")).withColumn("is_convex", F.col("is_convex") & ~F.col("_inside"))
                .withColumn("edges", F.when(~F.col("_inside"), F.col("edges"))).drop("_inside"))

    def touched_tiles(self) -> DataFrame:
        """Cells exploded over the tiles of their level that they touch, borders included."""
        s = self.side()
        return self._over(*[F.floor(F.col(c) / s) for c in ("cxmin", "cxmax", "cymin", "cymax")])

    def _over(self, tx0, tx1, ty0, ty1) -> DataFrame:
        cells = self.cells if len(self.levels) == 1 else self.cells.withColumn("level", _level(self.tile))
        return cells.withColumn("tx", F.explode(F.sequence(tx0, tx1))).withColumn("ty", F.explode(F.sequence(ty0, ty1)))

    point_tiles = tiles
    line_tiles = tiles

    def release(self) -> None:
        """Drop the persisted cells (after the last job that uses this index)."""
        self.cells.unpersist()
        if self.whole is not None:
            self.whole.release()


def _extent():
    return F.greatest(F.col("cxmax") - F.col("cxmin"), F.col("cymax") - F.col("cymin"))


def _is_fine():
    """A convex cell of so many edges that it pays to know which tiles are wholly inside."""
    return F.col("is_convex") & F.col("below").isNull() & (F.size("edges") > FINE_EDGES)


def _level(tile: float):
    """The level of a cell: the lowest whose tiles are at least ``LEVEL_FIT`` of its extent, one less for many-edged cells."""
    steps = F.ceil(F.log2(_extent() * LEVEL_FIT / F.lit(tile)) / math.log2(LEVEL_STEP))
    level = F.when(_extent() * LEVEL_FIT <= F.lit(tile), F.lit(0)).otherwise(steps.cast("int"))
    return level - _is_fine().cast("int")


def _trapezoids(cells: DataFrame) -> DataFrame:
    """The rows of the index, those of cells that are not convex cut into trapezoids."""
    general = ~F.col("is_box") & ~F.col("is_convex")
    rest = [c for c in cells.columns if c not in ("edges", "is_convex", "cxmin", "cymin", "cxmax", "cymax")]
    slabs, merged = G.memo(("trapezoids",), lambda: (G.slab_trapezoids(F.col("edges")), G.merged_trapezoids(F.col("_s"))))
    cut = cells.where(general).select(*rest, slabs.alias("_s")).select(*rest, merged.alias("_all"))
    cut = cut.select(*rest, "_all", F.explode("_all").alias("_t"))
    l, r, lo, hi = (F.col("_t")[k] for k in ("l", "r", "lo", "hi"))
    cut = cut.select(*rest, lo.alias("cymin"), hi.alias("cymax"),
                     F.least(G.x_at(l, lo), G.x_at(l, hi)).alias("cxmin"), F.greatest(G.x_at(r, lo), G.x_at(r, hi)).alias("cxmax"),
                     F.lit(True).alias("is_convex"), F.array(l, r).alias("edges"),
                     G.trapezoids_below(F.col("_t"), F.col("_all")).alias("below"))
    below = cut.schema["below"].dataType
    whole = cells.where(~general).withColumn("below", F.lit(None).cast(below))
    return whole.unionByName(cut)


def _field(name: str):
    return lambda e: e[name]


def _cell_shape_columns():
    """(is_box, is_convex, edges, bbox) over the columns ``_g``, ``_bb``, ``is_box``, ``is_convex``."""
    g = F.col("_g")
    rect = G.is_rectangle(g, F.col("_bb"))
    ccw = G.ccw_edges(g)
    convex = ~F.col("is_box") & G.is_convex(g, ccw)
    edges = (F.when(F.col("is_box"), F.lit(None))
             .when(F.col("is_convex"), ccw)
             .otherwise(G.polygon_edges(g)))
    return rect, convex, edges, G.bbox(g)


def index_cells(grid: DataFrame, id_col: str = "id", geom_col: str = "geom",
                tile: float | None = None,
                broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                hot_tile_rows: int = DEFAULT_HOT_TILE_ROWS,
                materialize: bool = True) -> CellIndex:
    """Prepare the grid: boxes, rectangle flag, edges, tile side, size estimate.

    The prepared cells are persisted (every spatial operator reads them
    again) unless ``materialize=False``. The tile side defaults to the median
    cell extent, so that a cell touches about four tiles and a tile about
    four cells; larger cells use the wider tiles of higher levels. One
    aggregate job over the cells gives the tile side and an upper bound of
    the size of the tile cover, which decides broadcast versus shuffled join;
    one more names the levels where cells differ much in size, and one bounds
    the trapezoids where cells are not convex (valid polygons: their rings
    do not cross).
    """
    g = F.col(geom_col)
    shape_box, shape_convex, shape_edges, bbox_col = G.memo(("cell_shape",), _cell_shape_columns)
    box_cols = ["cxmin", "cymin", "cxmax", "cymax"]
    cells = (grid.where(g.isNotNull())
             .select(F.col(id_col).alias("grid_id"), g.alias("_g"))
             .select("grid_id", "_g", bbox_col.alias("_bb"))
             .select("grid_id", "_g",
                     F.col("_bb.xmin").alias("cxmin"), F.col("_bb.ymin").alias("cymin"),
                     F.col("_bb.xmax").alias("cxmax"), F.col("_bb.ymax").alias("cymax"),
                     shape_box.alias("is_box"))
             .where(F.col("cxmin").isNotNull())
             .select("grid_id", "_g", *box_cols, "is_box", shape_convex.alias("is_convex"))
             .select("grid_id", *box_cols, "is_box", "is_convex", shape_edges.alias("edges")))
    if materialize:
        # Kept for every later join; recomputed from the grid if an executor is lost.
        cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    no_part = F.lit(None).cast(f"array<struct<l:{G.EDGE},r:{G.EDGE}>>").alias("below")
    st = cells.select("*", no_part).agg(F.percentile_approx(_extent(), 0.5).alias("s"), *_moments(),
                   F.sum((~F.col("is_box") & ~F.col("is_convex")).cast("long")).alias("general")).first()
    if tile is None:
        tile = float(st["s"]) if st["s"] else 1.0
        if not math.isfinite(tile) or tile <= 0:
            tile = 1.0
    index = _sized(cells.select("*", no_part), float(tile), st, broadcast_bytes, hot_tile_rows)
    if not st["general"]:
        return index
    # written out if not kept: else the optimizer would repeat the shape expressions inside those of the trapezoids
    parts = _trapezoids(cells if materialize else persist_shared(cells))
    if materialize:
        parts = parts.persist(StorageLevel.MEMORY_AND_DISK)
    cut = _sized(parts, float(tile), parts.agg(*_moments()).first(), broadcast_bytes, hot_tile_rows)
    cut.whole = index
    return cut


def _moments() -> list:
    """What bounds the size of a tile cover: rows, edges, the longest id, the largest extent; rows and edges of fine cells."""
    e = F.coalesce(F.size("edges"), F.lit(0)).cast("double")
    fine = F.coalesce(_is_fine(), F.lit(False))
    return [F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_box")).alias("shaped"), F.sum(e).alias("e"), F.count_if(fine).alias("fine"), F.sum(F.when(fine, e)).alias("fine_e"),
            F.max(F.octet_length(F.col("grid_id").cast("string"))).alias("key"), F.max(_extent()).alias("most")]


def _sized(cells: DataFrame, tile: float, st, broadcast_bytes: int, hot_tile_rows: int) -> CellIndex:
    """An index with its levels and the bound of its cover: a cell lists at most ``COVER_TILES`` tiles at its level, a fine one ``FINE_TILES``."""
    levels = (0,)
    if (st["most"] or 0) * LEVEL_FIT > tile or st["fine"]:
        levels = tuple(sorted(r[0] for r in cells.select(_level(tile)).distinct().collect()))  # as many as there are levels
    rows = COVER_TILES * (st["n"] or 0) + (FINE_TILES - COVER_TILES) * st["fine"]
    edges = COVER_TILES * 3 * (st["e"] or 0) + FINE_TILES * (st["fine_e"] or 0)  # a trapezoid stands on few others: two side edges each
    size = int(rows * (ROW_BYTES + (st["key"] or 0)) + EDGE_BYTES * edges)
    return CellIndex(cells, tile, size, size, broadcast_bytes, hot_tile_rows, levels, fine=bool(st["fine"]), boxes_only=not st["shaped"])


def _tile_join(items: DataFrame, cell_tiles: DataFrame, est_bytes: int,
               idx: CellIndex) -> DataFrame:
    """Equi-join items and cells on their tile: broadcast if checked small, else salted shuffle."""
    keys = idx.keys
    if est_bytes <= idx.broadcast_bytes:
        return items.join(F.broadcast(cell_tiles), keys)
    hot_rows = idx.hot_tile_rows
    # Per-tile item counts: partial aggregation before the shuffle, one row per tile.
    hot = (items.groupBy(*keys).count()
                .where(F.col("count") > hot_rows)
                .select(*keys, F.ceil(F.col("count") / hot_rows).cast("int").alias("n_salt")))
    # Counted once, bounded by total_items / hot_tile_rows rows. The salt below is a
    # hash of the row, so a task that runs again salts as before.
    hot = persist_shared(hot)
    salted_items = (items.join(F.broadcast(hot), keys, "left")
                    .withColumn("salt", F.when(F.col("n_salt").isNull(), F.lit(0))
                                .otherwise(F.pmod(F.xxhash64(*items.columns), F.col("n_salt")).cast("int")))
                    .drop("n_salt"))
    salted_cells = (cell_tiles.join(F.broadcast(hot), keys, "left")
                    .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n_salt"), F.lit(1)) - 1)))
                    .drop("n_salt"))
    # The hint keeps Spark from broadcasting the cover, whose size its statistics miss.
    return salted_items.join(salted_cells.hint("merge"), [*keys, "salt"]).drop("salt")


# --------------------------------------------------------------------------
# points
# --------------------------------------------------------------------------

def _in_closed_cell(px, py):
    """(px, py) inside the joined cell or on its border."""
    in_box = (px >= F.col("cxmin")) & (px <= F.col("cxmax")) & (py >= F.col("cymin")) & (py <= F.col("cymax"))
    return in_box & (F.when(F.col("is_box"), F.lit(True))
                     .when(F.col("is_convex"), G.convex_covers_point(F.col("edges"), px, py))
                     .otherwise(G.covers_point(F.col("edges"), px, py)))


def _in_open_cell(px, py):
    """(px, py) strictly inside the joined cell."""
    in_box = (px > F.col("cxmin")) & (px < F.col("cxmax")) & (py > F.col("cymin")) & (py < F.col("cymax"))
    return in_box & (F.when(F.col("is_box"), F.lit(True))
                     .when(F.col("is_convex"), G.convex_contains_point(F.col("edges"), px, py))
                     .otherwise(G.contains_point(F.col("edges"), px, py)))


def _members_columns():
    """(members of a point geometry, whether member ``_i`` stands for them all in the joined cell).

    A multi-point lies in a cell when no member is outside the closed cell
    and one is strictly inside; its first such member makes the pair, so a
    pair shows once however many tiles the members fall in.
    """
    g = F.col("_g")
    members = F.when(g["kind"].isin("Point", "MultiPoint"), G.vertices(g)).when(g.isNotNull(), F.raise_error(
        F.concat(F.lit("points_in_cells takes points, not "), g["kind"])).cast("array<struct<x:double,y:double>>"))
    members = F.filter(members, lambda p: p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"]))
    earlier = F.slice(F.col("_m"), 1, F.col("_i"))
    first = F.col("_m").isNull() | (F.forall("_m", lambda p: _in_closed_cell(p["x"], p["y"]))
                                    & ~F.exists(earlier, lambda p: _in_open_cell(p["x"], p["y"])))
    return members, first


def _point_columns(idx: CellIndex):
    """(tx, ty, inside) for columns px, py and the cell columns."""
    px, py, s = F.col("px"), F.col("py"), idx.side()
    in_box = (px > F.col("cxmin")) & (px < F.col("cxmax")) & (py > F.col("cymin")) & (py < F.col("cymax"))
    if idx.boxes_only:  # a short expression, all of it generated code
        return F.floor(px / s), F.floor(py / s), in_box
    small = F.size("edges") <= G.UNROLL_EDGES
    inside = (F.when(F.col("is_box"), in_box)
              .when(F.col("is_convex") & small, in_box & G.convex_contains_point_unrolled(F.col("edges"), px, py))
              .when(F.col("is_convex"), in_box & G.convex_contains_point(F.col("edges"), px, py))
              .otherwise(in_box & G.contains_point(F.col("edges"), px, py)))
    if idx.whole is not None:
        edges = F.col("edges")
        part = (py >= F.col("cymin")) & (py < F.col("cymax")) & G.between(edges[0], edges[1], px, py) & (
            (py > F.col("cymin")) | F.exists("below", lambda b: G.between(b["l"], b["r"], px, py)))
        inside = F.when(F.col("below").isNotNull(), part).otherwise(inside)
    return F.floor(px / s), F.floor(py / s), inside


def points_in_cells(idx: CellIndex, points: DataFrame, geom_col: str = "geom",
                    keep: list[str] | None = None) -> DataFrame:
    """Pairs (cell, point) with the point strictly inside the cell.

    Returns ``grid_id`` plus the ``keep`` columns of the point layer (all
    non-geometry columns by default) and ``px``, ``py``. A point on a border
    is in no cell; a point in overlapping cells is in each. A multi-point is
    contained as a whole: no member outside the closed cell, at least one
    strictly inside; ``px``, ``py`` are then its first member strictly
    inside. Other kinds than points raise; null and empty ones are in no cell.

    Where cells were cut into trapezoids, points join with those and
    multi-points, which need their whole cell, with the undivided cells.
    """
    keep = keep if keep is not None else [c for c in points.columns if c != geom_col]
    members, first = G.memo(("members",), _members_columns)
    pts = points.select(*keep, F.col(geom_col).alias("_g")).select(*keep, members.alias("_all"))
    if idx.whole is None:
        return _contained(idx, pts, keep, first)
    single = _contained(idx, pts.where(F.size("_all") == 1), keep, None)
    return single.unionByName(_contained(idx.whole, pts.where(F.size("_all") > 1), keep, first))


def _contained(idx: CellIndex, pts: DataFrame, keep: list[str], first) -> DataFrame:
    """Pairs of the cells and the members ``_all`` strictly inside for which ``first`` holds."""
    tx, ty, inside = G.memo(("points", idx.shape), lambda: _point_columns(idx))
    many = F.when(F.size("_all") > 1, F.col("_all")).alias("_m")
    level = [] if len(idx.levels) == 1 else ["level"]
    pts = (pts.select(*keep, many, F.posexplode("_all").alias("_i", "_p"))
              .select(*keep, "_m", "_i", F.col("_p.x").alias("px"), F.col("_p.y").alias("py")))
    pts = idx.at_each_level(pts).select(*keep, *level, "_m", "_i", "px", "py", tx.alias("tx"), ty.alias("ty"))
    pairs = _tile_join(pts, idx.point_tiles(), idx.point_bytes, idx).where(inside)
    if first is not None:
        pairs = pairs.where(first)
    return pairs.select("grid_id", *keep, "px", "py")


# --------------------------------------------------------------------------
# lines
# --------------------------------------------------------------------------

AREAL = ("Polygon", "MultiPolygon")


def explode_segments(lines: DataFrame, geom_col: str = "geom",
                     keep: list[str] | None = None, areas: bool = True) -> DataFrame:
    """One row per segment (x1, y1, x2, y2) of every line part or polygon ring.

    Without ``areas`` a polygon raises. A line that passes a stretch more than
    once gives segments that cover it once; lines of one segment cannot, and
    are not examined. Parts are exploded first, then consecutive vertices are
    paired with ``arrays_zip`` of two offset slices (no lambda functions, so
    the step stays in generated code).
    """
    keep = keep if keep is not None else [c for c in lines.columns if c != geom_col]
    g = F.col(geom_col)
    parts = g["parts"]
    if not areas:
        parts = F.when(G.holds_areas(g), F.raise_error(
            F.lit("this layer holds areas: pass areas=True to measure them")).cast(G.PARTS)).otherwise(parts)
    else:
        parts = F.when((g["kind"] == G.COLLECTION) & G.holds_areas(g), F.raise_error(
            F.lit("a collection holds areas: explode its members (geometry.collection_members) to measure them")).cast(G.PARTS)).otherwise(parts)
    segs, retraced, merged = G.memo(("retraced",), lambda: (
        G.supporting_segments(F.col("_parts")), G.is_retraced(F.col("_s")), G.merged_segments(F.col("_s"))))
    single = (F.size("_parts") == 1) & (F.size(F.get("_parts", F.lit(0))) <= 2)
    parts = (lines.select(*keep, parts.alias("_parts"), g["kind"].isin(*AREAL).alias("_area"))
             .select(*keep, "_parts", F.when(~single & ~F.col("_area"), segs).alias("_s"))
             .select(*keep, F.explode(F.when(F.coalesce(retraced, F.lit(False)), merged).otherwise(F.col("_parts"))).alias("_p")))
    m = F.greatest(F.size("_p") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("_p", 1, m).alias("a"), F.slice("_p", 2, m).alias("b"))
    return (parts.select(*keep, F.explode(pairs).alias("_z"))
                 .select(*keep, F.col("_z.a.x").alias("x1"), F.col("_z.a.y").alias("y1"),
                         F.col("_z.b.x").alias("x2"), F.col("_z.b.y").alias("y2")))


def _segment_tile_columns(s):
    """(tile columns, tile rows of column tx, border copies) of a segment, for tiles of side ``s``."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    dx = x2 - x1
    dy = y2 - y1
    seq_x = F.sequence(F.floor(F.least(x1, x2) / s), F.floor(F.greatest(x1, x2) / s))
    tx = F.col("tx")
    ta = (tx * s - x1) / G.nonzero(dx)
    tb = ((tx + 1) * s - x1) / G.nonzero(dx)
    t_lo = F.greatest(F.lit(0.0), F.least(ta, tb))
    t_hi = F.least(F.lit(1.0), F.greatest(ta, tb))
    ya = F.when(dx == 0, F.least(y1, y2)).otherwise(y1 + t_lo * dy)
    yb = F.when(dx == 0, F.greatest(y1, y2)).otherwise(y1 + t_hi * dy)
    slack = COVER_SLACK * s
    ty0 = F.floor((F.least(ya, yb) - slack) / s)
    ty1 = F.greatest(F.floor((F.greatest(ya, yb) + slack) / s), ty0)
    # A vertical (horizontal) segment on a tile boundary also lies on the
    # right (top) border of the cells just left of (below) that boundary,
    # whose interior covers stop one tile short: copy it there, flagged.
    # Only the row of the tile that holds the coordinate is copied (the
    # cover slack may add a neighbouring row that must not be copied too).
    on_x = (dx == 0) & (dy != 0) & (x1 / s == F.floor(x1 / s)) & (tx == F.floor(x1 / s))
    on_y = (dy == 0) & (dx != 0) & (y1 / s == F.floor(y1 / s)) & (F.col("ty") == F.floor(y1 / s))
    border = (F.when(on_x, F.array(F.lit(0), F.lit(1)))
              .when(on_y, F.array(F.lit(0), F.lit(2)))
              .otherwise(F.array(F.lit(0))))
    return seq_x, F.sequence(ty0, ty1), border


def segment_tiles(segs: DataFrame, idx: CellIndex) -> DataFrame:
    """Add (tx, ty, border) for every half-open tile a segment passes through.

    Column walk: for each tile column in the segment's x range, the y range
    of the segment inside that column gives its tile rows. ``border`` is 0
    for ordinary rows; 1 (2) marks the copy of a vertical (horizontal)
    segment on a tile boundary, placed one tile to the left (below).
    """
    seq_x, seq_y, border = G.memo(("segment_tiles", idx.tile, idx.levels), lambda: _segment_tile_columns(idx.side()))
    return (idx.at_each_level(segs).withColumn("tx", F.explode(seq_x))
                .withColumn("ty", F.explode(seq_y))
                .withColumn("border", F.explode(border))
                .withColumn("tx", F.col("tx") - (F.col("border") == 1).cast("long"))
                .withColumn("ty", F.col("ty") - (F.col("border") == 2).cast("long")))


def _on_border():
    """The joined segment runs along an edge of the box or convex cell, so no part of it is strictly inside."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    box = (((x1 == x2) & ((x1 == F.col("cxmin")) | (x1 == F.col("cxmax"))))
           | ((y1 == y2) & ((y1 == F.col("cymin")) | (y1 == F.col("cymax")))))
    return (F.col("is_box") & box) | (F.col("is_convex") & F.coalesce(
        F.exists("edges", lambda e: G.on_edge_line(e, x1, y1) & G.on_edge_line(e, x2, y2)), F.lit(False)))


def _part_fraction(closed: bool):
    """Fraction of a joined row's segment in a trapezoid; what it shares with one below counts there."""
    x1, y1, x2, y2 = ends = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    edges, flat = F.col("edges"), F.col("y1") == F.col("y2")
    lo, hi = G.between_range(edges[0], edges[1], *ends, F.col("_t0"), F.col("_t1"))

    def with_below(acc, b):
        b_lo, b_hi = G.between_range(b["l"], b["r"], *ends, F.col("_t0"), F.col("_t1"))
        return acc + F.greatest(F.least(hi, b_hi) - F.greatest(lo, b_lo), F.lit(0.0))
    own = F.greatest(hi - lo, F.lit(0.0))
    shared = F.aggregate("below", F.lit(0.0), with_below)
    at_foot = flat & (y1 == F.col("cymin"))
    if closed:
        return F.when(at_foot, F.greatest(own - shared, F.lit(0.0))).otherwise(own)
    along = F.exists("edges", lambda e: G.on_edge_line(e, x1, y1) & G.on_edge_line(e, x2, y2))
    return F.when(at_foot, shared).when((flat & (y1 == F.col("cymax"))) | along, F.lit(0.0)).otherwise(own)


def _clip_columns(idx: CellIndex, closed: bool = True):
    """(t0, t1, fraction, segment length) of a joined row."""
    s = idx.side()
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    dx = x2 - x1
    dy = y2 - y1
    cx_lo, cx_hi = G.axis_range(x1, dx, F.col("cxmin"), F.col("cxmax"))
    cy_lo, cy_hi = G.axis_range(y1, dy, F.col("cymin"), F.col("cymax"))
    kx_lo, kx_hi = G.tile_axis_range(x1, dx, F.col("tx"), s)
    ky_lo, ky_hi = G.tile_axis_range(y1, dy, F.col("ty"), s)
    border = F.col("border")
    on_right = F.col("cxmax") == x1
    on_top = F.col("cymax") == y1
    inf, ninf = F.lit(G.INF), F.lit(-G.INF)
    kx_lo = F.when(border == 1, F.when(on_right, ninf).otherwise(inf)).otherwise(kx_lo)
    kx_hi = F.when(border == 1, F.when(on_right, inf).otherwise(ninf)).otherwise(kx_hi)
    ky_lo = F.when(border == 2, F.when(on_top, ninf).otherwise(inf)).otherwise(ky_lo)
    ky_hi = F.when(border == 2, F.when(on_top, inf).otherwise(ninf)).otherwise(ky_hi)
    t0 = F.greatest(F.lit(0.0), cx_lo, cy_lo, kx_lo, ky_lo)
    t1 = F.least(F.lit(1.0), cx_hi, cy_hi, kx_hi, ky_hi)
    r0, r1 = F.col("_t0"), F.col("_t1")
    if idx.boxes_only and closed:
        return t0, t1, F.greatest(r1 - r0, F.lit(0.0)), G.seg_len(x1, y1, x2, y2)
    empty = r1 <= r0 if closed else (r1 <= r0) | _on_border()
    frac = (F.when(empty, F.lit(0.0))
            .when(F.col("is_box"), r1 - r0)
            .when(F.col("is_convex") & (F.size("edges") <= G.UNROLL_EDGES),
                  G.convex_clip_fraction_unrolled(F.col("edges"), x1, y1, x2, y2, r0, r1))
            .when(F.col("is_convex"), G.convex_clip_fraction(F.col("edges"), x1, y1, x2, y2, r0, r1)))
    if idx.whole is not None:
        frac = F.when(F.col("below").isNotNull(), F.when(r1 <= r0, F.lit(0.0)).otherwise(_part_fraction(closed))).otherwise(frac)
    return t0, t1, frac, G.seg_len(x1, y1, x2, y2)


# Note on code generation: the clipping projection below stays a separate
# operator (its expression holds a lambda-based branch for large convex
# cells, which Spark keeps out of whole-stage code generation). Measured on
# sf0.1, fusing it into the join stage made that stage's generated method
# too large for the JIT and the line jobs twice as slow; as its own operator
# it is compiled per expression, with common subexpressions shared.
def clip_pieces(idx: CellIndex, segs: DataFrame, keep: list[str],
                positive_only: bool = True, closed: bool = True) -> DataFrame:
    """Join segments with cells and measure each piece ``segment AND cell AND tile``.

    Without ``closed`` only what lies strictly inside a cell counts. Returns ``grid_id``, the ``keep`` columns and ``piece_len``. With
    ``positive_only`` only pieces of positive length are kept; callers that
    aggregate pass False and filter the sums instead (a sum of non-negative
    pieces is positive exactly when one piece is), because a row filter on
    ``piece_len`` would be pushed below the projection and recompute the
    clipping expressions. The parameter range inside the cell's box and the
    tile is computed once per pair; boxes, convex cells and trapezoids are
    measured with column arithmetic.
    """
    t0, t1, frac, length = G.memo(("clip", idx.shape, closed), lambda: _clip_columns(idx, closed))
    tiled = segment_tiles(segs, idx)
    if not closed:
        tiled = tiled.where(F.col("border") == 0)
    if closed and idx.boxes_only and idx.line_bytes > idx.broadcast_bytes and all(isinstance(tiled.schema[k].dataType, T.AtomicType) for k in keep):
        out = _box_blocks(idx, tiled, keep)
        return out.where(F.col("piece_len") > 0) if positive_only else out
    j = _tile_join(tiled, idx.line_tiles(), idx.line_bytes, idx)
    box = ["cymin"] if idx.whole is not None else []
    box = box if closed else ["cxmin", "cymin", "cxmax", "cymax"]
    ranged = j.select("grid_id", *keep, "x1", "y1", "x2", "y2", *box, "is_box", "is_convex", "edges", "below", t0.alias("_t0"), t1.alias("_t1"))
    out = ranged.select("grid_id", *keep, (frac * length).alias("piece_len"))
    return out.where(F.col("piece_len") > 0) if positive_only else out


def _tile_part(idx: CellIndex):
    """(t0, t1) of a segment's part in its tile; the copies on a border are not cut across that border."""
    s = idx.side()
    x1, y1, border = F.col("x1"), F.col("y1"), F.col("border")
    inf, ninf = F.lit(G.INF), F.lit(-G.INF)
    kx_lo, kx_hi = G.tile_axis_range(x1, F.col("x2") - x1, F.col("tx"), s)
    ky_lo, ky_hi = G.tile_axis_range(y1, F.col("y2") - y1, F.col("ty"), s)
    t0 = F.greatest(F.lit(0.0), F.when(border == 1, ninf).otherwise(kx_lo), F.when(border == 2, ninf).otherwise(ky_lo))
    t1 = F.least(F.lit(1.0), F.when(border == 1, inf).otherwise(kx_hi), F.when(border == 2, inf).otherwise(ky_hi))
    return t0, t1


def _box_blocks(idx: CellIndex, tiled: DataFrame, keep: list[str]) -> DataFrame:
    """``grid_id``, ``keep`` and lengths of tiled segments in boxes, summed in each tile (see :mod:`box_blocks`)."""
    keys = idx.keys
    cells = idx.line_tiles().select("grid_id", *keys, "cxmin", "cymin", "cxmax", "cymax")
    # Per-tile counts, one row a tile after partial aggregation; only tiles to be cut are kept and broadcast,
    # at most total_items / hot_tile_rows of them.
    items, boxes = F.col("n_items"), F.col("n_boxes")
    box_parts = F.ceil(boxes / HOT_BOXES)
    item_parts = F.ceil(items / F.greatest(F.lit(float(idx.hot_tile_rows)), F.lit(float(HOT_PAIRS)) / F.least(boxes, F.lit(HOT_BOXES))))
    hot = (tiled.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_items")).where(items > idx.hot_tile_rows)
           .join(cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_boxes")).hint("merge"), keys)
           .select(*keys, item_parts.cast("int").alias("n_i"), box_parts.cast("int").alias("n_b")).where("n_i > 1 or n_b > 1"))
    hot = F.broadcast(persist_shared(hot))
    n_i, n_b = (F.coalesce(k, F.lit(1)) for k in ("n_i", "n_b"))

    def spread(rows: DataFrame, own, parts, others, place) -> DataFrame:
        """Rows in one of ``parts``, chosen by a hash (a task that runs again chooses alike), and in each of the ``others``."""
        rows = rows.join(hot, keys, "left").withColumn("_own", F.when(parts > 1, F.pmod(F.xxhash64(*own), parts)).otherwise(F.lit(0)).cast("int"))
        return rows.withColumn("_other", F.explode(F.sequence(F.lit(0), others - 1))).withColumn("part", place)
    a, b, c, d = box_blocks.SHAPE
    t0, t1 = G.memo(("tile_part", idx.tile, idx.levels), lambda: _tile_part(idx))
    cells = spread(cells, cells.columns, n_b, n_i, F.col("_other") * n_b + F.col("_own"))
    segs = spread(tiled, tiled.columns, n_i, n_b, F.col("_own") * n_b + F.col("_other"))
    nothing = [F.lit(None).cast(tiled.schema[k].dataType).alias(k) for k in keep]
    no_id = F.lit(None).cast(idx.cells.schema["grid_id"].dataType).alias("grid_id")
    cells = cells.select(*keys, "part", F.lit(False).alias("is_seg"), "grid_id", *nothing, F.col("cxmin").alias(a), F.col("cymin").alias(b),
                         F.col("cxmax").alias(c), F.col("cymax").alias(d), F.lit(0.0).alias("t0"), F.lit(1.0).alias("t1"), F.lit(0).alias("border"))
    segs = segs.select(*keys, "part", F.lit(True).alias("is_seg"), no_id, *keep, F.col("x1").alias(a), F.col("y1").alias(b),
                       F.col("x2").alias(c), F.col("y2").alias(d), t0.alias("t0"), t1.alias("t1"), "border")
    rows = cells.unionByName(segs).repartition(*keys, "part").sortWithinPartitions(*keys, "part", "is_seg")
    types = [("grid_id", idx.cells.schema["grid_id"].dataType), *[(k, tiled.schema[k].dataType) for k in keep], ("piece_len", T.DoubleType())]
    out = T.StructType([T.StructField(name, kind) for name, kind in types])
    return rows.mapInArrow(box_blocks.box_lengths([*keys, "part"], keep, out.names), out)


def cell_borders(idx: CellIndex) -> DataFrame:
    """One row per edge (grid_id, x1, y1, x2, y2) of every cell."""
    def edge(x1, y1, x2, y2):
        return F.struct(*[F.col(c).alias(n) for c, n in ((x1, "x1"), (y1, "y1"), (x2, "x2"), (y2, "y2"))])
    box = F.array(edge("cxmin", "cymin", "cxmax", "cymin"), edge("cxmax", "cymin", "cxmax", "cymax"),
                  edge("cxmax", "cymax", "cxmin", "cymax"), edge("cxmin", "cymax", "cxmin", "cymin"))
    cells = (idx.whole or idx).cells
    return (cells.select("grid_id", F.explode(F.when(F.col("is_box"), box).otherwise(F.col("edges"))).alias("_e"))
            .select("grid_id", "_e.*"))


def borders_in_areas(idx: CellIndex, areas: DataFrame, geom_col: str, keep: list[str],
                     positive_only: bool = True) -> DataFrame:
    """Pieces of every cell's border strictly inside every area, with the area's ``keep`` columns.

    The join of the lines the other way round: the areas are indexed like
    cells and the cells' edges are the segments.
    """
    named = areas.select(F.struct(F.lit(0).alias("_row"), *keep).alias("_area"), F.col(geom_col).alias("_g_area"))
    of_areas = index_cells(named, "_area", "_g_area", broadcast_bytes=idx.broadcast_bytes,
                           hot_tile_rows=idx.hot_tile_rows, materialize=False)
    pieces = clip_pieces(of_areas, cell_borders(idx).withColumnRenamed("grid_id", "_cell"), ["_cell"],
                         positive_only, closed=False)
    return pieces.select(F.col("_cell").alias("grid_id"), *[F.col("grid_id")[c].alias(c) for c in keep], "piece_len")


def clip_lines_to_cells(idx: CellIndex, lines: DataFrame, geom_col: str = "geom",
                        keep: list[str] | None = None, positive_only: bool = True,
                        areas: bool = False) -> DataFrame:
    """Pieces of every line, or outline pieces of every area, inside every cell it meets.

    Rows are pieces or sums of them, not pairs: sum ``piece_len`` per cell (and category) for
    the clipped length ``ST_Length(ST_Intersection(cell, line))`` summed over
    lines, or per ``(cell, line id)`` for the length of one pair.

    A layer that holds polygons needs ``areas=True`` and raises otherwise.
    The length of a clipped area is its perimeter: the area's boundary in the
    closed cell and the cell's border strictly inside the area, so stretches
    that both share count once. An area that only touches a cell along a
    line counts that line.
    """
    keep = keep if keep is not None else [c for c in lines.columns if c != geom_col]
    segs = explode_segments(lines, geom_col, keep, areas)
    pieces = clip_pieces(idx, segs, keep, positive_only)
    if areas:
        polygons = lines.where(F.col(geom_col)["kind"].isin(*AREAL))
        pieces = pieces.unionByName(borders_in_areas(idx, polygons, geom_col, keep, positive_only))
    return pieces


#: Slack of the parameter along a segment within which its ranges in two half-planes still touch.
TOUCH = 1e-12


def _meets():
    """The joined segment has a point in the closed cell."""
    x1, y1, x2, y2 = ends = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    x_lo, x_hi = G.axis_range(x1, x2 - x1, F.col("cxmin"), F.col("cxmax"))
    y_lo, y_hi = G.axis_range(y1, y2 - y1, F.col("cymin"), F.col("cymax"))
    lo, hi = F.greatest(F.lit(0.0), x_lo, y_lo), F.least(F.lit(1.0), x_hi, y_hi)
    edges = F.col("edges")
    in_cell = G.convex_range(edges, *ends, lo, hi)
    in_part = G.between_range(edges[0], edges[1], *ends, lo, hi)
    wide = F.when(F.col("is_box"), hi - lo).when(F.col("below").isNotNull(), in_part[1] - in_part[0]).otherwise(in_cell["hi"] - in_cell["lo"])
    return (hi >= lo) & (wide >= -TOUCH)


def intersecting_lines(idx: CellIndex, lines: DataFrame, geom_col: str = "geom", keep: list[str] | None = None) -> DataFrame:
    """Pairs (grid_id, ``keep``) of cells and lines that share a point, be it one on the border.

    ``keep`` should tell the lines apart: a pair shows once, however many
    segments and tiles it meets in. Cells list all tiles that they touch, so
    the tile of the shared point lists both. Polygons raise: a line layer's
    areas meet cells without crossing their border.
    """
    keep = keep if keep is not None else [c for c in lines.columns if c != geom_col]
    segs = segment_tiles(explode_segments(lines, geom_col, keep, areas=False), idx).where(F.col("border") == 0)
    met = _tile_join(segs, idx.touched_tiles(), idx.line_bytes, idx)
    return met.where(G.memo(("meets",), _meets)).select("grid_id", *keep).distinct()


def pair_lengths(pieces: DataFrame, pair_keys: list[str]) -> DataFrame:
    """Clipped length per (grid_id, *pair_keys); pairs of positive length only."""
    return (pieces.groupBy("grid_id", *pair_keys).agg(F.sum("piece_len").alias("seg_len"))
                  .where(F.col("seg_len") > 0))
