"""DuckDB SQL for every registered query with a SQL equivalent.

The oracle joins cells and layers by plain inequality (a nested-loop or
range join inside DuckDB) and clips segments with closed-form arithmetic:
Liang-Barsky for boxes, one extra half-plane for the triangular cells. That
is a different method from the tile-keyed equi-join of the Spark side, so
agreement checks the tile logic, not just the arithmetic.
"""

from __future__ import annotations

BIG = "1e300"

# --------------------------------------------------------------------------
# layers (same derivations as tessera.plans.fixtures)
# --------------------------------------------------------------------------

CTE = {
    "grid": """grid as (
  select cast(id as bigint) as id,
         50e0 * ((id - 1) % 20) as xmin, 50e0 * ((id - 1) % 20) + 50e0 as xmax,
         50e0 * cast(floor((id - 1) / 20e0) as bigint) as ymin,
         50e0 * cast(floor((id - 1) / 20e0) as bigint) + 50e0 as ymax
  from range(1, 401) as t(id))""",
    "customer_grid": """customer_grid as (
  select c_custkey as id, cast((c_custkey * 7919) % 990 as double) as xmin, cast((c_custkey * 7919) % 990 + 7 as double) as xmax,
         cast((c_custkey * 104729) % 990 as double) as ymin, cast((c_custkey * 104729) % 990 + 5 as double) as ymax
  from customer)""",
    "mixed_grid": """mixed_grid as (
  select id, xmin, xmax, ymin, ymax from grid
  union all
  select cast(id as bigint), xmin, xmin + side, ymin, ymin + side
  from (values (1001, -24500e0, -24500e0, 50000e0), (1002, 0e0, 0e0, 1000e0), (1003, 110e0, 130e0, 270e0)) as t(id, xmin, ymin, side))""",
    "shuttles": """shuttle_base as (
  select o_orderkey as shuttle_id, 'S' || (o_orderkey % 3) as kind, (o_orderkey * 7919) % 1000 as x, (o_orderkey * 104729) % 1000 as y,
         o_custkey % 13 - 6 as a, o_custkey % 11 - 5 as b
  from orders),
shuttles as (
  select shuttle_id, kind, cast(x as double) as x1, cast(y as double) as y1, cast(x + 4 * a as double) as x2, cast(y + 4 * b as double) as y2
  from shuttle_base where a <> 0
  union all
  select shuttle_id, kind, x + 2 * a, y + 2 * b, x + 2 * a, y + 2 * b + 20 from shuttle_base where a <> 0
  union all
  select shuttle_id, kind, x, least(y, y + 4 * b), x, greatest(y, y + 4 * b, y + 2 * b + 20) from shuttle_base where a = 0)""",
    "tri": """tri as (
  select 2 * id - 1 as id, xmin, ymin, xmax, ymax, 1 as lower_half from grid
  union all
  select 2 * id as id, xmin, ymin, xmax, ymax, 0 as lower_half from grid)""",
    "roads": """roads as (
  select o_orderkey as road_id,
         case when o_orderkey % 14 = 13 then null else 5 * (o_orderkey % 14) end as speed,
         cast((o_orderkey * 7919) % 1000 as double) as x1,
         cast((o_orderkey * 104729) % 1000 as double) as y1,
         cast((o_orderkey * 7919) % 1000 + (o_custkey % 121) - 60 as double) as x2,
         cast((o_orderkey * 104729) % 1000 + (o_custkey % 97) - 48 as double) as y2
  from orders)""",
    "signs": """signs as (
  select l_orderkey * 100 + l_linenumber as objectid,
         case when l_linestatus = 'O' then 'panel' else 'mount' end as source,
         case l_partkey % 32
           when 0 then null when 1 then '' when 2 then '   ' when 3 then '_'
           when 4 then 'null' when 5 then '999___MISC._OTHER_SIGN'
           when 6 then 'R_999___MISC._REGULATORY_SIGNS'
           when 7 then 'R2-1___SPEED_LIMIT' when 8 then 'R2_1___SPEED_LIMIT'
           when 9 then 'S4_3___SCHOOL' when 10 then 'S5-1___SCHOOL_SPEED'
           when 11 then 'R1_1___STOP' when 12 then 'R1-2___YIELD'
           when 13 then 'R3_1___NO_RIGHT_TURN' when 14 then 'R4_7___KEEP_RIGHT'
           when 15 then 'W1_2___CURVE' when 16 then 'W1_8___CHEVRON_ALIGNMENT'
           when 17 then 'W13_1___ADVISORY_SPEED' when 18 then 'W2_1___CROSS_ROAD'
           when 19 then 'W3_1___STOP_AHEAD' when 20 then 'W7_1___HILL'
           when 21 then 'W8_1___BUMP' when 22 then 'W11-2___PEDESTRIAN'
           when 23 then 'R9_50_1___BIKE' when 24 then 'S1_1___SCHOOL'
           when 25 then 'OM3_L___OBJECT_MARKER' when 26 then 'W10_1___RAILROAD'
           when 27 then 'R15_1___CROSSBUCK' when 28 then 'W_999___MISC._WARNING_SIGNS'
           when 29 then 'INFO___GENERAL_INFORMATION_SIGNS'
           when 30 then 'REC___RECREATIONAL_AND_CULTURAL_INTEREST_AREA_SIGNS'
           else 'SERVICES___GENERAL_SERVICE_SIGNS' end as mutcddescd,
         cast((l_orderkey * 7919 + l_linenumber * 31) % 1000 as double) as x,
         cast((l_partkey * 104729 + l_suppkey * 17) % 1000 as double) as y
  from lineitem)""",
    "guardrails": """guardrails as (
  select p_partkey as guardrail_id,
         case p_size % 6 when 0 then 'STEEL BEAM' when 1 then 'W-BEAM/CABLE'
           when 2 then 'CONCRETE' when 3 then 'TIMBER.2' when 4 then '' else null end as materiald,
         cast((p_partkey * 7919) % 1000 as double) as x1,
         cast((p_partkey * 611953) % 1000 as double) as y1,
         cast((p_partkey * 7919) % 1000 + (p_partkey % 83) - 41 as double) as x2,
         cast((p_partkey * 611953) % 1000 + (p_partkey % 59) - 29 as double) as y2
  from part)""",
    "medians": """medians as (
  select c_custkey as median_id,
         case when c_custkey % 17 = 0 then null when c_custkey % 17 = 1 then ''
              else c_mktsegment end as typed,
         cast((c_custkey * 15485863) % 1000 as double) as x1,
         cast((c_custkey * 32452843) % 1000 as double) as y1,
         cast((c_custkey * 15485863) % 1000 + (c_custkey % 73) - 36 as double) as x2,
         cast((c_custkey * 32452843) % 1000 as double) as y2
  from customer)""",
    "sidewalks": """sidewalks as (
  select p_partkey as sidewalk_id, 1 as seg_no,
         cast((p_partkey * 49979687) % 1000 as double) as x1,
         cast((p_partkey * 86028121) % 1000 as double) as y1,
         cast((p_partkey * 49979687) % 1000 + 30 as double) as x2,
         cast((p_partkey * 86028121) % 1000 + (p_partkey % 41) - 20 as double) as y2
  from part
  union all
  select p_partkey as sidewalk_id, 2 as seg_no,
         cast((p_partkey * 49979687) % 1000 + 30 as double) as x1,
         cast((p_partkey * 86028121) % 1000 + (p_partkey % 41) - 20 as double) as y1,
         cast((p_partkey * 49979687) % 1000 + 30 as double) as x2,
         cast((p_partkey * 86028121) % 1000 + 40 as double) as y2
  from part)""",
    "crashes": """crashes as (
  select case when event_id % 50 = 0 then null else event_id end as objectid,
         cast((event_id * 7919 + user_id) % 1000 as double) as x,
         cast((event_id * 104729 + user_id * 13) % 1000 as double) as y
  from events)""",
    "areas": """areas as (
  select area_id, material, cast(x as double) as xmin, cast(y as double) as ymin,
         cast(x + w as double) as xmax, cast(y + h as double) as ymax
  from (select p_partkey as area_id, 'A' || (p_partkey % 3) as material,
               case when p_partkey % 4 = 0 then (p_partkey * 49979687) % 1000 - (p_partkey * 49979687) % 1000 % 50
                    else (p_partkey * 49979687) % 1000 end as x,
               case when p_partkey % 4 = 0 then (p_partkey * 86028121) % 1000 - (p_partkey * 86028121) % 1000 % 50
                    else (p_partkey * 86028121) % 1000 end as y,
               case when p_partkey % 4 = 0 then 50 else p_partkey % 83 + 10 end as w,
               p_partkey % 47 + 10 as h
        from part))""",
    "members": """members as (
  select event_id as group_id, m, cast(x + case when m = 1 then event_id % 7 * 4 else 0 end as double) as x,
         cast(y + case when m = 2 then event_id % 5 * 6 else 0 end as double) as y
  from (select event_id, (event_id * 7919 + user_id) % 1000 as x, (event_id * 104729 + user_id * 13) % 1000 as y from events),
       range(3) as t(m) where m <= event_id % 3)""",
    "curbs": """curbs as (
  select s_suppkey as curb_id,
         cast((s_suppkey * 7919) % 1000 as double) as x1,
         cast((s_suppkey * 104729) % 1000 as double) as y1,
         cast((s_suppkey * 7919) % 1000 + 25 as double) as x2,
         cast((s_suppkey * 104729) % 1000 as double) as y2
  from supplier)""",
}


def _with(*names: str, extra: list[str] | None = None) -> str:
    parts = [CTE[n] for n in names] + list(extra or [])
    return "with " + ",\n".join(parts) + "\n"


# --------------------------------------------------------------------------
# clipping arithmetic
# --------------------------------------------------------------------------

def _axis(p1: str, d: str, lo: str, hi: str) -> tuple[str, str]:
    t_lo = (f"case when {d} = 0 then (case when {p1} between {lo} and {hi} then -{BIG} else {BIG} end) "
            f"else least(({lo} - {p1}) / {d}, ({hi} - {p1}) / {d}) end")
    t_hi = (f"case when {d} = 0 then (case when {p1} between {lo} and {hi} then {BIG} else -{BIG} end) "
            f"else greatest(({lo} - {p1}) / {d}, ({hi} - {p1}) / {d}) end")
    return t_lo, t_hi


def _axis_open_low(p1: str, d: str, lo: str, hi: str) -> tuple[str, str]:
    """As :func:`_axis` for the half-open range ``lo < p <= hi`` (differs only when d = 0)."""
    t_lo, t_hi = _axis(p1, d, lo, hi)
    inside = f"{p1} > {lo} and {p1} <= {hi}"
    return (t_lo.replace(f"{p1} between {lo} and {hi}", inside),
            t_hi.replace(f"{p1} between {lo} and {hi}", inside))


def clip_len_quarter(c: str = "g", s: str = "s") -> str:
    """Length of segment ``s`` in the upper-right quarter ``(xmid, xmax] x (ymid, ymax]`` of box ``c``."""
    x1, y1, x2, y2 = (f"{s}.{n}" for n in ("x1", "y1", "x2", "y2"))
    dx, dy = f"({x2} - {x1})", f"({y2} - {y1})"
    xl, xh = _axis_open_low(x1, dx, f"(({c}.xmin + {c}.xmax) / 2)", f"{c}.xmax")
    yl, yh = _axis_open_low(y1, dy, f"(({c}.ymin + {c}.ymax) / 2)", f"{c}.ymax")
    return (f"greatest(least(1e0, {xh}, {yh}) - greatest(0e0, {xl}, {yl}), 0e0) "
            f"* sqrt({dx} * {dx} + {dy} * {dy})")


def _half_plane(a: str, b: str) -> tuple[str, str]:
    """Parameter range of a + t*b >= 0."""
    t_lo = f"case when {b} > 0 then -({a}) / {b} when {b} = 0 then (case when {a} >= 0 then -{BIG} else {BIG} end) else -{BIG} end"
    t_hi = f"case when {b} < 0 then -({a}) / {b} when {b} = 0 then (case when {a} >= 0 then {BIG} else -{BIG} end) else {BIG} end"
    return t_lo, t_hi


def clip_len(c: str = "g", s: str = "s", triangle: bool = False) -> str:
    """Clipped length of segment ``s`` in the closed box (or triangle) ``c``."""
    x1, y1, x2, y2 = (f"{s}.{n}" for n in ("x1", "y1", "x2", "y2"))
    dx, dy = f"({x2} - {x1})", f"({y2} - {y1})"
    xl, xh = _axis(x1, dx, f"{c}.xmin", f"{c}.xmax")
    yl, yh = _axis(y1, dy, f"{c}.ymin", f"{c}.ymax")
    lows, highs = [xl, yl], [xh, yh]
    if triangle:
        a_low = f"(({x1} - {c}.xmin) - ({y1} - {c}.ymin))"
        b_low = f"({dx} - {dy})"
        a = f"(case when {c}.lower_half = 1 then {a_low} else -{a_low} end)"
        b = f"(case when {c}.lower_half = 1 then {b_low} else -{b_low} end)"
        hl, hh = _half_plane(a, b)
        lows.append(hl)
        highs.append(hh)
    t0 = "greatest(0e0, " + ", ".join(lows) + ")"
    t1 = "least(1e0, " + ", ".join(highs) + ")"
    return f"greatest({t1} - {t0}, 0e0) * sqrt({dx} * {dx} + {dy} * {dy})"


def _overlap(c: str = "g", s: str = "s") -> str:
    return (f"least({s}.x1, {s}.x2) <= {c}.xmax and greatest({s}.x1, {s}.x2) >= {c}.xmin "
            f"and least({s}.y1, {s}.y2) <= {c}.ymax and greatest({s}.y1, {s}.y2) >= {c}.ymin")


def _pairs(name: str, layer: str, cells: str = "grid", triangle: bool = False) -> str:
    """CTE ``name``: every (cell, segment) pair of overlapping boxes with its clipped length."""
    return (f"{name} as (select g.id as grid_id, s.*, {clip_len('g', 's', triangle)} as seg_len "
            f"from {cells} g join {layer} s on {_overlap('g', 's')})")


def _inside(c: str = "g", p: str = "p") -> str:
    return f"{p}.x > {c}.xmin and {p}.x < {c}.xmax and {p}.y > {c}.ymin and {p}.y < {c}.ymax"


# --------------------------------------------------------------------------
# sign classes
# --------------------------------------------------------------------------

def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


# ---- Fixed values: the cleaning and grouping rules, spelled out apart from the Spark side. ----
_USABLE = """mutcddescd is not null and trim(mutcddescd) <> '' and mutcddescd not in (
  '_', 'null', '999___MISC._OTHER_SIGN', 'R_999___MISC._REGULATORY_SIGNS', 'W_999___MISC._WARNING_SIGNS',
  'INFO___GENERAL_INFORMATION_SIGNS', 'REC___RECREATIONAL_AND_CULTURAL_INTEREST_AREA_SIGNS',
  'SERVICES___GENERAL_SERVICE_SIGNS')"""
_GROUP = """case
  when starts_with(sign_code, 'R2_') then 'speed_limit'
  when starts_with(sign_code, 'S4_') or starts_with(sign_code, 'S5_') then 'school_speed'
  when starts_with(sign_code, 'R1_') then 'stop_yield'
  when starts_with(sign_code, 'R3_') or starts_with(sign_code, 'R4_') then 'lane_row_control'
  when starts_with(sign_code, 'W1_') or starts_with(sign_code, 'W13_') then 'curve_turn'
  when starts_with(sign_code, 'W2_') then 'intersection_warning'
  when starts_with(sign_code, 'W3_') then 'advance_condition'
  when starts_with(sign_code, 'W7_') or starts_with(sign_code, 'W8_') then 'grade_surface'
  when starts_with(sign_code, 'W11_') or starts_with(sign_code, 'R9_50_') then 'ped_bike_animal'
  when starts_with(sign_code, 'S1_1_') then 'school_zone'
  when starts_with(sign_code, 'OM') then 'object_marker'
  when starts_with(sign_code, 'W10_') or starts_with(sign_code, 'R15_1_') then 'railroad'
end"""
GROUPS = ["advance_condition", "curve_turn", "grade_surface", "intersection_warning", "lane_row_control", "object_marker",
          "ped_bike_animal", "railroad", "school_speed", "school_zone", "speed_limit", "stop_yield"]
# ---- end of fixed values ----


SIGN_CLASSES = """sclass as (
  select objectid, source, mutcddescd as sign_type, replace(mutcddescd, '-', '_') as sign_code, x, y
  from signs where {usable}),
sgroup as (select *, {group} as sign_group from sclass)"""


def _sign_ctes() -> str:
    return SIGN_CLASSES.format(usable=_USABLE, group=_GROUP)


SPEEDS = [str(5 * k) for k in range(1, 13)]
MATERIALS = {"STEEL BEAM": "STEEL_BEAM", "W-BEAM/CABLE": "W_BEAM_CABLE", "CONCRETE": "CONCRETE",
             "TIMBER.2": "TIMBER_2"}
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _r(expr: str) -> str:
    return f"round({expr}, 6)"


# --------------------------------------------------------------------------
# queries
# --------------------------------------------------------------------------

def _road_long() -> str:
    return (_with("grid", "roads", extra=[_pairs("p", "roads")])
            + "select grid_id, cast(speed as varchar) as speed_str, round(sum(seg_len), 6) as total_length "
              "from p where speed is not null and speed > 0 and seg_len > 0 group by 1, 2")


def _road_wide() -> str:
    cols = ", ".join(_r(f"coalesce(sum(case when speed_str = '{v}' then total_length end), 0e0)")
                     + f" as road_len_mph_{v}" for v in SPEEDS)
    return (_with("grid", "roads", extra=[_pairs("p", "roads"),
            "l as (select grid_id, cast(speed as varchar) as speed_str, sum(seg_len) as total_length "
            "from p where speed is not null and speed > 0 and seg_len > 0 group by 1, 2)"])
            + f"select grid_id, {cols} from l group by grid_id")


def _cat_long(layer: str, col: str, out: str) -> str:
    return (_with("grid", layer, extra=[_pairs("p", layer)])
            + f"select grid_id, {col} as {out}, round(sum(seg_len), 6) as total_length from p "
              f"where {col} is not null and {col} <> '' and seg_len > 0 group by 1, 2")


def _cat_wide(layer: str, col: str, prefix: str, values: dict[str, str]) -> str:
    cols = ", ".join(_r(f"coalesce(sum(case when l.cat = {_sql_str(raw)} then l.v end), 0e0)")
                     + f" as {prefix}{clean}" for raw, clean in values.items())
    return (_with("grid", layer, extra=[_pairs("p", layer),
            f"l as (select grid_id, {col} as cat, sum(seg_len) as v from p "
            f"where {col} is not null and {col} <> '' and seg_len > 0 group by 1, 2)"])
            + f"select g.id as grid_id, {cols} from grid g left join l on g.id = l.grid_id group by g.id")


def _sidewalk() -> str:
    return (_with("grid", "sidewalks", extra=[_pairs("p", "sidewalks"),
            "pair as (select grid_id, sidewalk_id, sum(seg_len) as len from p group by 1, 2)"])
            + "select grid_id, round(sum(len), 6) as sidewalk_len from pair where len > 0 group by 1")


def _crash() -> str:
    return (_with("grid", "crashes")
            + f"select g.id as grid_id, count(p.objectid) as crash_count "
              f"from grid g left join crashes p on {_inside('g', 'p')} group by g.id")


def _crash_large_grid() -> str:
    return (_with("customer_grid", "crashes")
            + f"select g.id as grid_id, count(p.objectid) as crash_count "
              f"from customer_grid g left join crashes p on {_inside('g', 'p')} group by g.id")


def _road_large_grid() -> str:
    return (_with("customer_grid", "roads", extra=[_pairs("p", "roads", "customer_grid")])
            + "select grid_id, cast(speed as varchar) as speed_str, round(sum(seg_len), 6) as total_length "
              "from p where speed is not null and speed > 0 and seg_len > 0 group by 1, 2")


def _concave_crash() -> str:
    # strictly inside the square and not in the closed removed quarter
    cond = (f"{_inside('g', 'p')} and not (p.x >= (g.xmin + g.xmax) / 2 and p.y >= (g.ymin + g.ymax) / 2)")
    return (_with("grid", "crashes")
            + f"select g.id as grid_id, count(p.objectid) as crash_count "
              f"from grid g left join crashes p on {cond} group by g.id")


def _mixed_crash() -> str:
    return (_with("grid", "mixed_grid", "crashes")
            + f"select g.id as grid_id, count(p.objectid) as crash_count "
              f"from mixed_grid g left join crashes p on {_inside('g', 'p')} group by g.id")


def _mixed_road() -> str:
    return (_with("grid", "mixed_grid", "roads", extra=[_pairs("p", "roads", "mixed_grid")])
            + "select grid_id, cast(speed as varchar) as speed_str, round(sum(seg_len), 6) as total_length "
              "from p where speed is not null and speed > 0 and seg_len > 0 group by 1, 2")


def _frame_crash() -> str:
    # strictly inside the square and not in the closed hole
    hole = "p.x between g.xmin + 10 and g.xmax - 10 and p.y between g.ymin + 10 and g.ymax - 10"
    return (_with("grid", "crashes")
            + f"select g.id as grid_id, count(p.objectid) as crash_count "
              f"from grid g left join crashes p on {_inside('g', 'p')} and not ({hole}) group by g.id")


def _frame_road() -> str:
    # the square less what runs strictly inside the hole; the difference leaves float residue where it is 0
    def open_axis(p1: str, d: str, lo: str, hi: str) -> tuple[str, str]:
        closed, inside = f"{p1} between {lo} and {hi}", f"{p1} > {lo} and {p1} < {hi}"
        return tuple(t.replace(closed, inside) for t in _axis(p1, d, lo, hi))
    dx, dy = "(s.x2 - s.x1)", "(s.y2 - s.y1)"
    xl, xh = open_axis("s.x1", dx, "(g.xmin + 10)", "(g.xmax - 10)")
    yl, yh = open_axis("s.y1", dy, "(g.ymin + 10)", "(g.ymax - 10)")
    hole = f"greatest(least(1e0, {xh}, {yh}) - greatest(0e0, {xl}, {yl}), 0e0) * sqrt({dx} * {dx} + {dy} * {dy})"
    pairs = f"p as (select g.id as grid_id, s.*, {clip_len('g', 's')} - {hole} as seg_len from grid g join roads s on {_overlap('g', 's')})"
    return (_with("grid", "roads", extra=[pairs])
            + "select grid_id, cast(speed as varchar) as speed_str, round(sum(seg_len), 6) as total_length "
              "from p where speed is not null and speed > 0 and seg_len > 1e-9 group by 1, 2")


#: The round cell's edge steps, a quarter of them; the other quarters are its turns.
_STEPS = [(8, 0), (6, 2), (4, 2), (2, 2), (2, 4), (2, 6)]


def _disc_edges() -> str:
    """CTE of the 24 edges (a vertex and the step from it) about a cell's lower left corner."""
    steps, (x, y) = [], (21, 5)
    for q in range(4):
        for dx, dy in _STEPS:
            dx, dy = ((dx, dy), (-dy, dx), (-dx, -dy), (dy, -dx))[q]
            steps.append(f"({x}e0, {y}e0, {dx}e0, {dy}e0)")
            x, y = x + dx, y + dy
    return "disc as (select * from (values " + ", ".join(steps) + ") as t(vx, vy, ex, ey))"


def _disc_road() -> str:
    # every edge bounds the parameter on its inner side
    a = "(e.ex * (s.y1 - g.ymin - e.vy) - e.ey * (s.x1 - g.xmin - e.vx))"
    b = "(e.ex * (s.y2 - s.y1) - e.ey * (s.x2 - s.x1))"
    lo, hi = _half_plane(a, b)
    dx, dy = "(s.x2 - s.x1)", "(s.y2 - s.y1)"
    ranges = (f"p as (select g.id as grid_id, s.road_id, any_value(s.speed) as speed, "
              f"greatest(least(1e0, min({hi})) - greatest(0e0, max({lo})), 0e0) * any_value(sqrt({dx} * {dx} + {dy} * {dy})) as seg_len "
              f"from grid g join roads s on {_overlap('g', 's')}, disc e group by 1, 2)")
    return (_with("grid", "roads", extra=[_disc_edges(), ranges])
            + "select grid_id, cast(speed as varchar) as speed_str, round(sum(seg_len), 6) as total_length "
              "from p where speed is not null and speed > 0 and seg_len > 0 group by 1, 2")


def _disc_crash() -> str:
    inner = "e.ex * (p.y - g.ymin - e.vy) - e.ey * (p.x - g.xmin - e.vx) <= 0"
    return (_with("grid", "crashes", extra=[_disc_edges(),
            f"near as (select g.id, p.objectid, g.xmin, g.ymin, p.x, p.y from grid g join crashes p on {_inside('g', 'p')} where p.objectid is not null)",
            f"within as (select g.id, count(*) as n from near g where not exists (select 1 from disc e where "
            f"{inner.replace('p.', 'g.')}) group by g.id)"])
            + "select g.id as grid_id, coalesce(n, 0) as crash_count from grid g left join within w on w.id = g.id")


def _intersecting() -> str:
    x1, y1, dx, dy = "s.x1", "s.y1", "(s.x2 - s.x1)", "(s.y2 - s.y1)"
    xl, xh = _axis(x1, dx, "g.xmin", "g.xmax")
    yl, yh = _axis(y1, dy, "g.ymin", "g.ymax")
    side = "(case when g.lower_half = 1 then 1 else -1 end)"
    hl, hh = _half_plane(f"({side} * ((s.x1 - g.xmin) - (s.y1 - g.ymin)))", f"({side} * ({dx} - {dy}))")
    return (_with("grid", "tri", "roads")
            + f"select g.id as grid_id, s.road_id from tri g join roads s on {_overlap('g', 's')} "
              f"where greatest(0e0, {xl}, {yl}, {hl}) <= least(1e0, {xh}, {yh}, {hh}) + 1e-12")


def _layer_window() -> str:
    return (_with("roads") + "select road_id, speed, round(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 6) as length from roads "
            "where least(x1, x2) <= 395 and greatest(x1, x2) >= 210 and least(y1, y2) <= 455 and greatest(y1, y2) >= 300")


def _forest_against_mean() -> str:
    return _features_with(
        f"select count(*) as n, round(sqrt(avg((crash_count - mean) * (crash_count - mean))), 6) as constant_rmse, true as forest_keeps_up "
        f"from ft, (select avg(crash_count) as mean from ft where {_split_fraction('grid_id')} < 0.8) where not ({_split_fraction('grid_id')} < 0.8)")


def _prediction_by_label_group() -> str:
    return _features_with(
        "select cast(quarter as int) as quarter, count(*) as n, round(avg(crash_count), 6) as mean_label, cast(quarter as int) as place "
        "from (select crash_count, ntile(4) over (order by crash_count, grid_id) as quarter from ft) group by quarter")


def _sign_long() -> str:
    return (_with("grid", "signs", extra=[_sign_ctes()])
            + f"select g.id as grid_id, p.sign_group, count(*) as count from grid g "
              f"join sgroup p on {_inside('g', 'p')} where p.sign_group is not null group by 1, 2")


def _sign_wide() -> str:
    cols = ", ".join(f"count(*) filter (where p.sign_group = {_sql_str(v)}) as {v}" for v in GROUPS)
    return (_with("grid", "signs", extra=[_sign_ctes()])
            + f"select g.id as grid_id, {cols} from grid g join sgroup p on {_inside('g', 'p')} "
              f"where p.sign_group is not null group by g.id")


def _sign_classify() -> str:
    return (_with("signs", extra=[_sign_ctes()])
            + "select objectid, source, sign_type, sign_code, sign_group from sgroup")


def _points_in_cells() -> str:
    return (_with("grid", "signs")
            + f"select g.id as grid_id, p.objectid, p.source, p.mutcddescd, p.x as px, p.y as py "
              f"from grid g join signs p on {_inside('g', 'p')}")


def _multipoint() -> str:
    return (_with("grid", "members")
            + f"select g.id as grid_id, p.group_id from grid g join members p "
              "on p.x >= g.xmin and p.x <= g.xmax and p.y >= g.ymin and p.y <= g.ymax "
              f"group by 1, 2 having bool_or({_inside('g', 'p')}) and count(*) = any_value(p.group_id) % 3 + 1")


def _area_length() -> str:
    # perimeter of the intersection of two boxes; a line where they only touch
    w = "(least(g.xmax, a.xmax) - greatest(g.xmin, a.xmin))"
    h = "(least(g.ymax, a.ymax) - greatest(g.ymin, a.ymin))"
    return (_with("grid", "areas", extra=[
        f"p as (select g.id as grid_id, a.material, case when {w} > 0 and {h} > 0 then 2 * ({w} + {h}) else {w} + {h} end as len "
        f"from grid g join areas a on {w} >= 0 and {h} >= 0)"])
        + "select grid_id, material, round(sum(len), 6) as total_length from p where len > 0 group by 1, 2")


def _area_length_triangles() -> str:
    # outline of the box in the closed triangle + edges of the triangle in the open box
    sides = ("outline as (select area_id, xmin as x1, ymin as y1, xmax as x2, ymin as y2 from areas union all "
             "select area_id, xmin, ymax, xmax, ymax from areas union all "
             "select area_id, xmin, ymin, xmin, ymax from areas union all select area_id, xmax, ymin, xmax, ymax from areas)")
    edges = ("edges as (select id, xmin as x1, ymin as y1, xmax as x2, ymax as y2 from tri union all "
             "select id, xmin, case when lower_half = 1 then ymin else ymax end, xmax, "
             "case when lower_half = 1 then ymin else ymax end from tri union all "
             "select id, case when lower_half = 1 then xmax else xmin end, ymin, "
             "case when lower_half = 1 then xmax else xmin end, ymax from tri)")
    open_box = "not (s.x1 = s.x2 and s.x1 in (g.xmin, g.xmax)) and not (s.y1 = s.y2 and s.y1 in (g.ymin, g.ymax))"
    return (_with("grid", "tri", "areas", extra=[
        sides, edges,
        f"p as (select g.id as grid_id, s.area_id, {clip_len('g', 's', True)} as len from tri g join outline s on {_overlap('g', 's')} "
        f"union all select s.id, g.area_id, {clip_len('g', 's')} from areas g join edges s on {_overlap('g', 's')} where {open_box})"])
        + "select grid_id, area_id, round(sum(len), 6) as seg_len from p group by 1, 2 having sum(len) > 0")


def _clip_segments() -> str:
    return (_with("grid", "roads", extra=[_pairs("p", "roads")])
            + "select grid_id, road_id, round(sum(seg_len), 6) as seg_len from p "
              "where seg_len > 0 group by 1, 2")


def _polygon_cells() -> str:
    return (_with("grid", "tri", "roads", extra=[_pairs("p", "roads", "tri", triangle=True)])
            + "select grid_id, cast(speed as varchar) as speed_str, round(sum(seg_len), 6) as total_length "
              "from p where speed is not null and speed > 0 and seg_len > 0 group by 1, 2")


def _concave_cells() -> str:
    # Square minus quarter: the difference of two lengths leaves float residue
    # (~1e-13) where the true length is 0, hence the small positive threshold.
    pairs = (f"p as (select g.id as grid_id, s.*, {clip_len('g', 's')} - {clip_len_quarter('g', 's')} "
             f"as seg_len from grid g join roads s on {_overlap('g', 's')})")
    return (_with("grid", "roads", extra=[pairs])
            + "select grid_id, cast(speed as varchar) as speed_str, round(sum(seg_len), 6) as total_length "
              "from p where speed is not null and speed > 0 and seg_len > 1e-9 group by 1, 2")


def _profile() -> str:
    def line(name, src, where=""):
        return (f"select '{name}' as layer, count(*) as rows, cast(0 as bigint) as null_geom, "
                f"min(least(x1, x2)) as xmin, min(least(y1, y2)) as ymin, "
                f"max(greatest(x1, x2)) as xmax, max(greatest(y1, y2)) as ymax from {src} {where}")

    def pts(name, src, where=""):
        return (f"select '{name}' as layer, count(*) as rows, cast(0 as bigint) as null_geom, "
                f"min(x) as xmin, min(y) as ymin, max(x) as xmax, max(y) as ymax from {src} {where}")

    parts = [
        "select 'grid' as layer, count(*) as rows, cast(0 as bigint) as null_geom, min(xmin) as xmin, "
        "min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax from grid",
        line("roads", "roads"), pts("crashes", "crashes"), line("curbs", "curbs"),
        line("guardrails", "guardrails"), line("medians", "medians"),
        # sidewalks: both segments together cover the three vertices
        "select 'sidewalks' as layer, count(distinct sidewalk_id) as rows, cast(0 as bigint) as null_geom, "
        "min(least(x1, x2)) as xmin, min(least(y1, y2)) as ymin, max(greatest(x1, x2)) as xmax, "
        "max(greatest(y1, y2)) as ymax from sidewalks",
        pts("sign_panels", "signs", "where source = 'panel'"),
        pts("sign_mounts", "signs", "where source = 'mount'"),
    ]
    return (_with("grid", "roads", "crashes", "curbs", "guardrails", "medians", "sidewalks", "signs")
            + "\nunion all\n".join(parts))


def _feature_ctes() -> list[str]:
    road_cols = ", ".join(f"sum(case when speed = {v} then seg_len end) as road_len_mph_{v}" for v in SPEEDS)
    sign_cols = ", ".join(f"count(*) filter (where p.sign_group = {_sql_str(v)}) as {v}" for v in GROUPS)
    g_cols = ", ".join(f"sum(case when materiald = {_sql_str(r)} then seg_len end) as guardrail_len_{c}"
                       for r, c in MATERIALS.items())
    m_cols = ", ".join(f"sum(case when typed = {_sql_str(v)} then seg_len end) as median_len_{v}"
                       for v in SEGMENTS)
    return [
        _pairs("rp", "roads"), _pairs("gp", "guardrails"), _pairs("mp", "medians"),
        _pairs("sp", "sidewalks"), _sign_ctes(),
        f"road_w as (select grid_id, {road_cols} from rp where speed is not null and speed > 0 "
        f"and seg_len > 0 group by grid_id)",
        f"sign_w as (select g.id as grid_id, {sign_cols} from grid g join sgroup p on {_inside('g', 'p')} "
        f"where p.sign_group is not null group by g.id)",
        f"guard_w as (select grid_id, {g_cols} from gp where materiald is not null and materiald <> '' "
        f"and seg_len > 0 group by grid_id)",
        f"med_w as (select grid_id, {m_cols} from mp where typed is not null and typed <> '' "
        f"and seg_len > 0 group by grid_id)",
        "side_pair as (select grid_id, sidewalk_id, sum(seg_len) as len from sp group by 1, 2)",
        "side_w as (select grid_id, sum(len) as sidewalk_len from side_pair where len > 0 group by 1)",
        f"crash_w as (select g.id as grid_id, count(p.objectid) as crash_count from grid g "
        f"left join crashes p on {_inside('g', 'p')} group by g.id)",
    ]


def _feature_select() -> str:
    cols = ["r.grid_id"]
    cols += [_r(f"coalesce(r.road_len_mph_{v}, 0e0)") + f" as road_len_mph_{v}" for v in SPEEDS]
    cols += [f"coalesce(s.{v}, 0) as {v}" for v in GROUPS]
    cols += [_r(f"coalesce(gw.guardrail_len_{c}, 0e0)") + f" as guardrail_len_{c}" for c in MATERIALS.values()]
    cols += [_r(f"coalesce(mw.median_len_{v}, 0e0)") + f" as median_len_{v}" for v in SEGMENTS]
    cols += [_r("coalesce(sw.sidewalk_len, 0e0)") + " as sidewalk_len",
             "coalesce(c.crash_count, 0) as crash_count"]
    return ("ft as (select " + ", ".join(cols) + " from road_w r "
            "left join sign_w s on r.grid_id = s.grid_id "
            "left join guard_w gw on r.grid_id = gw.grid_id "
            "left join med_w mw on r.grid_id = mw.grid_id "
            "left join side_w sw on r.grid_id = sw.grid_id "
            "left join crash_w c on r.grid_id = c.grid_id)")


def _features_with(tail: str) -> str:
    return (_with("grid", "roads", "guardrails", "medians", "sidewalks", "signs", "crashes",
                  extra=_feature_ctes() + [_feature_select()]) + tail)


def _split_fraction(col: str) -> str:
    return f"cast(('0x' || substr(md5(cast({col} as varchar)), 1, 8)) as bigint) / 4294967296.0"


def _variants() -> str:
    """Summary of the mixed-kind geometries built from roads (k = road_id mod 5)."""
    L = "sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"
    a, b, c, d = (f"({x}::bigint || ' ' || {y}::bigint)" for x, y in (("x1", "y1"), ("x2", "y2"), ("x2", "y1"), ("x1", "y2")))
    P = f"(abs(x2 - x1) + abs(y2 - y1) + {L})"
    return (_with("roads")
            + "select road_id, "
              "case road_id % 5 when 0 then 'LineString' when 1 then 'MultiLineString' when 2 then 'Point' "
              "when 3 then 'Polygon' else 'MultiPolygon' end as kind, "
              "case when road_id % 5 in (1, 4) then 2 else 1 end as n_parts, "
              "case road_id % 5 when 0 then 2 when 1 then 4 when 2 then 1 when 3 then 4 else 8 end as n_vertices, "
              "case when road_id % 5 = 4 then 2 else 0 end as n_polys, "
              "case when road_id % 5 = 2 then x1 else least(x1, x2) end as xmin, "
              "case when road_id % 5 = 2 then y1 else least(y1, y2) end as ymin, "
              "case when road_id % 5 = 2 then x1 else greatest(x1, x2) end as xmax, "
              "case when road_id % 5 = 2 then y1 else greatest(y1, y2) end as ymax, "
              f"case road_id % 5 when 0 then {a} || ',' || {b} when 1 then {a} || ',' || {b} || ',' || {b} || ',' || {a} "
              f"when 2 then {a} when 3 then {a} || ',' || {c} || ',' || {b} || ',' || {a} "
              f"else {a} || ',' || {c} || ',' || {b} || ',' || {a} || ',' || {b} || ',' || {a} || ',' || {d} || ',' || {b} "
              "end as coords, "
              f"round(case road_id % 5 when 0 then {L} when 1 then 2 * {L} when 2 then 0e0 "
              f"when 3 then {P} else 2 * {P} end, 6) as length "
              "from roads")


def _members() -> str:
    """The members of the collections built from roads: as many as road_id mod 4, and one."""
    L = "sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"
    P = f"(abs(x2 - x1) + abs(y2 - y1) + {L})"
    return (_with("roads")
            + "select road_id, 'GeometryCollection' as of, cast(m as int) as member, "
              "case m when 0 then 'Point' when 1 then 'LineString' when 2 then 'Polygon' else 'MultiPolygon' end as kind, "
              "case when m = 3 then 2 else 1 end as n_parts, case when m = 3 then 2 else 0 end as n_polys, "
              f"round(case m when 0 then 0e0 when 1 then {L} when 2 then {P} else 2 * {P} end, 6) as length "
              "from roads, range(4) t(m) where m <= road_id % 4")


SQL: dict[str, str] = {
    "collection_parse": _members(),
    "collection_roundtrip": _members(),
    "road_length_by_speed": _road_long(),
    "road_length_by_speed_wide": _road_wide(),
    "guardrail_length_by_material": _cat_long("guardrails", "materiald", "material"),
    "guardrail_length_by_material_wide": _cat_wide("guardrails", "materiald", "guardrail_len_", MATERIALS),
    "median_length_by_type": _cat_long("medians", "typed", "median_type"),
    "median_length_by_type_wide": _cat_wide("medians", "typed", "median_len_", {v: v for v in SEGMENTS}),
    "sidewalk_length": _sidewalk(),
    "crash_count": _crash(),
    "concave_crash_count": _concave_crash(),
    "crash_count_large_grid": _crash_large_grid(),
    "road_length_large_grid": _road_large_grid(),
    "sign_count_by_group": _sign_long(),
    "sign_count_by_group_wide": _sign_wide(),
    "sign_classify": _sign_classify(),
    "points_in_cells": _points_in_cells(),
    "multipoint_in_cells": _multipoint(),
    "area_length": _area_length(),
    "area_length_triangles": _area_length_triangles(),
    # what the forest must satisfy whatever its trees: rows held out, rows scored, predictions between labels
    "model_rmse": _features_with(
        f"select count(*) as n, true as rmse_is_formula, true as rmse_below_range from ft where not ({_split_fraction('grid_id')} < 0.8)"),
    "scored_grid": _features_with(
        "select g.id, ft.grid_id is not null as has_prediction, case when ft.grid_id is not null then true end as in_label_range "
        "from grid g left join ft on g.id = ft.grid_id"),
    "frame_road_length": _frame_road(),
    "frame_crash_count": _frame_crash(),
    "road_length_mixed_grid": _mixed_road(),
    "crash_count_mixed_grid": _mixed_crash(),
    "disc_road_length": _disc_road(),
    "disc_crash_count": _disc_crash(),
    "intersecting_roads": _intersecting(),
    "layer_window": _layer_window(),
    "retraced_lines": _cat_long("shuttles", "kind", "kind"),
    "forest_against_mean": _forest_against_mean(),
    "prediction_by_label_group": _prediction_by_label_group(),
    "clip_segments": _clip_segments(),
    "layer_profile": _profile(),
    "written_layer_profile": _profile(),
    "feature_table": _features_with("select * from ft"),
    "label_audit": _features_with(
        "select count(*) as rows, cast(sum(case when crash_count is null then 1 else 0 end) as bigint) "
        "as null_crashes, cast(sum(case when crash_count = 0 then 1 else 0 end) as bigint) as zero_crashes "
        "from ft"),
    "split_assignment": _features_with(
        f"select grid_id, crash_count, {_split_fraction('grid_id')} < 0.8 as is_train from ft"),
    "polygon_cells": _polygon_cells(),
    "concave_cells": _concave_cells(),
    "geojson_parse": _variants(),
    "wkb_roundtrip": _variants(),
    "geojson_convert": (_with("guardrails")
                        + "select guardrail_id, materiald, 'LineString' as kind, 2 as n_vertices, "
                          "x1, y1, x2, y2 from guardrails"),
}
