"""Sign codes to sign groups, as Column expressions.

Cleaning (applied to the raw code): not null, not blank after trim, not in
the deny list. Normalising: '-' becomes '_'. Grouping: the first rule whose
prefix (or exact value) matches wins; codes matching no rule get null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values: these must equal the reference's for equal results. ----
# Raw sign codes removed before grouping (exact matches).
DENY_LIST = [
    "_",
    "null",
    "999___MISC._OTHER_SIGN",
    "R_999___MISC._REGULATORY_SIGNS",
    "W_999___MISC._WARNING_SIGNS",
    "INFO___GENERAL_INFORMATION_SIGNS",
    "REC___RECREATIONAL_AND_CULTURAL_INTEREST_AREA_SIGNS",
    "SERVICES___GENERAL_SERVICE_SIGNS",
]
# Group rules in test order: (group, "prefix" | "equals", codes).
SIGN_GROUP_RULES = [
    ("speed_limit", "prefix", ["R2_"]),
    ("school_speed", "prefix", ["S4_", "S5_"]),
    ("stop_yield", "prefix", ["R1_"]),
    ("lane_row_control", "prefix", ["R3_", "R4_"]),
    ("curve_turn", "prefix", ["W1_", "W13_"]),
    ("intersection_warning", "prefix", ["W2_"]),
    ("advance_condition", "prefix", ["W3_"]),
    ("grade_surface", "prefix", ["W7_", "W8_"]),
    ("ped_bike_animal", "prefix", ["W11_"]),
    ("ped_bike_animal", "prefix", ["R9_50_"]),
    ("school_zone", "prefix", ["S1_1_"]),
    ("object_marker", "prefix", ["OM"]),
    ("object_marker", "equals", ["W1_8___CHEVRON_ALIGNMENT"]),
    ("railroad", "prefix", ["W10_"]),
    ("railroad", "prefix", ["R15_1_"]),
]
# ---- end of fixed values ----

SIGN_GROUPS = sorted({g for g, _, _ in SIGN_GROUP_RULES})


def is_usable_code(raw: Column) -> Column:
    """Cleaning filter on the raw code: not null, not blank, not denied."""
    return raw.isNotNull() & (F.trim(raw) != "") & ~raw.isin(DENY_LIST)


def normalize_code(raw: Column) -> Column:
    """Hyphens to underscores."""
    return F.translate(raw, "-", "_")


def _rule_pattern() -> tuple[str, dict[str, str]]:
    """One anchored alternation in rule order, and matched text -> group.

    Java regex alternation tries alternatives left to right, so the first
    rule (in table order) that matches at the start of the code wins, as in
    an ordered chain of tests. Prefix rules match their literal prefix;
    "equals" rules must match the whole code.
    """
    alts: list[str] = []
    lookup: dict[str, str] = {}
    for group, kind, values in SIGN_GROUP_RULES:
        for v in values:
            alts.append(r"\Q" + v + r"\E" + ("$" if kind == "equals" else ""))
            lookup.setdefault(v, group)
    return "^(?:" + "|".join(alts) + ")", lookup


def sign_group(code: Column) -> Column:
    """First matching rule's group; null when no rule matches.

    One regular-expression match and one map lookup per row: compact enough
    to stay compiled when the optimizer pushes ``sign_group IS NOT NULL``
    into the scan.
    """
    pattern, lookup = _rule_pattern()
    table = F.create_map(*[F.lit(x) for kv in lookup.items() for x in kv])
    return F.when(code.isNotNull(), F.try_element_at(table, F.regexp_extract(code, pattern, 0)))


def sign_group_chain(code: Column) -> Column:
    """The same rules as an explicit ``CASE WHEN`` chain (reference for tests)."""
    expr = None
    for group, kind, values in SIGN_GROUP_RULES:
        if kind == "prefix":
            cond = None
            for v in values:
                c = code.startswith(v)
                cond = c if cond is None else (cond | c)
        else:
            cond = code.isin(values)
        expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    return expr
