"""Panel specification: which column plays which role, and the fixed codes.

The engine is parameterised by column names; ``PanelSpec`` bundles the defaults
used for the TPC-H-style test data (see FIXTURES.md, part B):

* entity       = nation name of the ordering customer, plus one aggregate
                 entity that re-counts every row (the benchmark);
* level        = return flag N / A / R, plus the aggregate level A+R;
* axis "sex"   = line status (F, O)      -> code prefix ``G<v>_``;
* axis "age"   = order status (F, O, P)  -> code prefix ``B<v>_``;
* value        = 100 * share of rows with quantity above a threshold.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written: codes and labels appear in query
# output and in the SQL oracle).
# ---------------------------------------------------------------------------
TOTAL = "Total"
AGGREGATE_ENTITY = "ALL"
AGGREGATE_ENTITY_NAME = "All entities (aggregate)"
AGGREGATE_REGION = "AGGREGATE"

# level code, label, sort order, is aggregate level
LEVELS = [
    ("L_NONE", "Not returned", 1, 0),
    ("L_LTD", "Returned A", 2, 0),
    ("L_SEV", "Returned R", 3, 0),
    ("L_LTD_SEV", "Returned A or R", 4, 1),
]
# return flag -> base level; the aggregate level re-counts these flags
RETURNFLAG_LEVEL = {"N": "L_NONE", "A": "L_LTD", "R": "L_SEV"}
AGGREGATE_LEVEL = "L_LTD_SEV"
AGGREGATE_LEVEL_MEMBERS = ("A", "R")

# axis value, label, sort order (value 'Total' = not broken down)
SEX_VALUES = [(TOTAL, "Both statuses", 1), ("F", "Line status F", 2), ("O", "Line status O", 3)]
AGE_VALUES = [(TOTAL, "All order statuses", 1), ("F", "Order status F", 2),
              ("O", "Order status O", 3), ("P", "Order status P", 4)]
# code, name, unit, frequency, reference year
INDICATOR = ("LINE_SHARE", "Line items above the quantity threshold", "Percentage of line items", "A", 1998)
SEX_PREFIX = "G"
AGE_PREFIX = "B"

# quality flags: cells resting on fewer observations are suppressed or flagged
FLAG_UNRELIABLE = "u"
SUPPRESS_BELOW = 20
FLAG_BELOW = 50
# the category that the expectations allow to have no value
NULL_CATEGORY = "BF_L_SEV"


@dataclass(frozen=True)
class PanelSpec:
    """Roles and parameters of one panel."""

    entity: str = "entity"
    category: str = "category_code"
    level: str = "level"
    sex: str = "ls"
    age: str = "os"
    value: str = "pct"
    flag: str = "quality_flag"
    reliable: str = "is_reliable"
    is_aggregate: str = "is_aggregate"

    aggregate_entity: str = AGGREGATE_ENTITY
    focus_entity: str = "NATION_3"
    ref_level: str = "L_NONE"
    severe_level: str = "L_SEV"
    female: str = "F"
    male: str = "O"
    age_young: str = "F"
    age_mid: str = "O"
    age_old: str = "P"
    hit_threshold: float = 20.0
    suppress_below: int = SUPPRESS_BELOW
    flag_below: int = FLAG_BELOW
    leaders: tuple = ("NATION_0", "NATION_1", AGGREGATE_ENTITY)
    highlight: dict = field(default_factory=lambda: {
        "NATION_3": "#2E75B6", "NATION_7": "#2E75B6", "NATION_12": "#C00000"})
    highlight_default: str = "#D9D9D9"

    def code(self, level: str, sex: str = TOTAL, age: str = TOTAL) -> str:
        return category_code(level, sex, age)


def category_code(level: str, sex: str = TOTAL, age: str = TOTAL) -> str:
    """Category code of one cell of the cube: {level} | G<sex>_{level} | B<age>_{level}."""
    if sex != TOTAL and age != TOTAL:
        raise ValueError("the cube has no sex x age cells")
    if sex != TOTAL:
        return f"{SEX_PREFIX}{sex}_{level}"
    if age != TOTAL:
        return f"{AGE_PREFIX}{age}_{level}"
    return level


def all_category_codes() -> list[tuple[str, str, str, str]]:
    """(code, level, sex, age) for the 24 cells, in dimension sort order."""
    out = []
    for lvl, *_ in LEVELS:
        out.append((category_code(lvl), lvl, TOTAL, TOTAL))
    for sx, *_ in SEX_VALUES[1:]:
        for lvl, *_ in LEVELS:
            out.append((category_code(lvl, sex=sx), lvl, sx, TOTAL))
    for ag, *_ in AGE_VALUES[1:]:
        for lvl, *_ in LEVELS:
            out.append((category_code(lvl, age=ag), lvl, TOTAL, ag))
    return out


DEFAULT_SPEC = PanelSpec()
