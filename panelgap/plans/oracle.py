"""DuckDB SQL that the queries are compared with.

Written from the meaning of each query: a prelude rebuilds the panel from the raw
tables, ``by_entity`` turns the cells a query compares into one row per entity.
"""

from __future__ import annotations

from ..config import (AGE_VALUES, AGGREGATE_ENTITY, AGGREGATE_ENTITY_NAME, AGGREGATE_REGION,
                      FLAG_BELOW, INDICATOR, LEVELS, NULL_CATEGORY, SEX_VALUES, SUPPRESS_BELOW,
                      all_category_codes)


def _q(s) -> str:
    if s is None:
        return "NULL"
    if isinstance(s, bool):
        return "TRUE" if s else "FALSE"
    if isinstance(s, (int, float)):
        return repr(s)
    return "'" + str(s).replace("'", "''") + "'"


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_q(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


def cells_cte(entity: str = "nation", threshold: float = 20.0) -> str:
    if entity == "nation":
        base = f"""
  SELECT n.n_name AS entity, l.l_returnflag AS rf, l.l_linestatus AS ls, o.o_orderstatus AS os,
         CASE WHEN l.l_quantity > {threshold!r} THEN 1 ELSE 0 END AS hit
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""
    elif entity == "customer":
        base = f"""
  SELECT 'C' || CAST(o.o_custkey AS VARCHAR) AS entity, l.l_returnflag AS rf, l.l_linestatus AS ls,
         o.o_orderstatus AS os, CASE WHEN l.l_quantity > {threshold!r} THEN 1 ELSE 0 END AS hit
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
    elif entity == "supplier":
        base = f"""
  SELECT 'S' || CAST(l.l_suppkey AS VARCHAR) AS entity, l.l_returnflag AS rf, l.l_linestatus AS ls,
         o.o_orderstatus AS os, CASE WHEN l.l_quantity > {threshold!r} THEN 1 ELSE 0 END AS hit
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
    else:
        raise ValueError(entity)
    return f"""base AS ({base}),
lv AS (
  SELECT *, CASE rf WHEN 'N' THEN 'L_NONE' WHEN 'A' THEN 'L_LTD' WHEN 'R' THEN 'L_SEV' END AS lvl FROM base
  UNION ALL SELECT *, 'L_LTD_SEV' FROM base WHERE rf IN ('A', 'R')),
ax AS (SELECT entity, lvl, ls, os, hit FROM lv UNION ALL SELECT '{AGGREGATE_ENTITY}', lvl, ls, os, hit FROM lv),
g AS (
  SELECT entity, lvl, CASE WHEN GROUPING(ls) = 1 THEN 'Total' ELSE ls END AS ls,
         CASE WHEN GROUPING(os) = 1 THEN 'Total' ELSE os END AS os, COUNT(*) AS n, SUM(hit) AS h
  FROM ax GROUP BY GROUPING SETS ((entity, lvl), (entity, lvl, ls), (entity, lvl, os))),
cells AS (
  SELECT entity, entity = '{AGGREGATE_ENTITY}' AS is_aggregate,
         CASE WHEN ls <> 'Total' THEN CONCAT('G', ls, '_') WHEN os <> 'Total' THEN CONCAT('B', os, '_')
              ELSE '' END || lvl AS category_code,
         lvl AS level, ls, os, CAST(n AS BIGINT) AS n, CAST(h AS BIGINT) AS hits,
         100.0e0 * h / n AS pct
  FROM g)"""


def fact_cte(entity: str = "nation", threshold: float = 20.0) -> str:
    return cells_cte(entity, threshold) + f""",
fact0 AS (
  SELECT entity, is_aggregate, category_code, level, ls, os, n, hits,
         CASE WHEN n >= {SUPPRESS_BELOW} THEN pct END AS pct,
         CASE WHEN n < {FLAG_BELOW} THEN 'u' END AS quality_flag, n >= {FLAG_BELOW} AS is_reliable
  FROM cells),
fact AS (
  SELECT f.*, ROUND(100.0e0 - f.pct, 4) AS pct_excluded, ROUND(r.pct - f.pct, 4) AS gap_vs_ref,
         ROUND(f.pct - b.pct, 4) AS pct_vs_bench
  FROM fact0 f
  LEFT JOIN fact0 r ON r.entity = f.entity AND r.ls = f.ls AND r.os = f.os AND r.level = 'L_NONE'
  LEFT JOIN fact0 b ON b.entity = '{AGGREGATE_ENTITY}' AND b.level = f.level AND b.ls = f.ls AND b.os = f.os)"""


def dims_cte() -> str:
    lv = _values([(c, lab, s, bool(a)) for c, lab, s, a in LEVELS],
                  ["level", "level_label", "level_order", "level_is_aggregate"])
    sx = _values(SEX_VALUES, ["ls", "ls_label", "ls_order"])
    ag = _values(AGE_VALUES, ["os", "os_label", "os_order"])
    cat = _values([(code, lvl, s, a, s == "Total" and a == "Total", code == NULL_CATEGORY)
                   for code, lvl, s, a in all_category_codes()],
                  ["category_code", "level", "ls", "os", "is_core", "has_known_data_issues"])
    ind = _values([INDICATOR], ["indicator", "indicator_name", "unit", "frequency", "reference_year"])
    return f"""dim_level AS {lv},
dim_sex AS {sx},
dim_age AS {ag},
dim_category AS {cat},
dim_indicator AS {ind},
dim_entity AS (
  SELECT n.n_name AS entity, n.n_name AS entity_name, FALSE AS is_aggregate,
         'N' || LPAD(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS iso2, r.r_name AS region
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT '{AGGREGATE_ENTITY}', '{AGGREGATE_ENTITY_NAME}', TRUE, NULL, '{AGGREGATE_REGION}')"""


def with_fact(body: str, entity: str = "nation") -> str:
    return "WITH " + fact_cte(entity) + ",\n" + dims_cte() + "\n" + body


def with_cells(body: str, entity: str = "nation") -> str:
    return "WITH " + cells_cte(entity) + "\n" + body


def mart_cte(low: float = 0.0, high: float = 4.0) -> str:
    """The mart as SQL: wide pivot + gaps + band + ordinal rank."""
    return f""",
m0 AS (
  SELECT entity, is_aggregate,
    MAX(CASE WHEN category_code = 'L_NONE' THEN pct END) AS pct_ref,
    MAX(CASE WHEN category_code = 'L_SEV' THEN pct END) AS pct_sev,
    MAX(CASE WHEN category_code = 'L_LTD' THEN pct END) AS pct_ltd,
    MAX(CASE WHEN category_code = 'L_LTD_SEV' THEN pct END) AS pct_ltd_sev,
    MAX(CASE WHEN category_code = 'GF_L_SEV' THEN pct END) AS pct_female_sev,
    MAX(CASE WHEN category_code = 'GO_L_SEV' THEN pct END) AS pct_male_sev,
    MAX(CASE WHEN category_code = 'BO_L_SEV' THEN pct END) AS pct_mid_sev,
    MAX(CASE WHEN category_code = 'BP_L_SEV' THEN pct END) AS pct_old_sev
  FROM fact
  WHERE category_code IN ('L_NONE', 'L_SEV', 'L_LTD', 'L_LTD_SEV', 'GF_L_SEV', 'GO_L_SEV', 'BO_L_SEV', 'BP_L_SEV')
  GROUP BY entity, is_aggregate),
m1 AS (
  SELECT *, ROUND(pct_ref - pct_sev, 2) AS gap_total, ROUND(pct_male_sev - pct_female_sev, 2) AS gap_gender,
         ROUND(pct_mid_sev - pct_old_sev, 2) AS gap_age
  FROM m0),
mart AS (
  SELECT *,
    ROUND(gap_total - (SELECT MAX(gap_total) FROM m1 WHERE entity = '{AGGREGATE_ENTITY}'), 2) AS gap_vs_bench,
    ROUND(100.0e0 - pct_sev, 2) AS pct_excluded_sev,
    CASE WHEN is_aggregate THEN NULL WHEN gap_total IS NULL THEN NULL
         WHEN gap_total < {low!r} THEN 'High inclusion' WHEN gap_total > {high!r} THEN 'Extreme case'
         ELSE 'Medium inclusion' END AS inclusion_group,
    CASE WHEN NOT is_aggregate AND gap_total IS NOT NULL
         THEN CAST(ROW_NUMBER() OVER (PARTITION BY (NOT is_aggregate AND gap_total IS NOT NULL)
                                      ORDER BY gap_total DESC, entity) AS BIGINT) END AS rank_by_gap
  FROM m1)"""


def with_mart(body: str, low: float = 0.0, high: float = 4.0) -> str:
    return "WITH " + fact_cte() + ",\n" + dims_cte() + mart_cte(low, high) + "\n" + body


def by_entity(name: str, every: bool = True, where: str = "TRUE", **codes: str) -> str:
    """A CTE with one row per entity: for each ``alias=category`` the value and ``alias_ok``,
    its reliability.  ``every`` drops entities that lack one of the cells."""
    picks = ", ".join(f"MAX(pct) FILTER (category_code = '{c}') AS {a}, "
                      f"BOOL_AND(is_reliable) FILTER (category_code = '{c}') AS {a}_ok" for a, c in codes.items())
    listed = ", ".join(f"'{c}'" for c in codes.values())
    having = f" HAVING COUNT(DISTINCT category_code) = {len(codes)}" if every else ""
    return (f", {name} AS (SELECT entity, {picks} FROM fact WHERE category_code IN ({listed}) AND {where} "
            f"GROUP BY entity{having})")
