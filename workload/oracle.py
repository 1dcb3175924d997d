"""The registered queries as SQL over the sample tables, written independently."""

from __future__ import annotations

from workload import mapping as m
from workload.mapping import cte

ORACLE: dict[str, str] = {}

# Fixed values shared with the queries: names, codes and labels only.
VARIABLE_NAMES = (
    "pop", "housing", "pov1", "pov2", "foreign_born", "people_of_color1", "people_of_color2",
    "lep1", "lep2", "lep3", "lep4", "disability1", "disability2",
)
MEASURE_CASE = """CASE WHEN variable LIKE 'lep%' THEN 'lep' WHEN variable LIKE 'pov%' THEN 'pov'
  WHEN variable = 'foreign_born' THEN 'foreign_born' WHEN variable LIKE 'people%' THEN 'poc'
  WHEN variable LIKE 'disab%' THEN 'disability' WHEN variable = 'pop' THEN 'population'
  WHEN variable = 'housing' THEN 'housing_units' END"""

TRIPS, SPARSE = cte(m.TRIPS), cte(m.SPARSE_TRIPS)

# Filters and columns
ORACLE["filter_eq"] = f"SELECT * FROM {TRIPS} WHERE SERVICE_RTE_NUM = 7"
ORACLE["filter_in"] = f"SELECT * FROM {TRIPS} WHERE SERVICE_RTE_NUM IN (15, 17, 18, 40, 674)"
ORACLE["filter_not_in_range_keeps_null"] = """
SELECT o_orderkey, nullif(o_custkey, 13) AS route FROM orders
WHERE o_custkey = 13 OR NOT o_custkey BETWEEN 500 AND 600"""
ORACLE["filter_sql_logic"] = """
SELECT p_partkey, p_name, p_brand, p_size FROM part
WHERE (p_name LIKE '%ring' OR p_brand IN ('Brand#1', 'Brand#2'))
  AND NOT (p_size < 10 AND p_type <> 'ECONOMY') AND p_retailprice <= 1500"""
ORACLE["filter_date_range"] = f"""
SELECT * FROM {TRIPS}
WHERE OPERATION_DATE >= date '1997-10-02' AND OPERATION_DATE < date '1998-01-01'"""
ORACLE["filter_missing"] = """
SELECT l_orderkey AS TRIP_ID, l_partkey AS STOP_ID FROM lineitem WHERE l_quantity = 13"""
ORACLE["drop_na_rows"] = """
SELECT l_orderkey AS TRIP_ID, l_partkey AS STOP_ID, l_quantity AS PSNGR_BOARDINGS
FROM lineitem WHERE l_quantity <> 13"""
ORACLE["active_routes"] = f"""
SELECT * FROM {cte(m.ROUTES)} WHERE IS_ACTIVE_FLAG = 1 AND SERVICE_TYPE_CD <> 'DART'"""
ORACLE["current_stops"] = f"""
SELECT STOP_ID, XCOORD_OFFSET, YCOORD_OFFSET FROM {cte(m.STOP_HISTORY)}
WHERE STOP_STATUS_ID = 3 AND CHANGE_NUM = 213 AND MINOR_CHANGE_NUM = 0
  AND EFFECTIVE_END_DATE >= date '2021-10-02'"""
ORACLE["select_cols"] = "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem"
ORACLE["drop_cols"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus
FROM lineitem"""
ORACLE["clean_rename"] = """
SELECT p_partkey AS part_key, p_name AS label, p_size AS am_trip_count,
  p_brand AS am_trip_count_2 FROM part"""
ORACLE["mutate_chain"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
  l_quantity / 60 AS hours, 213 AS service_change, l_quantity / 60 * 255 AS annual_hours
FROM lineitem"""
ORACLE["profile_trips"] = """
SELECT count(*) AS rows, cast(9 AS int) AS columns, min(cast(l_shipdate AS date)) AS oldest,
  max(cast(l_shipdate AS date)) AS newest FROM lineitem"""
ORACLE["order_two_keys"] = "SELECT p_partkey, p_brand, p_size FROM part ORDER BY p_brand, p_size"
ORACLE["head_rows"] = "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 6"

# Joins
BOOKINGS = """(SELECT o_orderkey, nullif(o_custkey, 7) AS rider, o_orderstatus AS status,
  o_totalprice AS amount FROM orders)"""
RIDERS = """(SELECT nullif(c_custkey, 7) AS rider,
  CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS status,
  c_acctbal AS amount, c_mktsegment FROM customer)"""
for how, keyword in (("left", "LEFT"), ("right", "RIGHT"), ("inner", "INNER"), ("full", "FULL")):
    ORACLE[f"join_{how}"] = f"""
SELECT b.o_orderkey,
  CASE WHEN b.o_orderkey IS NULL THEN r.rider ELSE b.rider END AS rider,
  CASE WHEN b.o_orderkey IS NULL THEN r.status ELSE b.status END AS status,
  b.amount AS amount_x, r.amount AS amount_y, r.c_mktsegment
FROM {BOOKINGS} b {keyword} JOIN {RIDERS} r
  ON b.rider IS NOT DISTINCT FROM r.rider AND b.status IS NOT DISTINCT FROM r.status"""
for how, keyword in (("semi", "EXISTS"), ("anti", "NOT EXISTS")):
    ORACLE[f"join_{how}"] = f"""
SELECT * FROM {BOOKINGS} b WHERE {keyword} (SELECT 1 FROM {RIDERS} r
  WHERE b.rider IS NOT DISTINCT FROM r.rider AND b.status IS NOT DISTINCT FROM r.status)"""
ORACLE["join_null_keys"] = """
SELECT o_orderkey, nullif(o_custkey, 7) AS rider, c_name
FROM orders JOIN customer ON o_custkey = c_custkey"""
ORACLE["join_natural"] = """
SELECT c_custkey, n_nationkey, n_name, n_regionkey AS regionkey, r_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey"""
ORACLE["join_renamed_key"] = """
SELECT orders.*, c_name, c_nationkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
ORACLE["join_anti_orders"] = """
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
ORACLE["star_join"] = """
SELECT r_name, n_name, c_mktsegment, count(*) AS trips, sum(l_quantity) AS boardings
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""
ORACLE["fanout_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
ORACLE["rejoin_summary"] = f"""
SELECT r.*, boardings FROM {cte(m.ROUTES)} r LEFT JOIN (
  SELECT l_suppkey, sum(CASE WHEN l_quantity <> 13 THEN l_quantity ELSE 0 END) AS boardings
  FROM lineitem GROUP BY 1) ON SERVICE_RTE_NUM = l_suppkey"""

# Aggregates
ORACLE["average_daily_boardings"] = f"""
SELECT SERVICE_RTE_NUM, DAY_CODE, coalesce(sum(AVG_PSNGR_BOARDINGS), 0) AS avg_daily_boardings
FROM {cte(m.TRIP_SUMMARY)} WHERE SERVICE_CHANGE_NUM = 1998 AND SERVICE_RTE_NUM IN (1, 2)
GROUP BY ALL"""
ORACLE["sum_strict"] = f"""
SELECT SERVICE_RTE_NUM, CASE WHEN count(*) = count(boardings) THEN sum(boardings) END
  AS sum_boardings, count(*) AS count_trips FROM {SPARSE} GROUP BY ALL"""
ORACLE["route_day_totals"] = f"""
SELECT SERVICE_RTE_NUM, EXPRESS_LOCAL_CD, SCHED_DAY_TYPE_CODED_NUM,
  CASE WHEN count(*) = count(PSNGR_BOARDINGS) THEN sum(PSNGR_BOARDINGS) END AS sum_boardings,
  count(*) AS count_trips FROM {TRIPS} GROUP BY ALL"""
ORACLE["sum_na_rm"] = f"""
SELECT SERVICE_RTE_NUM,
  coalesce(sum(PSNGR_BOARDINGS) FILTER (SERVICE_RTE_NUM % 5 <> 0), 0) AS total,
  coalesce(sum(PSNGR_BOARDINGS), 0) AS boardings FROM {TRIPS} GROUP BY ALL"""
ORACLE["agg_menu"] = f"""
WITH t AS (SELECT *, median(boardings) OVER (PARTITION BY SERVICE_RTE_NUM) AS centre FROM {SPARSE}),
g AS (SELECT SERVICE_RTE_NUM, count(*) = count(boardings) AS whole, avg(boardings) AS mean,
    stddev_samp(boardings) AS sd, min(boardings) AS min, max(boardings) AS max,
    quantile_cont(boardings, 0.25) AS q25, quantile_cont(boardings, 0.5) AS median,
    quantile_cont(boardings, 0.75) AS q75, quantile_cont(boardings, 0.9) AS q90,
    1.4826 * median(abs(boardings - centre)) AS mad
  FROM t GROUP BY 1)
SELECT SERVICE_RTE_NUM, CASE WHEN whole THEN round(mean, 6) END AS mean,
  CASE WHEN whole THEN round(sd, 6) END AS sd, CASE WHEN whole THEN min END AS min,
  CASE WHEN whole THEN max END AS max, CASE WHEN whole THEN round(q25, 6) END AS q25,
  CASE WHEN whole THEN round(median, 6) END AS median,
  CASE WHEN whole THEN round(q75, 6) END AS q75, CASE WHEN whole THEN round(q90, 6) END AS q90,
  CASE WHEN whole THEN round(q75 - q25, 6) END AS iqr,
  CASE WHEN whole THEN round(mad, 6) END AS mad
FROM g"""
ORACLE["agg_positional"] = f"""
WITH t AS (SELECT *, row_number() OVER (PARTITION BY SERVICE_RTE_NUM
    ORDER BY TRIP_ID, STEP, STOP_ID, FARES, boardings NULLS FIRST) AS r,
  count(*) OVER (PARTITION BY SERVICE_RTE_NUM) AS n FROM {SPARSE})
SELECT SERVICE_RTE_NUM, max(FARES) FILTER (r = 1) AS "first",
  max(FARES) FILTER (r = n) AS "last", max(FARES) FILTER (r = 3) AS third FROM t GROUP BY 1"""
ORACLE["n_distinct_null"] = f"""
SELECT SERVICE_RTE_NUM, count(DISTINCT coalesce(day_part, -1)) AS parts,
  count(DISTINCT STOP_ID) AS stops FROM {SPARSE} GROUP BY 1"""
ORACLE["any_all"] = f"""
SELECT SERVICE_RTE_NUM,
  CASE WHEN max(boardings) > 49 THEN true WHEN count(*) > count(boardings) THEN NULL ELSE false END AS any_high,
  CASE WHEN max(boardings) > 49 THEN false WHEN count(*) > count(boardings) THEN NULL ELSE true END AS all_low,
  CASE WHEN count(*) > count(boardings) THEN NULL ELSE false END AS any_extreme,
  CASE WHEN count(*) > count(boardings) THEN NULL ELSE true END AS all_normal
FROM {SPARSE} GROUP BY 1"""
ORACLE["count_if_members"] = f"""
WITH g AS (SELECT SERVICE_RTE_NUM, count(*) FILTER (day_part = 5) AS a,
    count(*) FILTER (day_part IN (1, 2, 4) OR day_part IS NULL) AS early_or_missing,
    count(*) AS b FROM {SPARSE} GROUP BY 1),
h AS (SELECT *, 100 * a // b AS f, 2 * (100 * a % b) AS r FROM g)
SELECT SERVICE_RTE_NUM, a AS fifth, early_or_missing,
  (f + CASE WHEN r > b OR (r = b AND f % 2 = 1) THEN 1 ELSE 0 END) / 100.0::double AS share FROM h"""
ORACLE["sql_platform_hours"] = f"""
WITH trips AS {cte(m.ALL_TRIPS)},
a AS (SELECT DISTINCT TRIP_ID, SERVICE_RTE_NUM, EXPRESS_LOCAL_CD, SCHED_DAY_TYPE_CODED_NUM,
    DAY_PART_CD, INBD_OUTBD_CD, BUS_BASE_ID, BUS_TYPE_NUM, start_time_mnts_after_midnt,
    end_time_mnts_after_midnt FROM trips WHERE TRIP_KIND_CD = 'S'),
b AS (SELECT TRIP_ID, SERVICE_CHANGE_NUM, sum(TRIP_DURATION_MNTS)::double AS minutes
  FROM trips GROUP BY ALL)
SELECT SERVICE_CHANGE_NUM, a.*, minutes / 60 * CASE SCHED_DAY_TYPE_CODED_NUM
  WHEN 0 THEN 255 WHEN 1 THEN 52 WHEN 2 THEN 58 END AS annual_platform_hours
FROM a JOIN b USING (TRIP_ID)"""

# Windows, ranks and first rows
ORACLE["group_count_window"] = f"""
SELECT *, count(*) OVER (PARTITION BY SERVICE_RTE_NUM, EXPRESS_LOCAL_CD,
  SCHED_DAY_TYPE_CODED_NUM, SERVICE_CHANGE_NUM) AS daily_trips
FROM {cte(m.SCHEDULE)} WHERE WORKING_LOAD_STATUS = 'FINAL'"""
ORACLE["days_in_month"] = f"""
SELECT *, count(*) OVER (PARTITION BY CAL_YEAR_NUM, CAL_MONTH_IN_YEAR_NUM,
  SERVICE_DAY_TYPE_CODE) AS DAYS_IN_MONTH FROM {cte(m.DATES)}"""
RANKED = f"""(SELECT *, CASE WHEN boardings IS NOT NULL THEN cast(ntile(5) OVER (
    PARTITION BY SERVICE_RTE_NUM, boardings IS NULL
    ORDER BY boardings, TRIP_ID, STEP, STOP_ID, FARES) AS int) END AS quintile_rank
  FROM {SPARSE})"""
ORACLE["ntile_grouped"] = f"SELECT * FROM {RANKED}"
ORACLE["quintile_counts"] = f"""
SELECT SERVICE_RTE_NUM, quintile_rank, count(*) AS trips FROM {RANKED}
WHERE SERVICE_RTE_NUM IN (3, 4) GROUP BY ALL"""
ORACLE["ntile_ties"] = """
SELECT l_returnflag, bucket, l_linenumber, count(*) AS trips FROM (
  SELECT l_returnflag, l_linenumber,
    cast(ntile(5) OVER (PARTITION BY l_returnflag ORDER BY l_linenumber) AS int) AS bucket
  FROM lineitem) AS ranked
GROUP BY l_returnflag, bucket, l_linenumber
"""
ORACLE["ntile_mixed_types"] = """
SELECT o_orderkey, o_orderkey + 9007199254740992 AS big, o_totalprice,
  cast(ntile(4) OVER (ORDER BY o_orderkey) AS int) AS big_quartile,
  cast(ntile(4) OVER (ORDER BY o_totalprice, o_orderkey) AS int) AS price_quartile
FROM orders
"""
ORACLE["ntile_global"] = """
SELECT p_partkey, p_size, nullif(p_size, 17) AS size, p_retailprice,
  CASE WHEN p_size <> 17 THEN cast(ntile(5) OVER (PARTITION BY p_size = 17
    ORDER BY p_size, p_partkey) AS int) END AS size_quintile,
  cast(ntile(5) OVER (ORDER BY p_retailprice, p_partkey) AS int) AS price_quintile
FROM part"""
ORACLE["slice_max_ties"] = f"""
SELECT * EXCLUDE r FROM (SELECT *, rank() OVER (PARTITION BY SERVICE_RTE_NUM
  ORDER BY boardings DESC) AS r FROM {SPARSE} WHERE boardings IS NOT NULL) WHERE r <= 10"""
ORACLE["slice_max_global"] = f"""
SELECT * EXCLUDE r FROM (SELECT *, rank() OVER (ORDER BY boardings DESC) AS r
  FROM {SPARSE} WHERE boardings IS NOT NULL) WHERE r <= 10"""
ORACLE["histogram"] = """
SELECT cast(b AS int) AS bin, (b - 1) * 10::double AS "lower", b * 10::double AS "upper",
  count(*) AS count
FROM (SELECT greatest(ceil(l_quantity / 10), 1) AS b FROM lineitem WHERE l_quantity <> 13)
GROUP BY ALL"""
ORACLE["distinct_keep_first"] = """
SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1"""
ORACLE["distinct_cols"] = "SELECT DISTINCT l_suppkey, l_returnflag, l_linenumber FROM lineitem"

# Stacking and reshaping
ORACLE["bind_rows_fill"] = """
SELECT s_name AS name, s_nationkey AS nation, s_acctbal AS balance, NULL::varchar AS segment
FROM supplier
UNION ALL SELECT c_name, c_nationkey, NULL, c_mktsegment FROM customer"""
MOE = f"""(SELECT a.GEOID AS geoid, a.NAME AS name, variable, estimate, moe, mf_variable,
  round(CASE WHEN count(*) OVER g = count(estimate) OVER g THEN sqrt(
    coalesce(sum(CASE WHEN estimate <> 0 THEN moe * moe END) OVER g, 0)
    + coalesce(power(max(CASE WHEN estimate = 0 THEN moe END) OVER g, 2), 0)) END, 6) AS sum_moe
  FROM (SELECT *, {MEASURE_CASE} AS mf_variable FROM {cte(m.ACS)}) a
  WINDOW g AS (PARTITION BY GEOID, mf_variable))"""


def _cells(value: str) -> str:
    return ", ".join(
        f"max(CASE WHEN variable = '{v}' THEN {value} END) AS {value}_{v}" for v in VARIABLE_NAMES
    )


ORACLE["pivot_two_values"] = f"""
SELECT geoid, name, {_cells('estimate')}, {_cells('sum_moe')} FROM {MOE} GROUP BY geoid, name"""

# Column functions
ORACLE["recode_default"] = """
SELECT p_partkey, CASE p_brand WHEN 'Brand#1' THEN '671' WHEN 'Brand#2' THEN '672'
  WHEN 'Brand#3' THEN '673' WHEN 'Brand#4' THEN '674' ELSE p_brand END AS route FROM part"""
ORACLE["recode_pattern_no_default"] = """
SELECT p_partkey, p_name, CASE WHEN p_name LIKE '%ring%' THEN 'ring'
  WHEN p_name LIKE 'blue%' THEN 'blue'
  WHEN p_name LIKE '%bolt%' OR p_name LIKE '%nut%' THEN 'fastener' END AS kind FROM part"""
ORACLE["conditional_overwrite"] = """
SELECT p_partkey, CASE WHEN p_partkey IN (3, 5, 8) THEN 1.5::double ELSE p_retailprice END AS price
FROM part"""
ORACLE["gsub_all"] = """
SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '-', 'g') AS masked FROM part"""
ORACLE["text_to_number"] = """
SELECT p_partkey, CASE WHEN p_size > 25 THEN cast(substr(p_brand, 7) AS double) END AS route_number
FROM part"""
ORACLE["text_to_day"] = """
SELECT p_partkey, CASE WHEN p_size > 25 THEN date '2021-10-02' END AS day FROM part"""
ORACLE["round_half_even"] = """
WITH t AS (SELECT p_partkey, p_size, 100 * p_size // 40 AS f, 2 * (100 * p_size % 40) AS r FROM part)
SELECT p_partkey, round_even(p_size / 2::double, 0) AS halved,
  (f + CASE WHEN r > 40 OR (r = 40 AND f % 2 = 1) THEN 1 ELSE 0 END) / 100::double AS ratio FROM t"""
ORACLE["replace_na"] = """
SELECT o_orderkey, CASE WHEN o_custkey = 7 THEN 599 ELSE o_custkey END AS rider FROM orders"""
ORACLE["paste_parts"] = """
SELECT p_partkey, p_brand || '_' || CASE WHEN p_size = 11 THEN 'NA' ELSE p_size::varchar END AS label
FROM part"""
ORACLE["parse_problems"] = """
SELECT 'count' AS "column", count(*) AS problems, min(p_type) AS example FROM part WHERE p_size <= 25"""

# Census estimates
ORACLE["moe_sum"] = f"SELECT * FROM {MOE}"
ORACLE["moe_interval"] = f"""
SELECT GEOID, variable, round(estimate - moe * (1.96::double / 1.645::double), 6) AS "lower",
  round(estimate + moe * (1.96::double / 1.645::double), 6) AS "upper" FROM {cte(m.ACS)}"""
NAMED = "CASE variable WHEN 'B01001_001' THEN 'pop' WHEN 'C17002_001' THEN 'pov1' ELSE 'pov2' END"
PICKED = "variable IN ('B01001_001', 'C17002_001', 'C17002_008')"
ORACLE["acs_tidy"] = f"""
SELECT GEOID, NAME, {NAMED} AS variable, estimate, moe FROM {cte(m.ACS_FILES)}
WHERE year = 2019 AND {PICKED}"""
ORACLE["acs_wide"] = f"""
SELECT GEOID, NAME, {", ".join(
    f"max({v}) FILTER (variable = '{code}') AS {name}{letter}"
    for name, code in (("pop", "B01001_001"), ("pov1", "C17002_001"), ("pov2", "C17002_008"))
    for v, letter in (("estimate", "E"), ("moe", "M")))}
FROM {cte(m.ACS_FILES)} WHERE year = 2019 AND {PICKED} GROUP BY GEOID, NAME"""
ORACLE["decennial_wide"] = f"""
SELECT GEOID, NAME, max(estimate) FILTER (variable = 'B01001_001') AS pop,
  max(estimate) FILTER (variable = 'C17002_001') AS pov1,
  max(estimate) FILTER (variable = 'C17002_008') AS pov2
FROM {cte(m.ACS_FILES)} WHERE year = 2020 AND {PICKED} GROUP BY GEOID, NAME"""
ORACLE["search_variables"] = """
SELECT p_brand AS name, p_name AS label, nullif(p_type, 'ECONOMY') AS concept FROM part
WHERE p_name ILIKE '%blue%' OR p_name ILIKE '%small%' OR p_type ILIKE '%small%'"""
ORACLE["measure_by_place"] = """
SELECT s_suppkey::varchar AS GEOID, s_name AS NAME, 'medincome' AS variable,
  s_acctbal AS estimate, s_nationkey * 12 + 1::double AS moe,
  s_acctbal - (s_nationkey * 12 + 1) AS "lower", s_acctbal + (s_nationkey * 12 + 1) AS "upper"
FROM supplier"""

# Space. Projections are worked out step by step, the equal-area inverse by iteration.
LAMBERT = """
lambert AS (SELECT *, ln(m1 / m2) / ln(t1 / t2) AS n FROM (
  SELECT e, a, cos(p1) / sqrt(1 - power(e * sin(p1), 2)) AS m1,
    cos(p2) / sqrt(1 - power(e * sin(p2), 2)) AS m2,
    tan(pi() / 4 - p0 / 2) / power((1 - e * sin(p0)) / (1 + e * sin(p0)), e / 2) AS t0,
    tan(pi() / 4 - p1 / 2) / power((1 - e * sin(p1)) / (1 + e * sin(p1)), e / 2) AS t1,
    tan(pi() / 4 - p2 / 2) / power((1 - e * sin(p2)) / (1 + e * sin(p2)), e / 2) AS t2
  FROM (SELECT sqrt(2 / 298.257222101::double - power(1 / 298.257222101::double, 2)) AS e,
    6378137 / 0.304800609601219::double AS a, radians(47::double) AS p0,
    radians(48.7333333333333::double) AS p1, radians(47.5::double) AS p2)))"""


def _lambert(source: str, lon: str, lat: str, keep: str) -> str:
    """Feet from degrees for the rows of a CTE; needs the CTE ``lambert``."""
    return f"""(SELECT {keep}, 1640416.667::double + rho * sin(theta) AS x,
    rho0 - rho * cos(theta) AS y
  FROM (SELECT s.*, a * m1 / (n * power(t1, n)) * power(t0, n) AS rho0,
      n * radians({lon} + 120.833333333333::double) AS theta,
      a * m1 / (n * power(t1, n)) * power(tan(pi() / 4 - radians({lat}) / 2)
        / power((1 - e * sin(radians({lat}))) / (1 + e * sin(radians({lat}))), e / 2), n) AS rho
    FROM {source} s, lambert))"""


STEP = """(SELECT * EXCLUDE phi, phi + power(1 - e * e * sin(phi) * sin(phi), 2) / (2 * cos(phi))
  * (q / (1 - e * e) - sin(phi) / (1 - e * e * sin(phi) * sin(phi))
    + ln((1 - e * sin(phi)) / (1 + e * sin(phi))) / (2 * e)) AS phi FROM {})"""
ALBERS_START = f"""(SELECT *, (c - power(sqrt(px * px + (rho0 - py) * (rho0 - py)) * n / a, 2)) / n AS q,
    asin((c - power(sqrt(px * px + (rho0 - py) * (rho0 - py)) * n / a, 2)) / n / 2) AS phi,
    -96 + degrees(atan2(px, rho0 - py) / n) AS lon
  FROM (SELECT *, a * sqrt(c - n * q0) / n AS rho0 FROM (
    SELECT *, m1 * m1 + n * q1 AS c FROM (
      SELECT *, (m1 * m1 - m2 * m2) / (q2 - q1) AS n FROM (
        SELECT *, cos(p1) / sqrt(1 - e * e * sin(p1) * sin(p1)) AS m1,
          cos(p2) / sqrt(1 - e * e * sin(p2) * sin(p2)) AS m2,
          (1 - e * e) * (sin(p0) / (1 - e * e * sin(p0) * sin(p0)) - ln((1 - e * sin(p0)) / (1 + e * sin(p0))) / (2 * e)) AS q0,
          (1 - e * e) * (sin(p1) / (1 - e * e * sin(p1) * sin(p1)) - ln((1 - e * sin(p1)) / (1 + e * sin(p1))) / (2 * e)) AS q1,
          (1 - e * e) * (sin(p2) / (1 - e * e * sin(p2) * sin(p2)) - ln((1 - e * sin(p2)) / (1 + e * sin(p2))) / (2 * e)) AS q2
        FROM (SELECT sqrt(2 / 298.257222101::double - power(1 / 298.257222101::double, 2)) AS e,
          6378137::double AS a, radians(37.5::double) AS p0, radians(29.5::double) AS p1,
          radians(45.5::double) AS p2))))), {cte(m.JOBS)})"""
ALBERS = ALBERS_START
for _ in range(6):
    ALBERS = STEP.format(ALBERS)
DEGREE_JOBS = f"(SELECT c_custkey, cd01, cd02, lon, degrees(phi) AS lat FROM {ALBERS})"

ORACLE["project_lcc"] = f"""
WITH {LAMBERT}
SELECT stop_id, round(x, 3) AS x, round(y, 3) AS y
FROM {_lambert(cte(m.FEED['stops']), 'stop_lon', 'stop_lat', 'stop_id')}"""
ORACLE["project_albers_inverse"] = f"""
SELECT c_custkey, round(lon, 6) AS lon, round(lat, 6) AS lat FROM {DEGREE_JOBS}"""

CORNERS = """(VALUES
  ('outer', -1, 0, 0, -1), ('outer', 0, -1, 1, 0), ('outer', 1, 0, 0, 1), ('outer', 0, 1, -1, 0),
  ('hole', -1, -1, 1, -1), ('hole', 1, -1, 1, 1), ('hole', 1, 1, -1, 1), ('hole', -1, 1, -1, -1)
  ) AS side(part, fx, fy, tx, ty)"""


def _sides(areas: str) -> str:
    size = "CASE part WHEN 'outer' THEN radius ELSE hole END"
    return f"""(SELECT geoid, cx + fx * {size} AS x1, cy + fy * {size} AS y1,
    cx + tx * {size} AS x2, cy + ty * {size} AS y2
  FROM {areas}, {CORNERS} WHERE part = 'outer' OR holed)"""


def _hits(points: str, sides: str, keep: str) -> str:
    """Pairs of point and area by the even-odd rule, sides excluded."""
    return f"""(SELECT {keep}, geoid FROM {points} p JOIN {sides} e
    ON p.y BETWEEN least(y1, y2) AND greatest(y1, y2)
  GROUP BY ALL
  HAVING sum(CASE WHEN (y1 > p.y) <> (y2 > p.y)
      AND p.x < (x2 - x1) * (p.y - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1
    AND sum(CASE WHEN (x2 - x1) * (p.y - y1) = (y2 - y1) * (p.x - x1)
      AND p.x BETWEEN least(x1, x2) AND greatest(x1, x2) THEN 1 ELSE 0 END) = 0)"""


STOP_POINTS = f"""(SELECT STOP_ID, XCOORD_OFFSET AS x, YCOORD_OFFSET AS y
  FROM {cte(m.STOPS)} WHERE XCOORD_OFFSET IS NOT NULL)"""
STOP_HITS = _hits(STOP_POINTS, _sides(cte(m.AREAS_FEET)), "STOP_ID")
ORACLE["points_within"] = f"""
SELECT p.STOP_ID, h.geoid FROM {STOP_POINTS} p LEFT JOIN {STOP_HITS} h USING (STOP_ID)"""
ORACLE["polygons_contain"] = f"""
SELECT a.geoid, h.STOP_ID FROM {cte(m.AREAS_FEET)} a LEFT JOIN {STOP_HITS} h USING (geoid)"""
ORACLE["polygon_density"] = f"""
SELECT geoid, nullif(count(STOP_ID), 0) AS stops,
  2 * 3600 - CASE WHEN bool_or(holed) THEN 400 ELSE 0 END::double AS area,
  round(nullif(count(STOP_ID), 0) / (2 * 3600 - CASE WHEN bool_or(holed) THEN 400 ELSE 0 END::double) * 1e6, 6) AS density
FROM {cte(m.AREAS_FEET)} LEFT JOIN {STOP_HITS} USING (geoid) GROUP BY geoid"""

# Sides of the degree areas in feet: both ends projected.
GEO_SIDES = f"""
geo_sides AS MATERIALIZED (SELECT a.geoid, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM (SELECT geoid, i, x, y FROM {_lambert('numbered', 'x1', 'y1', 'geoid, i')}) a
  JOIN (SELECT geoid, i, x, y FROM {_lambert('numbered', 'x2', 'y2', 'geoid, i')}) b USING (geoid, i))"""
NUMBERED = f"""
numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY geoid, x1, y1, x2, y2) AS i
  FROM {_sides(cte(m.AREAS_DEGREES))})"""
JOB_POINTS = _lambert(DEGREE_JOBS, "lon", "lat", "c_custkey, cd01 + cd02 AS people")
ORACLE["jobs_by_area"] = f"""
WITH {LAMBERT}, {NUMBERED}, {GEO_SIDES},
jobs AS MATERIALIZED (SELECT * FROM {JOB_POINTS}),
totals AS (SELECT geoid, cast(sum(people) AS bigint) AS jobs
  FROM {_hits('jobs', 'geo_sides', 'c_custkey, people')} GROUP BY 1),
shapes AS (SELECT geoid, sum(x1 * y2 - x2 * y1) / 2 AS outer_minus_hole FROM (
    SELECT g.geoid, CASE WHEN abs(n.x1 - a.cx) + abs(n.y1 - a.cy) < 0.007::DOUBLE THEN -1 ELSE 1 END AS sign,
      g.x1 - c.x AS x1, (g.y1 - c.y) * CASE WHEN abs(n.x1 - a.cx) + abs(n.y1 - a.cy) < 0.007::DOUBLE THEN -1 ELSE 1 END AS y1,
      g.x2 - c.x AS x2, (g.y2 - c.y) * CASE WHEN abs(n.x1 - a.cx) + abs(n.y1 - a.cy) < 0.007::DOUBLE THEN -1 ELSE 1 END AS y2
    FROM (SELECT a.geoid, a.i, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
      FROM (SELECT geoid, i, x, y FROM {_lambert('numbered', 'x1', 'y1', 'geoid, i')}) a
      JOIN (SELECT geoid, i, x, y FROM {_lambert('numbered', 'x2', 'y2', 'geoid, i')}) b USING (geoid, i)) g
    JOIN numbered n USING (geoid, i) JOIN {cte(m.AREAS_DEGREES)} a USING (geoid)
    JOIN {_lambert(cte(m.AREAS_DEGREES), 'cx', 'cy', 'geoid')} c USING (geoid)) GROUP BY 1)
SELECT geoid, jobs, round(outer_minus_hole / 1e6, 3) AS area_million,
  round(jobs / outer_minus_hole * 1e9, 3) AS jobs_per_billion
FROM shapes LEFT JOIN totals USING (geoid)"""

# Whole analyses
EVENTS = f"""(SELECT * FROM {cte(m.PASSUPS)}
  WHERE FULL_DATE >= date '1996-01-01' AND FULL_DATE < date '1999-01-01'
    AND MESSAGE_TEXT <> 'Resume pick up of customers')"""
MONTH_DAYS = f"({ORACLE['days_in_month']})"
PLANNER = f"""(SELECT route_number, Routes, Lead FROM (
    SELECT *, try_cast(CASE WHEN Routes LIKE '% (%' THEN regexp_extract(Routes, '[0-9]+') ELSE Routes END AS double)
      AS route_number FROM {cte(m.PLANNERS)})
  QUALIFY row_number() OVER (PARTITION BY route_number ORDER BY Routes, Lead) = 1)"""
RATE_KEYS = """SERVICE_RTE_NUM, EXPRESS_LOCAL_CD, MESSAGE_TEXT, LOW_INCOME_FLAG, MINORITY_FLAG,
  OPPORTUNITY_SCORE, Lead, CAL_MONTH_IN_YEAR_NUM, CAL_YEAR_NUM, DAYS_IN_MONTH,
  SCHED_DAY_TYPE_CODED_NUM, daily_trips"""
ORACLE["passup_rate"] = f"""
WITH t AS ({ORACLE['group_count_window']}),
joined AS (SELECT e.SERVICE_RTE_NUM, t.EXPRESS_LOCAL_CD, MESSAGE_TEXT, LOW_INCOME_FLAG, MINORITY_FLAG,
    OPPORTUNITY_SCORE, Lead, CAL_MONTH_IN_YEAR_NUM, CAL_YEAR_NUM, DAYS_IN_MONTH,
    e.SCHED_DAY_TYPE_CODED_NUM, daily_trips
  FROM {EVENTS} e
  LEFT JOIN t ON e.SERVICE_RTE_NUM = t.SERVICE_RTE_NUM AND e.TRIP_ID = t.TRIP_ID
    AND e.SCHED_DAY_TYPE_CODED_NUM = t.SCHED_DAY_TYPE_CODED_NUM
  LEFT JOIN ({ORACLE['active_routes']}) r ON e.SERVICE_RTE_NUM = r.SERVICE_RTE_NUM
    AND t.EXPRESS_LOCAL_CD IS NOT DISTINCT FROM r.EXPRESS_LOCAL_CD
  LEFT JOIN {MONTH_DAYS} d ON e.FULL_DATE = d.FULL_DATE
  LEFT JOIN {PLANNER} p ON e.SERVICE_RTE_NUM = p.route_number)
SELECT {RATE_KEYS}, count(*) AS sum_monthly_passups, count(*) / DAYS_IN_MONTH AS average_daily_passups,
  daily_trips * DAYS_IN_MONTH AS monthly_trips,
  count(*) / (daily_trips * DAYS_IN_MONTH) AS pct_trips_with_passup
FROM joined GROUP BY {RATE_KEYS}"""
ORACLE["routes_without_passups"] = f"""
SELECT * FROM {cte(m.ALL_ROUTES)} WHERE SERVICE_RTE_NUM NOT IN (SELECT SERVICE_RTE_NUM FROM {EVENTS})"""
ORACLE["passups_by_stop"] = f"""
SELECT STOP_ID, MESSAGE_TEXT, CAL_MONTH_IN_YEAR_NUM, CAL_YEAR_NUM, DAYS_IN_MONTH,
  SCHED_DAY_TYPE_CODED_NUM, XCOORD_OFFSET, YCOORD_OFFSET, count(*) AS sum_monthly_passups_by_stop
FROM {EVENTS} LEFT JOIN {cte(m.STOPS)} USING (STOP_ID) LEFT JOIN {MONTH_DAYS} USING (FULL_DATE)
GROUP BY ALL"""
BY_AREA = f"""(SELECT a.geoid, SCHED_DAY_TYPE_CODED_NUM, CAL_MONTH_IN_YEAR_NUM, CAL_YEAR_NUM,
    block_group_passups_sum
  FROM {cte(m.AREAS_FEET)} a LEFT JOIN (
    SELECT geoid, SCHED_DAY_TYPE_CODED_NUM, month(FULL_DATE)::int AS CAL_MONTH_IN_YEAR_NUM,
      year(FULL_DATE)::int AS CAL_YEAR_NUM, count(*) AS block_group_passups_sum
    FROM {EVENTS} JOIN {STOP_HITS} USING (STOP_ID) GROUP BY ALL) USING (geoid))"""
ORACLE["passups_by_area"] = f"SELECT * FROM {BY_AREA}"
ORACLE["passup_month_layers"] = f"""
SELECT *, CASE SCHED_DAY_TYPE_CODED_NUM WHEN 0 THEN 'weekday' WHEN 1 THEN 'saturday'
  ELSE 'sunday' END AS layer
FROM {BY_AREA} WHERE CAL_MONTH_IN_YEAR_NUM = 11 AND SCHED_DAY_TYPE_CODED_NUM IN (0, 1, 2)"""

MEASURES = f"""(SELECT geoid, name, estimate_pov1 - estimate_pov2 AS population_200_pct_below_poverty_line,
    estimate_foreign_born AS foreign_born,
    estimate_people_of_color1 - estimate_people_of_color2 AS people_of_color,
    estimate_lep1 + estimate_lep2 + estimate_lep3 + estimate_lep4 AS limited_english_households,
    estimate_disability1 + estimate_disability2 AS people_with_disability,
    sum_moe_pov1 AS population_200_pct_below_poverty_line_moe,
    sum_moe_people_of_color1 AS people_of_color_moe, sum_moe_foreign_born AS foreign_born_moe,
    sum_moe_lep1 AS limited_english_households_moe, sum_moe_disability1 AS people_with_disability_moe
  FROM ({ORACLE['pivot_two_values']}))"""
ORACLE["area_measures"] = f"SELECT * FROM {MEASURES}"


def _quintile(measure: str, name: str) -> str:
    return f"""CASE WHEN {measure} IS NOT NULL THEN cast(ntile(5) OVER (
      PARTITION BY {measure} IS NULL ORDER BY {measure}, geoid) AS int) END AS {name}"""


def _scores(measures: str) -> str:
    return f"""(SELECT *, round(poc_quintile * 0.4::DOUBLE, 6) AS race_score,
    round(pov_quintile * 0.3::DOUBLE, 6) AS pov_score, round(lep_quintile * 0.1::DOUBLE, 6) AS lep_score,
    round(disability_quintile * 0.1::DOUBLE, 6) AS disability_score,
    round(foreign_born_quintile * 0.1::DOUBLE, 6) AS foreign_born_score,
    round_even(poc_quintile * 0.4::DOUBLE + pov_quintile * 0.3::DOUBLE + lep_quintile * 0.1::DOUBLE
      + disability_quintile * 0.1::DOUBLE + foreign_born_quintile * 0.1::DOUBLE, 0) AS final_score,
    2019 AS acs_year
  FROM (SELECT geoid, name,
    {_quintile('population_200_pct_below_poverty_line', 'pov_quintile')},
    {_quintile('people_of_color', 'poc_quintile')},
    {_quintile('foreign_born', 'foreign_born_quintile')},
    {_quintile('limited_english_households', 'lep_quintile')},
    {_quintile('people_with_disability', 'disability_quintile')}
    FROM {measures}))"""


SCORES = _scores(MEASURES)
ORACLE["equity_score"] = f"SELECT * FROM {SCORES}"
ALL_AREAS = f"""(SELECT a.geoid, s.* EXCLUDE geoid FROM (
    SELECT s_suppkey::varchar AS geoid FROM supplier
    UNION ALL SELECT 'n' || n_nationkey FROM nation) a LEFT JOIN {MEASURES} s USING (geoid))"""
ORACLE["equity_score_all_areas"] = f"SELECT * FROM {_scores(ALL_AREAS)}"
ORACLE["scored_areas"] = f"""
SELECT geoid, CASE WHEN holed THEN 2 ELSE 1 END AS rings, final_score
FROM {cte(m.AREAS_FEET)} LEFT JOIN {SCORES} USING (geoid)"""

# Literal left joins in feed order, then the repair, the projection and the renaming.
FEED_ROWS = f"""
feed_rows AS MATERIALIZED (SELECT stop_id, stop_name, route_id, route_desc, service_change_num,
    CASE WHEN route_short_name IN ('A Line', 'C', 'Link light rail') THEN
      CASE route_short_name WHEN 'A Line' THEN '671' WHEN 'C' THEN '673' ELSE '599' END
      ELSE coalesce(route_short_name, '599') END AS route_short_name,
    CASE WHEN stop_id IN ('46', '47') THEN 47.2041::DOUBLE ELSE stop_lat END AS lat,
    CASE WHEN stop_id IN ('46', '47') THEN -122.4559::DOUBLE ELSE stop_lon END AS lon
  FROM (SELECT DISTINCT service_change_num, stop_id, stop_name, stop_lat, stop_lon, route_id
    FROM {cte(m.FEED['stops'])} s LEFT JOIN {cte(m.FEED['stop_times'])} st USING (stop_id, service_change_num)
    LEFT JOIN {cte(m.FEED['trips'])} t USING (trip_id, service_change_num)
    LEFT JOIN {cte(m.FEED['calendar'])} c USING (service_id, service_change_num)
    WHERE start_date > date '2021-10-01')
  LEFT JOIN {cte(m.FEED['routes'])} r USING (route_id, service_change_num)
  QUALIFY row_number() OVER (
    PARTITION BY service_change_num, stop_id, route_short_name ORDER BY route_id) = 1)"""
PLACED = _lambert(
    "feed_rows",
    "lon",
    "lat",
    "stop_id, stop_name, route_id, route_short_name, route_desc, service_change_num",
)
ORACLE["stops_by_route"] = f"""
WITH {LAMBERT}, {FEED_ROWS}
SELECT * EXCLUDE (x, y), round(x, 3) AS x, round(y, 3) AS y FROM {PLACED}"""
SCORED_STOPS = f"""{LAMBERT}, {NUMBERED}, {GEO_SIDES}, {FEED_ROWS},
placed AS MATERIALIZED (SELECT * FROM {PLACED}),
places AS MATERIALIZED (SELECT DISTINCT x, y FROM placed),
place_hits AS MATERIALIZED {_hits('places', 'geo_sides', 'x, y')},
scored AS (SELECT p.*, h.geoid, pov_quintile, final_score FROM placed p
  JOIN place_hits h ON p.x = h.x AND p.y = h.y LEFT JOIN {SCORES} s ON h.geoid = s.geoid)"""
ORACLE["stop_equity"] = f"""
WITH {SCORED_STOPS}
SELECT stop_id, route_short_name, service_change_num, geoid, pov_quintile, final_score FROM scored"""
ORACLE["route_opportunity"] = f"""
WITH {SCORED_STOPS},
g AS (SELECT route_short_name, service_change_num, count(*) AS n,
    round(coalesce(avg(final_score), 'nan'::double), 6) AS mean_stop_score,
    count(*) FILTER (final_score = 5) AS a,
    count(*) FILTER (final_score IN (1, 2, 3, 4) OR final_score IS NULL) AS b
  FROM scored GROUP BY ALL),
h AS (SELECT *, 100 * a // n AS f, 2 * (100 * a % n) AS r FROM g),
k AS (SELECT *, (f + CASE WHEN r > n OR (r = n AND f % 2 = 1) THEN 1 ELSE 0 END) / 100::double AS pct FROM h)
SELECT route_short_name, service_change_num, n AS total_stop_count, mean_stop_score,
  a AS equity_stops_count, b AS non_equity_stops_count, pct AS percent_stops_in_priority_bg,
  cast(ntile(5) OVER (PARTITION BY service_change_num ORDER BY pct, route_short_name) AS int)
    AS route_opportunity_index_score FROM k"""
ORACLE["route_stop_shapes"] = f"""
WITH {SCORED_STOPS}
SELECT route_short_name, service_change_num, cast(count(DISTINCT (x, y)) AS int) AS places
FROM scored GROUP BY ALL"""
