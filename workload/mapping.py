"""The sample tables read as transit tables.

Each text is one SELECT that both SQL dialects understand; ``{table}`` stands for
a sample table and ``<<...>>`` for the few functions that are spelled differently.
Missing values are made with NULLIF and CASE, since the sample tables have none.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

TRIPS = """
SELECT cast(l_suppkey AS int) AS SERVICE_RTE_NUM, l_linestatus AS EXPRESS_LOCAL_CD,
  l_returnflag AS INBD_OUTBD_CD, l_linenumber AS SCHED_DAY_TYPE_CODED_NUM,
  nullif(l_quantity, 13) AS PSNGR_BOARDINGS, l_orderkey AS TRIP_ID, l_partkey AS STOP_ID,
  cast(l_shipdate AS date) AS OPERATION_DATE, l_extendedprice AS FARES
FROM {lineitem}
"""

# Missing counts on every fourth route only.
SPARSE_TRIPS = """
SELECT cast(l_suppkey AS int) AS SERVICE_RTE_NUM,
  CASE WHEN l_suppkey % 4 = 0 THEN nullif(l_quantity, 13) ELSE l_quantity END AS boardings,
  nullif(l_linenumber, 3) AS day_part, l_orderkey AS TRIP_ID, l_linenumber AS STEP,
  l_partkey AS STOP_ID, l_extendedprice AS FARES
FROM {lineitem}
"""

TRIP_SUMMARY = """
SELECT cast(extract(year FROM l_shipdate) AS int) AS SERVICE_CHANGE_NUM,
  cast(l_suppkey AS int) AS SERVICE_RTE_NUM,
  CASE l_linenumber WHEN 6 THEN 'SA' WHEN 7 THEN 'SU' ELSE 'WK' END AS DAY_CODE,
  l_returnflag AS INBD_OUTBD_CD, nullif(l_quantity, 13) AS AVG_PSNGR_BOARDINGS
FROM {lineitem}
"""

ALL_TRIPS = """
SELECT l_orderkey AS TRIP_ID, cast(l_suppkey AS int) AS SERVICE_RTE_NUM,
  l_linestatus AS EXPRESS_LOCAL_CD, l_linenumber - 1 AS SCHED_DAY_TYPE_CODED_NUM,
  l_returnflag AS DAY_PART_CD, l_returnflag AS INBD_OUTBD_CD,
  CASE WHEN l_tax > 0.04 THEN 'CB' ELSE 'EB' END AS BUS_BASE_ID,
  cast(l_partkey % 4 AS int) AS BUS_TYPE_NUM,
  cast(l_partkey % 1200 AS int) AS start_time_mnts_after_midnt,
  cast(l_partkey % 1200 + l_quantity AS int) AS end_time_mnts_after_midnt,
  cast(l_quantity AS int) AS TRIP_DURATION_MNTS,
  CASE WHEN l_quantity > 48 THEN 'D' ELSE 'S' END AS TRIP_KIND_CD,
  'FINAL' AS WORKING_LOAD_STATUS, 201 AS SERVICE_CHANGE_NUM, 0 AS MINOR_CHANGE_NUM
FROM {lineitem}
"""

PASSUPS = """
SELECT cast(l_shipdate AS date) AS FULL_DATE, l_linenumber AS SCHED_DAY_TYPE_CODED_NUM,
  l_partkey AS STOP_ID, cast(l_suppkey AS int) AS SERVICE_RTE_NUM, l_orderkey AS TRIP_ID,
  CASE l_returnflag WHEN 'R' THEN 'Resume pick up of customers' WHEN 'A' THEN 'Full bus'
    ELSE 'No wheelchair space' END AS MESSAGE_TEXT
FROM {lineitem}
"""

SCHEDULE = """
SELECT l_orderkey AS TRIP_ID, cast(l_suppkey AS int) AS SERVICE_RTE_NUM,
  l_linenumber AS SCHED_DAY_TYPE_CODED_NUM,
  CASE WHEN min(CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END) = 0 THEN 'F' ELSE 'O' END
    AS EXPRESS_LOCAL_CD,
  213 AS SERVICE_CHANGE_NUM, 0 AS MINOR_CHANGE_NUM, 'S' AS TRIP_KIND_CD,
  CASE WHEN max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) = 1 THEN 'DRAFT' ELSE 'FINAL' END
    AS WORKING_LOAD_STATUS
FROM {lineitem} AS l JOIN {orders} AS o ON l_orderkey = o_orderkey
GROUP BY l_orderkey, l_suppkey, l_linenumber
"""

ROUTES = """
SELECT cast(s_suppkey AS int) AS SERVICE_RTE_NUM,
  CASE s_suppkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' END AS EXPRESS_LOCAL_CD,
  s_name AS SERVICE_RTE_NM, s_nationkey % 2 AS LOW_INCOME_FLAG,
  CASE WHEN s_nationkey % 3 = 0 THEN 1 ELSE 0 END AS MINORITY_FLAG,
  s_nationkey % 5 + 1 AS OPPORTUNITY_SCORE,
  CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS IS_ACTIVE_FLAG,
  'CITY' AS OWNER_AGENCY_CD, 'CITY' AS OPERATOR_AGENCY_CD,
  CASE WHEN s_suppkey % 10 = 9 THEN 'DART' ELSE 'BUS' END AS SERVICE_TYPE_CD
FROM {supplier}
"""

# Routes of no pass-up among them.
ALL_ROUTES = f"""{ROUTES}UNION ALL
SELECT cast(1000000000 + n_nationkey AS int), CAST(NULL AS string), n_name, n_nationkey % 2,
  CASE WHEN n_nationkey % 3 = 0 THEN 1 ELSE 0 END, n_nationkey % 5 + 1, 1, 'CITY', 'CITY', 'BUS'
FROM {{nation}}
"""

DATES = """
SELECT FULL_DATE, cast(extract(year FROM FULL_DATE) AS int) AS CAL_YEAR_NUM,
  cast(extract(month FROM FULL_DATE) AS int) AS CAL_MONTH_IN_YEAR_NUM,
  CASE extract(<<isodow>> FROM FULL_DATE) WHEN 6 THEN 'SA' WHEN 7 THEN 'SU' ELSE 'WK' END
    AS SERVICE_DAY_TYPE_CODE
FROM (SELECT DISTINCT cast(l_shipdate AS date) AS FULL_DATE FROM {lineitem}) AS days
"""

PLANNERS = """
SELECT CASE WHEN s_suppkey < 6
    THEN chr(cast(65 + s_suppkey AS int)) || ' (' || cast(s_suppkey AS string) || ')'
    ELSE cast(s_suppkey AS string) END AS Routes,
  'Planner ' || cast(s_nationkey AS string) AS Lead
FROM {supplier}
"""
LETTERED = {"A (0)": "0", "B (1)": "1", "C (2)": "2", "D (3)": "3", "E (4)": "4", "F (5)": "5"}

# Stop positions in whole feet; every fiftieth stop has none.
STOPS = """
SELECT p_partkey AS STOP_ID,
  CASE WHEN p_partkey % 50 <> 0
    THEN cast(floor(p_partkey / 20) % 32 * 100 + p_partkey * 13 % 100 AS double) END AS XCOORD_OFFSET,
  CASE WHEN p_partkey % 50 <> 0
    THEN cast(floor(floor(p_partkey / 20) / 32) * 100 + p_partkey * 29 % 97 AS double) END AS YCOORD_OFFSET
FROM {part}
"""

# Long survey table, one of its names outside the patterns and the listed measures. Zero estimates on every seventh area, a missing one on some.
ACS = """
SELECT GEOID, NAME, variable,
  CASE WHEN area % 7 = 0 AND variable <> 'pop' THEN 0
    WHEN area % 11 = 5 AND variable = 'lep2' THEN NULL ELSE total END AS estimate, moe
FROM (
  SELECT s_suppkey AS area, cast(s_suppkey AS string) AS GEOID, s_name AS NAME,
    CASE (l_linenumber - 1) * 2 + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END
      WHEN 0 THEN 'pop' WHEN 1 THEN 'housing' WHEN 2 THEN 'pov1' WHEN 3 THEN 'pov2'
      WHEN 4 THEN 'foreign_born' WHEN 5 THEN 'people_of_color1' WHEN 6 THEN 'people_of_color2'
      WHEN 7 THEN 'lep1' WHEN 8 THEN 'lep2' WHEN 9 THEN 'lep3' WHEN 10 THEN 'lep4'
      WHEN 11 THEN 'disability1' WHEN 12 THEN 'disability2' ELSE 'vacant' END AS variable,
    total, moe
  FROM (
    SELECT l_suppkey, l_linenumber, l_linestatus, sum(l_quantity) AS total,
      cast(sum(cast(l_discount AS decimal(18, 2))) AS double) AS moe
    FROM {lineitem} GROUP BY l_suppkey, l_linenumber, l_linestatus
  ) AS l JOIN {supplier} AS s ON l_suppkey = s_suppkey
) AS summed
"""

# Landed survey files: block-group ids, published codes, two years.
ACS_FILES = """
SELECT '53033' || lpad(cast(s_suppkey AS string), 7, '0') AS GEOID, s_name AS NAME,
  variable, year, 'acs5' AS survey, estimate, moe
FROM (
  SELECT l_suppkey,
    CASE l_linenumber WHEN 1 THEN 'B01001_001' WHEN 2 THEN 'C17002_001' WHEN 3 THEN 'C17002_008'
      ELSE 'B19013_001' END AS variable,
    CASE WHEN l_linestatus = 'O' THEN 2019 ELSE 2020 END AS year,
    sum(l_quantity) AS estimate, cast(sum(cast(l_discount AS decimal(18, 2))) AS double) AS moe
  FROM {lineitem} GROUP BY 1, 2, 3
) AS l JOIN {supplier} AS s ON l_suppkey = s_suppkey
"""

# The stop table with its history: states, changes and last days of validity.
STOP_HISTORY = """
SELECT p_partkey AS STOP_ID, p_size % 4 AS STOP_STATUS_ID,
  CASE WHEN p_partkey % 3 = 0 THEN 201 WHEN p_partkey % 11 <> 0 THEN 213 END AS CHANGE_NUM,
  CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS MINOR_CHANGE_NUM,
  CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN date '2021-10-01'
    WHEN p_partkey % 5 = 1 THEN date '2021-10-02' ELSE date '2099-12-31' END AS EFFECTIVE_END_DATE,
  cast(p_partkey * 13 % 100 AS double) AS XCOORD_OFFSET, cast(p_partkey * 29 % 100 AS double) AS YCOORD_OFFSET
FROM {part}
"""

# Two service changes: the earlier one has half of the stops, a quarter of the trips and
# other first days.
CHANGE_OF_ORDER = "CASE WHEN {key} % 4 = 0 THEN '193' ELSE '213' END AS service_change_num"


def _in_both(select: str, source: str, only_earlier: str = "true") -> str:
    """Rows of a feed table in the later and, as far as they were there, in the earlier change."""
    return f"""
{select}, '213' AS service_change_num FROM {source}
UNION ALL
{select}, '193' AS service_change_num FROM {source} WHERE {only_earlier}
"""


FEED = {
    "stops": _in_both(
        """SELECT cast(p_partkey AS string) AS stop_id, p_name AS stop_name,
  cast(47.2 AS double) + floor(floor(p_partkey / 20) / 32) * cast(0.02 AS double) + (p_partkey * 29 % 20 - 10) * cast(0.001 AS double) + cast(0.0005 AS double) AS stop_lat,
  cast(-122.5 AS double) + floor(p_partkey / 20) % 32 * cast(0.02 AS double) + (p_partkey * 13 % 20 - 10) * cast(0.001 AS double) + cast(0.0005 AS double) AS stop_lon""",
        "{part}",
        "p_partkey % 2 = 0",
    ),
    "stop_times": f"""
SELECT cast(l_partkey AS string) AS stop_id, cast(l_orderkey AS string) AS trip_id,
  {CHANGE_OF_ORDER.format(key="l_orderkey")}
FROM {{lineitem}}
""",
    "trips": f"""
SELECT cast(o_orderkey AS string) AS trip_id, cast(o_custkey % 25 AS string) AS route_id,
  cast(o_custkey AS string) AS service_id, {CHANGE_OF_ORDER.format(key="o_orderkey")}
FROM {{orders}}
""",
    "calendar": """
SELECT cast(c_custkey AS string) AS service_id,
  CASE WHEN c_custkey % 3 = 0 THEN date '2021-09-15' ELSE date '2021-10-09' END AS start_date,
  '213' AS service_change_num
FROM {customer}
UNION ALL
SELECT cast(c_custkey AS string) AS service_id,
  CASE WHEN c_custkey % 2 = 0 THEN date '2021-09-15' ELSE date '2021-10-02' END AS start_date,
  '193' AS service_change_num
FROM {customer}
""",
    "routes": _in_both(
        """SELECT cast(n_nationkey AS string) AS route_id,
  CASE n_nationkey WHEN 0 THEN 'A Line' WHEN 1 THEN 'Link light rail' WHEN 2 THEN NULL
    WHEN 3 THEN 'C' WHEN 4 THEN 'C' ELSE n_name END AS route_short_name,
  n_name AS route_desc""",
        "{nation}",
        "n_nationkey <> 5",
    ),
}
MOVED = ("46", "47")

# Area shapes: a diamond around a grid position, every third with a square hole.
DIAMOND = [(-1.0, 0.0), (0.0, -1.0), (1.0, 0.0), (0.0, 1.0)]
SQUARE = [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)]

AREAS_FEET = """
SELECT cast(s_suppkey AS string) AS geoid, s_suppkey % 3 = 0 AS holed,
  cast(s_suppkey % 32 * 100 + 50 AS double) AS cx,
  cast(floor(s_suppkey / 32) * 100 + 50 AS double) AS cy, cast(60 AS double) AS radius, cast(10 AS double) AS hole
FROM {supplier}
"""
AREAS_DEGREES = """
SELECT cast(s_suppkey AS string) AS geoid, s_suppkey % 3 = 0 AS holed,
  cast(-122.5 AS double) + s_suppkey % 32 * cast(0.02 AS double) AS cx, cast(47.2 AS double) + floor(s_suppkey / 32) * cast(0.02 AS double) AS cy,
  cast(0.0121 AS double) AS radius, cast(0.002 AS double) AS hole
FROM {supplier}
"""

# Job points near the areas, in the equal-area metre system.
JOBS = """
SELECT c_custkey, c_custkey % 7 AS cd01, c_custkey % 5 AS cd02,
  cast(-1984000 + c_custkey % 1000 * 45 AS double) AS px,
  cast(1352000 + c_custkey * 37 % 1000 * 17 AS double) AS py
FROM {customer}
"""

PLACES = """
SELECT cast(s_suppkey AS string) AS GEOID, s_name || ' County, Washington' AS NAME,
  'medincome' AS variable, s_acctbal AS estimate, cast(s_nationkey * 12 + 1 AS double) AS moe
FROM {supplier}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _names(text: str) -> set[str]:
    return {field for _, field, _, _ in string.Formatter().parse(text) if field}


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A mapping as a DataFrame."""
    query = text.replace("<<isodow>>", "DAYOFWEEK_ISO")
    return spark.sql(query, **{n: table(spark, sf_dir, n) for n in _names(text)})


def cte(text: str) -> str:
    """A mapping as a parenthesised query for the other SQL dialect."""
    query = text.replace("<<isodow>>", "isodow")
    return "(" + query.format(**{n: n for n in _names(text)}).strip() + ")"
