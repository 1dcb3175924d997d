"""Whole analyses on hand-made rows."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.plans import equity, jobs, passups, places, ridership
from test_spatial import SQUARE, point_table, polygon_table

# Published summary: average daily boardings per route and day type.
SUMMARY = [
    (131, "SA", 1142.0), (131, "SU", 962.0), (131, "WK", 1769.0),
    (132, "SA", 1175.0), (132, "SU", 929.0), (132, "WK", 1661.0),
]


def test_published_daily_boardings(spark):
    data = []
    for route, day, total in SUMMARY:
        data += [(211, route, day, "I", 500.0), (211, route, day, "O", total - 500.0)]
        data += [(211, route, day, "O", None), (201, route, day, "I", 7.0)]
    data.append((211, 7, "WK", "I", 1.0))
    table = spark.createDataFrame(
        data,
        "SERVICE_CHANGE_NUM int, SERVICE_RTE_NUM int, DAY_CODE string, INBD_OUTBD_CD string,"
        " AVG_PSNGR_BOARDINGS double",
    )
    assert rows(ridership.average_daily_boardings(table, 211, [131, 132])) == SUMMARY


def test_route_totals_are_strict(spark):
    trips = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, None)], "SERVICE_RTE_NUM int, PSNGR_BOARDINGS double")
    assert rows(ridership.route_totals(trips)) == [(1, 5.0, 2), (2, None, 1)]


def _trip(trip, day, minutes, kind="S", change=201):
    return (trip, 3, "L", day, "AM", "I", "CB", 40, 300, 360, minutes, kind, "FINAL", change, 0)


TRIP_COLUMNS = (
    "TRIP_ID long, SERVICE_RTE_NUM int, EXPRESS_LOCAL_CD string, SCHED_DAY_TYPE_CODED_NUM int,"
    " DAY_PART_CD string, INBD_OUTBD_CD string, BUS_BASE_ID string, BUS_TYPE_NUM int,"
    " start_time_mnts_after_midnt int, end_time_mnts_after_midnt int, TRIP_DURATION_MNTS int,"
    " TRIP_KIND_CD string, WORKING_LOAD_STATUS string, SERVICE_CHANGE_NUM int, MINOR_CHANGE_NUM int"
)


def test_platform_hours(spark):
    trips = spark.createDataFrame(
        [_trip(1, 0, 60), _trip(1, 0, 30, "D"), _trip(2, 1, 60), _trip(3, 2, 60), _trip(4, 5, 60), _trip(5, 0, 60, change=1)],
        TRIP_COLUMNS,
    )
    got = ridership.annual_platform_hours(trips, 201)
    assert rows(got.select("TRIP_ID", "annual_platform_hours")) == [
        (1, 382.5), (2, 52.0), (3, 58.0), (4, None)
    ]


def test_pass_up_rates(spark):
    events = spark.sql(
        """SELECT * FROM VALUES
        (date'2021-11-01', 0, 10L, 7, 100L, 'Full'), (date'2021-11-02', 0, 10L, 7, 100L, 'Full'),
        (date'2021-11-02', 0, 11L, 671, 900L, 'Full'), (date'2021-11-02', 0, 10L, 7, 100L, 'Resume pick up of customers'),
        (date'2022-01-01', 0, 10L, 7, 100L, 'Full')
        AS t(FULL_DATE, SCHED_DAY_TYPE_CODED_NUM, STOP_ID, SERVICE_RTE_NUM, TRIP_ID, MESSAGE_TEXT)"""
    )
    trips = spark.createDataFrame([_trip(100, 0, 60), _trip(101, 0, 60)], TRIP_COLUMNS).withColumns(
        {"SERVICE_RTE_NUM": F.lit(7), "SERVICE_CHANGE_NUM": F.lit(213)}
    )
    routes = spark.sql(
        """SELECT * FROM VALUES (7, 'L', 1, 0, 5, 1, 'CITY', 'CITY', 'BUS'), (671, CAST(NULL AS string), 0, 1, 4, 1, 'CITY', 'CITY', 'BUS'),
        (8, 'L', 1, 0, 5, 0, 'CITY', 'CITY', 'BUS')
        AS t(SERVICE_RTE_NUM, EXPRESS_LOCAL_CD, LOW_INCOME_FLAG, MINORITY_FLAG, OPPORTUNITY_SCORE,
             IS_ACTIVE_FLAG, OWNER_AGENCY_CD, OPERATOR_AGENCY_CD, SERVICE_TYPE_CD)"""
    )
    dates = spark.sql(
        "SELECT date_add(date'2021-11-01', id) AS FULL_DATE, 2021 AS CAL_YEAR_NUM, 11 AS CAL_MONTH_IN_YEAR_NUM,"
        " 'WK' AS SERVICE_DAY_TYPE_CODE FROM (SELECT cast(id AS int) id FROM range(20))"
    )
    planners = spark.createDataFrame(
        [("7", "Kim"), ("A (671)", "Lee"), ("x", "Nobody"), ("7", "Later")], "Routes string, Lead string"
    )
    wide = passups.with_metadata(
        passups.passups_between(events, "2021-10-02", "2022-01-01"),
        passups.final_trips(trips, 213), passups.active_routes(routes, "CITY"), dates, planners,
    )
    rates = passups.passup_rates(wide)
    got = rates.select("SERVICE_RTE_NUM", "Lead", "LOW_INCOME_FLAG", "DAYS_IN_MONTH", "sum_monthly_passups",
                       "average_daily_passups", "monthly_trips", "pct_trips_with_passup")
    assert rows(got) == [
        (671, "Lee", 0, 20, 1, 0.05, None, None), (7, "Kim", 1, 20, 2, 0.1, 40, 0.05)
    ]
    assert rows(passups.routes_without_passups(routes, events).select("SERVICE_RTE_NUM")) == [(8,)]


def test_pass_ups_by_area(spark):
    events = spark.sql(
        """SELECT * FROM VALUES (date'2021-11-01', 0, 1L, 'Full'), (date'2021-11-01', 0, 1L, 'Full'),
        (date'2021-11-01', 1, 2L, 'Full'), (date'2021-11-01', 0, 9L, 'Full')
        AS t(FULL_DATE, SCHED_DAY_TYPE_CODED_NUM, STOP_ID, MESSAGE_TEXT)"""
    )
    stops = spark.createDataFrame(
        [(1, 1.0, 1.0, 100138, 149, 0), (2, 2.0, 1.0, 100138, 149, 0), (3, 1.0, 1.0, 5, 149, 0)],
        "STOP_ID long, XCOORD_OFFSET double, YCOORD_OFFSET double, STOP_STATUS_ID int, CHANGE_NUM int, MINOR_CHANGE_NUM int",
    ).withColumn("EFFECTIVE_END_DATE", F.to_date(F.lit("2030-01-01")))
    current = passups.current_stops(stops, 100138, 149, "2021-10-02")
    assert current.count() == 2
    dates = spark.sql("SELECT date'2021-11-01' AS FULL_DATE, 2021 AS CAL_YEAR_NUM, 11 AS CAL_MONTH_IN_YEAR_NUM, 'WK' AS SERVICE_DAY_TYPE_CODE")
    by_stop = passups.passups_by_stop(events, current, dates)
    assert by_stop.count() == 3
    areas = polygon_table(spark, {"in": [SQUARE], "far": [[(50, 50), (51, 50), (51, 51), (50, 50)]]})
    by_area = passups.passups_by_area(areas.withColumnRenamed("area", "GEO_ID_GRP"), by_stop)
    assert rows(by_area.drop("rings")) == [
        ("far", None, None, None, None), ("in", 0, 11, 2021, 2), ("in", 1, 11, 2021, 1)
    ]
    layers = passups.month_layers(by_area, 11)
    assert {n: d.count() for n, d in layers.items()} == {"weekday": 1, "saturday": 1, "sunday": 0}


def test_jobs_by_area(spark):
    areas = polygon_table(spark, {"in": [SQUARE]})
    points = point_table(spark, [(1, 1), (1, 1), (9, 9)]).withColumns({"cd01": F.lit(2), "cd02": F.lit(3)})
    got = jobs.jobs_by_area(areas, jobs.with_job_total(points), "area")
    assert "rings" in got.columns
    assert tuple(got.select("jobs", "job_density").first()) == (10, 10 / 16)


def acs_rows(spark, areas=10):
    """Area k has k times the measures of area 1, so quintiles follow k."""
    data = []
    for k in range(1, areas + 1):
        for i, name in enumerate(equity.VARIABLES):
            first = name in ("pov1", "people_of_color1")
            data.append((f"0530{k:02d}", f"Area {k}", name, float(k * (9 if first else 2)), float(i)))
    return spark.createDataFrame(data, "GEOID string, NAME string, variable string, estimate double, moe double")


def test_priority_scores(spark):
    scores = equity.area_scores(acs_rows(spark), 2019)
    got = {r["geoid"]: r for r in scores.collect()}
    assert [got[f"0530{k:02d}"]["final_score"] for k in range(1, 11)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    one = got["053010"]
    assert (one["race_score"], one["pov_score"], one["acs_year"]) == (2.0, 1.5, 2019)


def test_scores_of_all_areas(spark):
    areas = spark.createDataFrame([("053001",), ("none",)], "geoid string")
    got = equity.area_scores(acs_rows(spark), 2019, areas, keep_all_areas=True)
    assert rows(got.select("geoid", "pov_quintile", "final_score")) == [
        ("053001", 1, 1.0), ("none", None, None)
    ]


def test_measures_have_margins(spark):
    got = equity.area_measures(acs_rows(spark, 1)).first()
    assert got["population_200_pct_below_poverty_line"] == 7.0
    assert got["limited_english_households"] == 8.0
    assert got["population_200_pct_below_poverty_line_moe"] == pytest.approx((2**2 + 3**2) ** 0.5)
    assert got["foreign_born_moe"] == 4.0


def test_stop_and_route_scores(spark):
    areas = polygon_table(spark, {"a": [SQUARE], "b": [[(10, 0), (14, 0), (14, 4), (10, 4), (10, 0)]]})
    areas = areas.withColumnRenamed("area", "geoid")
    scores = spark.createDataFrame([("a", 5.0), ("b", None)], "geoid string, final_score double")
    places = [(1, 1), (2, 2), (11, 1), (3, 3), (99, 99)]
    stops = point_table(spark, places).withColumns(
        {"stop_id": F.col("id").cast("string"), "service_change_num": F.lit("213"),
         "route_short_name": F.when(F.col("id") == 3, "8").otherwise("7")}
    )
    scored = equity.stop_scores(stops, areas, scores)
    assert rows(scored.select("stop_id", "geoid", "final_score")) == [
        ("0", "a", 5.0), ("1", "a", 5.0), ("2", "b", None), ("3", "a", 5.0)
    ]
    index = equity.route_index(scored)
    assert rows(index) == [("7", "213", 3, 5.0, 2, 1, 0.67, 1), ("8", "213", 1, 5.0, 1, 0, 1.0, 2)]
    shapes = equity.route_stop_shapes(scored).where("route_short_name = '7'").first()
    assert [tuple(p) for p in shapes["stops"]] == [(1.0, 1.0), (2.0, 2.0), (11.0, 1.0)]


def test_measure_by_place(spark):
    frame = spark.createDataFrame(
        [("53033", "King County, Washington", "m", 9.0, 1.0), ("53061", "Kitsap County, Washington", "m", 5.0, 2.0)],
        "GEOID string, NAME string, variable string, estimate double, moe double",
    )
    got = places.measure_by_place(frame).collect()
    assert [tuple(r)[1:] for r in got] == [("Kitsap", "m", 5.0, 2.0, 3.0, 7.0), ("King", "m", 9.0, 1.0, 8.0, 10.0)]


def test_platform_hours_come_in_order(spark):
    from workload import mapping as m

    got = ridership.annual_platform_hours(m.view(spark, "/root/testdata/sf0.001", m.ALL_TRIPS), 201)
    order = [(r.SERVICE_RTE_NUM, r.SCHED_DAY_TYPE_CODED_NUM, r.TRIP_ID) for r in got.collect()]
    assert len(order) > 10 and order == sorted(order, key=lambda t: [(v is not None, v) for v in t])
