"""Pass-ups (riders left behind) by route, month and census area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.aggregates import rows
from headway.functions.missing import to_number
from headway.functions.recode import recode
from headway.operators.columns import drop_na
from headway.operators.groups import first_rows, with_group_stats
from headway.operators.joins import join
from headway.operators.spatial import as_points, totals_in

# Lettered lines and their route numbers in the planner sheet.
LETTERED_ROUTES = {
    "A (671)": "671",
    "B (672)": "672",
    "C (673)": "673",
    "D (674)": "674",
    "E (675)": "675",
    "F (676)": "676",
}
RESUMED = "Resume pick up of customers"

RATE_KEYS = [
    "SERVICE_RTE_NUM",
    "EXPRESS_LOCAL_CD",
    "MESSAGE_TEXT",
    "LOW_INCOME_FLAG",
    "MINORITY_FLAG",
    "OPPORTUNITY_SCORE",
    "Lead",
    "CAL_MONTH_IN_YEAR_NUM",
    "CAL_YEAR_NUM",
    "DAYS_IN_MONTH",
    "SCHED_DAY_TYPE_CODED_NUM",
    "daily_trips",
]


def passups_between(passups: DataFrame, first: str, before: str, resumed: str = RESUMED):
    """Pass-up events of the days ``first <= day < before``, resumptions left out."""
    day = F.col("FULL_DATE")
    return passups.where(
        (day >= F.to_date(F.lit(first)))
        & (day < F.to_date(F.lit(before)))
        & (F.col("MESSAGE_TEXT") != resumed)
    )


def final_trips(all_trips: DataFrame, service_change: int) -> DataFrame:
    """Scheduled trips of one service change in its final load."""
    return all_trips.where(
        (F.col("SERVICE_CHANGE_NUM") == service_change)
        & (F.col("WORKING_LOAD_STATUS") == "FINAL")
        & (F.col("MINOR_CHANGE_NUM") == 0)
        & (F.col("TRIP_KIND_CD") == "S")
    )


def active_routes(routes: DataFrame, agency: str) -> DataFrame:
    """Routes in use, owned and run by the agency, without on-demand service."""
    return routes.where(
        (F.col("IS_ACTIVE_FLAG") == 1)
        & (F.col("OWNER_AGENCY_CD") == agency)
        & (F.col("OPERATOR_AGENCY_CD") == agency)
        & (F.col("SERVICE_TYPE_CD") != "DART")
    )


def with_daily_trips(trips: DataFrame) -> DataFrame:
    """Every trip with the trips per day of its route, kind, day type and service change."""
    keys = ["SERVICE_RTE_NUM", "EXPRESS_LOCAL_CD", "SCHED_DAY_TYPE_CODED_NUM", "SERVICE_CHANGE_NUM"]
    return with_group_stats(trips, keys, daily_trips=rows())


def with_days_in_month(dates: DataFrame) -> DataFrame:
    """Every date with the number of dates of its day type in its month."""
    keys = ["CAL_YEAR_NUM", "CAL_MONTH_IN_YEAR_NUM", "SERVICE_DAY_TYPE_CODE"]
    return with_group_stats(dates, keys, DAYS_IN_MONTH=rows())


def clean_planners(
    planners: DataFrame, lettered: Mapping[str, str] = LETTERED_ROUTES
) -> DataFrame:
    """Planner per route number; of several rows the first by route text is kept."""
    numbered = planners.withColumn("route_number", to_number(recode("Routes", lettered)))
    return first_rows(numbered, ["route_number"], ["Routes", "Lead"])


def with_metadata(
    passups: DataFrame,
    trips: DataFrame,
    routes: DataFrame,
    dates: DataFrame,
    planners: DataFrame,
    lettered: Mapping[str, str] = LETTERED_ROUTES,
) -> DataFrame:
    """Pass-ups with their trip, route, calendar and planner columns."""
    joined = join(
        passups,
        with_daily_trips(trips),
        by=["SERVICE_RTE_NUM", "TRIP_ID", "SCHED_DAY_TYPE_CODED_NUM"],
    )
    joined = join(joined, routes, by=["SERVICE_RTE_NUM", "EXPRESS_LOCAL_CD"])
    joined = join(joined, with_days_in_month(dates), by="FULL_DATE")
    return join(
        joined, clean_planners(planners, lettered), by={"SERVICE_RTE_NUM": "route_number"}
    )


def passup_rates(with_columns: DataFrame) -> DataFrame:
    """Monthly pass-ups per route and equity flags, per day and per trip."""
    summary = with_columns.groupBy(*RATE_KEYS).agg(rows().alias("sum_monthly_passups"))
    monthly = F.col("daily_trips") * F.col("DAYS_IN_MONTH")
    return summary.withColumns(
        {
            "average_daily_passups": F.try_divide("sum_monthly_passups", "DAYS_IN_MONTH"),
            "monthly_trips": monthly,
            "pct_trips_with_passup": F.try_divide(F.col("sum_monthly_passups"), monthly),
        }
    )


def routes_without_passups(routes: DataFrame, passups: DataFrame) -> DataFrame:
    return join(routes, passups, by="SERVICE_RTE_NUM", how="anti")


def current_stops(stops: DataFrame, status: int, change: int, in_use_on: str) -> DataFrame:
    """Stop positions of one stop-table change still valid on a day."""
    return stops.where(
        (F.col("STOP_STATUS_ID") == status)
        & (F.col("CHANGE_NUM") == change)
        & (F.col("MINOR_CHANGE_NUM") == 0)
        & (F.col("EFFECTIVE_END_DATE") >= F.to_date(F.lit(in_use_on)))
    ).select("STOP_ID", "XCOORD_OFFSET", "YCOORD_OFFSET")


def passups_by_stop(passups: DataFrame, stops: DataFrame, dates: DataFrame) -> DataFrame:
    """Monthly pass-ups per stop, message and day type, with the stop's position."""
    joined = join(join(passups, stops), with_days_in_month(dates))
    return joined.groupBy(
        "STOP_ID",
        "MESSAGE_TEXT",
        "CAL_MONTH_IN_YEAR_NUM",
        "CAL_YEAR_NUM",
        "DAYS_IN_MONTH",
        "SCHED_DAY_TYPE_CODED_NUM",
        "XCOORD_OFFSET",
        "YCOORD_OFFSET",
    ).agg(rows().alias("sum_monthly_passups_by_stop"))


def passups_by_area(
    areas: DataFrame, by_stop: DataFrame, key: str = "GEO_ID_GRP", epsg: int = 2926
) -> DataFrame:
    """Areas with their monthly pass-ups per day type; areas without any stay.

    The sums travel without shapes and meet the areas' shapes again at the end.
    """
    positioned = drop_na(by_stop, ["XCOORD_OFFSET"])
    points = as_points(positioned, "XCOORD_OFFSET", "YCOORD_OFFSET", epsg)
    totals = totals_in(
        areas,
        points,
        key,
        value="sum_monthly_passups_by_stop",
        by=["SCHED_DAY_TYPE_CODED_NUM", "CAL_MONTH_IN_YEAR_NUM", "CAL_YEAR_NUM"],
        name="block_group_passups_sum",
    )
    return join(areas, totals, by=key, how="left")


def month_layers(by_area: DataFrame, month: int) -> dict[str, DataFrame]:
    """One map layer per day type for one month."""
    # Day type codes.
    day_types = {"weekday": 0, "saturday": 1, "sunday": 2}
    in_month = F.col("CAL_MONTH_IN_YEAR_NUM") == month
    return {
        name: by_area.where(in_month & (F.col("SCHED_DAY_TYPE_CODED_NUM") == code))
        for name, code in day_types.items()
    }
