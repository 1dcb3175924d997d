"""Boardings per route, platform hours and boarding ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.aggregates import rows, sum_skip, sum_strict
from headway.operators.ranking import ntile, slice_max
from headway.sources.warehouse import sql

# Service days per year of weekday, Saturday and Sunday schedules.
SERVICE_DAYS = {0: 255, 1: 52, 2: 58}
# The columns that describe a scheduled trip, in the order of the warehouse query.
TRIP_COLUMNS = (
    "TRIP_ID",
    "SERVICE_RTE_NUM",
    "EXPRESS_LOCAL_CD",
    "SCHED_DAY_TYPE_CODED_NUM",
    "DAY_PART_CD",
    "INBD_OUTBD_CD",
    "BUS_BASE_ID",
    "BUS_TYPE_NUM",
    "start_time_mnts_after_midnt",
    "end_time_mnts_after_midnt",
)


def trip_summary(table: DataFrame, service_change: int, routes: Sequence[int]) -> DataFrame:
    """Average boardings of some routes in one service change, as the warehouse holds them."""
    return sql(
        table.sparkSession,
        f"""
        SELECT SERVICE_CHANGE_NUM, SERVICE_RTE_NUM, DAY_CODE, INBD_OUTBD_CD, AVG_PSNGR_BOARDINGS
        FROM {{trips}}
        WHERE SERVICE_CHANGE_NUM = {int(service_change)}
          AND SERVICE_RTE_NUM IN ({", ".join(str(int(r)) for r in routes)})
        """,
        trips=table,
    )


def average_daily_boardings(
    table: DataFrame, service_change: int, routes: Sequence[int]
) -> DataFrame:
    """Average daily boardings per route and day type, both directions together."""
    return (
        trip_summary(table, service_change, routes)
        .groupBy("SERVICE_RTE_NUM", "DAY_CODE")
        .agg(sum_skip("AVG_PSNGR_BOARDINGS").alias("avg_daily_boardings"))
    )


def route_totals(
    trips: DataFrame,
    keys: Sequence[str] = ("SERVICE_RTE_NUM",),
    boardings: Column | str = "PSNGR_BOARDINGS",
) -> DataFrame:
    """Boardings and trips per group; one missing count makes the sum missing."""
    return trips.groupBy(*keys).agg(
        sum_strict(boardings).alias("sum_boardings"), rows().alias("count_trips")
    )


def annual_platform_hours(all_trips: DataFrame, service_change: int) -> DataFrame:
    """Hours per year of each scheduled trip; other day types have none.

    The trip's minutes cover all its rows, of service or not. One aggregation reads the
    schedule once; only its short result is spread over a trip's descriptions. Rows come by
    route and day type; the trip behind them in the order lets the sort split a route that
    holds very many rows.
    """
    final = all_trips.where(
        (F.col("SERVICE_CHANGE_NUM") == service_change)
        & (F.col("MINOR_CHANGE_NUM") == 0)
        & (F.col("WORKING_LOAD_STATUS") == "FINAL")
        & F.col("TRIP_ID").isNotNull()
    )
    described = final.groupBy("SERVICE_CHANGE_NUM", *TRIP_COLUMNS).agg(
        F.sum("TRIP_DURATION_MNTS").alias("minutes"),
        F.count_if(F.col("TRIP_KIND_CD") == "S").alias("in_service"),
    )
    minutes = F.sum("minutes").over(Window.partitionBy("TRIP_ID"))
    day = F.col("SCHED_DAY_TYPE_CODED_NUM")
    days = F.coalesce(*[F.when(day == kind, F.lit(n)) for kind, n in SERVICE_DAYS.items()])
    return (
        described.withColumn("annual_platform_hours", minutes / F.lit(60.0) * days)
        .where("in_service > 0")
        .drop("minutes", "in_service")
        .orderBy("SERVICE_RTE_NUM", "SCHED_DAY_TYPE_CODED_NUM", "TRIP_ID")
    )


def boarding_quintiles(
    trips: DataFrame, value: str, tiebreak: Sequence[str], route: str = "SERVICE_RTE_NUM"
) -> DataFrame:
    """Every trip with its quintile of boardings among its route's trips, which
    ``tiebreak`` tells apart."""
    return ntile(
        trips, {"quintile_rank": value}, 5, keys=[route], tiebreak=tiebreak, all_differ=True
    )


def busiest_trips(
    trips: DataFrame, value: str, n: int = 10, route: str = "SERVICE_RTE_NUM"
) -> DataFrame:
    """The n busiest trips of each route and all trips tied with the last of them."""
    return slice_max(trips, value, n, keys=[route])


def quintile_counts(ranked: DataFrame, routes: Sequence[int], route: str = "SERVICE_RTE_NUM"):
    """Trips per quintile of some routes."""
    return (
        ranked.where(F.col(route).isin(list(routes)))
        .groupBy(route, "quintile_rank")
        .agg(rows().alias("trips"))
    )
