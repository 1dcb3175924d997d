"""Stops served by each route, from a transit feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.missing import is_in
from headway.functions.recode import first_match, recode
from headway.operators.columns import replace_na
from headway.operators.groups import first_rows
from headway.operators.joins import join
from headway.operators.spatial import as_points, project

# Route names and the route numbers they are reported under.
ROUTE_NUMBERS = {
    "A": "671",
    "B": "672",
    "C": "673",
    "D": "674",
    "E": "675",
    "F": "676",
    "A Line": "671",
    "B Line": "672",
    "C Line": "673",
    "D Line": "674",
    "E Line": "675",
    "F Line": "676",
    "Link light rail": "599",
    "First Hill Streetcar": "98",
    "South Lake Union Streetcar": "97",
    "Duvall-Monroe Shuttle": "628",
    "Trailhead Direct Mt. Si": "634",
    "Trailhead Direct Mailbox Peak": "636",
    "Trailhead Direct Issaquah Alps": "637",
    "Trailhead Direct Cougar Mt.": "639",
}
# Two stops charted on water and the shore position used for them.
MOVED_STOPS = ("46769", "46766")
MOVED_TO = (47.508329, -122.463845)
UNNAMED_ROUTE = "599"


def route_stop_pairs(feed: Mapping[str, DataFrame], start_after: str) -> DataFrame:
    """Distinct stop and route pairs of services starting after a day.

    The date condition leaves only trips with a calendar row, so the feed's small
    tables are narrowed first and the stop times meet trips already reduced to
    their route.
    """
    services = feed["calendar"].where(F.col("start_date") > F.to_date(F.lit(start_after)))
    trips = join(feed["trips"], services, how="semi").drop("service_id")
    return join(feed["stop_times"], trips, how="inner").drop("trip_id").distinct()


def stops_by_route(
    feed: Mapping[str, DataFrame],
    start_after: str = "2021-10-01",
    moved: Sequence[str] = MOVED_STOPS,
    moved_to: tuple[float, float] = MOVED_TO,
    epsg: int = 2926,
) -> DataFrame:
    """Each stop once per route name, placed and projected, with route numbers.

    Tables carry ``service_change_num``, so feeds of several service changes are
    handled side by side. Where a stop and name occur with several route ids the
    lowest id is kept.
    """
    on_water = is_in("stop_id", moved)
    lat, lon = moved_to
    repaired = feed["stops"].withColumns(
        {
            "stop_lat": first_match([(on_water, F.lit(lat))], F.col("stop_lat")),
            "stop_lon": first_match([(on_water, F.lit(lon))], F.col("stop_lon")),
        }
    )
    # Each stop is projected once, not once per route that serves it.
    points = project(as_points(repaired, "stop_lon", "stop_lat", 4326), epsg)
    placed = join(points, route_stop_pairs(feed, start_after), how="inner")
    named = join(placed, feed["routes"], how="left")
    # The key of many values comes first: sorting compares it first.
    once = first_rows(
        named, ["stop_id", "service_change_num", "route_short_name"], ["route_id"]
    )
    numbered = once.withColumn("route_short_name", recode("route_short_name", ROUTE_NUMBERS))
    return replace_na(numbered, {"route_short_name": UNNAMED_ROUTE}).select(
        "stop_id",
        "stop_name",
        "route_id",
        "route_short_name",
        "route_desc",
        "service_change_num",
        "x",
        "y",
    )
