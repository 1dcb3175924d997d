"""One function per registered query: (session, folder of sample tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions import aggregates as agg
from headway.functions import missing as na
from headway.functions.estimates import interval, moe_at
from headway.functions.geometry import polygon_area
from headway.functions.recode import first_match, recode, recode_pattern
from headway.functions.rounding import half_even, ratio_half_even
from headway.operators import checks, columns, groups, ranking, spatial
from headway.operators.joins import join
from headway.operators.reshape import pivot_wider
from headway.plans import equity, feed, jobs, passups, places, ridership
from headway.session import kept, tune
from headway.sources import census
from headway.sources.tables import cast_problems
from workload import mapping as m

QUERIES = {}


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(Tables(tune(spark), sf_dir))

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


class Tables:
    """Sample tables and mappings of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return m.table(self.spark, self.sf_dir, name)

    def view(self, text: str) -> DataFrame:
        return m.view(self.spark, self.sf_dir, text)

    def feed(self) -> dict[str, DataFrame]:
        return {name: self.view(text) for name, text in m.FEED.items()}

    def areas(self, text: str, epsg: int) -> DataFrame:
        """Area shapes as polygons."""

        def ring(corners, size: str, backwards: bool = False) -> Column:
            closed = [*corners, corners[0]]
            return F.array(
                *[
                    F.struct(
                        (F.col("cx") + F.lit(x) * F.col(size)).alias("x"),
                        (F.col("cy") + F.lit(y) * F.col(size)).alias("y"),
                    )
                    for x, y in (reversed(closed) if backwards else closed)
                ]
            )

        outer, hole = ring(m.DIAMOND, "radius"), ring(m.SQUARE, "hole", backwards=True)
        rings = F.when(F.col("holed"), F.array(outer, hole)).otherwise(F.array(outer))
        shaped = self.view(text).select("geoid", rings.alias("rings"))
        return spatial.as_polygons(shaped, "rings", epsg)


# Filters and columns


@query
def filter_eq(t):
    return t.view(m.TRIPS).where(F.col("SERVICE_RTE_NUM") == 7)


@query
def filter_in(t):
    return t.view(m.TRIPS).where(na.is_in("SERVICE_RTE_NUM", [15, 17, 18, 40, 674]))


@query
def filter_not_in_range_keeps_null(t):
    routes = t.orders.select("o_orderkey", F.nullif("o_custkey", F.lit(13)).alias("route"))
    return routes.where(~na.in_run("route", 500, 600))


@query
def filter_sql_logic(t):
    return t.spark.sql(
        """
        SELECT p_partkey, p_name, p_brand, p_size FROM {part}
        WHERE (p_name LIKE '%ring' OR p_brand IN ('Brand#1', 'Brand#2'))
          AND NOT (p_size < 10 AND p_type <> 'ECONOMY') AND p_retailprice <= 1500
        """,
        part=t.part,
    )


@query
def filter_date_range(t):
    day = F.col("OPERATION_DATE")
    return t.view(m.TRIPS).where(
        (day >= F.to_date(F.lit("1997-10-02"))) & (day < F.to_date(F.lit("1998-01-01")))
    )


@query
def filter_missing(t):
    return t.view(m.TRIPS).where(F.col("PSNGR_BOARDINGS").isNull()).select("TRIP_ID", "STOP_ID")


@query
def drop_na_rows(t):
    return columns.drop_na(t.view(m.TRIPS), ["PSNGR_BOARDINGS"]).select(
        "TRIP_ID", "STOP_ID", "PSNGR_BOARDINGS"
    )


@query
def active_routes(t):
    return passups.active_routes(t.view(m.ROUTES), "CITY")


@query
def select_cols(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")


@query
def drop_cols(t):
    return t.lineitem.drop("l_shipdate", "l_tax", "l_discount", "l_extendedprice")


@query
def clean_rename(t):
    awkward = t.part.select(
        F.col("p_partkey").alias("Part Key"),
        F.col("p_name").alias("PartName"),
        F.col("p_size").alias("AM Trip Count"),
        F.col("p_brand").alias("am_trip_count"),
    )
    return columns.clean_names(awkward).withColumnsRenamed({"part_name": "label"})


@query
def mutate_chain(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    ).withColumns(
        {"hours": F.col("l_quantity") / F.lit(60.0), "service_change": F.lit(213)}
    ).withColumn("annual_hours", F.col("hours") * 255)


@query
def profile_trips(t):
    return columns.profile(t.view(m.TRIPS), "OPERATION_DATE")


@query
def order_two_keys(t):
    return t.part.select("p_partkey", "p_brand", "p_size").orderBy("p_brand", "p_size", "p_partkey")


@query
def head_rows(t):
    return t.part.select("p_partkey", "p_name").orderBy("p_partkey").limit(6)


# Joins


def _bookings(t):
    return t.orders.select(
        "o_orderkey",
        F.nullif("o_custkey", F.lit(7)).alias("rider"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
    )


def _riders(t):
    kind = F.array(F.lit("F"), F.lit("O"), F.lit("P"))[(F.col("c_custkey") % 3).cast("int")]
    return t.customer.select(
        F.nullif("c_custkey", F.lit(7)).alias("rider"),
        kind.alias("status"),
        F.col("c_acctbal").alias("amount"),
        "c_mktsegment",
    )


def _joined(how):
    def run(t):
        return join(
            _bookings(t), _riders(t), by=["rider", "status"], how=how, suffixes=("_x", "_y")
        )

    run.__name__ = f"join_{how}"
    return query(run)


for _how in ("left", "right", "inner", "full", "semi", "anti"):
    _joined(_how)


@query
def join_null_keys(t):
    left = t.orders.select("o_orderkey", F.nullif("o_custkey", F.lit(7)).alias("rider"))
    right = t.customer.select(F.nullif("c_custkey", F.lit(7)).alias("rider"), "c_name")
    return join(left, right, by="rider", how="inner")


@query
def join_natural(t):
    nation = t.nation.withColumnRenamed("n_regionkey", "regionkey")
    region = t.region.withColumnRenamed("r_regionkey", "regionkey")
    customer = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return join(join(customer, nation), region)


@query
def join_renamed_key(t):
    customer = t.customer.select("c_custkey", "c_name", "c_nationkey")
    return join(t.orders, customer, by={"o_custkey": "c_custkey"})


@query
def join_anti_orders(t):
    return join(t.orders, t.lineitem, by={"o_orderkey": "l_orderkey"}, how="anti")


@query
def star_join(t):
    fact = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity")
    wide = join(fact, t.orders.select("o_orderkey", "o_custkey"), by={"l_orderkey": "o_orderkey"})
    wide = join(wide, t.customer, by={"o_custkey": "c_custkey"})
    wide = join(wide, t.nation, by={"c_nationkey": "n_nationkey"})
    wide = join(wide, t.region, by={"n_regionkey": "r_regionkey"})
    return wide.groupBy("r_name", "n_name", "c_mktsegment").agg(
        agg.rows().alias("trips"), agg.sum_skip("l_quantity").alias("boardings")
    )


@query
def fanout_keys(t):
    return checks.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query
def rejoin_summary(t):
    totals = t.view(m.TRIPS).groupBy("SERVICE_RTE_NUM").agg(
        agg.sum_skip("PSNGR_BOARDINGS").alias("boardings")
    )
    return join(t.view(m.ROUTES), totals)


# Aggregates


@query
def average_daily_boardings(t):
    return ridership.average_daily_boardings(t.view(m.TRIP_SUMMARY), 1998, [1, 2])


@query
def sum_strict(t):
    return ridership.route_totals(t.view(m.SPARSE_TRIPS), ["SERVICE_RTE_NUM"], "boardings")


@query
def route_day_totals(t):
    keys = ["SERVICE_RTE_NUM", "EXPRESS_LOCAL_CD", "SCHED_DAY_TYPE_CODED_NUM"]
    return ridership.route_totals(t.view(m.TRIPS), keys)


@query
def sum_na_rm(t):
    never = F.when(F.col("SERVICE_RTE_NUM") % 5 != 0, F.col("PSNGR_BOARDINGS"))
    return t.view(m.TRIPS).groupBy("SERVICE_RTE_NUM").agg(
        agg.sum_skip(never).alias("total"), agg.sum_skip("PSNGR_BOARDINGS").alias("boardings")
    )


@query
def agg_menu(t):
    trips = t.view(m.SPARSE_TRIPS)
    key = ["SERVICE_RTE_NUM"]
    simple = trips.groupBy(*key).agg(
        F.round(agg.mean_strict("boardings"), 6).alias("mean"),
        F.round(agg.sd_strict("boardings"), 6).alias("sd"),
        agg.min_strict("boardings").alias("min"),
        agg.max_strict("boardings").alias("max"),
    )
    counted = kept(groups.counted_values(trips, key, "boardings"))
    spread = groups.quantiles(
        counted, key, "boardings", {"q25": 0.25, "median": 0.5, "q75": 0.75, "q90": 0.9}, "times"
    ).withColumn("iqr", F.col("q75") - F.col("q25"))
    mad = groups.median_absolute_deviation(counted, key, "boardings", weight="times")
    wide = join(join(simple, spread, by=key), mad, by=key)
    return wide.withColumns(
        {c: F.round(c, 6) for c in ("q25", "median", "q75", "q90", "iqr", "mad")}
    )


@query
def agg_positional(t):
    trips = t.view(m.SPARSE_TRIPS)
    order = ["TRIP_ID", "STEP", "STOP_ID", "FARES", "boardings"]
    place = F.struct(*order)
    ends = trips.groupBy("SERVICE_RTE_NUM").agg(
        agg.first_by("FARES", place).alias("first"), agg.last_by("FARES", place).alias("last")
    )
    third = groups.nth_rows(trips, ["SERVICE_RTE_NUM"], order, 3)
    third = third.select("SERVICE_RTE_NUM", F.col("FARES").alias("third"))
    return join(ends, third, by="SERVICE_RTE_NUM")


@query
def n_distinct_null(t):
    return t.view(m.SPARSE_TRIPS).groupBy("SERVICE_RTE_NUM").agg(
        agg.n_distinct("day_part").alias("parts"), agg.n_distinct("STOP_ID").alias("stops")
    )


@query
def any_all(t):
    high = F.col("boardings") > 49
    return t.view(m.SPARSE_TRIPS).groupBy("SERVICE_RTE_NUM").agg(
        agg.any_true(high).alias("any_high"),
        agg.all_true(~high).alias("all_low"),
        agg.any_true(F.col("boardings") > 90).alias("any_extreme"),
        agg.all_true(F.col("boardings") < 90).alias("all_normal"),
    )


@query
def count_if_members(t):
    part = F.col("day_part")
    return t.view(m.SPARSE_TRIPS).groupBy("SERVICE_RTE_NUM").agg(
        agg.count_where(na.is_in(part, [5])).alias("fifth"),
        agg.count_where(na.is_in(part, [1, 2, 4]) | part.isNull()).alias("early_or_missing"),
        ratio_half_even(agg.count_where(na.is_in(part, [5])), agg.rows()).alias("share"),
    )


@query
def sql_platform_hours(t):
    return ridership.annual_platform_hours(t.view(m.ALL_TRIPS), 201)


# Windows, ranks and first rows


@query
def group_count_window(t):
    trips = passups.final_trips(t.view(m.SCHEDULE), 213)
    return passups.with_daily_trips(trips)


@query
def days_in_month(t):
    return passups.with_days_in_month(t.view(m.DATES))


@query
def ntile_grouped(t):
    return ridership.boarding_quintiles(
        t.view(m.SPARSE_TRIPS), "boardings", ["TRIP_ID", "STEP", "STOP_ID", "FARES"]
    )


@query
def ntile_global(t):
    fares = t.part.select(
        "p_partkey", "p_size", F.nullif(F.col("p_size"), F.lit(17)).alias("size"), "p_retailprice"
    )
    return ranking.ntile(
        fares, {"size_quintile": "size", "price_quintile": "p_retailprice"}, 5,
        tiebreak=["p_partkey"],
    )


@query
def ntile_ties(t):
    """Rows per bucket and value: which of the tied rows a bucket gets is open, how many is not."""
    lines = t.lineitem.select("l_returnflag", "l_linenumber")
    ranked = ranking.ntile(lines, {"bucket": "l_linenumber"}, 5, ["l_returnflag"])
    return ranked.groupBy("l_returnflag", "bucket", "l_linenumber").agg(agg.rows().alias("trips"))


@query
def ntile_mixed_types(t):
    prices = t.orders.select("o_orderkey", (F.col("o_orderkey") + F.lit(2**53)).alias("big"), "o_totalprice")
    return ranking.ntile(
        prices, {"big_quartile": "big", "price_quartile": "o_totalprice"}, 4, tiebreak=["o_orderkey"]
    )


@query
def slice_max_ties(t):
    return ridership.busiest_trips(t.view(m.SPARSE_TRIPS), "boardings", 10)


@query
def slice_max_global(t):
    return ranking.slice_max(t.view(m.SPARSE_TRIPS), "boardings", 10)


@query
def quintile_counts(t):
    ranked = ridership.boarding_quintiles(
        t.view(m.SPARSE_TRIPS), "boardings", ["TRIP_ID", "STEP", "STOP_ID", "FARES"]
    )
    return ridership.quintile_counts(ranked, [3, 4])


@query
def histogram(t):
    return columns.histogram(t.view(m.TRIPS), "PSNGR_BOARDINGS", 0, 10)


@query
def distinct_keep_first(t):
    return groups.first_rows(t.part, ["p_brand"], ["p_partkey"])


@query
def distinct_cols(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linenumber").distinct()


# Stacking and reshaping


@query
def bind_rows_fill(t):
    suppliers = t.supplier.select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )
    customers = t.customer.select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    return columns.bind_rows(suppliers, customers)


@query
def pivot_two_values(t):
    long = equity.with_moe_of_measure(t.view(m.ACS)).withColumn("sum_moe", F.round("sum_moe", 6))
    names = list(equity.VARIABLES)
    return pivot_wider(long, ["geoid", "name"], "variable", ["estimate", "sum_moe"], names, leave_out=True)


# Column functions


@query
def recode_default(t):
    table = {"Brand#1": "671", "Brand#2": "672", "Brand#3": "673", "Brand#4": "674"}
    return t.part.select("p_partkey", recode("p_brand", table).alias("route"))


@query
def recode_pattern_no_default(t):
    rules = [("ring", "ring"), ("^blue", "blue"), ("bolt|nut", "fastener")]
    return t.part.select("p_partkey", "p_name", recode_pattern("p_name", rules).alias("kind"))


@query
def conditional_overwrite(t):
    moved = na.is_in(F.nullif("p_partkey", F.lit(9)), [3, 5, 8])
    return t.part.select(
        "p_partkey", first_match([(moved, F.lit(1.5))], F.col("p_retailprice")).alias("price")
    )


@query
def gsub_all(t):
    return t.part.select("p_partkey", na.replace_all("p_name", "[aeiou]", "-").alias("masked"))


@query
def text_to_number(t):
    text = F.when(F.col("p_size") > 25, F.regexp_replace("p_brand", "Brand#", " ")).otherwise(
        F.col("p_brand")
    )
    return t.part.select("p_partkey", na.to_number(text).alias("route_number"))


@query
def text_to_day(t):
    text = F.when(F.col("p_size") > 25, F.lit("2021-10-02")).otherwise(F.col("p_brand"))
    return t.part.select("p_partkey", na.to_day(text).alias("day"))


@query
def round_half_even(t):
    return t.part.select(
        "p_partkey",
        half_even(F.col("p_size") / F.lit(2.0)).alias("halved"),
        ratio_half_even("p_size", F.lit(40)).alias("ratio"),
    )


@query
def replace_na(t):
    rows = t.orders.select("o_orderkey", F.nullif("o_custkey", F.lit(7)).alias("rider"))
    return columns.replace_na(rows, {"rider": 599})


@query
def paste_parts(t):
    missing = F.nullif("p_size", F.lit(11))
    return t.part.select("p_partkey", na.paste("p_brand", missing, sep="_").alias("label"))


@query
def parse_problems(t):
    texts = t.part.select(
        F.col("p_brand").alias("code"),
        F.when(F.col("p_size") > 25, F.col("p_size").cast("string"))
        .otherwise(F.col("p_type"))
        .alias("count"),
    )
    return cast_problems(texts, "code string, count int")


# Census estimates


@query
def moe_sum(t):
    rows = equity.with_moe_of_measure(t.view(m.ACS))
    return rows.withColumn("sum_moe", F.round("sum_moe", 6))


@query
def moe_interval(t):
    wide = moe_at("moe", 95)
    lower, upper = interval("estimate", wide)
    return t.view(m.ACS).select(
        "GEOID", "variable", F.round(lower, 6).alias("lower"), F.round(upper, 6).alias("upper")
    )


PICKED = {"pop": "B01001_001", "pov1": "C17002_001", "pov2": "C17002_008"}


@query
def acs_tidy(t):
    return census.acs(
        t.view(m.ACS_FILES), PICKED, geography="block group", state="53", county="033",
        year=2019, survey="acs5",
    )


@query
def acs_wide(t):
    return census.acs(t.view(m.ACS_FILES), PICKED, year=2019, output="wide")


@query
def decennial_wide(t):
    counts = t.view(m.ACS_FILES).withColumnRenamed("estimate", "value")
    return census.decennial(counts, PICKED, year=2020, output="wide")


@query
def search_variables(t):
    catalogue = t.part.select(
        F.col("p_brand").alias("name"),
        F.col("p_name").alias("label"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("concept"),
    )
    return census.search_variables(catalogue, "BLUE|small")


@query
def measure_by_place(t):
    return places.measure_by_place(t.view(m.PLACES))


# Space


def _stops(t):
    stops = columns.drop_na(t.view(m.STOPS), ["XCOORD_OFFSET"])
    return spatial.as_points(stops, "XCOORD_OFFSET", "YCOORD_OFFSET", 2926)


@query
def project_lcc(t):
    points = spatial.project(
        spatial.as_points(t.view(m.FEED["stops"]), "stop_lon", "stop_lat", 4326), 2926
    )
    return points.select("stop_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query
def project_albers_inverse(t):
    points = spatial.project(spatial.as_points(t.view(m.JOBS), "px", "py", 102003), 4326)
    return points.select("c_custkey", F.round("x", 6).alias("lon"), F.round("y", 6).alias("lat"))


@query
def points_within(t):
    hits = spatial.spatial_join(_stops(t), t.areas(m.AREAS_FEET, 2926), "within")
    return spatial.drop_geometry(hits)


@query
def polygons_contain(t):
    hits = spatial.spatial_join(t.areas(m.AREAS_FEET, 2926), _stops(t), "contains", key="geoid")
    return spatial.drop_geometry(hits)


@query
def polygon_density(t):
    counted = spatial.count_in(t.areas(m.AREAS_FEET, 2926), _stops(t), "geoid", name="stops")
    area = polygon_area("rings")
    return counted.select(
        "geoid", "stops", area.alias("area"), F.round(F.col("stops") / area * 1e6, 6).alias("density")
    )


@query
def jobs_by_area(t):
    areas = spatial.project(t.areas(m.AREAS_DEGREES, 4326), 2926)
    people = jobs.with_job_total(t.view(m.JOBS))
    points = spatial.as_points(people, "px", "py", 102003)
    counted = jobs.jobs_by_area(areas, points, "geoid")
    return counted.select(
        "geoid", "jobs", F.round(F.col("area") / 1e6, 3).alias("area_million"),
        F.round(F.col("job_density") * 1e9, 3).alias("jobs_per_billion"),
    )


# Whole analyses


def _events(t):
    return passups.passups_between(t.view(m.PASSUPS), "1996-01-01", "1999-01-01")


@query
def passup_rate(t):
    joined = passups.with_metadata(
        _events(t),
        passups.final_trips(t.view(m.SCHEDULE), 213),
        passups.active_routes(t.view(m.ROUTES), "CITY"),
        t.view(m.DATES),
        t.view(m.PLANNERS),
        m.LETTERED,
    )
    return passups.passup_rates(joined)


@query
def routes_without_passups(t):
    return passups.routes_without_passups(t.view(m.ALL_ROUTES), _events(t))


@query
def current_stops(t):
    return passups.current_stops(t.view(m.STOP_HISTORY), 3, 213, "2021-10-02")


@query
def passups_by_stop(t):
    return passups.passups_by_stop(_events(t), t.view(m.STOPS), t.view(m.DATES))


def _by_area(t):
    areas = t.areas(m.AREAS_FEET, 2926)
    by_stop = passups.passups_by_stop(_events(t), t.view(m.STOPS), t.view(m.DATES))
    return passups.passups_by_area(areas, by_stop, "geoid")


@query
def passups_by_area(t):
    return spatial.drop_geometry(_by_area(t))


@query
def passup_month_layers(t):
    layers = passups.month_layers(_by_area(t), 11)
    return columns.bind_rows(
        *[
            spatial.drop_geometry(layer).withColumn("layer", F.lit(name))
            for name, layer in layers.items()
        ]
    )


@query
def area_measures(t):
    measures = equity.area_measures(t.view(m.ACS))
    moes = [c for c in measures.columns if c.endswith("_moe")]
    return measures.withColumns({c: F.round(c, 6) for c in moes})


def _rounded_scores(scores):
    parts = [c for c in scores.columns if c.endswith("_score") and c != "final_score"]
    return scores.withColumns({c: F.round(c, 6) for c in parts})


@query
def equity_score(t):
    return _rounded_scores(equity.area_scores(t.view(m.ACS), 2019))


@query
def scored_areas(t):
    shapes = equity.scored_areas(
        t.areas(m.AREAS_FEET, 2926), equity.area_scores(t.view(m.ACS), 2019)
    )
    return shapes.select("geoid", F.size("rings").alias("rings"), "final_score")


@query
def equity_score_all_areas(t):
    every = columns.bind_rows(
        t.supplier.select(F.col("s_suppkey").cast("string").alias("geoid")),
        t.nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("geoid")),
    )
    return _rounded_scores(equity.area_scores(t.view(m.ACS), 2019, every, keep_all_areas=True))


def _feed_stops(t):
    return feed.stops_by_route(t.feed(), moved=m.MOVED, moved_to=(47.2041, -122.4559))


@query
def stops_by_route(t):
    return _feed_stops(t).withColumns({"x": F.round("x", 3), "y": F.round("y", 3)})


def _scored_stops(t):
    areas = spatial.project(t.areas(m.AREAS_DEGREES, 4326), 2926)
    scores = equity.area_scores(t.view(m.ACS), 2019)
    return equity.stop_scores(_feed_stops(t), areas, scores)


@query
def stop_equity(t):
    return _scored_stops(t).select(
        "stop_id", "route_short_name", "service_change_num", "geoid", "pov_quintile", "final_score"
    )


@query
def route_opportunity(t):
    index = equity.route_index(_scored_stops(t))
    return index.withColumn("mean_stop_score", F.round("mean_stop_score", 6))


@query
def route_stop_shapes(t):
    shapes = equity.route_stop_shapes(_scored_stops(t))
    return shapes.select("route_short_name", "service_change_num", F.size("stops").alias("places"))
