"""Equity priority scores of census areas, stops and routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.aggregates import count_where, mean_skip, moe_of_sum, rows
from headway.functions.missing import is_in
from headway.functions.recode import recode_pattern
from headway.functions.rounding import half_even, ratio_half_even
from headway.operators.columns import clean_names, drop_na
from headway.operators.groups import with_group_stats
from headway.operators.joins import join
from headway.operators.ranking import ntile
from headway.operators.reshape import pivot_wider
from headway.operators.spatial import spatial_join
from headway.session import kept

# Survey variables by the name used here.
VARIABLES = {
    "pop": "B01001_001",
    "housing": "C16002_001",
    "pov1": "C17002_001",
    "pov2": "C17002_008",
    "foreign_born": "B99051_005",
    "people_of_color1": "B03002_001",
    "people_of_color2": "B03002_003",
    "lep1": "C16002_004",
    "lep2": "C16002_007",
    "lep3": "C16002_010",
    "lep4": "C16002_013",
    "disability1": "B23024_003",
    "disability2": "B23024_018",
}

# Measure of a variable by name pattern; the first match counts.
MEASURE_PATTERNS = [
    ("lep", "lep"),
    ("pov", "pov"),
    ("foreign_born", "foreign_born"),
    ("people", "poc"),
    ("disab", "disability"),
    ("pop", "population"),
    ("housing", "housing_units"),
]

# Weight of each measure's quintile in the score.
WEIGHTS = {
    "race_score": ("poc_quintile", 0.4),
    "pov_score": ("pov_quintile", 0.3),
    "lep_score": ("lep_quintile", 0.10),
    "disability_score": ("disability_quintile", 0.10),
    "foreign_born_score": ("foreign_born_quintile", 0.10),
}

# Measure column, its quintile, and the pattern group its margin comes from.
MEASURES = [
    ("population_200_pct_below_poverty_line", "pov_quintile", "pov"),
    ("people_of_color", "poc_quintile", "poc"),
    ("foreign_born", "foreign_born_quintile", "foreign_born"),
    ("limited_english_households", "lep_quintile", "lep"),
    ("people_with_disability", "disability_quintile", "disability"),
]


def with_measure(acs: DataFrame) -> DataFrame:
    return clean_names(acs).withColumn("mf_variable", recode_pattern("variable", MEASURE_PATTERNS))


def with_moe_of_measure(acs: DataFrame) -> DataFrame:
    """Every estimate with the margin of error of its measure's sum in its area."""
    return with_group_stats(
        with_measure(acs), ["mf_variable", "geoid"], sum_moe=moe_of_sum("moe", "estimate")
    )


def area_measures(acs: DataFrame) -> DataFrame:
    """The five measures of each area with their margins, in one aggregation; variables of
    none of them are left out."""
    margins = {
        f"{column}_moe": moe_of_sum("moe", "estimate", within=F.col("mf_variable") == group)
        for column, _, group in MEASURES
    }
    wide = pivot_wider(
        with_measure(acs), ["geoid", "name"], "variable", ["estimate"], list(VARIABLES), margins,
        leave_out=True,
    )
    c = F.col
    return wide.select(
        "geoid",
        "name",
        (c("pov1") - c("pov2")).alias("population_200_pct_below_poverty_line"),
        "foreign_born",
        (c("people_of_color1") - c("people_of_color2")).alias("people_of_color"),
        (c("lep1") + c("lep2") + c("lep3") + c("lep4")).alias("limited_english_households"),
        (c("disability1") + c("disability2")).alias("people_with_disability"),
        *margins,
    )


def area_scores(
    acs: DataFrame, acs_year: int, areas: DataFrame | None = None, keep_all_areas: bool = False
) -> DataFrame:
    """Quintiles of the five measures, their weighted scores and the priority score.

    ``keep_all_areas`` starts from the areas: those without estimates stay with
    missing scores, estimates of other areas are left out.
    """
    measures = area_measures(acs)
    if keep_all_areas:
        measures = join(areas.select("geoid"), measures, by="geoid", how="left")
    quintiles = ntile(
        kept(measures), {q: m for m, q, _ in MEASURES}, 5, tiebreak=["geoid"], all_differ=True
    )
    scored = quintiles.select(
        "geoid",
        "name",
        "pov_quintile",
        "poc_quintile",
        "foreign_born_quintile",
        "lep_quintile",
        "disability_quintile",
    ).withColumns({s: F.col(q) * F.lit(weight) for s, (q, weight) in WEIGHTS.items()})
    total = (
        F.col("race_score")
        + F.col("pov_score")
        + F.col("lep_score")
        + F.col("disability_score")
        + F.col("foreign_born_score")
    )
    return scored.withColumns(
        {"final_score": half_even(total), "acs_year": F.lit(acs_year)}
    )


def scored_areas(areas: DataFrame, scores: DataFrame) -> DataFrame:
    """Areas with shapes and scores; areas without scores stay."""
    return join(areas, scores, by="geoid", how="left")


def stop_scores(stops: DataFrame, areas: DataFrame, scores: DataFrame) -> DataFrame:
    """Stops with the scores of the area they lie in; stops in no area are left out.

    The shapes travel with the area id only; scores follow by that id.
    """
    located = spatial_join(stops, areas.select("geoid", "rings"), "within")
    return join(drop_na(clean_names(located), ["geoid"]), scores, by="geoid", how="left")


def route_index(scored_stops: DataFrame) -> DataFrame:
    """Share of a route's stops in top-priority areas and its quintile of that share."""
    score = F.col("final_score")
    per_route = scored_stops.groupBy("route_short_name", "service_change_num").agg(
        rows().alias("total_stop_count"),
        mean_skip(score).alias("mean_stop_score"),
        count_where(is_in(score, [5])).alias("equity_stops_count"),
        count_where(is_in(score, [1, 2, 3, 4]) | score.isNull()).alias("non_equity_stops_count"),
    )
    share = per_route.withColumn(
        "percent_stops_in_priority_bg", ratio_half_even("equity_stops_count", "total_stop_count")
    )
    return ntile(
        kept(share),
        {"route_opportunity_index_score": "percent_stops_in_priority_bg"},
        5,
        keys=["service_change_num"],
        tiebreak=["route_short_name"],
        all_differ=True,
    )


def route_stop_shapes(scored_stops: DataFrame) -> DataFrame:
    """The stop positions of each route, spread-out places once each."""
    return scored_stops.groupBy("route_short_name", "service_change_num").agg(
        F.sort_array(F.collect_set(F.struct("x", "y"))).alias("stops")
    )
