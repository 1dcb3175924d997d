"""One test per rule on missing values, ties and rounding."""

import datetime
import math
from fractions import Fraction

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.functions import aggregates as agg
from headway.functions import missing as na
from headway.functions.estimates import interval, moe_at
from headway.functions.recode import first_match, recode, recode_pattern
from headway.functions.rounding import half_even, ratio_half_even
from headway.operators import columns


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1,), (500,), (600,), (601,), (None,)], "v int")


def test_membership_is_never_missing(numbers):
    inside = numbers.where(na.is_in("v", [1, 500]))
    outside = numbers.where(na.not_in("v", [1, 500]))
    assert rows(inside) == [(1,), (500,)]
    assert rows(outside) == [(None,), (600,), (601,)]
    assert rows(numbers.where(na.is_in("v", [1, None]))) == [(None,), (1,)]
    assert numbers.where(na.is_in("v", [])).isEmpty()


def test_run_of_whole_numbers_keeps_missing(spark, numbers):
    assert rows(numbers.where(~na.in_run("v", 500, 600))) == [(None,), (1,), (601,)]
    halves = spark.createDataFrame([(500.5,), (501.0,)], "v double")
    assert rows(halves.where(na.in_run("v", 500, 600))) == [(501.0,)]


def test_filter_drops_missing_conditions(numbers):
    assert rows(numbers.where(F.col("v") != 1)) == [(500,), (600,), (601,)]


def test_text_functions(spark):
    texts = spark.createDataFrame(
        [("A (671)", "King County, Washington"), (" 7 ", None), (None, "x")], "a string, b string"
    )
    assert rows(texts.select(na.to_number("a"))) == [(None,), (None,), (7.0,)]
    assert rows(texts.select(na.matches("b", "County"))) == [(False,), (False,), (True,)]
    assert rows(texts.select(na.replace_all("b", " County, Washington", ""))) == [
        (None,), ("King",), ("x",)
    ]
    assert rows(texts.select(na.paste("a", "b", sep="-"))) == [
        (" 7 -NA",), ("A (671)-King County, Washington",), ("NA-x",)
    ]
    days = spark.createDataFrame([("2021-10-02",), ("soon",)], "d string")
    assert rows(days.select(na.to_day("d"))) == [(None,), (datetime.date(2021, 10, 2),)]


def test_recodes(spark):
    names = spark.createDataFrame([("A",), ("Z",), (None,)], "n string")
    assert rows(names.select(recode("n", {"A": "671"}))) == [(None,), ("671",), ("Z",)]
    assert rows(names.select(recode("n", {"A": "671"}, keep_others=False))) == [
        (None,), (None,), ("671",)
    ]
    variables = spark.createDataFrame([("people_of_color1",), ("pop",), ("x",)], "n string")
    rules = [("people", "poc"), ("pop", "population"), ("p", "never first")]
    assert rows(variables.select("n", recode_pattern("n", rules))) == [
        ("people_of_color1", "poc"), ("pop", "population"), ("x", None)
    ]
    chain = first_match([(F.col("n") == "A", F.lit(1)), (F.col("n") == "A", F.lit(2))], F.lit(9))
    assert rows(names.select(chain)) == [(1,), (9,), (9,)]


def test_half_even_rounding(spark):
    values = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (None,)], "v double")
    assert [r[0] for r in values.select(half_even("v")).collect()] == [0.0, 2.0, 2.0, -0.0, None]


def test_ratios_round_exactly(spark):
    pairs = [(a, b) for b in range(1, 60) for a in range(b + 1)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    for a, b, got in frame.select("a", "b", ratio_half_even("a", "b")).collect():
        assert got == round(Fraction(a, b) * 100) / 100.0
    none = spark.createDataFrame([(0, 0), (None, 3)], "a long, b long")
    assert rows(none.select(ratio_half_even("a", "b"))) == [(None,), (None,)]


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame(
        [("full", 1.0), ("full", 2.0), ("full", 4.0), ("some", 1.0), ("some", None), ("none", None)],
        "g string, v double",
    )


def _by_group(df, *stats):
    result = df.groupBy("g").agg(*[s.alias(f"s{i}") for i, s in enumerate(stats)])
    return {r[0]: tuple(r)[1:] for r in result.collect()}


def test_sums_and_means(groups):
    got = _by_group(
        groups, agg.sum_strict("v"), agg.sum_skip("v"), agg.mean_strict("v"), agg.mean_skip("v")
    )
    assert got["full"] == (7.0, 7.0, 7 / 3, 7 / 3)
    assert got["some"] == (None, 1.0, None, 1.0)
    assert got["none"][:3] == (None, 0.0, None) and math.isnan(got["none"][3])


def test_spread_and_range(groups):
    got = _by_group(groups, agg.sd_strict("v"), agg.min_strict("v"), agg.max_strict("v"))
    assert got["full"] == (pytest.approx(1.527525), 1.0, 4.0)
    assert got["some"] == (None, None, None)
    single = groups.where("v = 4")
    assert _by_group(single, agg.sd_strict("v")) == {"full": (None,)}


def test_distinct_counts_missing_as_a_value(groups):
    got = _by_group(groups, agg.n_distinct("v"), agg.rows(), agg.count_where(F.col("v") > 1))
    assert got == {"full": (3, 3, 2), "some": (2, 2, 0), "none": (1, 1, 0)}


def test_any_and_all_have_three_values(groups):
    high = F.col("v") > 1
    got = _by_group(groups, agg.any_true(high), agg.all_true(high), agg.all_true(F.col("v") > 0))
    assert got == {
        "full": (True, False, True), "some": (None, False, None), "none": (None, None, None)
    }


def test_positions(spark):
    frame = spark.createDataFrame([("g", 2, 5.0), ("g", 1, None), ("g", 3, 7.0)], "g string, i int, v double")
    assert _by_group(frame, agg.first_by("v", "i"), agg.last_by("v", "i")) == {"g": (None, 7.0)}


def test_margin_of_a_sum(spark):
    frame = spark.createDataFrame(
        [("a", 10, 3.0), ("a", 0, 4.0), ("a", 0, 2.0), ("b", 0, 4.0), ("c", 1, 2.0), ("c", 2, None)],
        "g string, est int, moe double",
    )
    assert _by_group(frame, agg.moe_of_sum("moe", "est")) == {"a": (5.0,), "b": (4.0,), "c": (None,)}


def test_intervals(spark):
    frame = spark.createDataFrame([(100.0, 16.45)], "e double, m double")
    low, high = interval("e", moe_at("m", 95))
    assert tuple(frame.select(low, high).first()) == pytest.approx((80.4, 119.6))
    with pytest.raises(ValueError):
        moe_at("m", 80)


def test_names():
    assert [columns.snake_case(n) for n in ("GEO_ID_GRP", "AM Trip Count", "Shape.area", "HSandLess", "2019 pop")] == [
        "geo_id_grp", "am_trip_count", "shape_area", "h_sand_less", "x2019_pop"
    ]


def test_clean_names_numbers_repeats(spark):
    assert columns.clean_names(spark.sql("SELECT 1 AS `A B`, 2 AS a_b, 3 AS `a.b`")).columns == [
        "a_b", "a_b_2", "a_b_3"
    ]


def test_stacking_and_filling(spark):
    a = spark.sql("SELECT 1 AS id, 'x' AS name")
    b = spark.sql("SELECT 2 AS id, 5 AS size")
    both = columns.bind_rows(a, b)
    assert rows(both) == [(1, "x", None), (2, None, 5)]
    filled = columns.replace_na(both, {"name": 599})
    assert rows(filled) == [(1, "x", None), (2, "599", 5)]
    assert rows(columns.drop_na(both, ["size"])) == [(2, None, 5)]


def test_histogram_bins_are_right_closed(spark):
    frame = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (2.1,), (None,)], "v double")
    assert rows(columns.histogram(frame, "v", 0, 1)) == [
        (1, 0.0, 1.0, 2), (2, 1.0, 2.0, 2), (3, 2.0, 3.0, 1)
    ]


def test_profile(spark):
    frame = spark.sql("SELECT date'2021-01-02' AS d UNION ALL SELECT date'2020-01-02'")
    assert tuple(columns.profile(frame, "d").first()) == (
        2, 1, datetime.date(2020, 1, 2), datetime.date(2021, 1, 2)
    )


def test_histogram_counts_values_below_the_start(spark):
    frame = spark.createDataFrame([(-5.0,), (0.0,), (1.0,), (12.0,), (None,)], "v double")
    found = {r["bin"]: (r["lower"], r["count"]) for r in columns.histogram(frame, "v", 0, 10).collect()}
    assert found == {0: (-10.0, 1), 1: (0.0, 2), 2: (10.0, 1)}
