import random
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators import groups, ranking


@pytest.fixture(autouse=True, scope="module")
def many_partitions(spark):
    """Small data would be merged into one partition; keep all of them."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, many ties, some missing values."""
    rng = random.Random(3)
    data = [
        ("hot" if i % 3 == 0 else rng.choice(["a", "b", None]),
         None if rng.random() < 0.1 else float(rng.randrange(12)), i)
        for i in range(1003)
    ]
    return spark.createDataFrame(data, "g string, v double, id long").repartition(6).cache()


@pytest.mark.parametrize("keys", [["g"], []])
def test_spread_out_buckets_equal_window_buckets(skewed, keys):
    got = ranking.ntile(skewed, {"q": "v", "p": "id"}, 5, keys, ["id"])
    part = ", ".join([*keys, "v IS NULL"])
    skewed.createOrReplaceTempView("skewed")
    expected = skewed.sparkSession.sql(
        f"""SELECT *, CASE WHEN v IS NOT NULL THEN ntile(5) OVER (PARTITION BY {part} ORDER BY v, id) END AS q,
        ntile(5) OVER (PARTITION BY {", ".join(keys) or "1"} ORDER BY id) AS p FROM skewed"""
    )
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("keys", [["g"], []])
def test_all_tied_rows_are_divided_evenly(spark, keys):
    frame = spark.createDataFrame([("a" if i % 3 else "b", 1.0) for i in range(31)], "g string, v double")
    got = ranking.ntile(frame, {"q": "v"}, 5, keys).groupBy(*keys, "q").count().collect()
    for g in {r["g"] for r in got} if keys else {None}:
        sizes = [r["count"] for r in got if not keys or r["g"] == g]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_columns_compare_in_their_own_type(spark):
    frame = spark.createDataFrame([(2**53 + i, float(-i), "abcdefgh" + "dcba"[i]) for i in range(4)], "a long, b double, c string")
    got = ranking.ntile(frame, {"qa": "a", "qb": "b", "qc": "c"}, 4).orderBy("a").collect()
    assert [(r["qa"], r["qb"], r["qc"]) for r in got] == [(1, 4, 4), (2, 3, 3), (3, 2, 2), (4, 1, 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=25), st.integers(2, 6))
def test_bucket_sizes_differ_by_one(spark, values, n):
    frame = spark.createDataFrame(
        [(None if v is None else float(v), i) for i, v in enumerate(values)], "v double, id long"
    )
    got = ranking.ntile(frame, {"q": "v"}, n, tiebreak=["id"]).collect()
    present = [r for r in got if r["v"] is not None]
    assert all(r["q"] is None for r in got if r["v"] is None)
    sizes = [sum(r["q"] == b for r in present) for b in range(1, n + 1)]
    assert sum(sizes) == len(present) and max(sizes) - min(sizes) <= 1
    assert sizes == sorted(sizes, reverse=True)


def test_text_and_date_tiebreaks(spark):
    frame = spark.sql(
        "SELECT 1 AS v, cast(id AS string) AS s, date_add(date'2020-01-01', cast(id AS int)) AS d FROM range(10)"
    )
    got = ranking.ntile(frame, {"q": "v"}, 5, tiebreak=["d", "s"])
    assert [r["q"] for r in got.orderBy("d").collect()] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_top_rows_keep_ties(skewed):
    got = ranking.slice_max(skewed, "v", 3, ["g"])
    skewed.createOrReplaceTempView("skewed")
    expected = skewed.sparkSession.sql(
        """SELECT g, v, id FROM (SELECT *, rank() OVER (PARTITION BY g ORDER BY v DESC) r
        FROM skewed WHERE v IS NOT NULL) WHERE r <= 3"""
    )
    assert rows(got) == rows(expected)
    assert rows(ranking.slice_max(skewed, "v", 10_000, ["g"])) == rows(skewed.where("v IS NOT NULL"))
    assert rows(ranking.slice_max(skewed, "id", 2).select("id")) == [(1001,), (1002,)]
    alone = ranking.slice_max(skewed, "id", 2)
    assert sorted(r["id"] for r in alone.collect()) == [1001, 1002]


def test_quantiles_interpolate(spark):
    frame = spark.createDataFrame(
        [("a", float(v)) for v in (4, 1, 3, 2)] + [("b", 5.0), ("c", None), ("c", 1.0)],
        "g string, v double",
    )
    wanted = {"q1": 0.25, "mid": 0.5, "q3": 0.75}
    assert rows(groups.quantiles(frame, ["g"], "v", wanted)) == [
        ("a", 1.75, 2.5, 3.25), ("b", 5.0, 5.0, 5.0), ("c", None, None, None)
    ]
    present = frame.where("v IS NOT NULL")
    assert rows(groups.quantiles(present, [], "v", {"mid": 0.5})) == [(2.5,)]
    assert rows(groups.quantiles(frame, [], "v", {"mid": 0.5})) == [(None,)]
    spread = groups.median_absolute_deviation(present, ["g"], "v")
    assert rows(spread) == [("a", pytest.approx(1.4826)), ("b", 0.0), ("c", 0.0)]


def test_quantiles_match_numpy(skewed):
    present = skewed.where("v IS NOT NULL")
    got = {r["g"]: r["q"] for r in groups.quantiles(present, ["g"], "v", {"q": 0.37}).collect()}
    values = {}
    for r in present.collect():
        values.setdefault(r["g"], []).append(r["v"])
    assert got == {g: pytest.approx(np.quantile(v, 0.37)) for g, v in values.items()}


def test_nth_row(skewed):
    got = {r["g"]: r["id"] for r in groups.nth_rows(skewed, ["g"], ["id"], 4).collect()}
    ids = {}
    for r in skewed.orderBy("id").collect():
        ids.setdefault(r["g"], []).append(r["id"])
    assert got == {g: found[3] for g, found in ids.items()}
    assert groups.nth_rows(skewed, ["g"], ["id"], 5000).isEmpty()


@pytest.mark.parametrize("tiebreak", [["id"], []])
def test_frequent_value_is_spread_over_places(spark, tiebreak):
    """A value on nine tenths of the rows never has to sit in one place."""
    frame = spark.range(0, 40_000, numPartitions=8).select(F.when(F.col("id") % 10 > 0, 5.0).otherwise(F.col("id").cast("double")).alias("v"), "id")
    frame = frame.withColumn("h", F.xxhash64("id"))
    placed = ranking.Places(frame, [["v", *tiebreak]], "h").marked({"p": ["v", *tiebreak]})
    sizes = [r["count"] for r in placed.groupBy("p").count().collect()]
    assert len(sizes) > 7 and max(sizes) < 8_000


def test_frequent_text_is_spread_over_places(spark):
    frame = spark.range(0, 40_000, numPartitions=8).select(F.when(F.col("id") % 10 > 0, "frequent text").otherwise(F.col("id").cast("string")).alias("v"), "id")
    frame = frame.withColumn("h", F.xxhash64("id"))
    sizes = [r["count"] for r in ranking.Places(frame, [["v"]], "h").marked({"p": ["v"]}).groupBy("p").count().collect()]
    assert len(sizes) > 7 and max(sizes) < 8_000


@pytest.mark.parametrize("keys", [["g"], []])
def test_equal_rows_are_divided_and_all_kept(spark, keys):
    """Two thirds of the rows equal in every column, maps and extra columns included."""
    frame = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 5.0).otherwise(F.col("id") % 9).alias("v"), F.lit("a").alias("g"), F.create_map(F.lit("k"), (F.col("id") % 3 > 1).cast("int")).alias("m")
    )
    got = ranking.ntile(frame, {"q": "v"}, 7, keys)
    assert got.columns == [*frame.columns, "q"]
    counts = {(r.v, r.q): r.n for r in got.groupBy("v", "q").agg(F.count("*").alias("n")).collect()}
    sizes = [sum(n for (_, q), n in counts.items() if q == b) for b in range(1, 8)]
    assert sizes == [429] * 4 + [428] * 3
    want = Counter((r.v, r.n) for r in frame.groupBy("v").agg(F.count("*").alias("n")).collect())
    assert Counter((v, sum(n for (w, _), n in counts.items() if w == v)) for v in {v for v, _ in counts}) == want
    low, high = [{v for v, q in counts if q == b} for b in (1, 7)]
    assert max(low) <= 5 <= min(high)


def test_quantiles_of_infinite_and_nan_values(spark):
    inf, nan = float("inf"), float("nan")
    data = {"a": [inf, inf, 1.0], "b": [-inf, 0.0, inf], "c": [-inf, inf], "d": [1.0, nan, nan], "e": [5.0], "f": [1.0, inf]}
    frame = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "g string, v double")
    got = {r.g: (r.lo, r.mid) for r in groups.quantiles(frame, ["g"], "v", {"lo": 0.0, "mid": 0.5}).collect()}
    assert got["a"] == (1.0, inf) and got["b"] == (-inf, 0.0) and got["e"] == (5.0, 5.0) and got["f"] == (1.0, inf)
    assert got["c"][0] == -inf and np.isnan(got["c"][1]) and got["d"][0] == 1.0 and np.isnan(got["d"][1])
    spread = {r.g: r.mad for r in groups.median_absolute_deviation(frame, ["g"], "v").collect()}
    assert spread["a"] == 0 and spread["b"] == inf and spread["e"] == 0


def test_quantiles_of_a_group_of_many_values(spark):
    frame = spark.range(0, 300_000, numPartitions=6).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"), (F.col("id") * 7919 % 300_007).cast("double").alias("v")
    )
    got = {r.g: r.q for r in groups.quantiles(frame, ["g"], "v", {"q": 0.77}).collect()}
    want = {r.g: r.q for r in frame.groupBy("g").agg(F.percentile("v", 0.77).alias("q")).collect()}
    assert got == pytest.approx(want)


def test_building_starts_no_job(spark, skewed):
    spark.sparkContext.setJobGroup("build", "build")
    ranking.ntile(skewed, {"q": "v", "p": "id"}, 5, ["g"], ["id"])
    groups.quantiles(skewed, ["g"], "v", {"q": 0.5})
    groups.median_absolute_deviation(skewed, ["g"], "v")
    groups.with_group_stats(skewed, ["g"], n=F.count("*"))
    ranking.slice_max(skewed, "v", 3, ["g"])
    started = spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("other", "other")
    assert not started


@pytest.mark.parametrize("all_differ", [True, False])
def test_groups_ordered_whole_get_the_buckets_of_spread_ones(spark, monkeypatch, all_differ):
    """Missing keys and values, NaN, rows that come twice, groups smaller than the bucket number."""
    data = [(k, v, i) for i in range(60) for k, v in [("a", float(i % 7)), (None, float(-i)), ("b" if i < 3 else "c", None if i % 5 == 0 else float("nan") if i % 4 == 0 else i / 2)]]
    frame = spark.createDataFrame([*data, *data[:40]], "g string, v double, id long")
    found = []
    for most in (1000, 90, 0):  # all groups in one way, some in either, all in the other
        monkeypatch.setattr(ranking, "GROUP_ROWS", most)
        found.append([str(r) for r in rows(ranking.ntile(frame, {"q": "v", "p": "id"}, 5, ["g"], ["id"], all_differ))])
    assert found[0] == found[1] == found[2] and len(found[0]) == len(data) + 40
