import pytest
from conftest import rows

from headway.operators import checks
from headway.operators.groups import first_rows, with_group_stats
from headway.operators.joins import join
from headway.functions import aggregates as agg


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (9, "w")], "k int, v string")


def test_missing_keys_match(left, right):
    got = join(left, right, by="k")
    assert got.columns == ["k", "v.x", "v.y"]
    assert rows(got) == [(None, "c", "z"), (1, "a", "x"), (1, "a", "y"), (2, "b", None)]
    never = join(left, right, by="k", na_matches=False)
    assert (None, "c", None) in rows(never)


def test_right_and_full_keep_the_key(left, right):
    assert rows(join(left, right, by="k", how="right")) == [
        (None, "c", "z"), (1, "a", "x"), (1, "a", "y"), (9, None, "w")
    ]
    assert rows(join(left, right, by="k", how="full")) == [
        (None, "c", "z"), (1, "a", "x"), (1, "a", "y"), (2, "b", None), (9, None, "w")
    ]


def test_inner_semi_anti(left, right):
    assert join(left, right, by="k", how="inner").count() == 3
    assert rows(join(left, right, by="k", how="semi")) == [(None, "c"), (1, "a")]
    assert rows(join(left, right, by="k", how="anti")) == [(2, "b")]
    matched = join(left, right, by="k", how="semi")
    unmatched = join(left, right, by="k", how="anti")
    assert rows(matched.unionByName(unmatched)) == rows(left)


def test_natural_and_renamed_keys(spark, left):
    other = spark.createDataFrame([(1, "a", 5), (1, "q", 6)], "k int, v string, n int")
    assert (1, "a", 5) in rows(join(left, other))
    named = spark.createDataFrame([(1.0, "p")], "route double, lead string")
    assert join(left, named, by={"k": "route"}).columns == ["k", "v", "lead"]
    with pytest.raises(ValueError):
        join(left, named)


def test_self_join(left):
    assert join(left, left, by="k", how="inner").count() == 3


def test_key_kinds_must_agree(spark, left):
    text = spark.createDataFrame([("1",)], "k string")
    with pytest.raises(TypeError, match="cannot join k"):
        join(left, text, by="k")


def test_fanout_check(left, right):
    assert checks.assert_no_fanout(right, left, by="k") is left
    with pytest.raises(ValueError, match="do not identify rows"):
        checks.assert_no_fanout(left, right, by="k")


def test_match_check(left, right):
    joined = join(left, right, by="k")
    with pytest.raises(ValueError):
        checks.assert_all_matched(joined, "v.y")
    assert checks.assert_all_matched(join(left, right, by="k", how="inner"), "v.y")


def test_group_stats_on_every_row(left, right):
    got = with_group_stats(right, ["k"], n=agg.rows())
    assert rows(got) == [(None, "z", 1), (1, "x", 2), (1, "y", 2), (9, "w", 1)]


def test_first_row_per_key(right):
    assert rows(first_rows(right, ["k"], ["v"])) == [(None, "z"), (1, "x"), (9, "w")]
