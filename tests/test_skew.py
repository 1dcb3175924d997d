"""A key with a third of all rows does not end up in one task."""

import pytest
from pyspark.sql import functions as F

from headway.functions.aggregates import rows as row_count
from headway.operators.groups import with_group_stats
from headway.operators.joins import join

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def facts(spark):
    """90,000 wide rows, a third of them on one key and some on a missing key."""
    return spark.range(0, 90_000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 30 != 1, F.col("id") % 500).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
        "id",
    )


@pytest.fixture(scope="module")
def names(spark):
    return spark.range(0, 600).select(
        F.when(F.col("id") != 0, F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("name")
    )


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner", "semi", "full"])
def test_joins_split_the_hot_key(facts, names, small_partitions, how):
    joined = join(facts, names, by="k", how=how)
    assert "skew=true" in final_plan(joined)
    matched = 90_000 - facts.where("k = 0").count()
    expected = {"left": 90_000, "inner": matched, "semi": matched, "full": 90_000 + 100}
    assert joined.count() == expected[how]


def test_group_statistics_split_the_hot_key(facts, small_partitions):
    counted = with_group_stats(facts, ["k"], n=row_count())
    assert "skew=true" in final_plan(counted)
    assert counted.where("k = 7").select(F.min("n"), F.count("*")).first()[0] > 30_000
