"""Shuffles stay in parts that a task can hold, whatever the session's partition count."""

from pyspark.sql import functions as F

from headway.session import RUNTIME_CONF, tune


def test_few_shuffle_partitions_do_not_make_large_ones(spark):
    names = [*RUNTIME_CONF, "spark.sql.shuffle.partitions"]
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        tune(spark).conf.set("spark.sql.shuffle.partitions", "2")
        wide = spark.range(600_000).select(F.sha2(F.col("id").cast("string"), 512).alias("k"))
        groups = wide.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        assert groups.select(F.spark_partition_id().alias("p")).distinct().count() > 2
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
