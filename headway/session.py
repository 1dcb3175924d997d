"""Session settings."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the library relies on. Skewed join keys are split by
# adaptive execution, also where that costs the next operator a shuffle. Shuffles start
# with many partitions and are merged to small ones: a task sorts and hashes all rows of
# its partition, some 30 times the size of the compressed shuffle blocks.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Bytes a shuffle partition should hold before adaptive execution merges small ones.
PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Partitions for ``spark.sql.shuffle.partitions``: enough to keep each near
    128 MiB and every core busy. Adaptive execution only merges, so start high."""
    return max(cores, -(-input_bytes // PARTITION_BYTES))


def build_session(app: str = "headway", master: str | None = None, **conf: str) -> SparkSession:
    """Session for stand-alone use; on a cluster the submitter sets the master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true", **RUNTIME_CONF}
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def kept(df: DataFrame) -> DataFrame:
    """A small table that a plan reads several times, computed once, when first needed.

    For summaries such as one row per area or route. They stay in the executors' storage
    (memory, then disk) until ``unpersist`` or ``spark.catalog.clearCache()``; a part that is
    lost with its executor is computed again.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)
