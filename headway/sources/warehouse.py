"""Warehouse queries: Spark SQL over tables, or a JDBC scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run a query; ``{name}`` in the text stands for the table given as ``name``."""
    return spark.sql(text, **tables)


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Rows of a query run by the database.

    With a partition column and its bounds the scan is read in parallel slices;
    filters on the result are still sent to the database.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("query", query).load()
    low, high = bounds
    return (
        reader.option("dbtable", f"({query}) source")
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", partitions)
        .load()
    )
