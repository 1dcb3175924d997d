"""Checks an analyst makes between steps; each returns rows or raises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.missing import quoted
from headway.operators.joins import Keys, key_pairs


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on more than one row, with their number of rows."""
    counted = df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where(F.col("rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    example = repeated_keys(df, keys).first()
    if example is not None:
        raise ValueError(f"{list(keys)} do not identify rows, e.g. {example.asDict()}")
    return df


def assert_no_fanout(left: DataFrame, right: DataFrame, by: Keys = None) -> DataFrame:
    """A left join on ``by`` must not repeat left rows."""
    return assert_unique(right, [b for _, b in key_pairs(left, right, by)])


def assert_all_matched(df: DataFrame, column: str) -> DataFrame:
    """No row may lack ``column`` after a join."""
    if not df.where(F.col(quoted(column)).isNull()).isEmpty():
        raise ValueError(f"rows without {column} after the join")
    return df
