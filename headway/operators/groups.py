"""Group-wise results on every row, first rows per key and exact quantiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.missing import quoted
from headway.operators.joins import attach, join
from headway.operators.ranking import first_by_count, rows_at_ranks
from headway.session import kept


def with_group_stats(df: DataFrame, keys: Sequence[str], **stats: Column) -> DataFrame:
    """Add aggregates of a row's group to every row.

    The groups are aggregated (partially before the shuffle) and joined back, so
    the rows of a hot group never have to sit in one task as in a window.
    """
    summary = df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(
        *[value.alias(name) for name, value in stats.items()]
    )
    return attach(df, summary, keys)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One whole row per key: the first in ``order``.

    The row limit is applied per map task before the shuffle, so each task sends
    at most one row per key.
    """
    window = Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(*order)
    numbered = df.withColumn("__row", F.row_number().over(window))
    return numbered.where(F.col("__row") == 1).drop("__row")


def nth_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Keys and order columns of the row at position ``n`` (from 1) of every group
    that has as many rows."""
    names = [*keys, *[c for c in order if c not in keys]]
    found = first_by_count(df, keys, order, [F.col(quoted(c)) for c in order], n)
    return found.where(F.col("__upto") >= n).select(*[F.col(quoted(c)) for c in names])


def counted_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys, ``value`` as a double and ``times``: how often a group has it, missing included.

    Quantiles and the deviation from a median need no more of the rows than this table.
    """
    column = F.col(quoted(value)).cast("double").alias(value)
    return df.groupBy(*[F.col(quoted(k)) for k in keys], column).agg(F.count(F.lit(1)).alias("times"))


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    weight: str | None = None,
) -> DataFrame:
    """Exact quantiles per group by linear interpolation between order statistics.

    A group with a missing value has missing quantiles. With ``weight`` a row
    stands for that many equal values. The distinct values with their counts are spread over
    places of their order, so a group of any size is never in one task.
    """
    key_columns = [F.col(quoted(k)) for k in keys]
    column = F.col(quoted(value)).cast("double").alias("__value")
    times = F.lit(1) if weight is None else F.col(quoted(weight))
    counted = df.groupBy(*key_columns, column).agg(F.sum(times).alias("__weight"))

    def wanted(total: Column) -> Column:
        targets = []
        for name, p in probabilities.items():
            position = (total - 1) * F.lit(float(p)) + 1
            for side, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
                targets.append(
                    F.struct(
                        F.lit(f"{name}:{side}").alias("label"), rank.cast("long").alias("rank")
                    )
                )
        return F.array(*targets)

    found = rows_at_ranks(counted.where("__value IS NOT NULL"), keys, ["__value"], wanted, weight="__weight")
    # A group's missing values join the found ones as one more row.
    missing = counted.where("__value IS NULL").select(*key_columns, F.lit(True).alias("__missing"))
    found = found.unionByName(missing, allowMissingColumns=True)
    at = lambda label: F.max(F.when(F.col("__label") == label, F.col("__value")))
    sides = found.groupBy(*key_columns).agg(
        F.max("__total").alias("__total"),
        F.max("__missing").alias("__missing"),
        *[
            at(f"{name}:{side}").alias(f"{name}:{side}")
            for name in probabilities
            for side in ("low", "high")
        ],
    )
    results = []
    for name, p in probabilities.items():
        position = (F.col("__total") - 1) * F.lit(float(p)) + 1
        low, high = F.col(quoted(f"{name}:low")), F.col(quoted(f"{name}:high"))
        share = position - F.floor(position)
        # Equal neighbours stand for themselves: an infinite one times a share of 0 would not.
        between = F.when(low == high, low).otherwise(low * (1 - share) + high * share)
        results.append(F.when(F.col("__missing").isNull(), between).alias(name))
    return sides.select(*key_columns, *results)


def median_absolute_deviation(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "mad", weight: str | None = None
) -> DataFrame:
    """1.4826 times the median distance from the group's median.

    Both medians work on the distinct values with their counts, which are far
    fewer than the rows of a large group. The groups' medians are kept (see
    ``headway.session.kept``), one row per group.
    """
    key_columns = [F.col(quoted(k)) for k in keys]
    counted = df if weight else counted_values(df, keys, value)
    times = weight or "times"
    centre = kept(quantiles(counted, keys, value, {"__centre": 0.5}, times))
    if keys:
        joined = join(counted, centre, by=list(keys))
    else:
        joined = counted.withColumn("__centre", centre.select("__centre").scalar())
    distance = F.col(quoted(value)).cast("double") - F.col("__centre")
    # An infinite value is at no distance from an infinite median.
    distance = F.when(F.col(quoted(value)) == F.col("__centre"), 0.0).otherwise(F.abs(distance))
    distances = joined.select(*key_columns, distance.alias("__distance"), F.col(quoted(times)).alias("__times"))
    spread = quantiles(distances, keys, "__distance", {name: 0.5}, "__times")
    return spread.withColumn(name, F.col(quoted(name)) * F.lit(1.4826))
