"""Aggregates with data-frame NA rules.

``*_strict``: one missing value makes the result missing. ``*_skip``: missing
values are left out, and nothing left means 0 (sum) or NaN (mean). All of them
are built from partial aggregates, so no group is gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.missing import as_column


def rows() -> Column:
    return F.count(F.lit(1))


def missing_rows(value: Column | str) -> Column:
    return F.count_if(as_column(value).isNull())


def _strict(value: Column | str, result: Column) -> Column:
    return F.when(missing_rows(value) == 0, result)


def sum_strict(value: Column | str) -> Column:
    return _strict(value, sum_skip(value))


def sum_skip(value: Column | str) -> Column:
    return F.coalesce(F.sum(as_column(value)), F.lit(0))


def mean_strict(value: Column | str) -> Column:
    return _strict(value, mean_skip(value))


def mean_skip(value: Column | str) -> Column:
    return F.coalesce(F.avg(as_column(value)), F.lit(float("nan")))


def sd_strict(value: Column | str) -> Column:
    return _strict(value, F.stddev_samp(as_column(value)))


def min_strict(value: Column | str) -> Column:
    return _strict(value, F.min(as_column(value)))


def max_strict(value: Column | str) -> Column:
    return _strict(value, F.max(as_column(value)))


def first_by(value: Column | str, order: Column | str) -> Column:
    """Value of the first row in ``order``; the value itself may be missing."""
    return F.min_by(as_column(value), as_column(order))


def last_by(value: Column | str, order: Column | str) -> Column:
    return F.max_by(as_column(value), as_column(order))


def n_distinct(value: Column | str) -> Column:
    """Distinct values, a missing value counting as one of them."""
    column = as_column(value)
    return F.count_distinct(column) + F.coalesce(
        F.max(column.isNull().cast("long")), F.lit(0).cast("long")
    )


def any_true(condition: Column | str) -> Column:
    """TRUE if any is TRUE, else missing if any is missing, else FALSE."""
    column = as_column(condition)
    return (
        F.when(F.count_if(column) > 0, True)
        .when(missing_rows(column) > 0, F.lit(None).cast("boolean"))
        .otherwise(False)
    )


def all_true(condition: Column | str) -> Column:
    """FALSE if any is FALSE, else missing if any is missing, else TRUE."""
    column = as_column(condition)
    return (
        F.when(F.count_if(~column) > 0, False)
        .when(missing_rows(column) > 0, F.lit(None).cast("boolean"))
        .otherwise(True)
    )


def count_where(condition: Column | str) -> Column:
    return F.count_if(as_column(condition))


def moe_of_sum(
    moe: Column | str, estimate: Column | str, within: Column | None = None
) -> Column:
    """Margin of error of a sum of estimates.

    Root of the summed squares, where all zero estimates together contribute
    only their largest margin. A missing margin makes the result missing.
    ``within`` restricts the aggregate to some of the group's rows.
    """
    margin, value = as_column(moe), as_column(estimate)
    chosen = F.lit(True) if within is None else within
    nonzero = F.sum(F.when(chosen & (value != 0), margin * margin))
    zero = F.max(F.when(chosen & (value == 0), margin))
    total = F.sqrt(F.coalesce(nonzero, F.lit(0.0)) + F.coalesce(zero * zero, F.lit(0.0)))
    return F.when(
        (F.count_if(chosen) > 0) & (F.count_if(chosen & (margin.isNull() | value.isNull())) == 0),
        total,
    )
