"""Survey estimates: confidence levels and interval bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.missing import as_column

# Standard normal quantiles used for published margins of error.
Z_SCORES = {90: 1.645, 95: 1.96, 99: 2.576}


def moe_at(moe: Column | str, level: int = 90) -> Column:
    """Published 90 % margin restated at another confidence level."""
    if level not in Z_SCORES:
        raise ValueError(f"confidence level must be one of {sorted(Z_SCORES)}")
    return as_column(moe) * F.lit(Z_SCORES[level] / Z_SCORES[90])


def interval(estimate: Column | str, moe: Column | str) -> tuple[Column, Column]:
    """Lower and upper bound of the estimate."""
    value, margin = as_column(estimate), as_column(moe)
    return (value - margin).alias("lower"), (value + margin).alias("upper")
