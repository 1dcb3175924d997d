"""Rounding with exact halves going to the even neighbour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.missing import as_column


def half_even(value: Column | str, digits: int = 0) -> Column:
    column = as_column(value)
    return F.rint(column) if digits == 0 else F.bround(column, digits)


def ratio_half_even(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``part / whole`` of two non-negative counts, rounded in whole numbers.

    Working on the remainder keeps exact halves exact (23/40 has no exact
    double). A zero or missing ``whole`` gives a missing ratio.
    """
    scale = 10**digits
    scaled = as_column(part).cast("long") * F.lit(scale)
    below = F.when(as_column(whole) != 0, as_column(whole).cast("long"))
    quotient = F.floor(scaled / below).cast("long")
    twice = F.lit(2) * (scaled - quotient * below)
    up = (twice > below) | ((twice == below) & (quotient % 2 == 1))
    return (quotient + F.when(up, 1).otherwise(0)) / F.lit(float(scale))
