"""Membership, pattern and conversion functions with data-frame NA rules.

A missing value is never a member of a list, never matches a pattern and never
makes a conversion fail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def quoted(name: str) -> str:
    """Column reference for any name, including names with dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def is_in(value: Column | str, members: Sequence) -> Column:
    """Membership that is TRUE or FALSE for every row, missing values included."""
    column = as_column(value)
    present = [m for m in members if m is not None]
    found = F.coalesce(column.isin(present), F.lit(False)) if present else F.lit(False)
    return (found | column.isNull()) if len(present) < len(members) else found


def not_in(value: Column | str, members: Sequence) -> Column:
    """Rows outside the list; rows with a missing value stay."""
    return ~is_in(value, members)


def in_run(value: Column | str, first: int, last: int) -> Column:
    """Membership in the whole numbers ``first..last`` without listing them."""
    column = as_column(value)
    return F.coalesce(column.between(first, last) & (column == F.floor(column)), F.lit(False))


def matches(value: Column | str, pattern: str) -> Column:
    """Regular-expression test; a missing text does not match."""
    return F.coalesce(as_column(value).rlike(pattern), F.lit(False))


def replace_all(value: Column | str, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(as_column(value), pattern, replacement)


def to_number(value: Column | str) -> Column:
    """Text to double; text that is no number becomes missing."""
    return F.trim(as_column(value)).try_cast("double")


def to_day(value: Column | str) -> Column:
    """Text or timestamp to date; text that is no date becomes missing."""
    return as_column(value).try_cast("date")


def paste(*parts: Column | str, sep: str = "") -> Column:
    """Concatenate, writing missing parts as the text NA. Strings are column names."""
    texts = [F.coalesce(as_column(p).cast("string"), F.lit("NA")) for p in parts]
    return F.concat_ws(sep, *texts)
