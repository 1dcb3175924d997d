"""Recoding by value, by pattern and by condition; the first match wins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.missing import as_column, matches


def recode(value: Column | str, table: Mapping[str, str], keep_others: bool = True) -> Column:
    """Replace by an exact-match table; other values stay or become missing."""
    column = as_column(value)
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    found = F.try_element_at(F.create_map(*pairs), column)
    return F.coalesce(found, column) if keep_others else found


def recode_pattern(value: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """First matching (pattern, label); no match leaves the result missing."""
    return first_match([(matches(value, pattern), F.lit(label)) for pattern, label in rules])


def first_match(rules: Sequence[tuple[Column, Column]], default: Column | None = None) -> Column:
    (condition, result), *rest = rules
    chain = F.when(condition, result)
    for condition, result in rest:
        chain = chain.when(condition, result)
    return chain if default is None else chain.otherwise(default)
