"""Column-set operators: names, stacking, missing values, profiles, bins."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.missing import quoted


def snake_case(name: str) -> str:
    """Lower-case words joined by underscores, starting with a letter."""
    text = name.replace("%", "_percent_").replace("#", "_number_").strip("﻿ '\"")
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower()
    return text if text and not text[0].isdigit() else f"x{text}"


def clean_names(df: DataFrame) -> DataFrame:
    """Snake-case all names; repeated results get _2, _3 and so on."""
    seen: dict[str, int] = {}
    names = []
    for name in map(snake_case, df.columns):
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*names)


def bind_rows(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; columns a table lacks are filled as missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def replace_na(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill missing values, each replacement taking its column's own type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            name: F.coalesce(F.col(quoted(name)), F.lit(value).cast(types[name]))
            for name, value in values.items()
        }
    )


def drop_na(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the rows where none of the columns is missing."""
    return df.na.drop(subset=list(columns))


def profile(df: DataFrame, day: str) -> DataFrame:
    """Row count, column count, oldest and newest value of a date column."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.min(quoted(day)).alias("oldest"),
        F.max(quoted(day)).alias("newest"),
    )


def histogram(df: DataFrame, value: Column | str, start: float, width: float) -> DataFrame:
    """Counts per right-closed bin; bin 1 also holds ``start``, values below it are in
    bins 0, -1 and so on.

    Bins without rows are not listed and missing values are not counted.
    """
    column = F.col(quoted(value)) if isinstance(value, str) else value
    place = F.ceil((column - F.lit(start)) / F.lit(width))
    place = F.when(column == F.lit(start), F.lit(1)).otherwise(place)
    binned = df.where(column.isNotNull()).select(place.cast("int").alias("bin"))
    return (
        binned.groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "bin",
            (F.lit(float(start)) + (F.col("bin") - 1) * F.lit(float(width))).alias("lower"),
            (F.lit(float(start)) + F.col("bin") * F.lit(float(width))).alias("upper"),
            "count",
        )
    )
