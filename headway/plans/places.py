"""A census measure by place with its interval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.estimates import interval
from headway.functions.missing import replace_all


def measure_by_place(estimates: DataFrame, name_ending: str = " County, Washington") -> DataFrame:
    """Places from the lowest to the highest estimate, with short names and bounds."""
    return (
        estimates.withColumn("NAME", replace_all("NAME", name_ending, ""))
        .select("GEOID", "NAME", "variable", "estimate", "moe", *interval("estimate", "moe"))
        .orderBy("estimate", "NAME")
    )
