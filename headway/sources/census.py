"""Landed census tables: survey estimates, decennial counts, variable catalogue.

Files are kept by year (and survey) folder; a reader names the variables it
wants and gets them under its own names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.estimates import moe_at
from headway.functions.missing import quoted
from headway.functions.recode import recode
from headway.operators.joins import join
from headway.operators.reshape import pivot_wider

# Length of the id of each level of geography.
GEOID_LENGTH = {"state": 2, "county": 5, "tract": 11, "block group": 12}


def _named(variables: Mapping[str, str] | Sequence[str]) -> dict[str, str]:
    """Chosen name to variable code."""
    return dict(variables) if isinstance(variables, Mapping) else {v: v for v in variables}


def _areas(geography: str | None, state: str | None, county: str | None) -> Column:
    chosen = F.lit(True)
    if geography is not None:
        if geography not in GEOID_LENGTH:
            raise ValueError(f"geography must be one of {sorted(GEOID_LENGTH)}")
        chosen = chosen & (F.length("GEOID") == GEOID_LENGTH[geography])
    if county is not None and state is None:
        raise ValueError("a county needs its state")
    if state is not None:
        chosen = chosen & F.col("GEOID").startswith(state + (county or ""))
    return chosen


def _pick(df: DataFrame, variables: Mapping[str, str] | Sequence[str]) -> DataFrame:
    names = _named(variables)
    return df.where(F.col("variable").isin(list(names.values()))).withColumn(
        "variable", recode("variable", {code: name for name, code in names.items()})
    )


def acs(
    table: DataFrame,
    variables: Mapping[str, str] | Sequence[str],
    geography: str | None = None,
    state: str | None = None,
    county: str | None = None,
    year: int | None = None,
    survey: str | None = None,
    moe_level: int = 90,
    output: str = "tidy",
    polygons: DataFrame | None = None,
) -> DataFrame:
    """Estimates with margins of error for chosen variables, areas and year.

    ``table`` has GEOID, NAME, variable, estimate, moe and, where it holds
    several, year and survey. State and county are given by their code.
    ``output="wide"`` makes columns {name}E (estimate) and {name}M; ``polygons``
    (keyed by GEOID) attaches the boundaries.
    """
    rows = table
    if year is not None:
        rows = rows.where(F.col("year") == year)
    if survey is not None:
        rows = rows.where(F.col("survey") == survey)
    rows = _pick(rows.where(_areas(geography, state, county)), variables).select(
        "GEOID", "NAME", "variable", "estimate", moe_at("moe", moe_level).alias("moe")
    )
    if output == "wide":
        names = list(_named(variables))
        wide = pivot_wider(rows, ["GEOID", "NAME"], "variable", ["estimate", "moe"], names)
        rows = wide.select(
            "GEOID",
            "NAME",
            *[
                F.col(quoted(f"{value}_{name}")).alias(name + letter)
                for name in names
                for value, letter in (("estimate", "E"), ("moe", "M"))
            ],
        )
    return rows if polygons is None else join(rows, polygons, by="GEOID", how="left")


def decennial(
    table: DataFrame,
    variables: Mapping[str, str] | Sequence[str],
    geography: str | None = None,
    state: str | None = None,
    county: str | None = None,
    year: int | None = None,
    output: str = "tidy",
) -> DataFrame:
    """Counts for chosen variables and areas: GEOID, NAME, variable, value."""
    rows = table if year is None else table.where(F.col("year") == year)
    rows = _pick(rows.where(_areas(geography, state, county)), variables)
    rows = rows.select("GEOID", "NAME", "variable", "value")
    if output == "wide":
        return pivot_wider(rows, ["GEOID", "NAME"], "variable", ["value"], list(_named(variables)))
    return rows


def read_acs(spark: SparkSession, path: str, variables, **choices) -> DataFrame:
    """``acs`` over landed Parquet partitioned by survey and year."""
    return acs(spark.read.parquet(path), variables, **choices)


def read_decennial(spark: SparkSession, path: str, variables, **choices) -> DataFrame:
    """``decennial`` over landed Parquet partitioned by year."""
    return decennial(spark.read.parquet(path), variables, **choices)


def long_from_wide(table: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Published wide files ({code}E estimate, {code}M margin) as long rows."""
    cells = F.array(
        *[
            F.struct(
                F.lit(code).alias("variable"),
                F.col(f"{code}E").cast("double").alias("estimate"),
                F.col(f"{code}M").cast("double").alias("moe"),
            )
            for code in codes
        ]
    )
    return table.select("GEOID", "NAME", F.inline(cells))


def search_variables(catalogue: DataFrame, pattern: str) -> DataFrame:
    """Catalogue rows whose label or concept matches, upper or lower case alike."""
    found = F.lit(False)
    for column in ("label", "concept"):
        found = found | F.coalesce(F.col(column).rlike(f"(?i){pattern}"), F.lit(False))
    return catalogue.where(found)
