"""Jobs per census area and their density."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.geometry import polygon_area
from headway.operators.spatial import count_in, crs_of, project


def with_job_total(jobs: DataFrame) -> DataFrame:
    """Jobs held by people without a degree: the sum of the two lower classes."""
    return jobs.withColumn("HSandLess", F.col("cd01") + F.col("cd02"))


def jobs_by_area(
    areas: DataFrame, jobs: DataFrame, key: str = "GEO_ID_GRP", value: str = "HSandLess"
) -> DataFrame:
    """Areas with their jobs and jobs per square unit; both tables are brought
    into the areas' reference system first."""
    total = count_in(areas, project(jobs, crs_of(areas)), key, value=value, name="jobs")
    area = polygon_area("rings")
    return total.withColumns({"area": area, "job_density": F.try_divide(F.col("jobs"), area)})
