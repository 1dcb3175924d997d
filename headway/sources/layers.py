"""Spatial layers: GeoJSON polygons and point tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.functions.geometry import orient
from headway.functions.missing import quoted
from headway.operators.spatial import as_points, as_polygons, project

_RING = "array<array<array<double>>>"


def _to_rings(parts):
    return F.transform(
        parts,
        lambda ring: F.transform(
            ring, lambda p: F.struct(p[0].cast("double").alias("x"), p[1].cast("double").alias("y"))
        ),
    )


def read_polygons(
    spark: SparkSession,
    path: str,
    properties: str,
    epsg: int = 4326,
    collection: bool = False,
) -> DataFrame:
    """GeoJSON polygons and multipolygons as a polygon table.

    ``properties`` declares the attributes to keep; ids stay text. One feature
    per line is split over tasks; ``collection=True`` reads whole
    FeatureCollection documents, one task each.
    """
    kept = StructType.fromDDL(properties)
    feature = (
        StructType()
        .add("properties", kept)
        .add("geometry", StructType().add("type", "string").add("coordinates", "string"))
    )
    if collection:
        document = StructType.fromDDL(f"features array<{feature.simpleString()}>")
        rows = (
            spark.read.schema(document)
            .json(path, multiLine=True)
            .select(F.explode("features").alias("f"))
            .select("f.*")
        )
    else:
        rows = spark.read.schema(feature).json(path)
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    single = orient(_to_rings(F.from_json(text, _RING)))
    multi = F.flatten(
        F.transform(F.from_json(text, f"array<{_RING}>"), lambda part: orient(_to_rings(part)))
    )
    rings = F.when(kind == "Polygon", single).when(kind == "MultiPolygon", multi)
    table = rows.select(
        *[F.col(f"properties.{quoted(f.name)}").alias(f.name) for f in kept.fields],
        rings.alias("rings"),
    )
    return as_polygons(table, "rings", epsg, oriented=True)


def read_points(
    table: DataFrame, x: str, y: str, epsg: int, to_epsg: int | None = None
) -> DataFrame:
    """A table with two coordinate columns as points, projected if asked."""
    points = as_points(table, x, y, epsg)
    return points if to_epsg is None else project(points, to_epsg)
