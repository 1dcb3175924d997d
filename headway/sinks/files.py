"""Result files. Every writer leaves one file per partition in a folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.geometry import parts
from headway.functions.missing import quoted
from headway.operators.spatial import crs_of, drop_geometry, is_polygons


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """Headed CSV with missing values written as NA; replaces unless appending."""
    df.write.mode("append" if append else "overwrite").csv(path, header=True, nullValue="NA")


def as_features(df: DataFrame) -> DataFrame:
    """Rows of a point, polygon or mixed table as one GeoJSON feature text each; a row of
    a mixed table is written with the shape it has."""
    attributes = F.struct(*[F.col(quoted(c)) for c in drop_geometry(df).columns])

    def feature(kind: str, place: Column, given: Column) -> Column:
        geometry = F.struct(F.lit(kind).alias("type"), place.alias("coordinates"))
        whole = F.struct(
            F.lit("Feature").alias("type"),
            attributes.alias("properties"),
            F.when(given, geometry).alias("geometry"),
        )
        return F.to_json(whole, {"ignoreNullFields": "false"})

    texts = []
    if is_polygons(df):
        place = F.transform(
            parts("rings"),
            lambda part: F.transform(
                part, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))
            ),
        )
        given = F.col("rings").isNotNull()
        texts.append((given, feature("MultiPolygon", place, given)))
    if {"x", "y"} <= set(df.columns):
        given = F.col("x").isNotNull() & F.col("y").isNotNull()
        texts.append((given, feature("Point", F.array("x", "y"), given)))
    without = texts[-1][1]
    return df.select(
        F.coalesce(*[F.when(given, text) for given, text in texts], without).alias("value")
    )


def write_layer(df: DataFrame, path: str) -> None:
    """GeoJSON, one feature per line."""
    as_features(df).write.mode("overwrite").text(path)


def map_layer(layers: Mapping[str, DataFrame], zcol: str) -> DataFrame:
    """Layers of a shared map as one feature table: ``layer``, value shown, shape.

    Polygon and point layers may be mixed; all share one reference system.
    """
    systems = {crs_of(table) for table in layers.values()}
    if len(systems) > 1:
        raise ValueError(f"layers of a map need one reference system, not {sorted(map(str, systems))}")
    features = []
    for name, table in layers.items():
        shape = ["rings"] if is_polygons(table) else ["x", "y"]
        features.append(
            table.select(
                F.lit(name).alias("layer"), F.col(quoted(zcol)).alias("value"), *shape
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), features)


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Several tables saved together, one Parquet folder each."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Parquet laid out by column values, e.g. month and day type."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
