"""CSV members of zip archives and transit feeds (zips of CSV tables).

Archives are spread over tasks and each one is unpacked as a stream, so a task
holds one compressed archive and one block of rows.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.sources.tables import DEFAULT_NA, _struct, clean_markers, typed

BLOCK_ROWS = 50_000

# Declared columns of the feed tables this library uses, and those of them that a feed may
# leave out. Further columns of a file are not read: they would become join keys in a
# natural join.
OPTIONAL = {"stops": ["stop_name"], "routes": ["route_short_name", "route_desc"]}
FEED_TABLES = {
    "stops": "stop_id string, stop_name string, stop_lat double, stop_lon double",
    "stop_times": "stop_id string, trip_id string",
    "trips": "trip_id string, route_id string, service_id string",
    "calendar": "service_id string, start_date string",
    "routes": "route_id string, route_short_name string, route_desc string",
}


def _unpacker(member: str, names: Sequence[str], required: bool, optional: Sequence[str]):
    wanted = list(names)

    def check(header: Sequence[str], path: str, name: str) -> None:
        lacking = [n for n in wanted if n not in header and n not in optional]
        if required and lacking:
            raise ValueError(f"{path}: {name} has no column {', '.join(lacking)}")

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    inside = [
                        n
                        for n in archive.namelist()
                        if n.rsplit("/", 1)[-1] == member or (member == "*" and n.endswith(".csv"))
                    ]
                    if required and not inside:
                        raise ValueError(f"{path}: no member {member}")
                    for name in inside:
                        with archive.open(name) as stream:
                            blocks = pd.read_csv(
                                stream,
                                dtype=str,
                                chunksize=BLOCK_ROWS,
                                keep_default_na=False,
                                encoding="utf-8-sig",
                                skipinitialspace=True,
                            )
                            for block in blocks:
                                check(block.columns, path, name)
                                block = block.reindex(columns=wanted).astype(object)
                                yield block.where(block.notna(), None).assign(archive=path)

    return unpack


def read_zipped_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    member: str = "*",
    na: Sequence[str] = DEFAULT_NA,
    partitions: int | None = None,
    required: bool = False,
    optional: Sequence[str] = (),
) -> DataFrame:
    """Rows of one CSV member of every archive under ``path``, plus ``archive``.

    Declared columns a member lacks are missing. With ``required``, an archive without the
    member, or a member without one of the columns that are not ``optional``, is an error
    that names both.

    An archive is one task's work. ``partitions`` spreads its rows afterwards,
    for few large archives followed by heavy work.
    """
    fields = _struct(schema)
    text_schema = StructType()
    for field in fields.fields:
        text_schema = text_schema.add(field.name, "string")
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    texts = files.mapInPandas(
        _unpacker(member, fields.fieldNames(), required, optional), text_schema.add("archive", "string")
    )
    if partitions:
        texts = texts.repartition(partitions)
    return typed(
        clean_markers(texts, na), StructType(list(fields.fields)).add("archive", "string")
    )


def read_gtfs(
    spark: SparkSession, path: str, feed_pattern: str = r"([^/]+)_gtfs\.zip$"
) -> dict[str, DataFrame]:
    """The tables of one or many zipped feeds.

    Every table carries ``service_change_num``, taken from the archive's name, so
    several feeds are handled by one plan instead of one run per feed.
    """
    tables = {}
    for name, schema in FEED_TABLES.items():
        rows = read_zipped_csv(
            spark, path, schema, member=f"{name}.txt", required=True, optional=OPTIONAL.get(name, ())
        )
        # A file name that does not fit stands for itself, so that feeds stay apart.
        change = F.regexp_extract("archive", feed_pattern, 1)
        rows = rows.withColumn(
            "service_change_num", F.when(change != "", change).otherwise(F.col("archive"))
        ).drop("archive")
        if name == "calendar":
            rows = rows.withColumn("start_date", F.try_to_date("start_date", "yyyyMMdd"))
        tables[name] = rows
    return tables
