"""Delimited text: null markers, declared or guessed types, parse problems."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from headway.functions.missing import quoted

DEFAULT_NA = ("", "NA")
# Spellings met in hand-kept sheets, to be passed as ``na`` where they occur.
SHEET_NA = ("", "NA", "N/A", "n/a", "null")

# Texts that count as each guessed type, narrowest first. Numbers
# with a leading zero are codes and stay text.
GUESSES = (
    ("boolean", r"^(TRUE|FALSE|true|false|T|F)$"),
    ("bigint", r"^-?(0|[1-9][0-9]{0,17})$"),
    ("double", r"^-?(0|[1-9][0-9]*)?(\.[0-9]*)?([eE][+-]?[0-9]+)?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp_ntz", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?$"),
)


def _struct(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def clean_markers(df: DataFrame, na: Sequence[str] = DEFAULT_NA) -> DataFrame:
    """Blank out null markers and outer spaces in all text columns."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    trimmed = {name: F.trim(F.col(quoted(name))) for name in texts}
    return df.withColumns(
        {name: F.when(~text.isin(list(na)), text) for name, text in trimmed.items()}
    )


def typed(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Text columns as the declared types; what cannot be converted is missing."""
    return df.select(
        *[
            F.col(quoted(f.name)).try_cast(f.dataType).alias(f.name)
            for f in _struct(schema).fields
        ]
    )


def guess_schema(df: DataFrame) -> StructType:
    """Types that fit every non-missing text of a column, found in one pass."""
    tests = []
    for i, name in enumerate(df.columns):
        column = F.col(quoted(name))
        tests.append(F.count(column).alias(f"{i}:n"))
        for kind, pattern in GUESSES:
            fits = column.rlike(pattern) & column.try_cast(kind).isNotNull()
            tests.append(F.count_if(fits).alias(f"{i}:{kind}"))
    counts = df.agg(*tests).first()
    schema = StructType()
    for i, name in enumerate(df.columns):
        present = counts[f"{i}:n"]
        fitting = [k for k, _ in GUESSES if present and counts[f"{i}:{k}"] == present]
        schema = schema.add(name, DataType.fromDDL(fitting[0] if fitting else "string"))
    return schema


def read_text_table(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """A headed CSV with every column as text; a byte-order mark is dropped."""
    return (
        spark.read.options(**options)
        .csv(path, header=True, inferSchema=False, enforceSchema=False)
    )


def read_table(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    na: Sequence[str] = DEFAULT_NA,
    **options: str,
) -> DataFrame:
    """A headed CSV with null markers removed.

    Declared columns are found by header name. Without ``schema`` the types are
    guessed, which reads the data once more; declare them for large inputs.
    """
    texts = clean_markers(read_text_table(spark, path, **options), na)
    return typed(texts, schema if schema is not None else guess_schema(texts))


def malformed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines whose number of fields differs from the header's, with their text."""
    names = read_text_table(spark, path).columns
    schema = StructType()
    for name in names:
        schema = schema.add(name, "string")
    lines = spark.read.schema(schema.add("_line", "string")).csv(
        path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_line"
    )
    # All fields must be asked for, or the parser would not look at them.
    fields = F.to_json(F.struct(*[quoted(name) for name in names]))
    return lines.where(F.col("_line").isNotNull() & (F.length(fields) > 0))


def cast_problems(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Texts that do not fit their declared type: column, problem count, example."""
    fields = _struct(schema).fields
    cells = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.when(
                    F.col(quoted(f.name)).try_cast(f.dataType).isNull(), F.col(quoted(f.name))
                ).alias("value"),
            )
            for f in fields
        ]
    )
    return (
        df.select(F.explode(cells).alias("cell"))
        .where(F.col("cell.value").isNotNull())
        .groupBy(F.col("cell.column").alias("column"))
        .agg(F.count(F.lit(1)).alias("problems"), F.min("cell.value").alias("example"))
    )


def read_sheets(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    na: Sequence[str] = DEFAULT_NA,
) -> DataFrame:
    """All sheets of a workbook exported as one CSV per sheet, with a ``sheet`` column.

    Columns are found by name, so sheets may differ in their order and in further ones; a
    declared column that a sheet lacks is missing there. The first lines of all files are
    read at once, then the sheets of each header in one scan.
    """
    lines = spark.read.text(folder).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        F.regexp_replace("value", "^\ufeff", "").alias("line"),
    )
    # One row per sheet.
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("line", "place").alias("header")).collect()
    alike: dict[str, list[str]] = {}
    for row in sorted(first):
        path = re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(row["file"]))
        alike.setdefault(row["header"].rstrip("\r"), []).append(path)
    fields = _struct(schema)
    sheets = [_sheets_alike(spark, paths, fields, na) for paths in alike.values()]
    if not sheets:
        return spark.createDataFrame([], StructType(list(fields.fields)).add("sheet", "string"))
    return reduce(DataFrame.unionByName, sheets)


def _sheets_alike(spark: SparkSession, paths: list[str], fields: StructType, na: Sequence[str]) -> DataFrame:
    """Sheets of one header; declared columns they lack are missing."""
    texts = read_text_table(spark, paths).withColumn(
        "sheet", F.regexp_replace(F.col("_metadata.file_name"), r"(?i)\.csv(\.gz)?$", "")
    )
    # File names are escaped like URLs.
    texts = texts.withColumn("sheet", F.url_decode(F.replace("sheet", F.lit("+"), F.lit("%2B"))))
    lacking = [f.name for f in fields.fields if f.name not in texts.columns]
    texts = texts.withColumns({name: F.lit(None).cast("string") for name in lacking}) if lacking else texts
    return typed(clean_markers(texts, na), StructType(list(fields.fields)).add("sheet", "string"))


def read_sheet(
    spark: SparkSession,
    folder: str,
    sheet: str,
    schema: StructType | str | None = None,
    na: Sequence[str] = DEFAULT_NA,
) -> DataFrame:
    """One named sheet of an exported workbook; the other files are not opened."""
    return read_table(spark, f"{folder.rstrip('/')}/{sheet}.csv", schema, na)
