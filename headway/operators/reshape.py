"""Long to wide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.missing import quoted

# Column of the rows whose name is missing.
NO_NAME = "NA"


def pivot_wider(
    df: DataFrame,
    ids: Sequence[str],
    names_from: str,
    values_from: Sequence[str],
    names: Sequence[str] | None = None,
    extra: Mapping[str, Column] | None = None,
    leave_out: bool = False,
) -> DataFrame:
    """One row per ``ids`` with a column per name (and value).

    Several value columns give ``{value}_{name}``, a single one plain ``{name}``;
    absent cells are missing. A repeated (ids, name) pair fails the query: it has
    no single cell value. The result is one aggregation by ``ids``, so nothing is
    shuffled a second time. A missing name becomes the column "NA". Give ``names`` for a
    schema that is fixed ahead; another name in the data then fails the query unless
    ``leave_out`` is set. ``extra`` adds further aggregates of the same groups.
    """
    text = F.col(quoted(names_from)).cast("string")
    name = F.coalesce(text, F.lit(NO_NAME))
    if names is None:
        found = df.select(F.col(quoted(names_from)).alias("name")).distinct().orderBy(F.col("name").asc_nulls_last())
        names = [NO_NAME if row[0] is None else row[0] for row in found.select(F.col("name").cast("string")).collect()]
    labels = [str(label) for label in names]
    other = F.count_if(~name.isin(labels)) if labels else F.count(F.lit(1))
    unlisted = F.lit(False) if leave_out else other > 0
    cells = []
    for value in values_from:
        for label in labels:
            here = name == F.lit(label)
            out = f"{value}_{label}" if len(values_from) > 1 else label
            repeated = F.raise_error(F.lit(f"several rows for one cell {names_from}={label}"))
            cells.append(
                F.when(unlisted, F.raise_error(F.lit(f"names of {names_from} that are not listed")))
                .when(F.count_if(here) > 1, repeated)
                .otherwise(F.max(F.when(here, F.col(quoted(value)))))
                .alias(out)
            )
    for out, aggregate in (extra or {}).items():
        cells.append(aggregate.alias(out))
    return df.groupBy(*[F.col(quoted(c)) for c in ids]).agg(*cells)
