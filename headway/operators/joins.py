"""Joins with data-frame key rules.

A missing key matches a missing key, keys of one name appear once, other clashing
names get a suffix, and number keys never meet text keys. The physical strategy
is left to Spark: a side is broadcast when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``, otherwise both sides are shuffled and
adaptive execution splits the partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from headway.functions.missing import quoted
Keys = str | Sequence[str] | Mapping[str, str] | None

KINDS = {
    "inner": "inner",
    "left": "left",
    "right": "right",
    "full": "full",
    "semi": "left_semi",
    "anti": "left_anti",
}
RIGHT_KEY = "__right_key_{}"

# Largest measured size, in bytes, of a summary that is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
# Overhead of a row in a broadcast table.
ROW_BYTES = 64


def key_pairs(left: DataFrame, right: DataFrame, by: Keys) -> list[tuple[str, str]]:
    """Pairs of key names; without ``by`` all names both tables have."""
    if by is None:
        common = [name for name in left.columns if name in right.columns]
        if not common:
            raise ValueError("the tables have no column name in common; give `by`")
        return [(name, name) for name in common]
    if isinstance(by, str):
        return [(by, by)]
    if isinstance(by, Mapping):
        return list(by.items())
    return [(name, name) for name in by]


def _family(kind: DataType) -> str:
    if isinstance(kind, NumericType):
        return "number"
    if isinstance(kind, StringType):
        return "text"
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return "time"
    return kind.simpleString()


def check_key_types(left: DataFrame, right: DataFrame, by: Keys = None) -> None:
    """Refuse keys of different kinds instead of casting one of them silently."""
    for left_name, right_name in key_pairs(left, right, by):
        kinds = left.schema[left_name].dataType, right.schema[right_name].dataType
        if _family(kinds[0]) != _family(kinds[1]):
            raise TypeError(
                f"cannot join {left_name} ({kinds[0].simpleString()}) "
                f"to {right_name} ({kinds[1].simpleString()})"
            )


def same_keys(pairs: Sequence[tuple[str, str]], na_matches: bool = True) -> Column:
    def equal(a: str, b: str) -> Column:
        first, second = F.col(quoted(a)), F.col(quoted(b))
        return first.eqNullSafe(second) if na_matches else first == second

    return reduce(lambda a, b: a & b, [equal(a, b) for a, b in pairs])


def join(
    left: DataFrame,
    right: DataFrame,
    by: Keys = None,
    how: str = "left",
    na_matches: bool = True,
    suffixes: tuple[str, str] = (".x", ".y"),
) -> DataFrame:
    """Join two tables on equal keys.

    ``by``: one name, several names, a mapping of left to right names, or None
    for all common names. ``how``: left, right, inner, full, semi or anti. Set
    ``na_matches=False`` when keys cannot be missing: the plain equality keeps
    an existing partitioning usable.
    """
    if how not in KINDS:
        raise ValueError(f"unknown join {how!r}; one of {sorted(KINDS)}")
    pairs = key_pairs(left, right, by)
    check_key_types(left, right, dict(pairs))
    right_names = {name: RIGHT_KEY.format(i) for i, (_, name) in enumerate(pairs)}
    on = [(name, right_names[other]) for name, other in pairs]
    condition = same_keys(on, na_matches)

    if how in ("semi", "anti"):
        lookup = right.select([F.col(quoted(b)).alias(right_names[b]) for _, b in pairs])
        return left.join(lookup, condition, KINDS[how])

    left_keys = [a for a, _ in pairs]
    left_rest = [c for c in left.columns if c not in left_keys]
    right_rest = [c for c in right.columns if c not in right_names]
    clash = set(left_rest) & set(right_rest)
    taken = set(left_keys)
    left_out = {c: c + suffixes[0] if c in clash else c for c in left_rest}
    right_out = {c: c + suffixes[1] if c in clash or c in taken else c for c in right_rest}
    first = left.select(
        [F.col(quoted(c)).alias(left_out.get(c, c)) for c in left.columns]
    )
    second = right.select(
        [F.col(quoted(b)).alias(right_names[b]) for _, b in pairs]
        + [F.col(quoted(c)).alias(right_out[c]) for c in right_rest]
    )
    outputs = [left_out.get(c, c) for c in left.columns] + [right_out[c] for c in right_rest]

    if how == "full":
        # A full outer join cannot split a hot key, its two halves can.
        matched = first.join(second, condition, "left").select([F.col(quoted(c)) for c in outputs])
        only_right = second.join(
            first.select([F.col(quoted(a)) for a in left_keys]), condition, "left_anti"
        )
        keys_back = {b: a for a, b in on}
        alone = only_right.select(
            [F.col(quoted(c)).alias(keys_back.get(c, c)) for c in only_right.columns]
        )
        return matched.unionByName(alone, allowMissingColumns=True)

    joined = first.join(second, condition, KINDS[how])
    if how == "right":
        source = dict(on)
        return joined.select(
            [F.col(quoted(source.get(c, c))).alias(c) for c in outputs]
        )
    return joined.select([F.col(quoted(c)) for c in outputs])


def measured_bytes(df: DataFrame) -> int:
    """Size of a table as text plus row overhead, a generous bound for its rows."""
    text = F.length(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])))
    return df.agg(F.coalesce(F.sum(text + ROW_BYTES), F.lit(0))).first()[0]


def attach(df: DataFrame, summary: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Join a summary of ``df`` back to its rows.

    Nothing runs until the result is asked for. Spark broadcasts a summary it knows or finds
    at run time to be small; otherwise adaptive execution splits the partitions of a hot key,
    of which the summary holds one row.
    """
    return join(df, summary, by=list(by), how=how)
