"""Exact duplicates by counting quotient filters.

Each partition turns the 64-bit fingerprints of its texts into a counting quotient
filter: the high bits (quotient) pick a slot, the low bits (remainder) are kept sorted
within the slot's run, and a count stands beside a remainder met more than once.
Filters of one region of quotients merge without loss, since both sides are sorted.
A merged count above one sends the rows of that fingerprint to a comparison of the
whole texts; all others are unique without any text having been moved.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import ROW, packed, stored, text_of, unpacked

# Fingerprints that a merged region holds on average.
REGION_ROWS = 1 << 18
RESULTS = ["keep_id", "group_size", "kept", "text_sha256"]
FILTER_SCHEMA = "region long, occupied binary, run_ends binary, remainders binary, count_at binary, counts binary"


def normalised(text: Column) -> Column:
    """Each run of white space ``[\\x20\\x09-\\x0D]+`` as one space."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*| [\x20\x09-\x0D]+", " ")


def pack_filter(prints: np.ndarray, copies: np.ndarray, slot_bits: int, rest_bits: int) -> dict:
    """Filter of sorted distinct fingerprints that share the bits above the slot.

    ``occupied``: a bit for each quotient that has a run; ``run_ends``: a bit for each
    remainder that ends a run; ``count_at``, ``counts``: where a count is above one.
    """
    slot = (prints >> np.uint64(rest_bits)) & np.uint64((1 << slot_bits) - 1)
    occupied = np.zeros(1 << slot_bits, np.uint8)
    occupied[slot] = 1
    ends = np.r_[slot[1:] != slot[:-1], True]
    more = np.flatnonzero(copies > 1)
    return {
        "occupied": np.packbits(occupied).tobytes(),
        "run_ends": np.packbits(ends).tobytes(),
        "remainders": (prints & np.uint64((1 << rest_bits) - 1)).astype("<u8").tobytes(),
        "count_at": more.astype("<u4").tobytes(),
        "counts": copies[more].astype("<i8").tobytes(),
    }


def unpack_filter(region: int, f: dict, slot_bits: int, rest_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints and counts that ``pack_filter`` took."""
    rest = np.frombuffer(f["remainders"], "<u8").astype(np.uint64)
    used = np.flatnonzero(np.unpackbits(np.frombuffer(f["occupied"], np.uint8))).astype(np.uint64)
    ends = np.unpackbits(np.frombuffer(f["run_ends"], np.uint8))[: len(rest)]
    run = np.cumsum(ends) - ends
    high = (np.uint64(region) << np.uint64(slot_bits)) | used[run]
    copies = np.ones(len(rest), np.int64)
    copies[np.frombuffer(f["count_at"], "<u4")] = np.frombuffer(f["counts"], "<i8")
    return (high << np.uint64(rest_bits)) | rest, copies


def merge_sorted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted run of distinct fingerprints with added counts."""
    prints = np.concatenate([p for p, _ in parts])
    copies = np.concatenate([c for _, c in parts])
    order = np.argsort(prints, kind="stable")
    prints, copies = prints[order], copies[order]
    starts = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]]) if len(prints) else np.zeros(0, int)
    return prints[starts], np.add.reduceat(copies, starts) if len(starts) else copies


def repeated_prints(prints: DataFrame, rows: int) -> DataFrame:
    """(fingerprint long, copies long) of those met more than once in column ``print``."""
    region_bits = max(4, int(np.ceil(np.log2(max(rows, 1) / REGION_ROWS + 1))))
    slot_bits = 12
    rest_bits = 64 - region_bits - slot_bits

    def build(batches):
        parts = []
        for batch in batches:
            found = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            parts.append(np.unique(found, return_counts=True))
            if len(parts) > 16:
                parts = [merge_sorted(parts)]
        if not parts:
            return
        values, copies = merge_sorted(parts)
        regions = values >> np.uint64(64 - region_bits)
        starts = np.flatnonzero(np.r_[True, regions[1:] != regions[:-1]]) if len(values) else []
        for a, b in zip(starts, [*starts[1:], len(values)]):
            f = pack_filter(values[a:b], copies[a:b], slot_bits, rest_bits)
            yield pa.RecordBatch.from_pydict(
                {"region": pa.array([int(regions[a])], pa.int64())} | {k: pa.array([v], pa.binary()) for k, v in f.items()}
            )

    def merge(key, frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack_filter(int(key[0]), f, slot_bits, rest_bits) for f in frame.to_dict("records")]
        values, copies = merge_sorted(parts)
        more = copies > 1
        return pd.DataFrame({"print": values[more].view(np.int64), "copies": copies[more]})

    filters = prints.select("print").mapInArrow(build, FILTER_SCHEMA)
    return filters.groupBy("region").applyInPandas(merge, "print long, copies long")


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``keep_id`` (id of the row that stays for its text),
    ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after each white-space run became one space; a null
    text counts as empty. Of equal texts the smallest id stays (a missing id last). If
    several rows of one text carry that id, exactly one of them is kept. An empty table
    gives an empty result; input columns named like a result are replaced by it.
    """
    text = normalised(text_of(f"{ROW}.`{text_col}`"))
    rows = docs.select(packed(docs)).withColumn("whole", text).withColumn("print", F.xxhash64("whole"))
    repeated = stored(repeated_prints(rows.select("print"), docs.count()), "prints")

    digest = F.sha2(F.col("whole").cast("binary"), 256).alias("text_sha256")
    single = (
        rows.select("print", ROW, digest)
        .join(repeated, "print", "left_anti")
        .select(
            ROW,
            F.col(ROW)[id_col].alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
            "text_sha256",
        )
    )
    # The number of a routed row tells apart rows that share id and text; it is fixed by the store.
    routed = stored(
        rows.join(repeated, "print", "left_semi").select(ROW, "print", "whole", digest, F.monotonically_increasing_id().alias("number")),
        "routed",
    )
    id_ = F.col(ROW)[id_col]
    groups = routed.groupBy("print", "whole").agg(
        F.min(F.struct(id_.isNull().alias("none"), id_.alias("id"), F.col("number"))).alias("first"),
        F.count("*").alias("group_size"),
    )
    checked = routed.join(groups, ["print", "whole"]).select(
        ROW,
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("number") == F.col("first.number")).alias("kept"),
        "text_sha256",
    )
    return unpacked(single.unionByName(checked), docs.columns, RESULTS)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns only."""
    marked = exact_copies(docs.select(packed(docs), docs[id_col], docs[text_col]), id_col, text_col)
    return marked.filter("kept").select(f"{ROW}.*")
