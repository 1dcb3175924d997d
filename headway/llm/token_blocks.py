"""Token ids in patched frame-of-reference blocks.

A block holds up to 1,024 ids: the smallest id is subtracted, the rest are packed at
the width that fits a percentile of them, and the few that need more bits are stored
whole in an exception list. Segments of whole documents carry the byte at which each of
their blocks starts, so any id is reached by opening one block.

File format, one row per segment: ``shard`` and ``segment`` give the order, ``first``
the ids before it in its shard, ``doc_ids`` and ``doc_tokens`` its documents, ``n_ids``
its ids, ``block_starts`` byte offsets into ``blocks``. A block is little-endian:
minimum u32, ids u16, exceptions u16, width u8, packed low bits, then positions u16 and
values u32 (both above the minimum) of the exceptions.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import encoder, slices

BLOCK = 1024
# A segment is closed once it holds so many ids; a document is never split.
SEGMENT_IDS = 128 * BLOCK
PERCENTILE = 95
HEAD = struct.Struct("<IHHB")
SEGMENTS = pa.schema(
    [
        ("shard", pa.int32()),
        ("segment", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
        ("block_starts", pa.list_(pa.int64())),
        ("blocks", pa.binary()),
    ]
)
SEGMENT_DDL = (
    "shard int, segment int, first long, n_ids long, doc_ids array<long>, doc_tokens array<long>, "
    "block_starts array<long>, blocks binary"
)


def pack_blocks(ids: np.ndarray) -> tuple[list[int], bytes]:
    """Block starts and bytes of any number of ids."""
    full = len(ids) // BLOCK
    packs: list[bytes | None] = [None] * (full + (len(ids) % BLOCK > 0))
    for first, table in ((0, ids[: full * BLOCK].reshape(full, BLOCK)), (full, ids[full * BLOCK :][None])):
        if not table.size:
            continue
        low = table.min(1)
        rest = table - low[:, None]
        at = np.percentile(rest, PERCENTILE, axis=1, method="higher").astype(np.uint64)
        widths = np.ceil(np.log2(at + np.uint64(1))).astype(int)
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            part = rest[rows]
            bits = (part[:, :, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
            body = np.packbits(bits.astype(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
            over = part >> np.uint32(width) if width < 32 else np.zeros_like(part)
            for k, row in enumerate(rows):
                where = np.flatnonzero(over[k])
                packs[first + row] = b"".join(
                    (
                        HEAD.pack(int(low[row]), table.shape[1], len(where), int(width)),
                        body[k].tobytes(),
                        where.astype("<u2").tobytes(),
                        part[k][where].astype("<u4").tobytes(),
                    )
                )
    starts = np.cumsum([0, *map(len, packs)])[:-1].tolist() if packs else []
    return starts, b"".join(packs)


def unpack_block(blocks: bytes, start: int) -> np.ndarray:
    """Ids of the block that starts at a byte."""
    low, n, exceptions, width = HEAD.unpack_from(blocks, start)
    at = start + HEAD.size
    held = -(-n * width // 8)
    ids = np.zeros(n, np.uint32)
    if width:
        bits = np.unpackbits(np.frombuffer(blocks, np.uint8, held, at), count=n * width, bitorder="little")
        wide = np.zeros((n, 32), np.uint8)
        wide[:, :width] = bits.reshape(n, width)
        ids = np.packbits(wide, axis=1, bitorder="little").view("<u4")[:, 0].astype(np.uint32)
    if exceptions:
        where = np.frombuffer(blocks, "<u2", exceptions, at + held)
        ids[where] = np.frombuffer(blocks, "<u4", exceptions, at + held + 2 * exceptions)
    return ids + np.uint32(low)


def token_segments(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of the file format above, in ascending order of the id.

    Each text's ids are followed by ``end_id``. A null text is empty; rows that share an
    id follow each other by text, those without id come first. An empty table gives no
    segment.
    """

    def pack(batches):
        encode, shard = encoder(tokenizer), TaskContext.get().partitionId()
        ids, owners, sizes = [], [], []
        segment = first = held = 0

        def close():
            starts, blocks = pack_blocks(np.concatenate([*ids, np.zeros(0, np.uint32)]))
            row = (shard, segment, first, held, owners, sizes, starts, blocks)
            return pa.RecordBatch.from_pydict({f.name: pa.array([v], f.type) for f, v in zip(SEGMENTS, row)})

        for batch in batches:
            for part in slices(batch):
                counts, flat = encode(part.column(1))
                ends = np.cumsum(counts)
                for owner, a, b in zip(part.column(0).to_pylist(), (ends - counts).tolist(), ends.tolist()):
                    ids += [flat[a:b], np.array([end_id], np.uint32)]
                    owners.append(owner)
                    sizes.append(b - a + 1)
                    held += b - a + 1
                    if held >= SEGMENT_IDS:
                        yield close()
                        segment, first, held = segment + 1, first + held, 0
                        ids, owners, sizes = [], [], []
        if owners:
            yield close()

    ordered = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    ordered = ordered.repartitionByRange("id").sortWithinPartitions("id", "text")
    return ordered.mapInArrow(pack, SEGMENT_DDL)


def read_documents(segments: DataFrame) -> DataFrame:
    """Documents of stored segments: ``doc_id``, ``start`` (ids of all documents before
    it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""

    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                flat = np.concatenate([unpack_block(row["blocks"], s) for s in row["block_starts"]])
                sizes = np.array(row["doc_tokens"])
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([row["shard"]] * len(sizes), pa.int32()),
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "local": pa.array(row["first"] + ends - sizes, pa.int64()),
                        "n_tokens": pa.array(sizes, pa.int64()),
                        "ids": pa.array([flat[e - n : e].astype("<u4").tobytes() for e, n in zip(ends, sizes)], pa.binary()),
                    }
                )

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # one row per partition that wrote: few enough to send to every task
        segments.groupBy("shard")
        .agg(F.sum("n_ids").alias("n"))
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    docs = segments.mapInArrow(unpack, "shard int, doc_id long, local long, n_tokens long, ids binary")
    return docs.join(F.broadcast(offsets), "shard").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids")
