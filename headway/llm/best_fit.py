"""Best-fit packing of whole documents, certified by lower bounds.

Pieces are dealt to groups of bounded size and each group is packed by best-fit
decreasing. Dual feasible functions give a number of sequences that no packing of a group
can stay below; a group that reaches it is certified. A group with a gap gives up its open
sequences (those with room). So does a certified one whose tokens alone would fit into
fewer, since documents of other groups may fill its room; any other gives its emptiest one.
The documents of these are dealt anew, so that groups exchange them, and packed again, round
by round, until the whole packing reaches the bound of all lengths. A repacking that saves
no sequence is discarded.

Only lengths take part. A piece that fills a sequence by itself never moves; the ids of the
others meet their place in one join at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import encoder, slices, stored
from headway.llm.packing import id_bytes, widened

# Tokens a group is meant to hold; a piece counts for LEAST_TOKENS at least, which bounds
# a group's pieces too.
GROUP_TOKENS = 1 << 22
LEAST_TOKENS = 32
ROUNDS = 5
# Steps of the dual feasible functions that round lengths down to k-ths of the room.
STEPS = range(1, 24)
PIECES = "piece_id long, doc_id long, piece int, start long, length int, ids binary"
PLACED = "piece_id long, length int, sequence_id long, offset int, grp int, open boolean"


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, room: int, id_col: str, text_col: str, width: int) -> DataFrame:
    """Each document's ids (``width`` bytes each) and ``end_id``; one longer than ``room`` is
    cut into pieces of ``room`` ids, what is left over comes first. ``piece_id`` is unique."""

    def cut(batches):
        encode = encoder(tokenizer)
        made = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch):
                counts, flat = encode(part.column(1))
                ends = np.cumsum(counts)
                sizes = counts + 1
                pieces = -(-sizes // room)
                owner = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = sizes - (pieces - 1) * room
                start = np.where(number > 0, head[owner] + (number - 1) * room, 0)
                length = np.where(number > 0, room, head[owner])
                data = np.insert(flat, ends, np.uint32(end_id)).astype(f"<u{width}").tobytes()
                stops = width * np.r_[0, np.cumsum(length)]
                ids = pa.array([data[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(made + np.arange(len(owner)), pa.int64()),
                        part.column(0).take(pa.array(owner)),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int32()),
                        ids,
                    ],
                    ["piece_id", "doc_id", "piece", "start", "length", "ids"],
                )
                made += len(owner)

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("t")).mapInArrow(cut, PIECES)


def least_sequences(count: np.ndarray, room: int) -> int:
    """Sequences that any packing of ``count[size]`` pieces of each size needs, by dual
    feasible functions: whatever fits into one sequence adds up to at most 1 under each."""
    size = np.arange(room + 1)
    best = -(-int(count @ size) // room)
    # Above room - t: a sequence of its own; below t: nothing; as it is in between.
    for t in range(1, room // 2 + 1):
        value = np.where(size > room - t, room, np.where(size < t, 0, size))
        best = max(best, -(-int(count @ value) // room))
    # Rounded down to k-ths of the room, except where that is exact already.
    for k in STEPS:
        exact = size * (k + 1) % room == 0
        value = np.where(exact, size * k, size * (k + 1) // room * room)
        best = max(best, -(-int(count @ value) // (room * k)))
    return best


def histogram(lengths: DataFrame, room: int) -> np.ndarray:
    """Pieces of each length up to ``room``."""
    count = np.zeros(room + 1, np.int64)
    for row in lengths.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most room rows
        count[row["length"]] = row["n"]
    return count


def best_fit(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence of each piece, its offset, ids in each sequence) by best-fit decreasing;
    pieces of one length go in the order given."""
    order = np.argsort(-lengths, kind="stable")
    place, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(room + 1)]  # sequences by their room
    some, made = 0, 0  # some: bit r is set where a sequence has room r
    for at, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = some >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            sequence = with_room[left].pop()
            if not with_room[left]:
                some ^= 1 << left
        else:
            left, sequence, made = room, made, made + 1
        place[at], offset[at] = sequence, room - left
        left -= size
        if left:
            if not with_room[left]:
                some |= 1 << left
            with_room[left].append(sequence)
    return place, offset, np.bincount(place, lengths, made).astype(np.int64) if made else np.zeros(0, np.int64)


def packed_group(room: int):
    """A function that packs one group: a table of ``piece_id``, ``length``, and
    ``sequence_id``, ``offset`` of an earlier round (null in the first), ``grp``."""

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("piece_id")
        ids = group.column("piece_id").to_numpy()
        lengths = group.column("length").to_numpy().astype(np.int64)
        place, offset, filled = best_fit(lengths, room)
        earlier = group.column("sequence_id")
        if earlier.null_count == 0:
            _, before = np.unique(earlier.to_numpy(), return_inverse=True)
            if before.max() + 1 <= len(filled):
                place, offset = before, group.column("offset").to_numpy().astype(np.int64)
                filled = np.bincount(place, lengths).astype(np.int64)
        least = least_sequences(np.bincount(lengths, minlength=room + 1), room)
        settled = len(filled) == least == -(-int(lengths.sum()) // room)
        give = np.arange(len(filled)) == np.argmin(filled) if settled else np.full(len(filled), True)
        give &= filled < room
        names = np.full(len(filled), np.iinfo(np.int64).max)
        np.minimum.at(names, place, ids)  # a sequence bears the smallest id of its pieces
        arrays = [ids, lengths, names[place], offset, group.column("grp").to_numpy(), give[place]]
        return pa.Table.from_arrays(
            [pa.array(v, t) for v, t in zip(arrays, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()))],
            ["piece_id", "length", "sequence_id", "offset", "grp", "open"],
        )

    return pack


def placed(lengths: DataFrame, room: int, group_tokens: int = GROUP_TOKENS, rounds: int = ROUNDS) -> DataFrame:
    """``piece_id``, ``sequence_id`` (the smallest piece of the sequence), ``offset`` for
    ``piece_id``, ``length`` of pieces below ``room``.

    Each round deals the open sequences (first: the pieces) to as many groups as their tokens
    ask for, by another hash. It ends when the bound is reached, one group has held all that
    is open, or after ``rounds``; only sums and a histogram of lengths reach the driver.
    """
    spark = lengths.sparkSession
    weight = F.sum(F.greatest("length", F.lit(LEAST_TOKENS))).cast("long")
    turn = lengths.select("piece_id", "length", F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("int").alias("offset"))
    count, done, closed = histogram(lengths, room), [], 0
    least = least_sequences(count, room)
    for k in range(rounds):
        total = turn.agg(weight).first()[0]
        if not total:
            break
        groups = -(-total // group_tokens)
        dealt = turn.withColumn("grp", F.pmod(F.xxhash64(F.coalesce("sequence_id", "piece_id"), F.lit(k)), F.lit(groups)).cast("int"))
        made = stored(dealt.groupBy("grp").applyInArrow(packed_group(room), PLACED), f"packed-{k}")
        heads = {r["open"]: r["n"] for r in made.where("offset = 0").groupBy("open").agg(F.count("*").alias("n")).collect()}
        if groups == 1 or k == rounds - 1 or closed + sum(heads.values()) <= least:
            done.append(made)
            break
        closed += heads.get(False, 0)
        done.append(made.where("NOT open"))
        turn = made.where("open").select("piece_id", "length", "sequence_id", "offset")
    names = ["piece_id", "sequence_id", "offset"]
    if not done:
        return spark.createDataFrame([], "piece_id long, sequence_id long, offset int")
    out = done[0].select(*names)
    for part in done[1:]:
        out = out.unionByName(part.select(*names))
    return out


def pack_whole(
    docs: DataFrame, tokenizer: str, end_id: int, room: int = 1024, id_col: str = "doc_id", text_col: str = "text", group_tokens: int = GROUP_TOKENS
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (little-endian
    unsigned 32-bit), ``sequence_id``, ``offset`` in the sequence.

    Documents of up to ``room`` ids stay whole. A null or empty text is its end id alone;
    rows that share an id or have none are packed each for itself; an empty table gives no
    row. Other columns are left out, whatever their names. Sequences hold at most ``room``
    ids, offsets have no gaps.
    """
    width = id_bytes(tokenizer, end_id)
    made = stored(pieces_of(docs, tokenizer, end_id, room, id_col, text_col, width), "whole-pieces")
    full = made.where(F.col("length") == room).withColumns({"sequence_id": F.col("piece_id"), "offset": F.lit(0)})
    rest = made.where(F.col("length") < room)
    rest = rest.join(placed(rest.select("piece_id", "length"), room, group_tokens), "piece_id")
    ids = F.col("ids") if width == 4 else widened(F.col("ids"))
    return full.unionByName(rest).select(
        "doc_id", "piece", "start", F.col("length").cast("long"), ids.alias("ids"), "sequence_id", F.col("offset").cast("long")
    )


def certificate(packed: DataFrame, room: int = 1024) -> tuple[int, int]:
    """(sequences of a packing, least number any packing needs), from its histogram of
    lengths: at most ``room`` numbers reach the driver."""
    made = packed.agg(F.count_if(F.col("offset") == 0)).first()[0]
    return made, least_sequences(histogram(packed, room), room)
