"""Packing token sequences by column generation for the cutting-stock problem.

Documents are cut at multiples of the sequence length; the pieces' lengths, rounded up
to classes of a few tokens, make a histogram of bounded size. A linear program over
patterns (how many pieces of each class share a sequence) is solved by column
generation: a knapsack dynamic program finds the pattern of the best price until none
pays. Patterns are used a whole number of times; the few pieces left fill sequences from
the largest down, one piece being cut where room stays. Pieces are then ranked within
their class and the ranks dealt out to the patterns.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import encoder, slices, small_batches, stored

GRAIN = 4
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def best_pattern(prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of sizes 1..room (prices[size])."""
    best, pick = np.zeros(room + 1), np.zeros(room + 1, int)
    for c in range(1, room + 1):
        gain = prices[1 : c + 1] + best[c - 1 :: -1][:c]
        k = int(np.argmax(gain))
        if gain[k] > best[c - 1]:
            best[c], pick[c] = gain[k], k + 1
        else:
            best[c] = best[c - 1]
    counts, c = np.zeros(room + 1, int), room
    while c > 0:
        if pick[c]:
            counts[pick[c]] += 1
            c -= pick[c]
        else:
            c -= 1
    return float(best[room]), counts


def solve_patterns(need: dict[int, int], room: int, gap: float = 1e-3, steps: int = 3000) -> list[tuple[np.ndarray, float]]:
    """Patterns and fractional uses that cover ``need`` (size -> pieces) with the fewest
    sequences, within ``gap`` of the bound that the last pricing proves."""
    sizes = np.array(sorted(need))
    m = len(sizes)
    want = np.array([need[s] for s in sizes], float)
    columns = np.zeros((room + 1, m))
    for k, s in enumerate(sizes):
        columns[s, k] = room // s
    basis = columns[sizes]  # rows: sizes, columns: patterns in use
    inverse = np.diag(1.0 / np.diag(basis))
    use = inverse @ want
    patterns = [columns[:, k] for k in range(m)]
    for _ in range(steps):
        prices = np.zeros(room + 1)
        prices[sizes] = np.maximum(inverse.sum(0), 0)
        value, counts = best_pattern(prices, room)
        if value <= 1 + gap:
            break
        step = inverse @ counts[sizes]
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        use = np.maximum(use - ratio[out] * step, 0)
        use[out] = ratio[out]
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        patterns[out] = counts
    return list(zip(patterns, use))


def fill_rest(left: Counter, room: int) -> list[tuple[list[int], int, tuple[int, int] | None]]:
    """Sequences for what whole uses leave: the largest pieces that fit, one after the
    other; room that stays is filled by the head of one more piece, whose tail opens the
    next sequence. Each is (whole pieces, units of the tail, (size cut, units of its head))."""
    left, made, tail = Counter(left), [], 0
    while left or tail:
        space, whole, cut = room - tail, [], None
        for size in sorted(left, reverse=True):
            n = min(left[size], space // size)
            whole += [size] * n
            space -= n * size
            left[size] -= n
        left += Counter()
        if space and left:
            size = min(left)  # above the space, or it would have been placed
            left[size] -= 1
            left += Counter()
            cut = (size, space)
        made.append((whole, tail, cut))
        tail = cut[0] - cut[1] if cut else 0
    return made


def plan(histogram: dict[int, int], room: int) -> list[tuple[int, int, int, int, int]]:
    """Where the ranks of each class go: (class, pieces a sequence, sequences, first
    sequence, units of a head that is cut off and stays there, its tail going to the next
    sequence; 0: not cut). Ranks are dealt in the order of the list."""
    left, dealt, sequence = Counter({s: n for s, n in histogram.items() if n}), [], 0
    for counts, use in sorted(solve_patterns(dict(left), room) if left else [], key=lambda p: -p[1]):
        pattern = {int(s): int(counts[s]) for s in np.flatnonzero(counts)}
        times = min([int(use + 1e-9), *(left[s] // n for s, n in pattern.items())])
        if times > 0:
            dealt += [(s, n, times, sequence, 0) for s, n in pattern.items()]
            left -= Counter({s: n * times for s, n in pattern.items()})
            sequence += times
    for whole, _, cut in fill_rest(left, room):
        dealt += [(s, n, 1, sequence, 0) for s, n in Counter(whole).items()]
        if cut:
            dealt.append((cut[0], 1, 1, sequence, cut[1]))
        sequence += 1
    return dealt


def id_bytes(tokenizer: str, end_id: int) -> int:
    """Bytes that hold every id while pieces move: two if they do, else four."""
    largest = max(end_id, *encoder(tokenizer).tokenizer.get_vocab().values())
    return 2 if largest < 1 << 16 else 4


def widened(ids: Column) -> Column:
    """Ids of two bytes as ids of four."""

    def widen(packed: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in packed.to_pylist()], pa.binary())

    return F.arrow_udf(widen, "binary")(ids)


def pieces_of(
    docs: DataFrame, tokenizer: str, end_id: int, length: int, id_col: str = "doc_id", text_col: str = "text", width: int = 4
) -> DataFrame:
    """Each document's ids (``width`` bytes each) and ``end_id``, cut at multiples of ``length``."""

    def cut(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, 1000, 1 << 20):
                counts, flat = encode(part.column(1))
                ends = np.cumsum(counts)
                rows = [[], [], [], [], []]
                for owner, a, b in zip(part.column(0).to_pylist(), (ends - counts).tolist(), ends.tolist()):
                    ids = np.append(flat[a:b], np.uint32(end_id)).astype(f"<u{width}")
                    for at in range(0, len(ids), length):
                        piece = ids[at : at + length]
                        for column, v in zip(rows, (owner, at, len(piece), len(ids), piece.tobytes())):
                            column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in rows[:4]), pa.array(rows[4], pa.binary())],
                    ["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("t")).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``ids``
    (little-endian unsigned 32-bit), ``sequence_id``, ``offset`` in the sequence.

    A null or empty text is its end id alone; rows that share an id are packed each for
    itself; an empty table gives no row. Sequences hold at most ``length`` ids, offsets
    have no gaps.
    """
    spark = docs.sparkSession
    small_batches(spark)
    width = id_bytes(tokenizer, end_id)
    made = stored(pieces_of(docs, tokenizer, end_id, length, id_col, text_col, width), "pieces")
    units = F.ceil(F.col("length") / GRAIN).cast("int")
    histogram = {r["units"]: r["n"] for r in made.groupBy(units.alias("units")).agg(F.count("*").alias("n")).collect()}

    dealt: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    for size, each, times, sequence, head in plan(histogram, -(-length // GRAIN)):
        dealt.setdefault(size, []).append((ranks[size], each, sequence, head * GRAIN))
        ranks[size] += each * times
    deal = spark.createDataFrame(
        list(dealt.items()), "units int, deal array<struct<rank:long,each:long,sequence:long,head:int>>"
    )

    # A class may hold most pieces: it is ranked in salted parts, whose counts are added up.
    salts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = made.withColumn("units", units).withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids"), F.lit(salts)))
    part = Window.partitionBy("units", "salt").orderBy("doc_id", "start", "ids")
    line = Window.partitionBy("units").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy("units", "salt").agg(F.count("*").alias("n"))
    starts = counts.select("units", "salt", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("before"))
    # At most one row per class, at most length / GRAIN classes.
    starts = starts.join(F.broadcast(deal), "units")
    rank = F.col("before") + F.col("inside") - 1
    mine = F.element_at(F.filter("deal", lambda d: d["rank"] <= F.col("rank")), -1)
    placed = (
        salted.withColumn("inside", F.row_number().over(part))
        .join(starts, ["units", "salt"])
        .withColumn("rank", rank)
        .withColumn("mine", mine)
        .withColumn("sequence_id", F.expr("mine.sequence + (rank - mine.rank) div mine.each"))
    )
    tail = F.struct(
        (F.col("start") + F.col("mine.head")).alias("start"),
        (F.col("length") - F.col("mine.head")).alias("length"),
        F.expr(f"substring(ids, {width} * mine.head + 1)").alias("ids"),
        (F.col("sequence_id") + 1).alias("sequence_id"),
    )
    head = F.struct(
        "start", F.col("mine.head").cast("long").alias("length"), F.expr(f"substring(ids, 1, {width} * mine.head)").alias("ids"), "sequence_id"
    )
    whole = F.struct("start", "length", "ids", "sequence_id")
    parts = F.when(F.col("mine.head") == 0, F.array(whole)).otherwise(F.array(head, tail))
    cut = placed.select("doc_id", "doc_tokens", F.explode(parts).alias("part")).select("doc_id", "doc_tokens", "part.*")
    within = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "doc_id", "start")
    before = F.coalesce(F.sum("length").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ids = F.col("ids") if width == 4 else widened(F.col("ids"))
    placed = cut.select("doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", before.alias("offset"))
    return placed.withColumn("ids", ids)
