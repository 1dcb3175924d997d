"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Every document of a source expects the same number of copies, target / size of the
source. Laid end to end, the expected copies of a source's documents make a line; one
offset is added and a document is emitted once for each whole number its stretch
crosses. Within a source documents lie by size class, so each class is thinned or
repeated evenly. A few long documents can still carry a small source off its target: of
the random offset and its shifts by 32nds, each source gets the one that comes nearest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import ROW, packed, text_of, unpacked, words

RESULTS = ["size", "source_size", "target", "copies", "taken"]
OFFSET = 0.3819660112501051
SHIFTS = 32
# Hex digits of a shard: size classes are split so that none, however full, is one group.
SHARD_DIGITS = 3


def size_class(size: Column) -> Column:
    """Eight classes for each doubling of the size."""
    bits = F.length(F.bin(size))
    return F.when(size < 16, size).otherwise(bits * 16 + F.call_function("shiftright", size, bits - 4)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], repeat: float) -> DataFrame:
    """(source, source_size) -> also ``target``: all words shared by weight, none above
    ``repeat`` times its own size, the excess reshared by weight.

    With sources sorted by size over weight, the limited ones come first: a source is
    limited while ``repeat * size`` is below its share of what the sources before left.
    One row per source meets in one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    up = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    ranked = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    )
    level = (F.sum("source_size").over(every) - repeat * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    limited = ranked.withColumn("level", level).withColumn(
        "limited", F.col("source_size") * repeat <= F.col("level") * F.col("weight")
    )
    # Past the first unlimited source the level only falls: the largest is the one that holds.
    share = F.max(F.when(~F.col("limited"), F.col("level"))).over(every)
    return limited.select(
        "source",
        "source_size",
        F.when(F.col("limited"), F.col("source_size") * repeat).otherwise(share * F.col("weight")).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    repeat: float = 3.0,
    offset: float = OFFSET,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Every row of ``docs`` with ``size`` (words), ``source_size``, ``target`` of its
    source, ``copies`` the mix holds of it and ``taken`` (copies times size).

    A null text has size 0; a null source is a source, the last. A source without words
    has target 0 and gives no copies. Rows that tie in id and size are ordered by text,
    so only identical ones are interchangeable. Input columns named like a result are
    replaced by it.
    """
    row = F.col(ROW)
    sized = (
        docs.select(packed(docs))
        .select(
            ROW,
            row[source_col].alias("source"),
            F.size(words(text_of(f"{ROW}.`{text_col}`"))).cast("long").alias("size"),
            F.substring(F.md5(F.coalesce(row[id_col].cast("string"), F.lit(""))), 1, SHARD_DIGITS).alias("shard"),
            row[id_col].alias("id"),
            F.xxhash64(row[text_col]).alias("tie"),
        )
        .withColumn("class", size_class(F.col("size")))
    )
    # Keys without nulls: the join below then keeps the partitioning of the ranking.
    group = ["none", "key", "class", "shard"]
    sized = sized.withColumn("none", F.col("source").isNull()).withColumn("key", F.coalesce("source", F.lit("")))
    counts = sized.groupBy(*group).agg(F.first("source").alias("source"), F.count("*").alias("rows"), F.sum("size").alias("words"))
    targets = source_targets(
        counts.groupBy("source").agg(F.sum("words").alias("source_size")), list(weights), float(repeat)
    )
    targets = targets.withColumn("none", F.col("source").isNull()).withColumn("key", F.coalesce("source", F.lit(""))).drop("source")
    line = Window.partitionBy("none", "key").orderBy("class", "shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(*group, F.coalesce(F.sum("rows").over(line), F.lit(0)).alias("before"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    starts = firsts.join(targets, ["none", "key"]).withColumn("rate", rate)
    inside = Window.partitionBy(*group).orderBy("size", F.col("id").asc_nulls_first(), "tie")
    ranked = sized.withColumn("rank", F.row_number().over(inside)).drop("source")

    def crossed(start) -> Column:
        at = F.col("before") + F.col("rank")
        return (F.floor(start + F.col("rate") * at) - F.floor(start + F.col("rate") * (at - 1))).cast("long")

    # The best shift of each source, from sizes alone; rows are moved once, for the ranking.
    shifts = [(offset + k / SHIFTS) % 1.0 for k in range(SHIFTS)]
    light = ranked.select(*group, "size", "rank").join(starts, group)
    sums = light.groupBy("none", "key", "target").agg(*[F.sum(F.col("size") * crossed(F.lit(u))).alias(f"t{k}") for k, u in enumerate(shifts)])
    miss = F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")), F.lit(k), F.lit(u).alias("start")) for k, u in enumerate(shifts)])
    best = sums.select("none", "key", F.array_min(miss)["start"].alias("start"))
    result = ranked.join(starts.join(best, ["none", "key"]), group).withColumn("copies", crossed(F.col("start")))
    return unpacked(result.withColumn("taken", F.col("copies") * F.col("size")), docs.columns, RESULTS)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, own columns only."""
    names = {k: options.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))}
    marked = mix(docs.select(packed(docs), *[docs[c] for c in names.values()]), **options)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return marked.filter("copies > 0").select(ROW, copies).select(f"{ROW}.*")
