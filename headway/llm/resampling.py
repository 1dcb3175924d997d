"""Importance resampling of raw text towards a target.

Word unigrams and bigrams hash into buckets; target and raw text each have a generative
model over the buckets, counted over all their documents. A document's weight is the mean
log ratio of the two models over its n-grams, times a fixed number of n-grams (STRENGTH),
so that long texts weigh no more than short ones; the ratio of the models of the whole
document, the sum, would let its length alone decide. Adding Gumbel noise and keeping the largest sums
samples documents without replacement in proportion to their weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import ROW, packed, slices, stored, unpacked
from headway.llm.near_copies import mixed_bits

BUCKETS = 1 << 14
STRENGTH = 20.0
# Most ids of target documents that the target model is fitted on.
TARGET_ROWS = 200_000
RESULTS = ["log_weight", "draw", "kept"]


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, its text) for lower-case words and pairs of words."""
    import xxhash

    lists = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    flat = lists.flatten()
    full = np.asarray(pc.not_equal(flat, ""), bool)
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))[full]
    coded = flat.dictionary_encode()
    names = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    one = names[coded.indices.to_numpy(zero_copy_only=False)[full]]
    inside = owner[1:] == owner[:-1]
    two = mixed_bits(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:])[inside]
    buckets = np.concatenate([one, two]) & np.uint64(BUCKETS - 1)
    return buckets.astype(np.int64), np.concatenate([owner, owner[:-1][inside]])


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n, aimed): n-grams of all texts and of the aimed ones, in one pass; each task
    adds up its own first."""

    def count(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for part in slices(batch):
                buckets, owner = grams(part.column(0))
                aimed = np.asarray(part.column(1), bool)
                total[0] += np.bincount(buckets, minlength=BUCKETS)
                total[1] += np.bincount(buckets[aimed[owner]], minlength=BUCKETS)
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (used, total[0][used], total[1][used])], ["bucket", "n", "aimed"])

    made = texts.select("text", "aimed").mapInArrow(count, "bucket long, n long, aimed long")
    return made.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("aimed").alias("aimed"))


def log_ratios(texts: DataFrame) -> np.ndarray:
    """Log ratio of the two models for each bucket, one added to each count; BUCKETS numbers."""
    counts = np.ones((2, BUCKETS))
    for row in bucket_counts(texts).collect():  # one row per bucket
        counts[:, row["bucket"]] += row["n"], row["aimed"]
    raw, aimed = np.log(counts / counts.sum(1, keepdims=True))
    return aimed - raw


def marked(docs: DataFrame, target: DataFrame, id_col: str, text_col: str, most: int = TARGET_ROWS) -> DataFrame:
    """``text`` and ``aimed`` of each row: whether its id is among those of ``target``.

    The target model is fitted on at most ``most`` ids, those of smallest hash; this bounds
    what is broadcast (16 bytes an id) at every size, so the texts never move. A null id is
    in no target; repeated ids count once.
    """
    ids = target.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    few = ids.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(most).withColumn("found", F.lit(True))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(few), "id", "left").select("text", F.coalesce("found", F.lit(False)).alias("aimed"))


def resample(docs: DataFrame, target: DataFrame, fraction: float, seed: int = 11, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``log_weight``, ``draw`` (weight plus noise) and ``kept``;
    the rows whose id is in ``target`` are the target (see ``marked``).

    ``kept`` marks the ``floor(fraction * rows)`` rows of largest draw. Null and wordless texts
    have no n-gram; they get the smallest weight and are never kept. The noise is a function of
    id, text and seed: reruns agree, and rows that tie with the last one kept (equal in id
    and text) are kept too. An empty target equals the raw model smoothed: all
    weights come from counts alone. Input columns named like a result are replaced by it.
    """
    ratio = log_ratios(marked(docs, target, id_col, text_col))

    def weigh(texts: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, len(texts), 2000):
            part = texts.slice(at, 2000)
            buckets, owner = grams(part)
            n = np.bincount(owner, minlength=len(part))
            mean = np.bincount(owner, ratio[buckets], len(part)) / np.maximum(n, 1)
            parts.append(pa.array(np.where(n > 0, STRENGTH * mean, 0.0), mask=n == 0))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.float64())

    def run(texts: pa.Array) -> pa.Array:
        return weigh(texts)

    row = F.col(ROW)
    rows = docs.select(packed(docs)).withColumn("log_weight", F.arrow_udf(run, "double")(row[text_col]))
    chance = (F.pmod(F.xxhash64(row[id_col].cast("string"), row[text_col], F.lit(seed)), F.lit(2**52)) + 0.5) / float(2**52)
    drawn = rows.withColumn("draw", F.col("log_weight") - F.log(-F.log(chance)))
    light = stored(drawn.select("draw"), "draws")
    limit = int(fraction * docs.count())
    bound = nth_largest(light.where("draw is not null"), limit)
    kept = F.coalesce(F.col("draw") >= F.lit(bound), F.lit(False)) if bound is not None else F.lit(False)
    return unpacked(drawn.withColumn("kept", kept), docs.columns, RESULTS)


def nth_largest(draws: DataFrame, n: int) -> float | None:
    """The n-th largest value of a column of doubles, found by narrowing a histogram of
    4,096 cells until a cell is one value or few rows; only counts reach the driver."""
    low, high, rows = draws.agg(F.min("draw"), F.max("draw"), F.count("*")).first()
    if n <= 0 or not rows:
        return None
    if n >= rows:
        return low
    while True:
        step = (high - low) / 4096
        inside = draws.where(F.col("draw").between(low, high))
        if step <= 0 or low + step == low or inside.count() <= 4096:
            values = sorted((r[0] for r in inside.orderBy(F.desc("draw")).limit(max(n, 1) if n <= 4096 else 4096).collect()), reverse=True)
            return values[min(n, len(values)) - 1]
        cell = F.least(F.floor((F.col("draw") - low) / step), F.lit(4095))
        cells = {r["cell"]: r for r in inside.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min("draw").alias("a"), F.max("draw").alias("b")).collect()}
        for c in sorted(cells, reverse=True):
            if n <= cells[c]["n"]:
                low, high = cells[c]["a"], cells[c]["b"]
                break
            n -= cells[c]["n"]
