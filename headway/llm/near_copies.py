"""Near duplicates by b-bit MinHash.

A document is its set of word shingles, a set is 240 minima of which only the low four
bits are kept and packed; 40 hashes of six whole minima each are its bands. Sets that
share a band are candidates; the share of equal four-bit values, corrected for the
values that agree by chance, estimates their similarity, and what may reach the wanted
similarity is confirmed on the full sets. Links join sets to groups.

Equal sets are one set from the start, so copies cost nothing. A band's bucket is not
expanded into pairs: first each set is compared with the sets that lead its buckets;
then only buckets whose sets are still in different groups are looked at again, pairs of
different groups, in blocks, until no bucket holds an untested pair of two groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import ROW, packed, slices, small_batches, stored, unpacked

HASHES, BAND_ROWS, LOW_BITS = 240, 6, 4
# Minima of the longer signature that sets in unsettled buckets get for a closer estimate.
FINE_HASHES = 2048
# Standard deviations of the estimate by which a candidate may fall short of the wanted
# similarity before it is given up without looking at the full sets.
MARGIN = 4.5
BLOCK_SETS = 256
RESULTS = ["n_shingles", "component_id", "kept", "first"]

_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 2**64, FINE_HASHES, np.uint64) | np.uint64(1)
_TERMS = _RANDOM.integers(0, 2**64, FINE_HASHES, np.uint64)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _folded(parts: list[np.ndarray]) -> np.ndarray:
    code = np.zeros_like(parts[0])
    for part in parts:
        code = mixed_bits(code * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(1))
    return code


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's ``width``-word shingles; of fewer
    words the whole sequence is one, of none nothing."""
    import xxhash

    spaced = pc.ascii_lower(pc.fill_null(texts, ""))
    lists = pc.ascii_split_whitespace(spaced)
    coded = lists.flatten().dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64)
    flat = hashes[coded.indices.to_numpy(zero_copy_only=False)]
    full = np.asarray(pc.not_equal(lists.flatten(), ""))  # leading or trailing white space leaves an empty word
    bounds = np.r_[0, np.cumsum(full)][lists.offsets.to_numpy()]
    flat = flat[full]
    n = len(flat) - width + 1
    whole = _folded([flat[k : k + n] for k in range(width)]) if n > 0 else np.zeros(0, np.uint64)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            sets.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            sets.append(_folded([flat[k : k + 1] for k in range(a, b)]))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minima(shingles: np.ndarray, hashes: int) -> np.ndarray:
    least = np.full(hashes, np.uint64(2**64 - 1))
    step = max(1, (1 << 19) // hashes)
    for at in range(0, len(shingles), step):
        some = shingles[at : at + step]
        least = np.minimum(least, (some[None, :] * _FACTORS[:hashes, None] + _TERMS[:hashes, None]).min(1))
    return least


def packed_bits(least: np.ndarray) -> bytes:
    """The low bits of the mixed minima: those of the minima themselves depend on the low
    bits of the shingle alone, and two shingles would agree in all hashes or in none."""
    low = (mixed_bits(least) & np.uint64(2**LOW_BITS - 1)).astype(np.uint8)
    return ((low[0::2] << 4) | low[1::2]).tobytes()


def signature(shingles: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(packed low bits of the minima, band hashes) of a set that isn't empty."""
    least = minima(shingles, HASHES)
    table = least.reshape(-1, BAND_ROWS)
    bands = _folded([np.arange(len(table), dtype=np.uint64), *table.T])
    return packed_bits(least), bands.view(np.int64)


def estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity from packed signatures (rows of bytes): the share of equal values less
    what agrees by chance."""
    differ = left ^ right
    equal = ((differ & 0xF0) == 0).sum(-1, dtype=np.int32) + ((differ & 0x0F) == 0).sum(-1, dtype=np.int32)
    chance = 2.0**-LOW_BITS
    return (equal / (2 * differ.shape[-1]) - chance) / (1 - chance)


def least_estimate(similarity: float, hashes: int) -> float:
    chance = 2.0**-LOW_BITS
    agree = similarity + (1 - similarity) * chance
    return float(similarity - MARGIN * np.sqrt(agree * (1 - agree) / hashes) / (1 - chance))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on full sets."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def described(rows: DataFrame, width: int) -> DataFrame:
    """(row..., text) -> row, print, n_shingles, set_id (null for an empty set), low_bits, bands."""

    def describe(batches):
        import xxhash

        for batch in batches:
            for part in slices(batch, 1000, 1 << 22):
                sets = shingle_sets(part.column("text"), width)
                names = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                made: dict[bytes, tuple] = {n: signature(s) for n, s in zip(names, sets) if n}
                none = (None, None)
                found = [made[n] if n else none for n in names]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("print"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(names, pa.binary()),
                        pa.array([x[0] for x in found], pa.binary()),
                        pa.array([x[1] for x in found], pa.list_(pa.int64())),
                    ],
                    ["id", "print", "n_shingles", "set_id", "low_bits", "bands"],
                )

    return rows.mapInArrow(describe, "id long, print long, n_shingles long, set_id binary, low_bits binary, bands array<long>")


def likely(pairs: DataFrame, low_bits: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of sets whose estimate leaves the similarity possible."""
    bound = least_estimate(similarity, HASHES)

    def keep(batches):
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES // 2) for c in ("a_bits", "b_bits"))
            yield batch.filter(pa.array(estimates(left, right) >= bound)).select(["a", "b"])

    sides = pairs.join(low_bits.select(F.col("set_id").alias("a"), F.col("low_bits").alias("a_bits")), "a")
    sides = sides.join(low_bits.select(F.col("set_id").alias("b"), F.col("low_bits").alias("b_bits")), "b")
    return sides.select("a", "b", "a_bits", "b_bits").mapInArrow(keep, "a binary, b binary")


def full_sets(needed: DataFrame, about: DataFrame, rows: DataFrame, width: int, fine: bool = False) -> DataFrame:
    """(set_id, shingles, low_bits) of the needed set ids, made from one text of each
    again; ``low_bits`` is the longer signature if ``fine``, else null."""
    prints = about.join(needed, "set_id", "left_semi").groupBy("set_id").agg(F.min("print").alias("print")).select("print")

    def make(batches):
        import xxhash

        for batch in batches:
            for part in slices(batch, 1000, 1 << 22):
                sets = shingle_sets(part.column(0), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                        pa.array([packed_bits(minima(s, FINE_HASHES)) if fine else None for s in sets], pa.binary()),
                    ],
                    ["set_id", "shingles", "low_bits"],
                )

    texts = rows.join(prints.distinct(), "print", "left_semi").select("text")
    return texts.mapInArrow(make, "set_id binary, shingles binary, low_bits binary").dropDuplicates(["set_id"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar on their full sets."""

    def check(batches):
        for batch in batches:
            for part in slices(batch, 500):
                sides = zip(part.column("a_set").to_pylist(), part.column("b_set").to_pylist())
                fine = [similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in sides]
                yield part.filter(pa.array(fine, pa.bool_())).select(["a", "b"])

    both = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("a_set")), "a")
    both = both.join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("b_set")), "b")
    return both.select("a", "b", "a_set", "b_set").mapInArrow(check, "a binary, b binary")


def groups_of(links: DataFrame) -> DataFrame:
    """(set_id, label): the smallest set id reachable over the links (a, b), of each set
    that has one. Large and small stars in turn, each an aggregation and a join."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    size = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least.select("a", F.least("a", "m").alias("m")), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(least, "a")
        small = down.select("a", F.col("m").alias("b")).unionByName(down.select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = stored(small.where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.countDistinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == size:
            break
        size = tuple(now)
        if now[0] == now[1] and edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break  # each set has one label, no label has one itself
    return edges.select(F.col("a").alias("set_id"), F.col("b").alias("label"))


def labelled(table: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """``table`` with the label of column ``name`` as ``<name>_label``; alone: itself."""
    found = labels.select(F.col("set_id").alias(name), F.col("label").alias("_label"))
    return table.join(found, name, "left").withColumn(f"{name}_label", F.coalesce("_label", name)).drop("_label")


def across(members: DataFrame, labels: DataFrame, bits: DataFrame, similarity: float, best: bool) -> DataFrame:
    """Likely pairs (a, b) of different groups among ``members`` of the same bucket; with
    ``best``, of a member's pairs with one group in a block only those of the best estimate.

    Members outside a bucket's largest group meet all its members, block by block: a task
    holds two blocks of about ``BLOCK_SETS`` long signatures at a time.
    """
    bound = least_estimate(similarity, FINE_HASHES)
    marked = labelled(members.select("band", "set_id"), labels, "set_id")
    shares = marked.groupBy("band", "set_id_label").agg(F.count("*").alias("n"))
    open_ = (
        shares.groupBy("band")
        .agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("set_id_label", F.struct("n", "set_id_label")).alias("main"), F.count("*").alias("k"))
        .where("k > 1")
    )
    rows = (
        marked.join(open_, "band")
        .join(bits, "set_id")
        .withColumn("i_blocks", F.ceil(F.col("n") / BLOCK_SETS).cast("int"))
        .withColumn("j_blocks", F.ceil((F.col("n") - F.col("most")) / BLOCK_SETS).cast("int"))
        .withColumn("odd", F.col("set_id_label") != F.col("main"))
    )
    own = F.xxhash64("set_id")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    base = rows.select("band", F.pmod(own, "i_blocks").alias("i"), each("j_blocks").alias("j"), F.lit(False).alias("odd"), "set_id", "set_id_label", "low_bits", "bands")
    odd = rows.where("odd").select("band", each("i_blocks").alias("i"), F.pmod(own, "j_blocks").alias("j"), "odd", "set_id", "set_id_label", "low_bits", "bands")
    dealt = base.withColumn("i", F.col("i").cast("int")).unionByName(odd.withColumn("j", F.col("j").cast("int")).select(base.columns))
    dealt = dealt.withColumn("j", F.col("j").cast("int")).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "odd")

    def compare(band, names, groups, low, bands, odd):
        left, right = np.flatnonzero(odd), np.flatnonzero(~odd)
        if not len(left) or not len(right):
            return
        right = right[np.argsort(groups[right], kind="stable")]
        new = np.r_[True, groups[right][1:] != groups[right][:-1]]
        firsts, group_of = np.flatnonzero(new), np.cumsum(new) - 1
        earlier = bands[:, : int(np.flatnonzero(bands[0] == band)[0])]
        for at in range(0, len(left), 8):
            some = left[at : at + 8]
            near = estimates(low[some][:, None, :], low[right][None, :, :])
            near[groups[some][:, None] == groups[right][None, :]] = -1
            # Of the buckets that hold both, all of them unsettled, the first counts.
            near[(earlier[some][:, None, :] == earlier[right][None, :, :]).any(-1)] = -1
            fine = near >= bound
            if best:
                fine &= near == np.maximum.reduceat(near, firsts, 1)[:, group_of]
            x, y = np.nonzero(fine)
            yield names[some[x]], names[right[y]]

    def meet(batches):
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
                if held.num_rows == 0:
                    continue
            if held is None or held.num_rows == 0:
                continue
            keys = np.stack([held.column(c).to_numpy() for c in ("band", "i", "j")], 1)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
            stops = [*starts[1:], len(keys)]
            done = len(starts) if batch is None else len(starts) - 1
            if done:
                upto = stops[done - 1]
                part = held.slice(0, upto)
                names = np.array(part.column("set_id").to_pylist(), object)
                groups = np.array(part.column("set_id_label").to_pylist(), object)
                low = np.frombuffer(b"".join(part.column("low_bits").to_pylist()), np.uint8).reshape(-1, FINE_HASHES // 2)
                odd = part.column("odd").to_numpy()
                bands = part.column("bands").combine_chunks().flatten().to_numpy().reshape(len(odd), -1)
                for a, b in zip(starts[:done], stops[:done]):
                    for x, y in compare(keys[a, 0], names[a:b], groups[a:b], low[a:b], bands[a:b], odd[a:b]):
                        if len(x):
                            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.binary()), pa.array(y.tolist(), pa.binary())], ["a", "b"])
                held = held.slice(upto)

    found = dealt.mapInArrow(meet, "a binary, b binary")
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _with_end(batches):
    yield from batches
    yield None


def linked_sets(about: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(set_id, label) of every set that a link joins to another."""
    similarity = percent / 100
    distinct_sets = stored(about.where("set_id is not null").select("set_id", "low_bits", "bands").dropDuplicates(["set_id"]), "sets")
    bits = distinct_sets.select("set_id", "low_bits")
    keyed = distinct_sets.select("set_id", F.explode("bands").alias("band"))
    buckets = keyed.groupBy("band").agg(F.min("set_id").alias("lead"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = stored(keyed.join(buckets, "band"), "members")

    # Each set with every other set that leads one of its buckets.
    led = members.where("set_id <> lead").select(F.col("set_id").alias("a"), F.col("lead").alias("b")).distinct()
    first = stored(likely(led, bits, similarity), "likely")
    links = stored(confirmed(first, full_sets(_ends(first), about, rows, width), percent), "links")
    labels = groups_of(links)

    # What is left: pairs of different groups in one bucket, those tried above excepted;
    # the best of them first, as they may leave few pairs that still part two groups.
    now = labelled(members.select("band", "set_id"), labels, "set_id")
    unsettled = now.groupBy("band").agg(F.min("set_id_label").alias("x"), F.max("set_id_label").alias("y")).where("x <> y")
    members = stored(members.join(unsettled, "band", "left_semi").select("band", "set_id"), "members")
    sets = stored(full_sets(members.select("set_id").distinct(), about, rows, width, fine=True), "full")
    fine = sets.select("set_id", "low_bits").join(distinct_sets.select("set_id", "bands"), "set_id")
    tried = first
    for best in (True, False):
        new = stored(across(members, labels, fine, similarity, best).join(tried, ["a", "b"], "left_anti"), "likely")
        more = stored(confirmed(new, sets, percent), "links")
        tried = tried.unionByName(new)
        # A label stands for its group: linking labels is linking their sets.
        joined = more.join(labels.select(F.col("set_id").alias("a"), F.col("label").alias("a_label")), "a", "left")
        joined = joined.join(labels.select(F.col("set_id").alias("b"), F.col("label").alias("b_label")), "b", "left")
        joined = joined.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
        stars = labels.select(F.col("set_id").alias("a"), F.col("label").alias("b"))
        labels = groups_of(joined.unionByName(stars))
    return labels


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()


def near_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``n_shingles``, ``component_id`` (smallest id of its
    group, its own if alone), ``kept`` (it has that id) and ``first`` (kept, and of several
    texts with that id, or without any, the one chosen).

    Words are runs of non-white-space, A-Z in lower case; two documents are linked when
    100 * common shingles >= ``percent`` * all shingles of both. Null and blank texts have
    no shingle and are linked with nothing. A row without id takes part in links; a group
    of rows without any id has a null component, and its rows are kept. Rows that share
    both id and text are all kept or all dropped, also in ``first``. Input columns named like a result are
    replaced by it.
    """
    small_batches(docs.sparkSession)
    row = F.col(ROW)
    whole = docs.select(packed(docs))
    keyed = whole.select(ROW, row[id_col].cast("long").alias("id"), F.coalesce(row[text_col], F.lit("")).alias("text"))
    keyed = keyed.withColumn("print", F.xxhash64("text"))
    rows = keyed.select("id", "print", "text")
    about = stored(described(rows, width), "about")
    labels = linked_sets(about, rows, width, percent)
    sets = about.where("set_id is not null").groupBy("set_id")
    sets = sets.agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "print")).alias("least"))
    named = labelled(sets, labels, "set_id")
    least = named.groupBy("set_id_label").agg(F.min("least").alias("component"))
    of_set = named.join(least, "set_id_label").select("set_id", "component")
    # One description for each text: rows of one text share it.
    texts = about.groupBy("print", "n_shingles", "set_id").agg(F.count("*").alias("n")).join(of_set, "set_id", "left")
    texts = texts.select("print", F.col("n_shingles").alias("_n"), F.col("set_id").isNull().alias("alone"), "component")
    found = keyed.select(ROW, "id", "print").join(texts, "print", "left")
    component = F.when(F.col("alone"), F.col("id")).otherwise(F.col("component.id"))
    kept = F.col("id").eqNullSafe(component)
    first = kept & (F.col("alone") | (F.col("print") == F.col("component.print")))
    found = found.select(ROW, F.col("_n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"), first.alias("first"))
    return unpacked(found, docs.columns, RESULTS)
