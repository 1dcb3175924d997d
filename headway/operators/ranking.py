"""Positions, equal-sized buckets and top rows per group.

A group may be larger than one task should hold. A row's place in an order is computed from
the row and from cut points taken from a sample; a group spreads over many places and only
the counts of places meet. Then the few places that hold a wanted position are looked into.
Everything is part of one lazy plan: cut points are a subquery of it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, MapType, StringType, VariantType

from headway.functions.missing import quoted
from headway.operators.joins import attach, join

# Cut points of an order, and sampled rows a cut point stands for.
CUTS = 4095
ROWS_PER_CUT = 16
# Steps of the search for a cut point that one projection takes.
HALVINGS = 3
# Characters of a text or bytes of a binary value that make a cut point.
CUT_LENGTH = 256
# Bits of a place that one column of the order takes; columns that take part.
LEVEL_BITS = 14
LEVELS = 4
# Parts in which the first rows of a group are found before they meet.
PARTS = 64
# Rows up to which a group is put in order as a whole, in one task.
GROUP_ROWS = 100_000


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def _is_nan(column: Column, kind: DataType) -> Column:
    return F.isnan(column) if kind.typeName() in ("double", "float") else F.lit(False)


def _present(df: DataFrame, name: str) -> Column:
    column = F.col(quoted(name))
    return column.isNotNull() & ~_is_nan(column, df.schema[name].dataType)


def _row_hash(df: DataFrame) -> Column:
    """The same number for equal rows. Maps, which have no hash, are left out."""
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]
    return F.xxhash64(*_cols(plain))


def with_one(df: DataFrame, one: DataFrame) -> DataFrame:
    """The columns of ``one``, a table of one row of bounded size, on every row.

    An equi-join on a number that is always 0, which the optimizer does not know: nested
    subqueries would each be planned again and again.
    """
    def always(table: DataFrame) -> Column:
        plain = [f.name for f in table.schema if not isinstance(f.dataType, (MapType, VariantType))]
        return F.pmod(F.xxhash64(*_cols(plain[:1])), F.lit(1))

    both = df.withColumn("__one", always(df)).join(F.broadcast(one.withColumn("__one", always(one))), "__one", "left")
    return both.drop("__one")


def _advanced(at: Column, cuts: Column, value: Column, steps: Sequence[int], done: int = 0) -> Column:
    """``at`` and as many of the steps as still lead to a cut point not above ``value``."""
    if not steps:
        return at + done
    further, stay = (_advanced(at, cuts, value, steps[1:], d) for d in (done + steps[0], done))
    return F.when(F.get(cuts, at + (done + steps[0] - 1)) <= value, further).otherwise(stay)


class Places:
    """Where a row stands in the order of some columns, as a number computed from the row.

    Cut points come from a sample of ROWS_PER_CUT times CUTS rows at most. A row equal to a cut point in one column is
    placed further by the next one, at last by its hash; so a frequent value is divided as
    the order goes on. Only the balance depends on the cut points, never a result.

    ``orders`` are lists of columns, each followed by a hash column in the order of rows if
    ``hashed`` names one.
    """

    def __init__(self, df: DataFrame, orders: Sequence[Sequence[str]], hashed: str | None = None):
        self.df, self.hashed = df, hashed
        self.names = [n for n in dict.fromkeys(c for order in orders for c in order[:LEVELS]) if n != hashed]
        keys = [F.when(_present(df, n), self._cut_key(n)) for n in self.names]
        mixed = F.xxhash64(F.col(quoted(hashed)) if hashed else _row_hash(df), F.lit(7))
        # One row of each of many shares of the hash: evenly drawn, equal rows at most once, in one
        # pass, and the same rows whenever it is drawn.
        held = df.select(mixed.alias("h"), F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).alias("k"))
        sample = held.groupBy(F.pmod("h", F.lit(CUTS * ROWS_PER_CUT)).alias("share")).agg(F.min_by("k", "h").alias("k")).select("k.*")
        values = sample.select(*[F.sort_array(F.collect_list(f"k{i}")).alias(f"k{i}") for i in range(len(keys))])
        picked = values.select(F.struct(*[self._picked(F.col(f"k{i}")).alias(f"k{i}") for i in range(len(keys))]).alias("__cuts"))
        self.cuts = picked

    def marked(self, slots: Mapping[str, Sequence[str]]) -> DataFrame:
        """The rows with, for each name, their place in an order.

        All columns are searched at once, some halvings in each projection, so that the number
        found so far is computed once and the search stays generated code.
        """
        held = with_one(self.df, self.cuts).withColumns({f"__at{i}": F.lit(0) for i in range(len(self.names))})
        cuts = [F.col("__cuts")[f"k{i}"] for i in range(len(self.names))]
        ats = [F.col(f"__at{i}") for i in range(len(self.names))]
        values = _cols(self.names)
        bits = CUTS.bit_length()
        for low in range(bits - HALVINGS, -HALVINGS, -HALVINGS):
            steps = [1 << k for k in reversed(range(max(low, 0), low + HALVINGS))]
            held = held.withColumns({f"__at{i}": _advanced(at, cut, v, steps) for i, (at, cut, v) in enumerate(zip(ats, cuts, values))})
        same = [v.isNull() | F.coalesce(F.get(cut, at - 1) == v, F.lit(False)) for at, cut, v in zip(ats, cuts, values)]
        held = held.withColumns({f"__same{i}": x for i, x in enumerate(same)})
        last = F.lit((1 << LEVEL_BITS) - 1)
        digits = [
            F.when(v.isNull(), 0).when(_is_nan(v, self.df.schema[n].dataType), last).otherwise(2 * at + F.when(F.col(f"__same{i}"), 1).otherwise(2))
            for i, (n, at, v) in enumerate(zip(self.names, ats, values))
        ]
        held = held.withColumns({f"__digit{i}": d for i, d in enumerate(digits)})
        return held.withColumns({name: self._place(order) for name, order in slots.items()}).select(*_cols(self.df.columns), *_cols(list(slots)))

    def _place(self, order: Sequence[str]) -> Column:
        place, deeper = F.lit(0).cast("long"), F.lit(True)
        levels = [*order, self.hashed] if self.hashed and len(order) < LEVELS else list(order)
        for name in levels[:LEVELS]:
            if name == self.hashed:
                digit = F.shiftright(F.col(quoted(name)), 65 - LEVEL_BITS).cast("int") + (1 << LEVEL_BITS - 2)
            else:
                i = self.names.index(name)
                digit = F.col(f"__digit{i}")
            place = place * (1 << LEVEL_BITS) + F.when(deeper, digit).otherwise(0)
            if name != self.hashed:
                deeper = deeper & F.col(f"__same{i}")
        return place

    @staticmethod
    def _picked(values: Column) -> Column:
        """Evenly spaced different values."""
        spots = F.sequence(F.lit(0), F.least(F.size(values), F.lit(CUTS)) - 1)
        many = F.transform(spots, lambda i: F.get(values, F.floor(i * F.size(values) / F.least(F.size(values), F.lit(CUTS))).cast("int")))
        return F.when(F.size(values) > 0, F.array_distinct(many)).otherwise(F.slice(values, 1, 0))

    def _cut_key(self, name: str) -> Column:
        column = F.col(quoted(name))
        if isinstance(self.df.schema[name].dataType, (StringType, BinaryType)):
            return F.substring(column, 1, CUT_LENGTH)
        return column


def rows_at_ranks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    targets: Callable[[Column], Column],
    weight: str | None = None,
) -> DataFrame:
    """Rows standing at chosen positions of their group's order.

    ``targets`` maps the group's total to an array of (label, rank) structs. With
    ``weight`` a row stands for that many rows. Returns the keys, the order
    columns, ``__label`` and ``__total``. ``order`` should tell rows apart, since
    equal rows share a place.
    """
    unit = F.lit(1).cast("long") if weight is None else F.col(quoted(weight)).cast("long")
    rest = [o for o in order if o not in keys]
    rows = df.select(*_cols(keys), *_cols(rest), unit.alias("__w"))
    hits = _at_ranks(Places(rows, [order]).marked({"__slot": order}), keys, targets, order)
    return hits.select(*_cols(keys), *_cols(rest), F.col("__hit.label").alias("__label"), "__total")


def _at_ranks(ranged: DataFrame, keys: Sequence[str], targets: Callable[[Column], Column], order: Sequence[str]) -> DataFrame:
    """Rows of ``ranged`` at the wanted ranks of their group, with ``__hit``, ``__total`` and
    ``__first``, the rank at which the row begins. ``__slot`` holds the place of a row, ``__w``
    for how many it stands; rows equal in ``order`` should be one."""
    # At most one row per key and place.
    slots = ranged.groupBy(*_cols(keys), "__slot").agg(F.sum("__w").alias("__n"))
    group = Window.partitionBy(*_cols(keys))
    wanted = (
        slots.withColumn("__before", F.sum("__n").over(group.orderBy("__slot")) - F.col("__n"))
        .withColumn("__total", F.sum("__n").over(group))
        .withColumn(
            "__targets",
            F.filter(targets(F.col("__total")), lambda t: (t["rank"] > F.col("__before")) & (t["rank"] <= F.col("__before") + F.col("__n"))),
        )
        .where(F.size("__targets") > 0)
        .drop("__n")
    )
    if not keys:
        wanted = F.broadcast(wanted)  # a row for each target at most
    inside = join(ranged, wanted, by=[*keys, "__slot"], how="inner")
    running = Window.partitionBy(*_cols(keys), "__slot").orderBy(*_cols(order))
    upto = F.sum("__w").over(running.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reached = inside.withColumn("__first", F.col("__before") + upto - F.col("__w") + 1).withColumn("__hit", F.explode("__targets"))
    return reached.where((F.col("__hit.rank") >= F.col("__first")) & (F.col("__hit.rank") < F.col("__first") + F.col("__w")))


def ntile(
    df: DataFrame,
    columns: Mapping[str, str],
    n: int,
    keys: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    all_differ: bool = False,
) -> DataFrame:
    """Split each group into ``n`` buckets of almost equal size, 1 the lowest.

    ``columns`` maps result names to columns, each compared in its own type. Missing
    values get no bucket and are not counted; the larger buckets come first. Rows that
    tie in the value and ``tiebreak`` are divided arbitrarily, so bucket sizes always
    differ by at most one.

    Groups of at most GROUP_ROWS rows are put in order by a window. In larger ones, and
    without ``keys``, only the first row of each bucket is looked for, for all columns at once;
    a row's bucket then follows from comparing it with those few. Rows equal in every column, of
    which a bucket takes only some, are counted and written out again by their number. With
    ``all_differ`` the caller states that there are none, which saves reading ``df`` for them.
    """
    if not keys:
        return _spread_ntile(df, columns, n, keys, tiebreak, all_differ)
    large = df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > GROUP_ROWS)
    few = _window_ntile(join(df, large, by=list(keys), how="anti"), columns, n, keys, tiebreak, all_differ)
    many = _spread_ntile(join(df, large, by=list(keys), how="semi"), columns, n, keys, tiebreak, all_differ)
    return few.unionByName(many)


def _window_ntile(
    df: DataFrame, columns: Mapping[str, str], n: int, keys: Sequence[str], tiebreak: Sequence[str], all_differ: bool
) -> DataFrame:
    """``ntile`` of groups that one task can order. Rows that the order does not tell apart
    share the last one's bucket with ``all_differ``, as they do in large groups."""
    held = df.withColumn("__hash", _row_hash(df))
    results = []
    for i, (out, c) in enumerate(columns.items()):
        held = held.withColumn(f"__here{i}", _present(df, c))
        group = Window.partitionBy(*_cols(keys), f"__here{i}")
        line = group.orderBy(*_cols([c, *tiebreak]), "__hash")
        upto = F.count(F.lit(1)).over(line.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        held = held.withColumns({f"__rank{i}": upto if all_differ else F.row_number().over(line), f"__total{i}": F.count(F.lit(1)).over(group)})
        rank, each, more = F.col(f"__rank{i}"), F.floor(F.col(f"__total{i}") / n), F.col(f"__total{i}") % n
        # The first ``more`` buckets have a row more than ``each``.
        bucket = F.when(rank <= more * (each + 1), F.ceil(rank / (each + 1))).otherwise(more + F.ceil((rank - more * (each + 1)) / F.greatest(each, F.lit(1))))
        results.append(F.when(F.col(f"__here{i}"), bucket).cast("int").alias(out))
    done = held.select(*_cols([c for c in df.columns if c not in columns]), *results)
    return done.select(*_cols(df.columns), *_cols([o for o in columns if o not in df.columns]))


def _spread_ntile(
    df: DataFrame, columns: Mapping[str, str], n: int, keys: Sequence[str], tiebreak: Sequence[str], all_differ: bool
) -> DataFrame:
    """``ntile`` by the first rows of the buckets, with no group in one task."""
    names = list(columns.values())
    rows = df.withColumn("__hash", _row_hash(df))
    orders = {f"__place{i}": [c, *tiebreak] for i, c in enumerate(names)}
    placed = Places(rows, list(orders.values()), "__hash").marked(orders)
    order_keys = [F.struct(F.col(quoted(c)).alias("v"), *[F.col(quoted(b)).alias(f"t{i}") for i, b in enumerate(tiebreak)], "__hash") for c in names]
    kinds = [f.dataType for f in rows.select(*[k.alias(f"k{i}") for i, k in enumerate(order_keys)]).schema]
    each = [
        F.struct(
            F.lit(i).alias("__out"),
            F.when(_present(df, c), F.col(f"__place{i}")).alias("__slot"),
            *[(k if j == i else F.lit(None).cast(kinds[j])).alias(f"__k{j}") for j, k in enumerate(order_keys)],
        )
        for i, c in enumerate(names)
    ]
    narrow = placed.select(*[F.col(quoted(k)).alias(f"__g{i}") for i, k in enumerate(keys)], F.explode(F.array(*each)).alias("__e"))
    groups = [f"__g{i}" for i in range(len(keys))]
    narrow = narrow.select(*groups, "__e.*").where("__slot IS NOT NULL")
    ordered = [f"__k{j}" for j in range(len(names))]
    narrow = narrow.groupBy(*groups, "__out", "__slot", *ordered).agg(F.count(F.lit(1)).alias("__w"))

    def firsts(total: Column) -> Column:
        """Rank of the first row of each bucket from the second on."""
        ranks = F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda k: (k * F.floor(total / n) + F.least(k, total % n) + 1).cast("long"))
        return F.transform(ranks, lambda r: F.struct(r.alias("rank"))) if n > 1 else F.array().cast("array<struct<rank:bigint>>")

    hits = _at_ranks(narrow, [*groups, "__out"], firsts, ordered)
    below = F.col("__hit.rank") - F.col("__first")  # of equal rows, those in earlier buckets
    starts = hits.groupBy(*groups).agg(
        *[F.collect_list(F.when(F.col("__out") == j, F.struct(F.col(f"__k{j}").alias("key"), below.alias("below")))).alias(f"__starts{j}") for j in range(len(names))]
    )
    starts = starts.select(*groups, F.struct(*[F.col(f"__starts{j}").alias(f"s{j}") for j in range(len(names))]).alias("__starts"))
    if keys:
        joined = join(rows, starts, by=dict(zip(keys, groups)), how="left")
    else:
        joined = with_one(rows, starts.select("__starts"))
    begins = [F.col("__starts")[f"s{j}"] for j in range(len(names))]

    def bucketed(frame: DataFrame, reached: Callable[[Column, Column], Column]) -> DataFrame:
        results = [
            F.when(_present(df, c), 1 + F.coalesce(F.size(F.filter(begin, lambda s: reached(s, key))), F.lit(0))).cast("int").alias(out)
            for (out, c), begin, key in zip(columns.items(), begins, order_keys)
        ]
        done = frame.select(*_cols([c for c in df.columns if c not in columns]), *results)
        return done.select(*_cols(df.columns), *_cols([o for o in columns if o not in df.columns]))

    def upto(start: Column, key: Column) -> Column:
        return start["key"] <= key

    if all_differ:
        return bucketed(joined, upto)
    split = F.lit(False)
    for begin, key in zip(begins, order_keys):
        split = split | F.coalesce(F.exists(begin, lambda s: (s["below"] > 0) & (s["key"] == key)), F.lit(False))
    joined = joined.withColumn("__split", split)
    # Equal rows are told apart by number only; rows that differ in a map alone follow each other.
    equal = joined.where("__split").groupBy(*_cols(rows.columns), "__starts").agg(F.count(F.lit(1)).alias("__copies"))
    line = Window.partitionBy("__hash").orderBy(F.to_json(F.struct(*_cols(df.columns))))
    counted = equal.withColumn("__upto", F.sum("__copies").over(line))
    copies = counted.withColumn("__number", F.explode(F.sequence(F.col("__upto") - F.col("__copies") + 1, F.col("__upto"))))
    numbered = bucketed(copies, lambda s, key: (s["key"] < key) | ((s["key"] == key) & (s["below"] < F.col("__number"))))
    return bucketed(joined.where(~F.col("__split")), upto).unionByName(numbered)


def slice_max(df: DataFrame, value: str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """The ``n`` largest rows per group, with all rows tied with the last one.

    First the n-th largest value of each group is found, then the rows reaching
    it are kept where they are, so ties of any number stay spread out.
    """
    column = F.col(quoted(value))
    present = df.where(_present(df, value))
    top = first_by_count(present, keys, [value], [column.desc()], n)
    least = top.groupBy(*_cols(keys)).agg(F.min(column).alias("__least"))
    if not keys:
        return present.where(column >= least.select("__least").scalar())
    joined = attach(present, least, keys, how="inner")
    return joined.where(column >= F.col("__least")).drop("__least")


def first_by_count(df: DataFrame, keys: Sequence[str], names: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The different rows of ``keys`` and ``names`` that reach into the first ``n`` rows of
    their group, with ``__upto``, the rows up to their last one.

    Equal rows are counted first. Each group's first are found in parts, of which at most
    ``n`` rows each meet.
    """
    both = [*keys, *[c for c in names if c not in keys]]
    counted = df.groupBy(*_cols(both)).agg(F.count(F.lit(1)).alias("__n"))
    plain = [c for c in names if not isinstance(df.schema[c].dataType, (MapType, VariantType))]
    counted = counted.withColumn("__part", F.pmod(F.xxhash64(*_cols(plain)), F.lit(PARTS)))
    part = Window.partitionBy(*_cols(keys), "__part").orderBy(*order)
    few = counted.withColumn("__row", F.row_number().over(part)).where(F.col("__row") <= n).drop("__row", "__part")
    line = Window.partitionBy(*_cols(keys)).orderBy(*order)
    running = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return few.withColumn("__upto", F.sum("__n").over(running)).where(F.col("__upto") - F.col("__n") < n).drop("__n")
