"""Point and polygon tables: reference systems, projection, spatial joins.

A point table has columns x and y, a polygon table a column ``rings``; the code
of the reference system travels in the metadata of those columns. A polygon is
laid over the cells of a grid, a point has one cell, and the two meet in an
equi-join on the cell before the exact test runs. Cell sides are powers of four, each
polygon's from its own box, so layers may mix polygons of all sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.geometry import box, edges, edges_in_band, orient_nested, strictly_inside
from headway.functions.missing import quoted
from headway.functions.projection import convert
from headway.operators.joins import join

GEOMETRY = ("x", "y", "rings")

# Cell number of points without a position; no polygon covers it.
NO_CELL = -(2**63)
# Sides that a band of a polygon should hold, and bands cut first into one coarse band.
BAND_SIDES = 64
COARSE_BITS = 5
# Cell sides are powers of two between these exponents.
LEVELS = (-60, 60)
NO_LEVEL = -99


def _tagged(column: Column, name: str, epsg: int) -> Column:
    return column.alias(name, metadata={"epsg": epsg})


def is_polygons(df: DataFrame) -> bool:
    return "rings" in df.columns


def crs_of(df: DataFrame) -> int | None:
    """Code of the table's reference system, or None when it has none."""
    name = "rings" if is_polygons(df) else "x"
    return df.schema[name].metadata.get("epsg") if name in df.columns else None


def same_crs(a: DataFrame, b: DataFrame) -> bool:
    return crs_of(a) is not None and crs_of(a) == crs_of(b)


def as_points(df: DataFrame, x: str, y: str, epsg: int) -> DataFrame:
    """Turn two coordinate columns (longitude or easting first) into a point table."""
    rest = [F.col(quoted(c)) for c in df.columns if c not in (x, y)]
    return df.select(
        *rest,
        _tagged(F.col(quoted(x)).cast("double"), "x", epsg),
        _tagged(F.col(quoted(y)).cast("double"), "y", epsg),
    )


def as_polygons(df: DataFrame, rings: str, epsg: int, oriented: bool = False) -> DataFrame:
    """Turn a column of rings into a polygon table. Rings are turned by their nesting, so
    that holes subtract from areas, unless they are known to be ``oriented``."""
    rest = [F.col(quoted(c)) for c in df.columns if c != rings]
    shape = F.col(quoted(rings)) if oriented else orient_nested(F.col(quoted(rings)))
    return df.select(*rest, _tagged(shape, "rings", epsg))


def drop_geometry(df: DataFrame) -> DataFrame:
    return df.drop(*GEOMETRY)


def project(df: DataFrame, to_epsg: int) -> DataFrame:
    """Points or polygons in another reference system."""
    source = crs_of(df)
    if source is None:
        raise ValueError("the table has no reference system; use as_points or as_polygons")
    if is_polygons(df):

        def moved(p: Column) -> Column:
            x, y = convert(p["x"], p["y"], source, to_epsg)
            return F.struct(x.alias("x"), y.alias("y"))

        rings = F.transform("rings", lambda ring: F.transform(ring, moved))
        return df.withColumns({"rings": rings}).withMetadata("rings", {"epsg": to_epsg})
    x, y = convert(F.col("x"), F.col("y"), source, to_epsg)
    moved_points = df.withColumns({"x": x, "y": y})
    return moved_points.withMetadata("x", {"epsg": to_epsg}).withMetadata("y", {"epsg": to_epsg})


def _level(length: Column) -> Column:
    """Exponent, even, of the smallest cell side (a power of four) not below a length;
    missing for nothing, NaN or infinity."""
    exponent = 2 * F.ceil(F.log2(length) / 2)
    usable = (length > 0) & (length < F.lit(float("inf")))
    return F.when(usable, F.least(F.greatest(exponent, F.lit(LEVELS[0])), F.lit(LEVELS[1])).cast("int"))


def _side(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def _cell(value: Column, level: Column) -> Column:
    """Number of the cell; exact, since dividing by a power of two is."""
    return F.floor(value / _side(level))


def _point_cells(across: str, up: str) -> list[Column]:
    """Cell of a point in ``__grid``; NO_CELL for a missing coordinate."""
    numbers = {across: _cell(F.col("x"), F.col("__grid.lx")), up: _cell(F.col("y"), F.col("__grid.ly"))}
    return [F.coalesce(number, F.lit(NO_CELL)).alias(name) for name, number in numbers.items()]


def _levelled(polygons: DataFrame) -> DataFrame:
    """Polygons with ``__box``, their sides, and ``__lx``, ``__ly``: the levels of their own
    box, a box of many sides being cut into bands of height."""
    wide, high = F.col("__box.xmax") - F.col("__box.xmin"), F.col("__box.ymax") - F.col("__box.ymin")
    bands = F.greatest(F.ceil(F.size("__sides") / BAND_SIDES), F.lit(1))
    # Nothing computed of a shape may be missing, and no filter may ask for it: the optimizer
    # would work out the shape once more for each. A shape without extent has no level.
    found = box("rings")
    limits = F.struct(*[F.coalesce(found[c], F.lit(float("nan"))).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])
    laid = polygons.withColumns({"__box": limits, "__sides": edges("rings")})
    levels = {"__lx": _level(wide), "__top": _level(high), "__ly": _level(high / bands)}
    holds = levels["__lx"].isNotNull() & levels["__ly"].isNotNull()
    return laid.withColumns({n: F.coalesce(F.when(holds, v), F.lit(NO_LEVEL)) for n, v in levels.items()})


def _gridded(levelled: DataFrame, grid: Column) -> DataFrame:
    """One row per polygon and cell of its own level, with the sides in its band.

    Levels are not finer than the points' grid. A polygon lies in two columns and about as
    many bands as it has 64 sides; bands are cut out of coarse ones, so that not every side
    is held against every band.
    """
    laid = levelled.withColumns({"__px": F.greatest("__lx", grid["lx"]), "__py": F.greatest("__ly", grid["ly"])})

    def cells(low: str, high: str, level: Column) -> Column:
        covered = F.sequence(_cell(F.col(f"__box.{low}"), level), _cell(F.col(f"__box.{high}"), level))
        return F.explode(F.when(F.col("__lx") != NO_LEVEL, covered).otherwise(F.array().cast("array<bigint>")))

    def in_band(number: Column, level: Column) -> Column:
        return edges_in_band(F.col("__sides"), number * _side(level), (number + 1) * _side(level))

    coarse = F.col("__py") + COARSE_BITS
    laid = laid.withColumn("__coarse", cells("ymin", "ymax", coarse))
    laid = laid.withColumn("__sides", in_band(F.col("__coarse"), coarse))
    first = F.greatest(F.shiftleft("__coarse", COARSE_BITS), _cell(F.col("__box.ymin"), F.col("__py")))
    last = F.least(F.shiftleft(F.col("__coarse") + 1, COARSE_BITS) - 1, _cell(F.col("__box.ymax"), F.col("__py")))
    laid = laid.withColumn("__cy", F.explode(F.sequence(first, last)))
    laid = laid.withColumn("__sides", in_band(F.col("__cy"), F.col("__py")))
    return laid.withColumn("__cx", cells("xmin", "xmax", F.col("__px"))).drop("__coarse", "__lx", "__ly", "__top")


def _candidates(polygons: DataFrame, points: DataFrame, shuffled: bool) -> tuple[DataFrame, Column]:
    """(polygons per grid cell that holds points, with the sides in the cell's band; the grid).

    The grid of the points has the cells of a polygon of median size. Each cell that holds a
    point is looked up at every level that polygons lie on, as many as powers of four
    separate their sizes; so a polygon of any size costs no more cells than it has bands.
    """
    levelled = _levelled(polygons)
    some = lambda c: F.when(F.col("__lx") != NO_LEVEL, c)
    middle = [F.floor(F.percentile(some(F.col(level)), 0.5)).cast("int") for level in ("__lx", "__top")]
    grid = levelled.agg(F.struct(middle[0].alias("lx"), middle[1].alias("ly"))).scalar()
    grid = F.struct(*[F.coalesce(grid[c], F.lit(0)).alias(c) for c in ("lx", "ly")])
    held = levelled.withColumn("__grid", grid)
    cells = _gridded(held, F.col("__grid")).drop("__grid")
    level = F.struct(F.greatest("__lx", "__grid.lx").alias("px"), F.greatest("__ly", "__grid.ly").alias("py"))
    levels = held.agg(F.array_sort(F.collect_set(some(level)))).scalar()
    # Numbers instead of missing cells and levels: a filter on them, also one that the optimizer
    # makes of the join, would work out the (possibly long) coordinate expressions many times
    # over. The join leaves such cells out.
    full = points.withColumn("__grid", grid).select(*_point_cells("__fx", "__fy"), "__grid").distinct()
    looked = full.withColumn("__level", F.explode(levels)).select(
        "__fx", "__fy", F.col("__level.px").alias("__px"), F.col("__level.py").alias("__py"),
        F.expr("shiftright(__fx, __level.px - __grid.lx)").alias("__cx"),
        F.expr("shiftright(__fy, __level.py - __grid.ly)").alias("__cy"),
        (F.col("__fx") * _side(F.col("__grid.lx"))).alias("__left"), ((F.col("__fx") + 1) * _side(F.col("__grid.lx"))).alias("__right"),
        (F.col("__fy") * _side(F.col("__grid.ly"))).alias("__low"), ((F.col("__fy") + 1) * _side(F.col("__grid.ly"))).alias("__high"),
    )
    b = F.col("__box")
    met = looked.join(cells.hint("merge") if shuffled else cells, ["__px", "__py", "__cx", "__cy"])
    met = met.where((b["xmin"] <= F.col("__right")) & (b["xmax"] >= F.col("__left")) & (b["ymin"] <= F.col("__high")) & (b["ymax"] >= F.col("__low")))
    met = met.withColumn("__sides", edges_in_band(F.col("__sides"), F.col("__low"), F.col("__high")))
    return met.drop("__px", "__py", "__cx", "__cy", "__left", "__right", "__low", "__high"), grid


def spatial_join(
    left: DataFrame,
    right: DataFrame,
    predicate: str = "within",
    how: str = "left",
    key: str | None = None,
    suffixes: tuple[str, str] = (".x", ".y"),
    shuffled: bool = False,
) -> DataFrame:
    """Join points to the polygons that hold them; a boundary point is in none.

    ``within``: points on the left, each kept once per polygon holding it.
    ``contains``: polygons on the left; a left join also keeps empty polygons and
    needs the ``key`` that tells polygons apart. The left geometry is kept. Nothing runs
    before the result is asked for; Spark broadcasts a layer it knows or finds to be small,
    unless ``shuffled``, else both sides are shuffled and hot cells are split.
    """
    if predicate not in ("within", "contains") or how not in ("left", "inner"):
        raise ValueError("predicate is within or contains, how is left or inner")
    points_first = predicate == "within"
    points, polygons = (left, right) if points_first else (right, left)
    if not is_polygons(polygons) or is_polygons(points):
        raise ValueError(f"{predicate} needs points {'first' if points_first else 'second'}")
    if not same_crs(points, polygons):
        raise ValueError(f"reference systems differ: {crs_of(left)} and {crs_of(right)}")

    left_names = [c for c in left.columns if c not in GEOMETRY]
    right_names = [c for c in right.columns if c not in GEOMETRY]
    clash = set(left_names) & set(right_names)
    left_out = {c: c + suffixes[0] if c in clash else c for c in left_names}
    right_out = {c: c + suffixes[1] if c in clash else c for c in right_names}
    point_out, polygon_out = (left_out, right_out) if points_first else (right_out, left_out)

    shapes = polygons.select(
        *[F.col(quoted(c)).alias(polygon_out[c]) for c in polygon_out], "rings"
    )
    cells, grid = _candidates(shapes, points, shuffled)
    if points_first:
        cells = cells.drop("rings")
    # Columns that cannot be missing, so that no null filter repeats the (possibly
    # long) coordinate expressions below the join. NaN lies in no box.
    nowhere = F.lit(float("nan"))
    placed = points.withColumn("__grid", grid).select(
        *[F.col(quoted(c)).alias(point_out[c]) for c in point_out],
        "x",
        "y",
        F.coalesce("x", nowhere).alias("__x"),
        F.coalesce("y", nowhere).alias("__y"),
        *_point_cells("__px", "__py"),
    )
    x, y, b = F.col("__x"), F.col("__y"), F.col("__box")
    holds = (
        (F.col("__px") == F.col("__fx"))
        & (F.col("__py") == F.col("__fy"))
        & x.between(b["xmin"], b["xmax"])
        & y.between(b["ymin"], b["ymax"])
        & strictly_inside(x, y, F.col("__sides"))
    )
    # A point has exactly one cell, so no pair can be met twice.
    hits = placed.join(cells.hint("merge") if shuffled else cells, holds, how if points_first else "inner")

    left_columns = [F.col(quoted(left_out[c])) for c in left_names]
    right_columns = [F.col(quoted(right_out[c])) for c in right_names]
    if points_first:
        return hits.select(*left_columns, *right_columns, "x", "y")
    found = hits.select(*left_columns, *right_columns, "rings")
    if how == "inner":
        return found
    if key is None:
        raise ValueError("a left join from polygons needs the polygon key")
    key_out = left_out[key]
    used = found.select(quoted(key_out)).distinct()
    return found.unionByName(
        join(shapes, used, by=key_out, how="anti"), allowMissingColumns=True
    ).withMetadata("rings", {"epsg": crs_of(polygons)})


def totals_in(
    polygons: DataFrame,
    points: DataFrame,
    key: str,
    value: str | None = None,
    by: Sequence[str] = (),
    name: str = "total",
) -> DataFrame:
    """Points (or the sum of a point column) per polygon that holds any.

    Points at one place are added up before the spatial join, so a place with
    very many rows is tested once per ``by`` group.
    """
    amount = F.count(F.lit(1)) if value is None else F.coalesce(F.sum(quoted(value)), F.lit(0))
    groups = [F.col(quoted(c)) for c in by]
    places = points.groupBy(*groups, "x", "y").agg(amount.alias("__amount"))
    places = as_points(places, "x", "y", crs_of(points))
    hits = spatial_join(places, polygons.select(quoted(key), "rings"), "within", how="inner")
    return hits.groupBy(quoted(key), *groups).agg(F.sum("__amount").alias(name))


def count_in(
    polygons: DataFrame,
    points: DataFrame,
    key: str,
    value: str | None = None,
    by: Sequence[str] = (),
    name: str = "total",
) -> DataFrame:
    """Every polygon with its total; without points it stays, the total missing."""
    return join(polygons, totals_in(polygons, points, key, value, by, name), by=key, how="left")
