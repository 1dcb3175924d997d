import math
import random
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.functions.geometry import RINGS_TYPE, orient, parts, polygon_area, strictly_inside, edges
from headway.functions.projection import SYSTEMS, AlbersEqualArea, LambertConformal, convert
from headway.operators import spatial

SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]


def polygon_table(spark, shapes, epsg=2926):
    data = [
        (key, [[(float(x), float(y)) for x, y in ring] for ring in rings])
        for key, rings in shapes.items()
    ]
    return spatial.as_polygons(
        spark.createDataFrame(data, f"area string, rings {RINGS_TYPE}"), "rings", epsg
    )


def point_table(spark, points, epsg=2926):
    frame = spark.createDataFrame(
        [(i, None if p is None else float(p[0]), None if p is None else float(p[1]))
         for i, p in enumerate(points)],
        "id long, px double, py double",
    )
    return spatial.as_points(frame, "px", "py", epsg)


def test_lambert_worked_example(spark):
    clarke = LambertConformal(
        axis=20925832.16, eccentricity2=2 / 294.97870 - 1 / 294.97870**2, parallel1=28 + 23 / 60,
        parallel2=30 + 17 / 60, origin_lat=27 + 50 / 60, origin_lon=-99.0, false_easting=2000000.0,
    )
    x, y = clarke.from_degrees(F.lit(-96.0), F.lit(28.5))
    assert tuple(spark.range(1).select(x, y).first()) == pytest.approx((2963503.91, 254759.80), abs=0.01)


def test_lambert_feet(spark):
    x, y = convert(F.lit(-122.463845), F.lit(47.508329), 4326, 2926)
    got = spark.range(1).select(x, y).first()
    assert tuple(got) == pytest.approx((1237465.518, 189692.311), abs=0.001)


def test_albers_worked_example(spark):
    clarke = AlbersEqualArea(6378206.4, 0.00676866, 29.5, 45.5, 23.0, -96.0)
    x, y = clarke.from_degrees(F.lit(-75.0), F.lit(35.0))
    lon, lat = clarke.to_degrees(F.lit(1885472.7264557), F.lit(1535925.0033391))
    got = tuple(spark.range(1).select(x, y, lon, lat).first())
    assert got == pytest.approx((1885472.7, 1535925.0, -75.0, 35.0), abs=0.05)
    assert got[2:] == pytest.approx((-75.0, 35.0), abs=1e-9)


@pytest.mark.parametrize("code", sorted(set(SYSTEMS) - {4326}))
def test_projection_round_trip(spark, code):
    grid = spark.range(400).selectExpr("-125 + id % 20 AS lon", "30 + id div 20 AS lat").selectExpr(
        "cast(lon AS double) lon", "cast(lat AS double) lat"
    )
    x, y = convert(F.col("lon"), F.col("lat"), 4326, code)
    lon, lat = convert(x, y, code, 4326)
    worst = grid.select(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(worst) < 1e-10


def test_reference_systems(spark):
    points = point_table(spark, [(-122.4, 47.5)], 4326)
    shapes = polygon_table(spark, {"a": [SQUARE]})
    assert spatial.crs_of(points) == 4326 and not spatial.same_crs(points, shapes)
    moved = spatial.project(points, 2926)
    assert spatial.same_crs(moved, shapes)
    with pytest.raises(ValueError, match="reference systems differ"):
        spatial.spatial_join(points, shapes, "within")
    with pytest.raises(ValueError):
        convert(F.lit(1.0), F.lit(1.0), 4326, 99)
    degrees = polygon_table(spark, {"a": [[(-122, 47), (-121, 47), (-121, 48), (-122, 47)]]}, 4326)
    corner = spatial.project(degrees, 2926).select("rings")
    x, y = convert(F.lit(-122.0), F.lit(47.0), 4326, 2926)
    assert corner.first()[0][0][0] == tuple(spark.range(1).select(x, y).first())


def test_boundary_points_are_outside(spark):
    shapes = polygon_table(spark, {"a": [SQUARE, HOLE]})
    points = point_table(spark, [(0.5, 0.5), (2, 2), (5, 5), (0, 2), (4, 4), (1, 2), None])
    got = spatial.spatial_join(points, shapes, "within")
    assert [tuple(r) for r in got.orderBy("id").select("id", "area").collect()] == [
        (0, "a"), (1, None), (2, None), (3, None), (4, None), (5, None), (6, None)
    ]


def test_contains_keeps_empty_polygons(spark):
    shapes = polygon_table(
        spark, {"a": [SQUARE], "b": [[(2, 2), (6, 2), (6, 6), (2, 6), (2, 2)]], "far": [[(90, 90), (91, 90), (91, 91), (90, 90)]]}
    )
    points = point_table(spark, [(3, 3), (1, 1), (50, 50)])
    got = spatial.spatial_join(shapes, points, "contains", key="area")
    assert spatial.crs_of(got) == 2926
    assert rows(got.select("area", "id")) == [("a", 0), ("a", 1), ("b", 0), ("far", None)]
    with pytest.raises(ValueError, match="key"):
        spatial.spatial_join(shapes, points, "contains")
    assert rows(spatial.count_in(shapes, points, "area").select("area", "total")) == [
        ("a", 2), ("b", 1), ("far", None)
    ]
    summed = spatial.count_in(shapes, points, "area", value="id")
    assert rows(summed.select("area", "total")) == [("a", 1), ("b", 0), ("far", None)]


def brute_force(points, shapes):
    """Even-odd rule in whole numbers."""
    found = set()
    for i, (x, y) in enumerate(points):
        for key, rings in shapes.items():
            odd, touching = False, False
            for ring in rings:
                for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                    turn = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
                    if turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                        touching = True
                    if (y1 > y) != (y2 > y) and (turn > 0) == (y2 > y1):
                        odd = not odd
            if odd and not touching:
                found.add((i, key))
    return found


@pytest.mark.parametrize("seed,shuffled", [(1, False), (2, True), (3, False)])
def test_random_polygons_equal_brute_force(spark, seed, shuffled):
    """Broadcast and shuffled layers, with one polygon far larger than the rest."""
    rng = random.Random(seed)
    shapes = {}
    for k in range(40):
        cx, cy, size = rng.randrange(200), rng.randrange(200), rng.choice([3, 8, 20])
        ring = [(cx + rng.randrange(-size, size + 1), cy + rng.randrange(-size, size + 1)) for _ in range(rng.randrange(3, 9))]
        shapes[f"p{k}"] = [ring + ring[:1]]
    shapes["large"] = [[(-50, -40), (260, -50), (250, 270), (-45, 260), (-50, -40)]]
    points = [(rng.randrange(-60, 280), rng.randrange(-60, 280)) for _ in range(600)]
    got = spatial.spatial_join(
        point_table(spark, points), polygon_table(spark, shapes), "within", "inner",
        shuffled=shuffled,
    )
    pairs = [tuple(r) for r in got.select("id", "area").collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == brute_force(points, shapes)


def star(cx, cy, radius, corners, seed):
    """A closed ring of many corners around a point, every second one pulled in."""
    pick = random.Random(seed)
    ring = []
    for k in range(corners):
        angle, far = 2 * math.pi * k / corners, radius * (1 if k % 2 else 0.6 + 0.3 * pick.random())
        ring.append((cx + far * math.cos(angle), cy + far * math.sin(angle)))
    return [*ring, ring[0]]


def test_one_huge_detailed_polygon_among_small_ones(spark):
    shapes = {f"p{k}": [[(k % 100, k // 100), (k % 100 + 1, k // 100), (k % 100, k // 100 + 1), (k % 100, k // 100)]] for k in range(10_000)}
    shapes["huge"] = [star(50, 50, 40_000, 20_000, 1)]
    layer = polygon_table(spark, shapes)
    levelled = spatial._levelled(layer).withColumn("g", F.struct(F.lit(0).alias("lx"), F.lit(0).alias("ly")))
    cells = spatial._gridded(levelled, F.col("g"))
    found = cells.groupBy((F.col("area") == "huge").alias("huge")).agg(F.count("*").alias("n"), F.max(F.size("__sides")).alias("sides"))
    sizes = {r.huge: (r.n, r.sides) for r in found.collect()}
    assert sizes[False][0] <= 4 * 10_000 and sizes[True][0] <= 3 * 4 * 20_000 / spatial.BAND_SIDES and sizes[True][1] < 20_000 / 4
    pick = random.Random(4)
    points = [(k % 100 + 0.25, k // 100 % 100 + 0.25) for k in range(0, 10_000, 7)] + [(pick.uniform(-45_000, 45_000), pick.uniform(-45_000, 45_000)) for _ in range(300)]
    got = spatial.spatial_join(point_table(spark, points), layer, "within", "inner")
    small = {(i, f"p{k}") for i, k in enumerate(range(0, 10_000, 7))}
    assert {tuple(r) for r in got.select("id", "area").collect()} == small | brute_force(points, {"huge": shapes["huge"]})


def test_points_in_one_hot_cell_are_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        shapes = {f"p{k}": [[(k, 0), (k + 1, 0), (k + 1, 1), (k, 1), (k, 0)]] for k in range(300)}
        raw = spark.range(0, 90_000, numPartitions=8).select(
            "id", F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.col("id") % 300 + 0.5).alias("px"), F.lit(0.5).alias("py"), F.sha2(F.col("id").cast("string"), 512).alias("payload")
        )
        got = spatial.spatial_join(spatial.as_points(raw, "px", "py", 2926), polygon_table(spark, shapes), "within", shuffled=True)
        counted = {r.area: r.n for r in got.groupBy("area").agg(F.count("*").alias("n")).collect()}
        assert counted["p7"] == 30_000 + sum(k % 3 > 0 and k % 300 == 7 for k in range(90_000)) and sum(counted.values()) == 90_000
        got.write.format("noop").mode("overwrite").save()
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_many_corners_and_holes_are_turned_in_time(spark):
    outer = [(100_000 * math.cos(2 * math.pi * k / 40_000), 100_000 * math.sin(2 * math.pi * k / 40_000)) for k in range(40_000)]
    holes = [[(x, y), (x + 10, y), (x + 10, y + 10), (x, y + 10), (x, y)] for x in range(-500, 500, 100) for y in range(-500, 500, 100)]
    started = time.time()
    frame = polygon_table(spark, {"a": [*holes[:50], [*outer, outer[0]], *holes[50:]]})
    area = frame.select(polygon_area("rings")).first()[0]
    assert area == pytest.approx(math.pi * 1e10 - 100 * 100, rel=1e-6) and time.time() - started < 60


def test_spatial_join_builds_without_a_job(spark):
    layer, points = polygon_table(spark, {"a": [SQUARE]}), point_table(spark, [(1, 1)])
    spark.sparkContext.setJobGroup("spatial", "spatial")
    spatial.count_in(layer, points, "area")
    started = spark.sparkContext.statusTracker().getJobIdsForGroup("spatial")
    spark.sparkContext.setJobGroup("other", "other")
    assert not started


def test_empty_layers_and_shapes_without_extent(spark):
    points = point_table(spark, [(1, 1), None, (float("nan"), 1)])
    flat = polygon_table(spark, {"line": [[(0, 0), (4, 0), (0, 0), (0, 0)]], "none": []})
    assert rows(spatial.spatial_join(points, flat).select("id", "area")) == [(0, None), (1, None), (2, None)]
    assert rows(spatial.spatial_join(points, flat.where("area = 'x'")).select("id", "area")) == [(0, None), (1, None), (2, None)]
    assert rows(spatial.spatial_join(flat, points, "contains", key="area").select("area", "id")) == [("line", None), ("none", None)]


def test_projection_is_not_worked_out_in_filters(spark):
    """A filter on computed coordinates repeats the whole projection for every row."""
    degrees = point_table(spark, [(-122.463845, 47.508329), None, (float("nan"), 47.5)], 4326)
    feet = spatial.project(degrees, 2926)
    corner = (1237465.0, 189692.0)
    square = polygon_table(spark, {"a": [[(corner[0] + 4 * x, corner[1] + 4 * y) for x, y in SQUARE]]})
    got = spatial.spatial_join(feet, square)
    assert rows(got.select("id", "area")) == [(0, "a"), (1, None), (2, None)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "TAN(" in plan
    assert not [line for line in plan.splitlines() if "Filter" in line and "TAN(" in line]


def test_areas(spark):
    frame = polygon_table(spark, {"a": [SQUARE, SQUARE[::-1]], "h": [SQUARE, HOLE], "m": [SQUARE, [(10, 0), (12, 0), (12, 2), (10, 2), (10, 0)]]})
    got = frame.select("area", polygon_area("rings"), F.size(parts("rings")))
    assert rows(got) == [("a", 0.0, 1), ("h", 12.0, 1), ("m", 20.0, 2)]
    loose = polygon_table(spark, {"h": [SQUARE[::-1], HOLE[::-1]]})
    assert loose.select(polygon_area(orient("rings"))).first()[0] == 12.0


def test_rings_of_any_turn_and_empty_rings(spark):
    island = [(1.5, 1.5), (2.5, 1.5), (2.5, 2.5), (1.5, 2.5), (1.5, 1.5)]
    frame = polygon_table(
        spark, {"e": [SQUARE, []], "h": [SQUARE, HOLE[::-1]], "i": [island, HOLE, SQUARE[::-1]], "n": [[]]}
    )
    got = frame.select("area", polygon_area("rings"), F.size(parts("rings")))
    assert rows(got) == [("e", 16.0, 1), ("h", 12.0, 1), ("i", 13.0, 2), ("n", 0.0, 0)]


def test_inside_needs_no_join(spark):
    frame = polygon_table(spark, {"a": [SQUARE]})
    inside = strictly_inside(F.lit(1.0), F.lit(1.0), edges("rings"))
    assert frame.select(inside).first()[0] is True
