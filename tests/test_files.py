"""Readers and writers on small hand-made files."""

import json
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.operators.spatial import as_points, crs_of, drop_geometry
from headway.functions.geometry import polygon_area
from headway.plans.feed import stops_by_route
from headway.sinks import files
from headway.sources import archives, census, layers, tables, warehouse
from headway.sources.paths import Paths
from test_spatial import HOLE, SQUARE, polygon_table


def test_paths():
    assert Paths("s3a://store/project/").at("data", "/a/", 213) == "s3a://store/project/data/a/213"


@pytest.fixture
def trip_counts(tmp_path):
    path = tmp_path / "counts.csv"
    path.write_text(
        "﻿SERVICE_RTE_NUM,EXPRESS_LOCAL_CD,AM Trip Count,All Trips\n1,L,4,68\n1,L,,68\n7,E,NA,3\n",
        encoding="utf-8",
    )
    return str(path)


def test_headed_text_with_declared_types(spark, trip_counts):
    got = tables.read_table(spark, trip_counts, "`AM Trip Count` int, SERVICE_RTE_NUM int")
    assert got.columns == ["AM Trip Count", "SERVICE_RTE_NUM"]
    assert rows(got) == [(None, 1), (None, 7), (4, 1)]


def test_guessed_types(spark, trip_counts):
    got = tables.read_table(spark, trip_counts)
    assert [k for _, k in got.dtypes] == ["bigint", "string", "bigint", "bigint"]
    mixed = spark.createDataFrame(
        [("1.5", "2021-10-02", "TRUE", "007", "x", None), ("-2", "2021-10-03", "FALSE", "12", "1", None)],
        "a string, b string, c string, d string, e string, f string",
    )
    kinds = [f.dataType.simpleString() for f in tables.guess_schema(mixed).fields]
    assert kinds == ["double", "date", "boolean", "string", "string", "string"]


def test_null_markers(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("Month,Sales\nJan,n/a\nFeb,N/A\nMar,\nApr,5\nMay,12.8\nDec,null\n")
    default = tables.read_table(spark, str(path))
    assert dict(default.dtypes)["Sales"] == "string"
    full = tables.read_table(spark, str(path), na=tables.SHEET_NA)
    assert dict(full.dtypes)["Sales"] == "double"
    assert full.where("Sales IS NOT NULL").count() == 2
    text = tables.clean_markers(tables.read_text_table(spark, str(path)))
    assert rows(tables.cast_problems(text, "Month string, Sales double")) == [("Sales", 3, "N/A")]


def test_malformed_lines(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("a,b\n1,2\n3\n4,5,6\n")
    assert rows(tables.malformed_lines(spark, str(path)).select("_line")) == [("3",), ("4,5,6",)]


def test_sheets(spark, tmp_path):
    (tmp_path / "Routes by planner.csv").write_text("Routes,Lead\nA (671),Kim\n")
    (tmp_path / "Other.csv").write_text("Routes,Lead\n5,Lee\n")
    one = tables.read_sheet(spark, str(tmp_path), "Routes by planner", "Routes string, Lead string")
    assert rows(one) == [("A (671)", "Kim")]
    both = tables.read_sheets(spark, str(tmp_path), "Routes string, Lead string")
    assert rows(both) == [("5", "Lee", "Other"), ("A (671)", "Kim", "Routes by planner")]


def test_zipped_members(spark, tmp_path):
    for name, text in (("a", "id,note\n1,\"two\nlines\"\n2,NA\n"), ("b", "note,id\nx,3\n")):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as archive:
            archive.writestr(f"inner/{name}.csv", text)
            archive.writestr("readme.txt", "no table")
    got = archives.read_zipped_csv(spark, str(tmp_path / "*.zip"), "id int, note string")
    assert rows(got.select("id", "note")) == [(1, "two\nlines"), (2, None), (3, "x")]
    one = archives.read_zipped_csv(
        spark, str(tmp_path / "*.zip"), "id int", member="b.csv", partitions=3
    )
    assert rows(one.select("id")) == [(3,)]


FEED_FILES = {
    "stops.txt": "stop_id,stop_code,stop_name,stop_lat,stop_lon\n46769,9,Dock,47.0,-122.0\n2,9,Hill,47.6,-122.3\n3,9,Gone,47.6,-122.3\n",
    "stop_times.txt": "trip_id,stop_id,stop_sequence\nt1,46769,1\nt1,2,2\nt2,2,1\nt3,3,1\nt4,2,1\n",
    "trips.txt": "route_id,service_id,trip_id\nr1,new,t1\nr2,new,t2\nr1,old,t3\nr9,new,t4\n",
    "calendar.txt": "service_id,start_date\nnew,20211009\nold,20210901\n",
    "routes.txt": "route_id,agency_id,route_short_name,route_desc\nr1,1,A Line,first\nr2,1,7,second\nr9,1,,nameless\n",
}


def test_feed_to_stops(spark, tmp_path):
    for change in ("213", "221"):
        with zipfile.ZipFile(tmp_path / f"{change}_gtfs.zip", "w") as archive:
            for name, text in FEED_FILES.items():
                archive.writestr(name, text)
    feed = archives.read_gtfs(spark, str(tmp_path))
    assert feed["calendar"].schema["start_date"].dataType.simpleString() == "date"
    got = stops_by_route(feed)
    assert crs_of(got) == 2926
    expected = [
        (stop, route, change)
        for change in ("213", "221")
        for stop, route in (("2", "599"), ("2", "671"), ("2", "7"), ("46769", "671"))
    ]
    found = rows(got.select("stop_id", "route_short_name", "service_change_num"))
    assert found == sorted(expected)
    dock = got.where("stop_id = '46769'").first()
    assert (dock["x"], dock["y"]) == pytest.approx((1237465.518, 189692.311), abs=0.001)


def test_each_stop_is_projected_once(spark, tmp_path):
    """The projection lies below the joins, where a stop has one row and not one per route."""
    write_feed(tmp_path / "213_gtfs.zip", FEED_FILES)
    got = stops_by_route(archives.read_gtfs(spark, str(tmp_path)))
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    projected = [i for i, line in enumerate(plan) if "TAN(" in line]
    assert len(projected) == 1
    assert projected[0] > next(i for i, line in enumerate(plan) if "Join" in line)


def test_polygon_layers(spark, tmp_path):
    ring = [list(map(float, p)) for p in SQUARE]
    hole = [list(map(float, p)) for p in HOLE][::-1]
    features = [
        {"type": "Feature", "properties": {"GEO_ID_GRP": "0530", "n": 1},
         "geometry": {"type": "Polygon", "coordinates": [ring, hole]}},
        {"type": "Feature", "properties": {"GEO_ID_GRP": "0531", "n": 2},
         "geometry": {"type": "MultiPolygon", "coordinates": [[ring[::-1]], [[[9, 9], [9, 10], [10, 9], [9, 9]]]]}},
        {"type": "Feature", "properties": {"GEO_ID_GRP": "0532", "n": 3}, "geometry": None},
    ]
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(map(json.dumps, features)))
    whole = tmp_path / "whole.json"
    whole.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    for path, collection in ((lines, False), (whole, True)):
        got = layers.read_polygons(spark, str(path), "GEO_ID_GRP string", collection=collection)
        assert crs_of(got) == 4326
        assert rows(got.select("GEO_ID_GRP", F.size("rings"), polygon_area("rings"))) == [
            ("0530", 2, 12.0), ("0531", 2, 16.5), ("0532", None, None)
        ]
    out = str(tmp_path / "out")
    first = layers.read_polygons(spark, str(lines), "GEO_ID_GRP string, n int")
    files.write_layer(first, out)
    again = layers.read_polygons(spark, out, "GEO_ID_GRP string, n int")
    assert rows(again) == rows(first)
    assert rows(drop_geometry(again))[0] == ("0530", 1)


def test_point_layers(spark, tmp_path):
    frame = spark.createDataFrame([("a", -122.463845, 47.508329)], "id string, lon double, lat double")
    points = layers.read_points(frame, "lon", "lat", 4326, 2926)
    assert crs_of(points) == 2926
    feature = json.loads(files.as_features(as_points(frame, "lon", "lat", 4326)).first()[0])
    assert feature["geometry"] == {"type": "Point", "coordinates": [-122.463845, 47.508329]}
    assert feature["properties"] == {"id": "a"}


def test_map_layers(spark):
    shapes = polygon_table(spark, {"a": [SQUARE]}).withColumn("score", F.lit(3))
    both = files.map_layer({"one": shapes, "two": shapes}, "score")
    assert rows(both.select("layer", "value")) == [("one", 3), ("two", 3)]


def test_map_layers_of_areas_and_points(spark):
    shapes = polygon_table(spark, {"a": [SQUARE]}).withColumn("score", F.lit(3))
    points = as_points(spark.createDataFrame([(5, 1.0, 2.0)], "score int, px double, py double"), "px", "py", 2926)
    found = [json.loads(r.value) for r in files.as_features(files.map_layer({"areas": shapes, "stops": points}, "score")).collect()]
    assert sorted((f["properties"]["layer"], f["geometry"]["type"]) for f in found) == [("areas", "MultiPolygon"), ("stops", "Point")]
    with pytest.raises(ValueError, match="one reference system"):
        files.map_layer({"areas": shapes, "stops": as_points(points, "x", "y", 4326)}, "score")


def test_csv_and_table_sets(spark, tmp_path):
    frame = spark.createDataFrame([(1, None), (2, "x,y")], "id int, note string")
    out = str(tmp_path / "csv")
    files.write_csv(frame, out)
    files.write_csv(frame, out)
    assert rows(tables.read_table(spark, out, "id int, note string")) == rows(frame)
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    assert "1,NA" in text and '"x,y"' in text
    files.write_csv(frame, out, append=True)
    assert tables.read_table(spark, out, "id int").count() == 4
    files.write_tables({"a": frame, "b": frame}, str(tmp_path / "set"))
    assert spark.read.parquet(str(tmp_path / "set" / "b")).count() == 2
    files.write_partitioned(frame, str(tmp_path / "parts"), ["id"])
    assert (tmp_path / "parts" / "id=2").is_dir()


def test_queries_over_tables(spark):
    frame = spark.createDataFrame([(1,), (5,)], "n int")
    assert rows(warehouse.sql(spark, "SELECT n FROM {t} WHERE n > 2", t=frame)) == [(5,)]


ACS = [
    ("530330001001", "B1", "C_1", 10.0, 2.0, 2019, "acs5"),
    ("530330001001", "B1", "C_2", 4.0, 1.0, 2019, "acs5"),
    ("530330001001", "B1", "C_1", 11.0, 2.0, 2020, "acs5"),
    ("53033", "King", "C_1", 99.0, 5.0, 2019, "acs1"),
    ("410330001001", "Other", "C_1", 7.0, 1.0, 2019, "acs5"),
]


def test_survey_estimates(spark, tmp_path):
    path = str(tmp_path / "acs")
    frame = spark.createDataFrame(
        ACS, "GEOID string, NAME string, variable string, estimate double, moe double, year int, survey string"
    )
    frame.write.partitionBy("survey", "year").parquet(path)
    got = census.read_acs(
        spark, path, {"one": "C_1", "two": "C_2"}, geography="block group", state="53",
        county="033", year=2019, survey="acs5",
    )
    assert rows(got) == [
        ("530330001001", "B1", "one", 10.0, 2.0), ("530330001001", "B1", "two", 4.0, 1.0)
    ]
    wide = census.acs(frame, {"one": "C_1"}, year=2019, survey="acs5", moe_level=95, output="wide")
    assert wide.columns == ["GEOID", "NAME", "oneE", "oneM"]
    assert wide.where("NAME = 'B1'").first()["oneM"] == pytest.approx(2 * 1.96 / 1.645)
    shapes = polygon_table(spark, {"53033": [SQUARE]}).withColumnRenamed("area", "GEOID")
    placed = census.acs(frame, ["C_1"], geography="county", polygons=shapes)
    assert placed.select("NAME", F.size("rings")).collect() == [("King", 1)]
    with pytest.raises(ValueError):
        census.acs(frame, ["C_1"], geography="Block Group")
    with pytest.raises(ValueError):
        census.acs(frame, ["C_1"], county="033")


def test_decennial_counts(spark, tmp_path):
    path = str(tmp_path / "dec")
    spark.createDataFrame(
        [("53", "WA", "P1", 5.0, 2010), ("53", "WA", "P2", 6.0, 2010)],
        "GEOID string, NAME string, variable string, value double, year int",
    ).write.partitionBy("year").parquet(path)
    assert rows(census.read_decennial(spark, path, ["P1"], year=2010)) == [("53", "WA", "P1", 5.0)]
    wide = census.read_decennial(spark, path, ["P1", "P2"], year=2010, output="wide")
    assert rows(wide) == [("53", "WA", 5.0, 6.0)]


def test_published_wide_files(spark):
    wide = spark.sql("SELECT '53' AS GEOID, 'WA' AS NAME, 5 AS C_1E, 2 AS C_1M, 7 AS C_2E, NULL AS C_2M")
    assert rows(census.long_from_wide(wide, ["C_1", "C_2"])) == [
        ("53", "WA", "C_1", 5.0, 2.0), ("53", "WA", "C_2", 7.0, None)
    ]


def test_variable_search(spark):
    catalogue = spark.createDataFrame(
        [("B1", "Estimate!!Total", "SEX BY AGE"), ("B2", "Median income", None)],
        "name string, label string, concept string",
    )
    assert [r[0] for r in census.search_variables(catalogue, "sex|zip").collect()] == ["B1"]
    assert [r[0] for r in census.search_variables(catalogue, "income").collect()] == ["B2"]




def test_sheets_of_other_headers(spark, tmp_path):
    (tmp_path / "a b[1].csv").write_text("﻿Routes,Lead\n1,Kim\n")
    (tmp_path / "c+d.csv").write_text("Lead,Extra,Routes\nLee,x,2\n")
    (tmp_path / "e.csv").write_text("Routes\n3\n")
    (tmp_path / "f.csv").write_text("Lead,Extra,Routes\r\nAnn,y,4\r\n")
    got = tables.read_sheets(spark, str(tmp_path), "Routes int, Lead string")
    assert got.columns == ["Routes", "Lead", "sheet"]
    assert rows(got) == [(1, "Kim", "a b[1]"), (2, "Lee", "c+d"), (3, None, "e"), (4, "Ann", "f")]


def write_feed(path, files):
    with zipfile.ZipFile(path, "w") as archive:
        for name, text in files.items():
            archive.writestr(name, text)


def test_feed_without_optional_columns(spark, tmp_path):
    files = {**FEED_FILES, "routes.txt": "route_id,route_short_name\nr1,A Line\nr2,7\n", "stops.txt": "stop_id,stop_lat,stop_lon\n2,47.6,-122.3\n"}
    write_feed(tmp_path / "213_gtfs.zip", files)
    write_feed(tmp_path / "193_gtfs.zip", FEED_FILES)
    feed = archives.read_gtfs(spark, str(tmp_path))
    assert rows(feed["routes"].where("service_change_num = '213'").select("route_id", "route_desc")) == [("r1", None), ("r2", None)]
    found = {(r.stop_id, r.service_change_num) for r in stops_by_route(feed).collect()}
    assert ("2", "213") in found and ("46769", "193") in found and ("46769", "213") not in found


@pytest.mark.parametrize("files, message", [
    ({k: v for k, v in FEED_FILES.items() if k != "trips.txt"}, "213_gtfs.zip: no member trips.txt"),
    ({**FEED_FILES, "trips.txt": "route_id,trip_id\nr1,t1\n"}, "trips.txt has no column service_id"),
])
def test_feed_without_what_it_needs(spark, tmp_path, files, message):
    write_feed(tmp_path / "213_gtfs.zip", files)
    with pytest.raises(Exception, match=message):
        archives.read_gtfs(spark, str(tmp_path))["trips"].collect()
