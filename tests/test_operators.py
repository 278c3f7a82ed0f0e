"""Operators on small rows with known results."""

import io
import os
import struct
import zipfile
from datetime import date, datetime
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terraops import sinks
from terraops.functions import geo
from terraops.operators import catalog, grid, index, osm, poi, spatial, trips
from terraops.plans import pipelines
from terraops.sources import archives, html, shapefile, tables

at = datetime.fromisoformat
STAFF = [("Reed, Ann", 1), ("Stone, Bob", 2), ("Idle, Cy", 3)]
TRAVEL = [
    (1, at("2020-01-01T16:00:00"), at("2020-01-06T12:00:00"), "Ulm;Bonn"),
    (1, at("2020-02-01T16:00:00"), at("2020-02-04T17:00:00"), "Kiel;Ulm;Kiel;Jena"),
    (2, at("2020-01-02T00:00:00"), at("2020-01-05T00:00:00"), "Jena"),
    (2, at("2019-12-31T00:00:00"), at("2020-01-05T00:00:00"), "Bonn;Ulm"),
    (9, at("2020-01-02T00:00:00"), at("2020-01-05T00:00:00"), "Bonn"),
]
CITIES = [("Ulm", 0, 0.0, 0.0), ("Bonn", 1, 3.0, 4.0), ("Jena", 2, 6.0, 8.0), ("Ulm", 3, 9.0, 9.0), ("Kiel", 4, 0.0, 1.0)]


@pytest.fixture()
def found(spark):
    staff = spark.createDataFrame(STAFF, "Name string, ID int")
    travel = spark.createDataFrame(TRAVEL, "ID int, Start timestamp_ntz, End timestamp_ntz, Route string")
    limits = [F.lit(v).cast("timestamp_ntz") for v in ("2020-01-01 00:00:00", "2020-12-31 00:00:00")]
    return pipelines.trip_report(staff, travel, *limits, ["Reed, Ann", "Stone, Bob"])


def test_trip_report(found, spark):
    assert [(r["index"], r.Name, r.Duration, r.Route) for r in found.orderBy("index").collect()] == [(0, "Reed, Ann", 3, "Kiel;Ulm;Kiel;Jena"), (1, "Reed, Ann", 4, "Ulm;Bonn"), (2, "Stone, Bob", 3, "Jena")]
    staff = spark.createDataFrame(STAFF, "Name string, ID int")
    names = staff.where("ID = 2").select("Name")
    travel = spark.createDataFrame(TRAVEL, "ID int, Start timestamp_ntz, End timestamp_ntz, Route string")
    limits = [F.lit(v).cast("timestamp_ntz") for v in ("2000-01-01 00:00:00", "2020-12-31 00:00:00")]
    assert trips.employee_trips(staff, travel, *limits, names).count() == 2


def test_trip_analysis(found, spark):
    names = spark.createDataFrame(STAFF, "Name string, ID int")
    rows = {r.Name: r for r in pipelines.trip_analysis(found, spark.createDataFrame(CITIES, "NAME string, pos int, x double, y double"), ["index"], names).collect()}
    ann = rows["Reed, Ann"]
    assert (ann.total_trips, ann.total_travel_days, ann.total_cities, ann.cities_visited) == (2, 7, 4, "Kiel;Ulm;Jena;Bonn")
    assert (ann.total_time_span, ann.longest_trip_days, ann.shortest_trip_days, ann.most_stops_compat, ann.most_stops) == (34, 4, 3, 2, 4)
    planar = 10 + 1 + 1 + 2 * np.hypot(6, 7)
    assert ann.total_distance_mi == pytest.approx(np.radians(planar) * 3956, abs=0.05)
    assert (ann.avg_days_per_trip, ann.span_per_trip) == (3.5, 17.0)
    assert (rows["Stone, Bob"].total_distance_mi, rows["Idle, Cy"].total_trips, rows["Idle, Cy"].longest_trip_days) == (0.0, 0, None)


def test_unknown_city(found, spark):
    cities = spark.createDataFrame(CITIES[:2], "NAME string, pos int, x double, y double")
    rows = {r["index"]: r for r in trips.route_lines(found, cities, ["index"]).collect()}
    assert [tuple(p) for p in rows[1].path] == [(0.0, 0.0), (3.0, 4.0)]
    assert rows[0].path is None and rows[0].missing_cities == ["Kiel", "Jena"]
    with pytest.raises(PySparkException):
        trips.route_lines(found, cities, ["index"], strict=True).collect()


def test_dense_index_has_no_gaps_or_ties(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    rows = index.dense_index(df, "v").orderBy("v").collect()
    assert [r["index"] for r in rows] == list(range(1000)) == [r.v for r in rows]
    assert index.dense_index(df.limit(0), "v").count() == 0


@pytest.mark.parametrize("parts", ["8", "64"])
def test_dense_index_with_other_columns(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.range(100_000).select((F.col("id") * 7919 % 100_000).alias("v"), F.concat(F.lit("row "), "id").alias("other"))
        rows = index.dense_index(df, "v").toPandas()
        assert rows["index"].tolist() == rows.v.tolist() and rows["index"].is_unique and rows.other.nunique() == 100_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_path_lengths_cross_partitions(spark):
    rows = [(k % 3 and "hot" or "b", k, float(k % 7), float(k % 5)) for k in range(500)] + [(None, 1, 0.0, 0.0), (None, 2, 3.0, 4.0), ("one", 1, 1.0, 1.0)]
    got = {r.id: (r.points, r.length) for r in index.path_lengths(spark.createDataFrame(rows, "id string, seq int, x double, y double"), ["id"], "seq").collect()}
    for key in ("hot", "b", None, "one"):
        own = np.array([r[2:] for r in rows if r[0] == key])
        assert got[key] == (len(own), pytest.approx(np.hypot(*np.diff(own, axis=0).T).sum()))


def test_running_flag(spark):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 3, None), ("b", 1, None)], "k string, pos int, hit boolean")
    assert {(r.k, r.pos): r.seen for r in catalog.running_flag(df, ["k"], "pos", F.col("hit")).collect()} == {("a", 1): False, ("a", 2): True, ("a", 3): True, ("b", 1): False}


def test_distinct_values_drop_one_blank(spark):
    df = spark.createDataFrame([(" ", "a"), ("", "a"), (None, "b"), ("x", " ")], "p string, q string")
    assert {tuple(r) for r in index.distinct_values(df, ["p", "q"]).collect()} == {("p", ""), ("p", None), ("p", "x"), ("q", "a"), ("q", "b")}


def test_spatial_join_equals_the_nested_loop(spark):
    draw = np.random.default_rng(5)
    points = [(i, *map(float, p)) for i, p in enumerate(draw.uniform(-50, 50, (300, 2)))]
    shapes = [(k, [[tuple(map(float, p)) for p in draw.uniform(-1, 1, (5, 2)) * 20 + draw.uniform(-40, 40, 2)] for _ in range(1 + k % 2)]) for k in range(12)]
    left = spark.createDataFrame(points, "id int, x double, y double")
    right = spark.createDataFrame(shapes, "shape int, rings array<array<struct<x:double,y:double>>>")
    x, y = np.array([p[1] for p in points]), np.array([p[2] for p in points])
    want = {(int(i), k) for k, rings in shapes for i in np.flatnonzero(spatial.inside(x, y, [np.array(r) for r in rings]))}
    assert {(r.id, r["shape"]) for r in spatial.points_in_polygons(left, right).collect()} == want
    for cell in (5.0, 100.0, None):
        kept, spatial.BROADCAST_CORNERS = spatial.BROADCAST_CORNERS, 3
        try:
            assert {(r.id, r["shape"]) for r in spatial.points_in_polygons(left, right, cell=cell).collect()} == want
        finally:
            spatial.BROADCAST_CORNERS = kept


def test_ring_of_hits_equals_the_nested_loop(spark):
    draw = np.random.default_rng(6)
    points = [(i, *map(float, p)) for i, p in enumerate(draw.uniform(-5, 5, (200, 2)))]
    df = spark.createDataFrame(points, "id int, x double, y double")
    xy = np.array([p[1:] for p in points])
    want = set(np.flatnonzero(spatial.inside(xy[:, 0], xy[:, 1], [xy[:40]])).tolist())
    assert {r.id for r in spatial.within_hits(df, df.where("id < 40"), "id").collect()} == want
    want = set(np.flatnonzero(spatial.inside(xy[:, 0], xy[:, 1], [xy])).tolist())
    assert {r.id for r in spatial.within_hits(df, df, "id").collect()} == want
    even = spark.createDataFrame([(k, float(k % 5), float(k // 5)) for k in range(25)], "id int, x double, y double")  # corners in rows, on one another's edges
    grid_xy = np.array([(float(k % 5), float(k // 5)) for k in range(25)])
    want = set(np.flatnonzero(spatial.inside(grid_xy[:, 0], grid_xy[:, 1], [grid_xy])).tolist())
    assert {r.id for r in spatial.within_hits(even, even, "id").collect()} == want
    assert spatial.within_hits(df, df.limit(0), "id").count() == 0


def test_search_falls_back_to_everything(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 50.0)], "id int, x double, y double")
    zone = spark.createDataFrame([("z", [[(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)]])], "zone string, rings array<array<struct<x:double,y:double>>>")
    assert [r.id for r in poi.search(points, ["id"], zones=zone).collect()] == [1]
    assert [r.id for r in poi.search(points, ["id"], zones=zone, condition=F.col("id") > 1).collect()] == [1, 2]
    assert poi.attribute_query(points, "id", "1", ["x"], ["id"]).count() == 0
    assert [r.id for r in poi.search(points, ["id"], condition=F.col("id") > 0, centre=spark.createDataFrame([(50.0, 50.0, 10.0)], "lat double, lon double, radius_km double"), limit=1).collect()] == [2]
    assert [r.id for r in poi.search(points, ["id"], condition=F.col("id") > 0, centre=spark.createDataFrame([(50.0, 50.0, 10.0)], "lat double, lon double, radius_km double"), limit=1, compat=True).collect()] == [1]
    none = points.limit(0)
    assert poi.refine(points, none, F.col("id") > 1).count() == 0
    assert poi.refine(points, none, F.col("id") > 1, compat=True).count() == 1
    assert poi.refine(points, None, F.col("id") > 1).count() == 1


def test_clip_and_overlay(spark):
    lines = spark.createDataFrame([(1, "r", [(-5.0, 1.0), (5.0, 1.0)]), (2, "s", [(20.0, 20.0), (21.0, 21.0)]), (3, "t", [(0.0, 0.5)])], "road int, kind string, path array<struct<x:double,y:double>>")
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    polygons = spark.createDataFrame([(7, "p", [square]), (8, "q", [[(100.0, 0.0), (101.0, 0.0), (101.0, 1.0)]])], "oid int, owner string, rings array<array<struct<x:double,y:double>>>")
    row = spatial.clip(lines, polygons, "road", "oid").select("road", "oid", "kind", spatial.parts_length(F.col("parts")).alias("n")).collect()
    assert [tuple(r) for r in row] == [(1, 7, "r", 4.0)]
    assert [r.owner for r in spatial.clip(lines, polygons, "road", "oid", keep_polygon=True).collect()] == ["p"]
    assert {tuple(r) for r in pipelines.clip_status(lines, polygons, "road", "oid").collect()} == {(7, 1, 0), (8, 0, 0)}


def test_waterbodies(spark):
    nodes = [("node", i, float(i % 2), float(i // 2), None, None) for i in range(4)]
    tags = [{"waterway": "river", "name": "Po"}, {"waterway": "drain", "natural": "water"}, {"natural": "water", "water": "pond"}, {"natural": "bay"}, {"highway": "x"}, None]
    ways = [("way", 10 + k, None, None, [0, 1, 3, 2], t) for k, t in enumerate(tags)] + [("way", 20, None, None, [0, 99], {"waterway": "river"}), ("way", 10, None, None, [0, 1], tags[0])]
    schema = "pos int, type string, id bigint, lat double, lon double, nodes array<bigint>, tags map<string,string>"
    elements = spark.createDataFrame([(k, *r) for k, r in enumerate(nodes + ways)], schema)
    rows = {r.way_id: r for r in pipelines.waterbodies(elements).collect()}
    assert {k: (r.kind, r["class"], r.tag, r.name) for k, r in rows.items()} == {
        10: ("linear", "River", "river", "Po"), 11: ("linear", "OtherLinear", "OtherLinear", "unknown"), 12: ("areal", "Pond", "pond", "unknown"), 13: ("areal", "OtherAreal", "OtherAreal", "unknown"),
    }
    assert rows[10].length == pytest.approx(110574.39, abs=0.1)  # the last of the two ways of this id: one degree north
    assert rows[12].area == pytest.approx(12308778361.469, rel=1e-4)  # the published figure has geodesics for edges, ours parallels


def test_catalog_filters(spark, tmp_path):
    raw = [
        ("a", ["x", "y"], "", "P/1", "T", "2000-01-01", "2001-01-01"), ("b", ["y"], "", "Q/2", "U", "2002-01-01", "Present"),
        ("c", ["z"], "", "P/3", "T", None, None), ("d", [], "", "P/4", "T", "2003-01-01", "2003-06-01T00:00:00.0Z"),
    ]
    rows = catalog.dated(spark.createDataFrame(raw, tables.schemas.CATALOG))
    names = lambda df: sorted(r.dataset for r in df.collect())
    assert names(catalog.with_tags(rows, ["x", "z"])) == ["a", "c"]
    assert names(catalog.with_tags(rows, ["x", "y"], every=True)) == ["a"]
    assert names(catalog.with_tags_compat(rows.withColumn("pos", F.ascii("dataset")), ["y"], "pos")) == ["a", "b", "c", "d"]
    assert names(catalog.of_type(rows, "")) == ["a", "b", "c", "d"] and names(catalog.of_publisher(rows, "P")) == ["a", "c", "d"]
    period = (F.lit(date(2004, 1, 1)), F.lit(date(2005, 1, 1)))
    assert names(catalog.overlapping(rows, *period, date(2024, 1, 1))) == ["b", "c"]
    assert names(pipelines.catalog_search(rows, date(2001, 6, 1), date(2003, 3, 1), date(2024, 1, 1), publisher="P")) == ["c", "d"]
    assert tuple(catalog.bounds(rows, date(2024, 1, 1)).first()) == (date(2000, 1, 1), date(2024, 1, 1))
    keys = spark.createDataFrame([("a",)], "dataset string")
    assert names(catalog.selected(rows, keys, "dataset", invert=True)) == ["b", "c", "d"]
    assert {tuple(r) for r in catalog.facets(rows).where("facet = 'tag'").collect()} == {("tag", "x", 1), ("tag", "y", 2), ("tag", "z", 1)}


def test_catalog_is_built_once(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([("a", ["x"], "", "P/1", "T", None, None)], tables.schemas.CATALOG)

    for _ in range(2):
        assert [r.dataset for r in tables.catalog_or_build(spark, str(tmp_path / "c"), build).collect()] == ["a"]
    assert built == [1]


def test_first_polygon_of_a_name_as_one_ring(spark):
    rows = [("n", 1, [[(0.0, 0.0)], [(1.0, 1.0)]]), ("n", 0, [[(2.0, 2.0)], [(3.0, 3.0)]])]
    df = spatial.first_flattened(spark.createDataFrame(rows, "name string, pos int, rings array<array<struct<x:double,y:double>>>"), "name", "pos")
    assert [[tuple(p) for p in ring] for ring in df.first().rings] == [[(2.0, 2.0), (3.0, 3.0)]]


def test_pages(spark):
    page = '<table><tbody><td class="ee-dataset"><a href="/d/N1">n</a></td><td class="ee-dataset-description-snippet">About &amp; more</td><td class="ee-tag-buttons ee-small"><a href="/t/p">p</a><a href="/t/q">q</a><a href="/t/p">p</a></td></tbody></table>'
    rows = html.catalog_rows(spark.createDataFrame([("u", page), ("v", "<tbody><td>bad</td></tbody>"), ("w", None)], "url string, html string")).collect()
    assert [(r.url, r.dataset, r.tags, r.description) for r in rows if r.error is None] == [("u", "N1", ["p", "q"], "About & more")]
    assert [r.url for r in rows if r.error] == ["v"]
    detail = '<code>ee.Image("A/B")</code><dd>x</dd><dd>2001-01-01 - Present</dd><code>ee.No("C")</code>'
    row = html.detail_rows(spark.createDataFrame([("u", detail), ("v", "")], "url string, html string")).orderBy("url").collect()
    assert tuple(row[0])[1:5] == ("A/B", "Image", "2001-01-01", "Present") and row[1].error
    place = '<td class="lat">1.5</td><td class="city">Ulm x</td><td><span class="country_name">DE</span></td>'
    assert tuple(html.place_rows(spark.createDataFrame([("u", place)], "url string, html string")).first())[1:6] == (1.5, 0.0, "Ulm", "", "DE")
    links = html.page_links(spark.createDataFrame([(1, "h/", '<a href="x">TRACT/</a><a href="y">a b</a><a href="z">m.zip</a><a>low</a>')], "page_id int, url string, html string"))
    assert [r.link for r in links.collect()] == ["h/TRACT/", "h/m.zip"]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(buffer := io.BytesIO(), "w") as file:
        file.writestr("a.txt", b"one")
        file.writestr("b/c.txt", b"two")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "good.zip").write_bytes(buffer.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    rows = archives.members(archives.archives(spark, str(tmp_path))).collect()
    assert sorted((r.member, bytes(r.content)) for r in rows if not r.error) == [("a.txt", b"one"), ("b/c.txt", b"two")]
    assert len([r for r in rows if r.error]) == 1


def test_a_member_that_inflates_too_far_is_an_error(spark):
    with zipfile.ZipFile(buffer := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as file:
        file.writestr("bomb", bytes(10_000_000))
        file.writestr("small", b"x" * 1000)
    rows = {r.member: r for r in archives.members(spark.createDataFrame([("a", bytearray(buffer.getvalue()))], "archive string, content binary"), most=1000).collect()}
    assert "more than 1000 bytes" in rows["bomb"].error and rows["bomb"].content is None and len(rows["small"].content) == 1000


def test_any_damaged_byte_of_an_archive_is_a_row(spark):
    with zipfile.ZipFile(buffer := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as file:
        for name in ("a.txt", "b.txt"):
            file.writestr(name, f"{name} some text to be packed " * 20)
    good, draw, zips = buffer.getvalue(), np.random.default_rng(3), []
    for k in range(500):
        bad = bytearray(good)
        bad[int(draw.integers(len(bad)))] ^= 1 << int(draw.integers(8))
        zips.append((str(k), bytes(bad)))
    rows = archives.members(spark.createDataFrame([*zips, ("none", None)], "archive string, content binary")).collect()
    assert {r.archive for r in rows} == {str(k) for k in range(500)} | {"none"}
    assert all((r.content is None) == (r.error is not None) for r in rows)
    assert sum(r.error is not None for r in rows) > 200
    assert all(bytes(r.content).decode()[6:].startswith("some text") or b"some text" in bytes(r.content) for r in rows if r.content)


SHAPE = "array<array<struct<x:double,y:double>>>"
STAR = [[float(r * np.cos(a)), float(r * np.sin(a))] for k, a in enumerate(np.linspace(0, 2 * np.pi, 10, endpoint=False)) for r in [4 if k % 2 else 9]]
HOLE = [[-1.0, -1.0], [1.0, -1.0], [1.0, 1.0], [-1.0, 1.0]]


def inside_length(path, rings, n=20_000):
    """The length of path within rings, by many points along it."""
    steps = np.concatenate([p + (q - p) * (np.arange(n)[:, None] + 0.5) / n for p, q in zip(path, path[1:], strict=False)])
    weight = np.repeat(np.hypot(*np.diff(path, axis=0).T) / n, n)
    return weight[spatial.inside(steps[:, 0], steps[:, 1], rings)].sum()


def length_of(parts):
    return sum(np.hypot(*np.diff(np.array([(p.x, p.y) for p in part]), axis=0).T).sum() for part in parts)


@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_clip_by_brute_force(spark, limit, monkeypatch):
    """Lengths inside concave rings with holes, against many points along each line."""
    monkeypatch.setattr(spatial, "BROADCAST_CORNERS", limit)
    draw = np.random.default_rng(8)
    paths = [draw.uniform(-10, 10, (int(n), 2)) for n in draw.integers(2, 6, 40)]
    lines = spark.createDataFrame([(k, [tuple(map(float, p)) for p in path]) for k, path in enumerate(paths)], "road int, path array<struct<x:double,y:double>>")
    shapes = {7: [STAR, HOLE], 8: [[[x / 50 + 3, y / 50 + 3] for x, y in STAR]]}
    polygons = spark.createDataFrame([(k, [[tuple(p) for p in r] for r in rings]) for k, rings in shapes.items()], f"oid int, rings {SHAPE}")
    found = {(r.road, r.oid): r for r in spatial.clip(lines, polygons, "road", "oid").collect()}
    for k, path in enumerate(paths):
        for oid, rings in shapes.items():
            want = inside_length(path, [np.array(r) for r in rings])
            got = found.get((k, oid))
            assert (length_of(got.parts) if got else 0) == pytest.approx(want, abs=0.02)
            for part in got.parts if got else []:
                middle = np.array([[(p.x + q.x) / 2, (p.y + q.y) / 2] for p, q in zip(part, part[1:], strict=False)])
                assert spatial.inside(middle[:, 0], middle[:, 1], [np.array(r) for r in rings]).all()
    assert spatial.clip(lines.limit(0), polygons, "road", "oid").count() == spatial.clip(lines, polygons.limit(0), "road", "oid").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_clip_along_edges_and_through_corners(spark, seed):
    """Lines and rings with corners at whole numbers, many of them on one another; pieces are the shapes' own by the rule of points."""
    draw = np.random.default_rng(seed)
    paths = [draw.integers(0, 5, (int(n), 2)).astype(float) for n in draw.integers(2, 5, 40)]
    shapes = [draw.integers(0, 5, (int(n), 2)).astype(float) for n in draw.integers(3, 7, 30)] + [np.array([[0.0, 0.0], [4, 0], [4, 4], [0, 4]])]
    pairs = lambda rows: [tuple(map(float, p)) for p in rows]
    lines = spark.createDataFrame([(k, pairs(p)) for k, p in enumerate(paths)], "road int, path array<struct<x:double,y:double>>")
    polygons = spark.createDataFrame([(k, [pairs(r)]) for k, r in enumerate(shapes)], f"oid int, rings {SHAPE}")
    found = {(r.road, r.oid): r.parts for r in spatial.clip(lines, polygons, "road", "oid").collect()}
    assert len(found) > 400
    for k, path in enumerate(paths):
        for oid, shape in enumerate(shapes):
            parts = found.get((k, oid), [])
            n = 997
            steps = np.concatenate([p + (q - p) * (np.arange(n)[:, None] + 0.5) / n for p, q in zip(path, path[1:], strict=False)])
            weight = np.repeat(np.hypot(*np.diff(path, axis=0).T) / n, n)
            within, edge = spatial.inside(steps[:, 0], steps[:, 1], [shape]), on_edge(steps, shape)  # on an edge, rounding decides
            assert weight[within & ~edge].sum() - 0.05 <= length_of(parts) <= weight[within | edge].sum() + 0.05
            for part in parts:
                middle = np.array([[(a.x + b.x) / 2, (a.y + b.y) / 2] for a, b in zip(part, part[1:], strict=False) if np.hypot(b.x - a.x, b.y - a.y) > 1e-6]).reshape(-1, 2)
                assert (spatial.inside(middle[:, 0], middle[:, 1], [shape]) | on_edge(middle, shape)).all()


def on_edge(points, ring):
    out = np.zeros(len(points), bool)
    for a, b in zip(ring, np.roll(ring, -1, 0), strict=True):
        d = b - a
        t = np.clip(((points - a) @ d) / max(d @ d, 1e-12), 0, 1)
        out |= np.hypot(*(a + t[:, None] * d - points).T) < 1e-9
    return out


def test_clip_keeps_rows_of_repeated_and_null_ids_apart(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    line = lambda y, x=-5.0: [(x, y), (5.0, y)]
    lines = spark.createDataFrame([(1, "a", line(1.0)), (1, "b", line(2.0)), (None, "c", line(3.0)), (4, "d", line(float("nan"))), (5, "e", [(None, 1.0), (1.0, 1.0)]), (6, "f", [(1.0, 1.0)]), (7, "g", None), (8, "h", [(1.0, 1.0), None])], "road int, kind string, path array<struct<x:double,y:double>>")
    polygons = spark.createDataFrame([(7, [square]), (7, [square]), (None, [[(0.0, 0.0), (2.0, 0.0), (2.0, 4.0), (0.0, 4.0)]]), (9, []), (10, [[(0.0, 0.0), (1.0, 1.0)]]), (11, [[(0.0, 0.0), (float("inf"), 0.0), (0.5, 5.0)]])], f"oid int, rings {SHAPE}")
    rows = spatial.clip(lines, polygons, "road", "oid").collect()
    good = [(r.road, r.kind, r.oid, length_of(r.parts)) for r in rows if r.ok]
    key = lambda r: (str(r[1]), str(r[2]))
    assert sorted(good, key=key) == sorted([(road, kind, oid, n) for road, kind in ((1, "a"), (1, "b"), (None, "c")) for oid, n in ((7, 4.0), (7, 4.0), (None, 2.0))], key=key)
    bad = [(r.kind, r.oid, r.parts, r.error is None) for r in rows if not r.ok]
    assert {r[:2] for r in bad} == {("e", 7), ("e", None), ("h", 7), ("h", None), ("a", 11), ("b", 11), ("c", 11)} and all(r[2:] == (None, False) for r in bad)
    assert len(bad) == 9  # e and h meet both rows of 7, and their known points are not in the box of 11
    counts = {(r.oid, r.pieces, r.failed) for r in pipelines.clip_status(lines, polygons.where("oid <> 7"), "road", "oid").collect()}
    assert counts == {(9, 0, 0), (10, 0, 0), (11, 0, 3)}


def test_clip_of_a_ring_of_many_corners(spark):
    n = 20_000
    ring = [(float((8 + (k % 2)) * np.cos(a)), float((8 + (k % 2)) * np.sin(a))) for k, a in enumerate(np.linspace(0, 2 * np.pi, n, endpoint=False))]
    lines = spark.range(1_024).select(F.col("id").alias("road"), F.array(geo.point(F.lit(-20.0), F.col("id") / 64 - 8), geo.point(F.lit(20.0), F.col("id") / 64 - 8)).alias("path"))
    polygon = spark.createDataFrame([(1, [ring])], f"oid int, rings {SHAPE}")
    rows = {r.road: r for r in spatial.clip(lines, polygon, "road", "oid").collect()}
    for road in (64, 512, 1000):
        path = np.array([(-20.0, road / 64 - 8), (20.0, road / 64 - 8)])
        assert length_of(rows[road].parts) == pytest.approx(inside_length(path, [np.array(ring)], 5_000), abs=0.2)
    assert len(rows) == 1_024


def test_spatial_join_of_any_mix_of_sizes(spark):
    """Twenty thousand small polygons and one as large as the world: each polygon has four cells at most."""
    small = spark.range(20_000).select(F.col("id").alias("zone"), (F.col("id") % 200 - 100.0).alias("a"), (F.floor(F.col("id") / 200) - 50.0).alias("b"))
    corner = lambda dx, dy: geo.point(F.col("a") + dx, F.col("b") + dy)
    small = small.select("zone", F.array(F.array(corner(0, 0), corner(0.001, 0), corner(0.001, 0.001), corner(0, 0.001))).alias("rings"))
    world = spark.createDataFrame([(-1, [[(-180.0, -90.0), (180.0, -90.0), (180.0, 90.0), (-180.0, 90.0)]]), (-2, [[(float("nan"), 0.0), (1.0, 1.0), (0.0, 1.0)]]), (-3, [])], f"zone long, rings {SHAPE}")
    points = spark.createDataFrame([(k, k * 10 - 49.9995, k * 7 - 29.9995) for k in range(10)], "id int, x double, y double")
    points = points.union(spark.createDataFrame([(20, None, 1.0), (21, float("nan"), 1.0), (22, float("inf"), 1.0)], "id int, x double, y double"))
    zones = small.union(world)
    found = {(r.id, r.zone) for r in spatial.points_in_polygons(points, zones).collect()}
    assert found == {(k, -1) for k in range(10)} | {(k, (k * 7 - 30 + 50) * 200 + k * 10 - 50 + 100) for k in range(10)}
    kept, spatial.BROADCAST_CORNERS = spatial.BROADCAST_CORNERS, 100
    try:  # the widest level is broadcast, the small ones are shuffled
        assert {(r.id, r.zone) for r in spatial.points_in_polygons(points, zones).collect()} == found
    finally:
        spatial.BROADCAST_CORNERS = kept


def test_boxes_meet_once_whatever_their_sizes(spark):
    draw = np.random.default_rng(3)

    def boxes(n):
        at, size = draw.uniform(-10, 10, (n, 2)), 10 ** draw.uniform(-5, 1.5, (n, 2))
        return [(k, tuple(map(float, (*a, *(a + s))))) for k, (a, s) in enumerate(zip(at, size, strict=True))]

    left, right = boxes(200), boxes(150)
    kind = "struct<x0:double,y0:double,x1:double,y1:double>"
    a, b = spark.createDataFrame(left, f"i int, __lb {kind}"), spark.createDataFrame(right, f"j int, __rb {kind}")
    want = sorted((i, j) for i, p in left for j, q in right if p[0] <= q[2] and q[0] <= p[2] and p[1] <= q[3] and q[1] <= p[3])
    for few in (True, False):
        at = [grid.levels(df, own=grid.mask(grid.level(box)))["own"] for df, box in ((a, "__lb"), (b, "__rb"))]
        met = grid.meeting_boxes(a, b, *at, few)
        assert sorted((r.i, r.j) for r in met.collect()) == want
    assert met.selectExpr("i").count() == len(want) > 100


@pytest.mark.parametrize("kind", ["point", "line", "polygon"])
def test_shapefile_round_trip(spark, tmp_path, kind):
    shape = [[(0.0, 1.5)]] if kind == "point" else [[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0)], [(5.0, 5.0), (6.0, 5.0), (6.0, 6.0)]]
    rows = [(1, "é" * 3, 0.5, shape), (2, None, None, [])]
    df = spark.createDataFrame(rows, "id int, name string, v double, parts array<array<struct<x:double,y:double>>>").coalesce(1)
    shapefile.save(shapefile.encoded(df, kind), str(tmp_path / "layer"))
    back = shapefile.layer(spark, str(tmp_path / "layer")).orderBy("index").collect()
    assert [[[tuple(p) for p in part] for part in r.parts] for r in back] == [shape, []]
    assert back[0].attributes == {"id": "1", "name": "é" * 3, "v": "0.50000000"}
    assert back[1].attributes["name"] is None
    assert shapefile.vertices(shapefile.layer(spark, str(tmp_path / "layer")), ["layer"]).count() == sum(map(len, shape))


def test_a_layer_is_decoded_by_slices(spark):
    rows = [(k, "é" * k, [[(float(k), float(j)) for j in range(k % 5)]] if k % 7 else None) for k in range(200)]
    df = spark.createDataFrame(rows, f"id int, name string, parts {SHAPE}").coalesce(1)
    files = shapefile.encoded(df, "line").cache()
    for records in (1, 16, 64, 4_096):
        back = shapefile.decoded(files.where("kind in ('shp', 'dbf')"), records=records).orderBy("index").collect()
        assert [r["index"] for r in back] == list(range(200)) == [int(r.attributes["id"]) for r in back]
        assert [[tuple(p) for part in r.parts for p in part] for r in back] == [[p for part in r[2] or [] for p in part] for r in rows]
        assert all((r.attributes["name"] or "") == rows[k][1][:127] for k, r in enumerate(back))  # 254 bytes, cut at a character
    assert {len(r.attributes) for r in shapefile.decoded(files.where("kind = 'shp'"), records=16).collect()} == {0}
    assert shapefile.decoded(files.limit(0)).count() == 0


def test_z_and_m_of_shapes(spark):
    def record(k, body):
        return struct.pack(">2i", k, len(body) // 2) + body

    xy = np.array([[0.0, 1.0], [2.0, 3.0], [4.0, 5.0]])
    line = lambda kind, *more: struct.pack("<i4d2i2i", kind, 0, 1, 4, 5, 2, 3, 0, 2) + xy.tobytes() + b"".join(struct.pack("<2d3d", min(v), max(v), *v) for v in more)
    bodies = [line(13, (7.0, 8.0, 9.0), (0.1, 0.2, 0.3)), line(13, (7.0, 8.0, 9.0)), line(23, (0.1, 0.2, 0.3)), line(3), struct.pack("<i4d", 11, 1, 2, 3, 4), struct.pack("<i", 0), struct.pack("<i4di", 18, 0, 0, 1, 1, 2) + struct.pack("<4d", 0, 0, 1, 1) + struct.pack("<2d2d", 5, 6, 5, 6)]
    shp = bytes(100) + b"".join(record(k + 1, b) for k, b in enumerate(bodies))
    rows = shapefile.decoded(spark.createDataFrame([("a", "shp", bytearray(shp))], "layer string, kind string, content binary"), ordinates=True, records=2).orderBy("index").collect()
    z, m = [[7.0, 8.0], [9.0]], [[0.1, 0.2], [0.3]]
    assert [(r.z, r.m) for r in rows] == [(z, m), (z, None), (None, m), (None, None), ([[3.0]], [[4.0]]), (None, None), ([[5.0], [6.0]], None)]
    assert [sum(map(len, r.parts)) for r in rows] == [3, 3, 3, 3, 1, 0, 2]


def test_csv_sources_and_sinks(spark, tmp_path, found):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "travel_0001.csv").write_text("1,2020-01-01 00:00:00,2020-01-02 00:00:00,A;B\n")
    (tmp_path / "in" / "travel_x.csv").write_text("junk\n")
    assert [tuple(r) for r in tables.travel(spark, str(tmp_path / "in")).collect()] == [(1, at("2020-01-01T00:00:00"), at("2020-01-02T00:00:00"), "A;B")]
    sinks.indexed_csv(found.orderBy("index").coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*.csv")).read_text().splitlines()
    assert text[0].lstrip(' "').startswith(",Name") or text[0].split(",")[0].strip('" ') == ""
    assert text[1] == '0,"Reed, Ann",1,3,2020-02-01 16:00:00,2020-02-04 17:00:00,Kiel;Ulm;Kiel;Jena'
    sinks.trip_lines(trips.route_lines(found, spark.createDataFrame(CITIES, "NAME string, pos int, x double, y double"), ["index"]), str(tmp_path / "lines"))
    assert "LineString (0.0 0.0,3.0 4.0)" in [r.geom_wkt for r in spark.read.parquet(str(tmp_path / "lines")).collect()]
    sinks.by_polygon(spark.createDataFrame([(7, 1), (8, 2)], "oid int, v int"), str(tmp_path / "clip"), "oid")
    assert {p.name for p in (tmp_path / "clip").glob("clip_oid=*")} == {"clip_oid=7", "clip_oid=8"}


def test_tracks_keep_their_order(spark):
    rows = spark.createDataFrame([("v", 2, 1.0, 1.0), ("v", 1, 0.0, 0.0), ("w", 1, 5.0, 5.0)], "id string, seq int, x double, y double")
    assert {r.id: [tuple(p) for p in r.path] for r in index.paths(rows, ["id"], "seq").collect()} == {"v": [(0.0, 0.0), (1.0, 1.0)], "w": [(5.0, 5.0)]}


def test_streams_take_the_same_expressions(spark, tmp_path):
    """Operators without a global order work on a streaming DataFrame too."""
    pd.DataFrame({"id": [1, 2], "x": [0.5, 9.0], "y": [0.5, 9.0]}).to_parquet(tmp_path / "p.parquet")
    zone = spark.createDataFrame([("z", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]])], "zone string, rings array<array<struct<x:double,y:double>>>")
    stream = spark.readStream.schema("id long, x double, y double").parquet(str(tmp_path))
    query = spatial.points_in_polygons(stream, zone).select("id", geo.bearing_label(F.col("x")).alias("b")).writeStream.format("memory").queryName("hits").start()
    try:
        query.processAllAvailable()
        assert [r.id for r in spark.sql("select id from hits").collect()] == [1]
    finally:
        query.stop()


def test_lists_and_tracks_in_parts(spark):
    rows = [(k % 4 and "hot" or "b", k, float(k % 7), float(k % 5)) for k in range(500)] + [(None, 1, 0.0, 0.0), (None, 2, 3.0, 4.0), ("one", 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id string, seq int, x double, y double").repartition(5)
    lists = {}
    for r in index.list_chunks(df, ["id"], ["seq"], "seq", 16).orderBy("chunk").collect():
        assert len(r["values"]) <= 16
        lists.setdefault(r.id, []).extend(r["values"])
    tracks = {}
    for r in index.path_chunks(df, ["id"], "seq", size=16).orderBy("chunk").collect():
        assert len(r.path) <= 17
        done = tracks.setdefault(r.id, [])
        assert not done or done[-1] == tuple(r.path[0])
        done.extend(map(tuple, r.path[1:] if done else r.path))
    for key in ("hot", "b", None, "one"):
        own = sorted(r[1:] for r in rows if r[0] == key)
        assert lists[key] == [r[0] for r in own] and tracks[key] == [r[1:] for r in own]
    assert index.list_chunks(df.limit(0), ["id"], ["seq"], "seq").count() == index.path_chunks(df.limit(0), ["id"], "seq").count() == 0


def test_table_functions_in_sql(spark):
    html.register_functions(spark)
    page = '<td class="lat">1.5</td><td class="city">Ulm x</td>'
    rows = spark.sql(f"SELECT p.*, r.* FROM VALUES ('u', '{page}'), ('v', '<td class=\"lat\">far</td>'), ('w', null) p(url, html), LATERAL place_cells(html) r").collect()
    found = {r.url: r for r in rows}
    assert (found["u"].lat, found["u"].city, found["u"].error) == (1.5, "Ulm", None) and found["v"].error and found["w"].city == ""


def test_travel_files_below_folders_by_their_names(spark, tmp_path):
    for k, name in enumerate(("travel_0001.csv", "a/travel_0002.csv", "a/b/travel_0003.csv", "a/travel_00004.csv", "xtravel_0005.csv", "travel_0006.csv.old")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f"{k},2020-01-01 00:00:00,2020-01-02 00:00:00,A;B\n")
    assert sorted(r.ID for r in tables.travel(spark, str(tmp_path)).collect()) == [0, 1, 2]


def test_example_of_a_trip_report(spark):
    """The published example: TRIP_EXAMPLE names a folder with its input_data and results."""
    folder = Path(os.environ.get("TRIP_EXAMPLE", ""))
    results = [f for f in (folder / "results").glob("employee_trips_*.csv") if os.environ.get("TRIP_EXAMPLE")]
    if not results:
        pytest.skip("the example is not here")
    limits = [F.lit(v).cast("timestamp_ntz") for v in ("2016-06-26 00:00:00", "2017-05-11 00:00:00")]
    people = tables.employees(spark, str(folder / "input_data" / "employees.csv"))
    report = pipelines.trip_report(people, tables.travel(spark, str(folder / "input_data")), *limits, ["Jones, Frank", "Brown, Justine", "Samulson, Roger"])
    got = {(r["index"], r.Name, r.ID, r.Duration, str(r.Start), str(r.End), r.Route) for r in report.collect()}
    whole, part = sorted((pd.read_csv(f) for f in results), key=len, reverse=True)
    assert got == set(whole.itertuples(index=False, name=None)) and len(got) == 14
    assert {r for r in got if 3 <= r[3] <= 10} == set(part.itertuples(index=False, name=None))
    stats = {r.Name: r for r in trips.trip_stats(report).collect()}
    for row in pd.read_csv(folder / "results" / "analysis.csv").itertuples():
        own = stats[row.Name]
        assert (own.total_trips, own.total_travel_days, own.total_cities, own.cities_visited, own.total_time_span, own.longest_trip_days, own.shortest_trip_days) == row[3:10]


@pytest.mark.parametrize("name", ["page_details", "page_table_functions", "page_kv", "buffer_rings", "vector_roundtrip"])
def test_rows_of_a_small_file_are_dealt_over_cores(spark, sf, monkeypatch, name):
    """The given part table is one task as it is read, at 60 times its size too; what takes long for each row is dealt first."""
    from terraops import storage
    from terraops.plans import queries

    dealt = []
    monkeypatch.setattr(storage, "dealt", lambda df, deal=storage.dealt: dealt.append(deal(df)) or dealt[-1])
    assert queries.QUERIES[name](spark, sf).count() > 0
    assert dealt and all(df.rdd.getNumPartitions() >= 4 for df in dealt)


def test_good_and_bad_rows_are_worked_out_once(spark, tmp_path):
    from terraops import sinks

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(10).selectExpr("id", "if(id % 5 = 0, 'bad', null) as error").mapInPandas(count, "id long, error string")
    sinks.catalog_json(rows, f"{tmp_path}/catalog")
    assert seen.value == 10
    assert spark.read.json(f"{tmp_path}/catalog").count() == 8 and spark.read.json(f"{tmp_path}/catalog_partial").count() == 2


@pytest.mark.parametrize(("records", "vertices"), [(7, 1 << 20), (1 << 16, 10), (1, 1)])
def test_a_partition_is_several_sets_of_files(spark, records, vertices):
    from terraops.sources import shapefile

    shapes = [([[{"x": float(k), "y": float(j)} for j in range(k % 4)]] if k % 4 else None, k) for k in range(40)]
    df = spark.createDataFrame(shapes, "parts array<array<struct<x:double,y:double>>>, k long").coalesce(1)
    files = shapefile.encoded(df, "line", records=records, vertices=vertices).where("kind in ('shp', 'dbf')").cache()
    back = shapefile.decoded(files)
    counts = back.groupBy("layer").agg(F.count("*").alias("n"), F.sum(F.size(F.flatten("parts"))).alias("v")).collect()
    assert len(counts) > 1 and all(r.n <= records and (r.v <= vertices or r.n == 1) for r in counts)
    want = {(k, k % 4) for _, k in shapes}
    assert {(int(r.attributes["k"]), sum(map(len, r.parts))) for r in back.collect()} == want and sum(r.n for r in counts) == 40


def in_any_order(df, seen):
    """df, whose rows come in another order each time they are worked out, as those of a shuffle over several executors do; seen counts them."""

    def mix(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch.sample(frac=1, random_state=np.random.default_rng())

    return df.mapInPandas(mix, df.schema)


@pytest.mark.parametrize("records", [16, 4_096])
def test_shapes_keep_their_attributes_when_rows_change_their_order(spark, records):
    points = spark.range(200).selectExpr("id as k", "array(array(struct(cast(id as double) as x, 0D as y))) as parts").coalesce(1)
    seen = spark.sparkContext.accumulator(0)
    back = shapefile.points(shapefile.decoded(shapefile.encoded(in_any_order(points, seen), "point"), records=records)).collect()
    assert seen.value == 200  # the files are read once
    assert sorted(int(r.attributes["k"]) for r in back) == list(range(200)) and all(int(r.attributes["k"]) == r.x for r in back)


@pytest.mark.parametrize("ordinates", [False, True])
def test_attributes_without_shapes_are_no_records(spark, ordinates):
    files = [("a", "dbf", bytearray(shapefile.write_attributes(pd.DataFrame({"k": [1, 2, 3]}))))]
    assert shapefile.decoded(spark.createDataFrame(files, "layer string, kind string, content binary"), ordinates, records=2).collect() == []


def test_vector_roundtrip_when_rows_change_their_order(spark, sf, monkeypatch):
    from terraops import storage
    from terraops.plans import queries

    seen = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(storage, "dealt", lambda df, deal=storage.dealt: in_any_order(deal(df), seen))
    df = queries.QUERIES["vector_roundtrip"](spark, sf)
    db = duckdb.connect()
    db.execute(f"create view part as select * from '{sf}/part.parquet'")
    want = sorted(db.execute(queries.ORACLE_SQL["vector_roundtrip"]).fetchall())
    for _ in range(2):
        assert sorted(tuple(r) for r in df.collect()) == want
    assert seen.value == len(want)  # the sets are made once


@pytest.mark.parametrize("together", [1, 3_000, 1 << 20])
def test_small_members_are_handed_on_together(spark, monkeypatch, together):
    from terraops.sources import archives

    monkeypatch.setattr(archives, "TOGETHER", together)
    packed = []
    for k in range(20):
        with zipfile.ZipFile(buffer := io.BytesIO(), "w") as file:
            for j in range(k % 3):
                file.writestr(f"{j}", bytes([k]) * 100 * j)
        packed.append((f"a{k}", bytearray(buffer.getvalue()) if k else None))
    got = archives.members(spark.createDataFrame(packed, "archive string, content binary").coalesce(1)).collect()
    assert {(r.archive, r.member, bytes(r.content)) for r in got if r.member} == {(f"a{k}", f"{j}", bytes([k]) * 100 * j) for k in range(1, 20) for j in range(k % 3)}
    assert [r.archive for r in got if r.error] == ["a0"]
