"""Scalar functions, with their edge cases."""

import math
from datetime import date, datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terraops.functions import geo, text, time


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def ring(*points):
    return F.array(*[geo.point(F.lit(x), F.lit(y)) for x, y in points])


SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]


def test_whole_days_are_not_calendar_days(spark):
    stamp = lambda s: F.lit(datetime.fromisoformat(s)).cast("timestamp_ntz")
    assert one(spark, time.whole_days(stamp("2024-01-01T23:00:00"), stamp("2024-01-02T22:59:59"))) == 0
    assert one(spark, time.whole_days(stamp("2024-01-01T23:00:00"), stamp("2024-01-03T23:00:00"))) == 2
    assert one(spark, time.whole_days(stamp("2024-01-02T00:00:00"), stamp("2024-01-01T23:00:00"))) == -1


def test_dates_in_several_formats(spark):
    rows = [("2020-02-29",), ("2020-02-29T10:11:12.5Z",), ("Present",), (None,), ("soon",), ("2020-13-01",)]
    df = spark.createDataFrame(rows, "t string").select(time.parse_date(F.col("t")).alias("d"), time.is_present(F.col("t")).alias("p"), time.unreadable(F.col("t")).alias("u"))
    assert [tuple(r) for r in df.collect()] == [(date(2020, 2, 29), False, False)] * 2 + [(None, True, False), (None, False, False), (None, False, True), (None, False, True)]


def test_availability_wants_one_separator(spark):
    rows = [("2001-01-01 - 2002-01-01",), ("2001-01-01 - Present",), ("2001-01-01",), ("a - b - c",), ("x - y",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    loose = [r[0] and tuple(r[0]) for r in df.select(time.availability(F.col("t"))).collect()]
    strict = [r[0] and tuple(r[0]) for r in df.select(time.availability(F.col("t"), strict=True)).collect()]
    assert loose == [("2001-01-01", "2002-01-01"), ("2001-01-01", "Present"), None, None, ("x", "y"), None]
    assert strict == loose[:4] + [None, None]


def test_period_is_clipped_and_bounded(spark):
    assert one(spark, time.period_start(F.lit(date(2020, 8, 31)), 6, F.lit(date(2000, 1, 1)), F.lit(date(2019, 1, 1)))) == date(2020, 2, 29)
    assert one(spark, time.period_start(F.lit(date(2000, 3, 1)), 6, F.lit(date(2000, 1, 1)), F.lit(date(2000, 2, 2)))) == date(2000, 2, 2)
    assert one(spark, time.year_start(date(2024, 5, 6))) == date(2024, 1, 1)


@pytest.mark.parametrize(("angle", "label"), [(0, "N"), (22.5, "NE"), (337.5, "N"), (337.4, "NW"), (-22.5, "N"), (-45, "NW"), (180, "S"), (-180, "S"), (359, "N"), (112.5, "SE")])
def test_bearing_label(spark, angle, label):
    assert one(spark, geo.bearing_label(F.lit(float(angle)))) == label


def test_bearing_and_haversine(spark):
    at = [F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)]
    assert one(spark, geo.bearing(*at)) == pytest.approx(90)
    assert one(spark, geo.haversine(*at)) == pytest.approx(math.radians(1) * 3956)


@pytest.mark.parametrize(("unit", "km"), [("MI", 1.60934), ("Miles", 1.60934), ("m", 0.001), ("feet", 1 / 3280.839895), ("km", 1.0), ("parsec", 1.0)])
def test_units(spark, unit, km):
    assert one(spark, geo.to_km(F.lit(1.0), F.lit(unit))) == pytest.approx(km)


def test_circle_corners(spark):
    corners = one(spark, geo.circle(F.lit(0.0), F.lit(0.0), F.lit(100.0)))
    angles = [math.degrees(math.atan2(p["x"], p["y"])) % 360 for p in corners]
    assert angles == pytest.approx([30, 90, 150, 210, 270, 330], abs=0.01)
    assert len(one(spark, geo.closed(geo.buffer(F.lit(0.0), F.lit(0.0), F.lit(30.0))))) == 65


def test_paths_of_few_points(spark):
    empty = F.array().cast("array<struct<x:double,y:double>>")
    assert one(spark, geo.path_length(empty)) == 0
    assert one(spark, geo.path_length(ring((1.0, 1.0)))) == 0
    assert one(spark, geo.in_ring(F.lit(0.0), F.lit(0.0), empty)) is False
    assert one(spark, geo.closed(empty)) == []
    assert one(spark, geo.path_length(ring((0.0, 0.0), (3.0, 4.0)))) == 5


def test_hole_is_outside(spark):
    rings = F.array(ring(*SQUARE), ring((1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)))
    assert one(spark, geo.in_rings(F.lit(3.0), F.lit(3.0), rings)) is True
    assert one(spark, geo.in_rings(F.lit(1.5), F.lit(1.5), rings)) is False


def test_wkt_both_ways(spark):
    text_ = one(spark, geo.line_wkt(ring((1.5, 2.0), (-3.0, 4.25))))
    assert text_ == "LineString (1.5 2.0,-3.0 4.25)"
    assert [tuple(p) for p in one(spark, geo.line_from_wkt(F.lit(text_)))] == [(1.5, 2.0), (-3.0, 4.25)]
    assert one(spark, geo.line_from_wkt(F.lit("Point (1 2)"))) is None
    assert one(spark, geo.polygon_wkt(F.array(ring((0.0, 0.0), (1.0, 0.0))))) == "Polygon ((0.0 0.0,1.0 0.0))"


def test_geodesics_against_published_values(spark):
    # a degree of longitude at the equator, a degree of latitude from it, and a quarter meridian on WGS84
    assert geo.geodesic_metres(*map(np.array, ([0.0], [0.0], [1.0], [0.0])))[0] == pytest.approx(111319.491, abs=0.01)
    assert geo.geodesic_metres(*map(np.array, ([0.0], [0.0], [0.0], [1.0])))[0] == pytest.approx(110574.389, abs=0.01)
    assert geo.geodesic_metres(*map(np.array, ([0.0], [0.0], [0.0], [90.0])))[0] == pytest.approx(10001965.729, abs=0.01)
    assert geo.geodesic_metres(*map(np.array, ([5.0], [5.0], [5.0], [5.0])))[0] == 0
    rows = spark.createDataFrame([([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)],), ([],), (None,)], "p array<struct<x:double,y:double>>")
    assert [r[0] for r in rows.select(geo.geodesic_length(F.col("p"))).collect()] == [pytest.approx(221893.88, abs=0.1), 0.0, None]


def test_area_of_the_whole_ellipsoid(spark):
    corners = [(float(x), 0.0) for x in range(0, 361, 30)] + [(360.0, 90.0), (0.0, 90.0)]
    assert one(spark, geo.ellipsoid_area(ring(*corners))) == pytest.approx(510065621724089 / 2, rel=1e-9)


def test_texts(spark):
    assert one(spark, text.code_block(F.lit('ee.ImageCollection("A/B/C")'))) == ("ImageCollection", "A/B/C")
    assert one(spark, text.publisher(F.lit("A/B/C"))) == "A"
    assert one(spark, text.stem(F.lit("a.b.csv"))) == "a.b"
    assert one(spark, text.extension(F.lit("a.b.csv"))) == ".csv"
    assert one(spark, text.last_segment(F.lit("x/y/z"))) == "z"
    assert one(spark, text.round1(F.lit(0.25))) == 0.2
    assert one(spark, text.unknown_if_missing(F.create_map(F.lit("a"), F.lit("b")))) == "unknown"
    assert one(spark, text.is_folder_link(F.lit("TRACT/"))) and not one(spark, text.is_folder_link(F.lit("TWO WORDS")))


coordinate = st.integers(-40, 40).map(lambda v: v / 10 + 0.003)
polygon = st.lists(st.tuples(st.integers(-30, 30), st.integers(-30, 30)), min_size=3, max_size=8, unique=True).map(lambda p: np.array(p, float) / 10)


def test_geodesics_between_all_pairs():
    draw = np.random.default_rng(0)
    x, y = draw.uniform(-180, 180, 5_000), draw.uniform(-89, 89, 5_000)
    back = geo.geodesic_metres(x, y, x + 180 + draw.normal(0, 0.3, 5_000), -y + draw.normal(0, 0.3, 5_000))
    assert np.isfinite(back).all() and back.min() > 19.8e6 and back.max() < 20_003_932
    known = [((0, 0), (179.5, 0.5), 19936288.579), ((0, -30), (179.8, 29.9), 19989832.828), ((0, 0), (180, 0), 20003931.459), ((10, 0), (40, 0), 6378137 * np.radians(30)), ((5, 90), (77, 90), 0.0), ((170, 10), (-170, 10), None)]
    for (x1, y1), (x2, y2), metres in known:
        got = geo.geodesic_metres(*(np.array([float(v)]) for v in (x1, y1, x2, y2)))[0]
        assert got == pytest.approx(metres if metres is not None else geo.geodesic_metres(*(np.array([v]) for v in (0.0, 10.0, 20.0, 10.0)))[0], abs=2e-3)
    # the search by azimuth against the rounds, where these converge
    u = lambda v: np.arctan((1 - geo.WGS84_F) * np.tan(np.radians(v)))
    turn, u1, u2 = np.radians(draw.uniform(0, 150, 5_000)), u(y), u(draw.permutation(y))
    terms = turn, np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    assert np.nanmax(np.abs(geo._vincenty(*terms) - geo._by_azimuth(*terms))) < 1e-3
    assert np.isnan(geo.geodesic_metres(*(np.array([v]) for v in (np.nan, 0.0, 1.0, 1.0)))).all()


def test_rings_over_the_date_line_and_poles(spark):
    centres = spark.createDataFrame([(0.0, 179.5, 500.0), (88.0, 10.0, 1000.0), (-85.0, -170.0, 1500.0), (50.0, -179.9, 800.0), (20.0, 30.0, 700.0)], "lat double, lon double, km double")
    df = centres.withColumn("rings", geo.wrapped_rings(geo.circle(F.col("lat"), F.col("lon"), F.col("km"), 64))).cache()
    points = spark.createDataFrame([(float(x), float(y)) for x in range(-180, 181, 5) for y in range(-90, 91, 3)], "x double, y double")
    rows = df.crossJoin(points).select("*", geo.in_rings(F.col("x"), F.col("y"), F.col("rings")).alias("inside"), geo.haversine(F.col("lat"), F.col("lon"), F.col("y"), F.col("x"), geo.KM).alias("d"), F.size("rings").alias("n")).drop("rings").collect()
    for r in rows:
        if r.d < 0.95 * r.km and r.x < 180:  # 180 is -180
            assert r.inside, r
        assert not (r.d > 1.02 * r.km and r.inside), r
    assert {(r.lat, r.n) for r in rows} == {(0.0, 2), (88.0, 2), (-85.0, 2), (50.0, 2), (20.0, 1)}
    plain = df.select(geo.circle(F.col("lat"), F.col("lon"), F.col("km")).alias("r")).where("r[0].x between 0 and 100").select((geo.wrapped_rings(F.col("r")) == F.array("r")).alias("same"))
    assert plain.where("not same").count() == 0


def test_areas_about_poles(spark):
    """A hemisphere, what lies north of a parallel, and strips over the date line, however they are cut."""
    ring = lambda y, turn=1: [(float((turn * 30 * k + 180) % 360 - 180), y) for k in range(12)]
    box = lambda x0, x1, y0, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    rings = [ring(0.0), ring(60.0), ring(60.0, -1), ring(-60.0), box(170.0, -170.0, 10.0, 20.0), box(0.0, 20.0, 10.0, 20.0), ring(0.0, -1)]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rings)], "k int, ring array<struct<x:double,y:double>>")
    area = {r.k: r.a for r in df.select("k", geo.ellipsoid_area(F.col("ring")).alias("a")).collect()}
    half = 510065621724088.4 / 2
    assert area[0] == pytest.approx(half, rel=1e-9) == area[6]
    assert area[1] == area[2] == pytest.approx(area[3], rel=1e-12) and 0.06 * 2 * half < area[1] < 0.07 * 2 * half
    assert area[4] == pytest.approx(area[5], rel=1e-12)


def test_geodesics_are_those_of_the_converged_formula():
    """A step of 1e-12 in longitude is some micrometres, and near-antipodal edges differ by method: either turned sums over a rounding tie."""
    draw = np.random.default_rng(11)
    x1, x2, y1, y2 = draw.uniform(-180, 180, 20_000), draw.uniform(-180, 180, 20_000), draw.uniform(-89, 89, 20_000), draw.uniform(-89, 89, 20_000)
    x2[:2_000], y2[:2_000] = x1[:2_000] + 180 + draw.uniform(-3, 3, 2_000), -y1[:2_000] + draw.uniform(-0.9, 0.9, 2_000)
    f = geo.WGS84_F
    turn = np.abs(np.radians((x2 - x1 + 180) % 360 - 180))
    u1, u2 = np.arctan((1 - f) * np.tan(np.radians(y1))), np.arctan((1 - f) * np.tan(np.radians(y2)))
    exact = geo._by_azimuth(turn, np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2))
    near = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * np.cos(turn) < -0.99
    got = geo.geodesic_metres(x1, y1, x2, y2)
    assert near.sum() > 1_000 and np.abs(got - exact)[near].max() < 1e-7
    t, s1, c1, s2, c2 = (v[~near] for v in (turn, np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)))
    lam, b = t, geo.WGS84_A * (1 - f)
    for _ in range(60):
        sin_s, cos_s = np.hypot(c2 * np.sin(lam), c1 * s2 - s1 * c2 * np.cos(lam)), s1 * s2 + c1 * c2 * np.cos(lam)
        s, sin_a = np.arctan2(sin_s, cos_s), c1 * c2 * np.sin(lam) / sin_s
        q = 1 - sin_a**2
        m, c = cos_s - 2 * s1 * s2 / q, f / 16 * q * (4 + f * (4 - 3 * q))
        lam = t + (1 - c) * f * sin_a * (s + c * sin_s * (m + c * cos_s * (2 * m**2 - 1)))
    k = q * (geo.WGS84_A**2 - b**2) / b**2
    a, d = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k))), k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    metres = b * a * (s - d * sin_s * (m + d / 4 * (cos_s * (2 * m**2 - 1) - d / 6 * m * (4 * sin_s**2 - 3) * (4 * m**2 - 3))))
    assert np.abs(got[~near] - metres).max() < 2e-7
