"""Geometry as columns: a point is struct<x,y>, a path or ring an array of points, a shape an array of rings."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean radius in miles of the trip report, in km of the search polygons, and the WGS84 ellipsoid.
MILES, KM = 3956, 6371
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def pairs(path: Column, merge) -> Column:
    """merge(a, b) of each two consecutive points; empty for fewer than two."""
    n = F.greatest(F.size(path) - 1, F.lit(0))
    return F.zip_with(F.slice(path, 1, n), F.slice(path, 2, n), merge)


def closed(ring: Column) -> Column:
    """The ring with its first point once more at the end."""
    return F.when(F.size(ring) > 0, F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def path_length(path: Column) -> Column:
    """Planar length in the units of the coordinates."""
    return total(pairs(path, lambda a, b: F.hypot(b.x - a.x, b.y - a.y)))


def degrees_to_miles(length: Column) -> Column:
    return F.radians(length) * MILES


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = MILES) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing in degrees above -180 up to 180."""
    turn, p, q = F.radians(lon2 - lon1), F.radians(lat1), F.radians(lat2)
    return F.degrees(F.atan2(F.cos(q) * F.sin(turn), F.cos(p) * F.sin(q) - F.sin(p) * F.cos(q) * F.cos(turn)))


def bearing_label(angle: Column) -> Column:
    """One of eight directions; a sector holds its lower bound, and 337.5 is north."""
    turned = F.when(angle < 0, angle + 360).otherwise(angle)
    names = F.array(*map(F.lit, ("N", "NE", "E", "SE", "S", "SW", "W", "NW", "N")))
    return F.get(names, F.floor((turned + 22.5) / 45).cast("int"))


def to_km(distance: Column, unit: Column) -> Column:
    """Miles, metres or feet as km, whatever the case of the unit; other units are left unchanged."""
    u = F.lower(unit)
    return F.when(u.isin("mi", "miles"), distance * 1.60934).when(u.isin("m", "meters"), distance / 1000).when(u.isin("ft", "feet"), distance / 3280.839895).otherwise(distance)


def circle(lat: Column, lon: Column, radius_km: Column, sides: int = 6) -> Column:
    """Ring of a regular polygon about a point of the sphere; the first corner is half a step from north.

    Longitudes are not wrapped: circles over the date line or a pole reach beyond 180 degrees; see wrapped_rings.
    """
    p, r, step = F.radians(lat), radius_km / KM, 2 * math.pi / sides
    once = F.struct(F.sin(p).alias("sp"), F.cos(p).alias("cp"), F.sin(r).alias("sr"), F.cos(r).alias("cr"), F.radians(lon).alias("lon"))

    def corners(c: Column) -> Column:
        def aimed(k: Column) -> Column:
            turn = F.lit(step / 2) + k * step
            return F.struct(F.sin(turn).alias("east"), F.asin(c.sp * c.cr + c.cp * c.sr * F.cos(turn)).alias("y"))

        def corner(a: Column) -> Column:
            x = c.lon + F.atan2(a.east * c.sr * c.cp, c.cr - c.sp * F.sin(a.y))
            return F.struct((x * 180 / math.pi).alias("x"), (a.y * 180 / math.pi).alias("y"))

        return F.transform(F.transform(F.sequence(F.lit(0), F.lit(sides - 1)), aimed), corner)

    return _let(once, corners)  # sines of the centre and the radius are the same for all corners


def buffer(lat: Column, lon: Column, distance: Column, unit: str = "mi", sides: int = 64) -> Column:
    return circle(lat, lon, to_km(distance, F.lit(unit)), sides)


def _let(value: Column, body) -> Column:
    """body of value, which is worked out once."""
    return F.transform(F.array(value), body)[0]


def turn(degrees: Column) -> Column:
    """A difference of longitudes the shorter way round: at least -180 and below 180."""
    return F.when((degrees >= -180) & (degrees < 180), degrees).otherwise(degrees - 360 * F.floor((degrees + 180) / 360))


def unrolled(ring: Column) -> Column:
    """The ring with longitudes that go on from corner to corner the shorter way, the first corner once more at the end.

    In a ring about a pole the last longitude is 360 degrees from the first. Work grows with the square of the corners.
    """

    def on(done: Column, p: Column) -> Column:
        last = F.element_at(done, -1)
        return F.concat(done, F.array(F.struct((last.x + turn(p.x - last.x)).alias("x"), p.y.alias("y"))))

    return F.when(F.size(ring) > 0, F.aggregate(F.slice(closed(ring), 2, F.size(ring)), F.slice(ring, 1, 1), on)).otherwise(ring)


def _beside(ring: Column, x: Column, right: bool) -> Column:
    """The part of the ring on one side of the meridian x."""
    inside = (lambda p: p.x >= x) if right else (lambda p: p.x <= x)

    def step(a: Column, b: Column) -> Column:
        met = F.struct(x.alias("x"), (a.y + (b.y - a.y) * F.try_divide(x - a.x, b.x - a.x)).alias("y"))
        none = F.slice(F.array(a), 1, 0)
        return F.concat(F.when(inside(a), F.array(a)).otherwise(none), F.when(inside(a) != inside(b), F.array(met)).otherwise(none))

    return _let(ring, lambda r: F.flatten(pairs(closed(r), step)))


def wrapped_rings(ring: Column) -> Column:
    """Rings between -180 and 180 degrees that together enclose what the ring does on the globe.

    Edges go the shorter way round. A ring over the date line is split there, one about a pole is closed over the
    pole that is nearer to its corners; any other is left as it is.
    """

    def split(line: Column) -> Column:
        first, last = line[0], F.element_at(line, -1)
        pole = F.when(F.aggregate(line, F.lit(0.0), lambda t, p: t + p.y) >= 0, 91.0).otherwise(-91.0)  # beyond it, so that points at the pole are inside
        over = F.array(*[F.struct(p.x.alias("x"), pole.alias("y")) for p in (last, first)])
        whole = F.when(F.abs(last.x - first.x) > 180, F.concat(line, over)).otherwise(F.slice(line, 1, F.size(line) - 1))
        strip = lambda r, k: _beside(_beside(r, 360.0 * k - 180, True), 360.0 * k + 180, False)
        moved = lambda r: F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda k: F.transform(strip(r, k), lambda p: F.struct((p.x - 360 * k).alias("x"), p.y.alias("y"))))
        return F.filter(_let(whole, moved), lambda r: F.size(r) > 2)

    far = F.exists(ring, lambda p: F.abs(p.x) > 180) | F.exists(pairs(closed(ring), lambda a, b: F.abs(b.x - a.x) > 180), lambda v: v)
    return F.when(far, _let(unrolled(ring), split)).otherwise(F.array(ring))


def in_rings(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd rule over all rings, which need not be closed; a ring edge is half-open in y."""

    def crosses(a: Column, b: Column) -> Column:
        spans = (b.y > y) != (a.y > y)
        return F.when(spans, x < F.try_divide((a.x - b.x) * (y - b.y), a.y - b.y) + b.x).otherwise(False)

    edges = F.flatten(F.transform(rings, lambda ring: pairs(closed(ring), crosses)))
    return F.aggregate(edges, F.lit(False), lambda odd, e: odd != e)


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    return in_rings(x, y, F.array(ring))


def box(points: Column) -> Column:
    """struct<x0,y0,x1,y1> about the points; nulls for none."""
    xs, ys = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def path_text(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda p: F.concat_ws(" ", p.x.cast("string"), p.y.cast("string"))), ",")


def line_wkt(path: Column) -> Column:
    return F.concat(F.lit("LineString ("), path_text(path), F.lit(")"))


def polygon_wkt(rings: Column) -> Column:
    return F.concat(F.lit("Polygon ("), F.array_join(F.transform(rings, lambda r: F.concat(F.lit("("), path_text(r), F.lit(")"))), ","), F.lit(")"))


def line_from_wkt(text: Column) -> Column:
    """The path of a LineString text, null for anything else."""
    inner = F.regexp_extract(text, r"(?i)^\s*linestring\s*\(([^()]*)\)\s*$", 1)
    parts = F.transform(F.split(F.trim(inner), r"\s*,\s*"), lambda p: F.split(p, r"\s+"))
    path = F.transform(parts, lambda p: F.struct(F.get(p, 0).try_cast("double").alias("x"), F.get(p, 1).try_cast("double").alias("y")))
    return F.when(inner != "", path)


#: Rounds of Vincenty's formula before an edge is left to the search by azimuth, and halvings of that.
ROUNDS, HALVINGS = 20, 120
#: Edges whose ends are so near to antipodal (cosine of their angle on the auxiliary sphere) are left to that search at once.
ANTIPODAL = -0.99


def _vincenty(turn: np.ndarray, s1: np.ndarray, c1: np.ndarray, s2: np.ndarray, c2: np.ndarray) -> np.ndarray:
    """Metres by Vincenty's inverse formula; NaN where it has not converged, as it does not between near-antipodal points."""
    f, b = WGS84_F, WGS84_A * (1 - WGS84_F)
    out = np.full(len(turn), np.nan)
    left, lam, last = np.arange(len(turn)), turn.copy(), np.zeros(len(turn), bool)  # one round more once converged: 1e-12 of lam are some micrometres
    with np.errstate(invalid="ignore", divide="ignore"):
        for _ in range(ROUNDS):
            u1, v1, u2, v2 = s1[left], c1[left], s2[left], c2[left]
            sin_s = np.hypot(v2 * np.sin(lam), v1 * u2 - u1 * v2 * np.cos(lam))
            cos_s = u1 * u2 + v1 * v2 * np.cos(lam)
            s = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s == 0, 0, v1 * v2 * np.sin(lam) / sin_s)
            cos2_a = 1 - sin_a**2
            cos_m = np.where(cos2_a == 0, 0, cos_s - 2 * u1 * u2 / np.where(cos2_a == 0, 1, cos2_a))
            c = f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a))
            after = turn[left] + (1 - c) * f * sin_a * (s + c * sin_s * (cos_m + c * cos_s * (2 * cos_m**2 - 1)))
            done = (np.abs(after - lam) < 1e-12) & (np.abs(after) <= np.pi)
            k = cos2_a * (WGS84_A**2 - b**2) / b**2
            big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
            big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
            ds = big_b * sin_s * (cos_m + big_b / 4 * (cos_s * (2 * cos_m**2 - 1) - big_b / 6 * cos_m * (4 * sin_s**2 - 3) * (4 * cos_m**2 - 3)))
            out[left[last]] = np.where(sin_s == 0, 0.0, b * big_a * (s - ds))[last]
            left, lam, last = left[~last], after[~last], done[~last]
            if not len(left):
                break
    return out


def _by_azimuth(turn: np.ndarray, s1: np.ndarray, c1: np.ndarray, s2: np.ndarray, c2: np.ndarray) -> np.ndarray:
    """Metres for 0 <= turn <= pi by a search for the azimuth at the first point; it converges for all pairs of points.

    With the point further from the equator first, and that in the south, the longitude that a geodesic reaches
    grows with its azimuth (Karney, Algorithms for geodesics, 2013), so halving finds the root. Longitude and length are integrals of
    smooth functions along the great circle of the auxiliary sphere, taken by Gauss and Legendre's rule.
    """
    f, b = WGS84_F, WGS84_A * (1 - WGS84_F)
    swap = np.abs(s2) > np.abs(s1)
    s1, c1, s2, c2 = np.where(swap, s2, s1), np.where(swap, c2, c1), np.where(swap, s1, s2), np.where(swap, c1, c2)
    sign = np.where(s1 > 0, -1.0, 1.0)
    s1, s2 = np.where(s1 == 0, -1e-300, s1 * sign), s2 * sign
    nodes, weights = np.polynomial.legendre.leggauss(16)

    def reached(delta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longitude and length of the geodesic whose azimuth is delta beyond east."""
        sin_a, cos_a = np.cos(delta), -np.sin(delta)
        sin_0 = sin_a * c1
        across = np.sqrt(np.maximum(0, (cos_a * c1) ** 2 + (c2 - c1) * (c2 + c1)))  # cos a2 cos u2
        from_, to = np.arctan2(s1, cos_a * c1), np.arctan2(s2, across)
        omega = np.arctan2(sin_0 * s2, across) - np.arctan2(sin_0 * s1, cos_a * c1)
        k2 = (cos_a**2 + (sin_a * s1) ** 2) * f * (2 - f) / (1 - f) ** 2
        half = (to - from_) / 2
        root = np.sqrt(1 + k2[:, None] * np.sin(((from_ + to) / 2)[:, None] + half[:, None] * nodes) ** 2)
        behind = half * ((2 - f) / (1 + (1 - f) * root) * weights).sum(1)
        return omega - f * sin_0 * behind, b * half * (root * weights).sum(1)

    low, high = np.full(len(turn), -np.pi / 2), np.full(len(turn), np.pi / 2)
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        short = reached(middle)[0] < turn
        low, high = np.where(short, middle, low), np.where(short, high, middle)
    out = reached(high)[1]
    along = (s1 == -1e-300) & (s2 == 0) & (turn <= (1 - f) * np.pi)  # on the equator
    return np.where(along, WGS84_A * turn, out)


def geodesic_metres(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """Length of the shortest way on the WGS84 ellipsoid, for every pair of points; NaN for coordinates that are not finite.

    Near-antipodal points, whose cosine is below ANTIPODAL, are measured by azimuth, all others by Vincenty's formula.
    """
    f = WGS84_F
    turn = np.radians((lon2 - lon1 + 180) % 360 - 180)
    u1, u2 = np.arctan((1 - f) * np.tan(np.radians(lat1))), np.arctan((1 - f) * np.tan(np.radians(lat2)))
    terms = [np.abs(turn), np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)]
    out = np.full(len(turn), np.nan)
    plain = np.flatnonzero(~(terms[1] * terms[3] + terms[2] * terms[4] * np.cos(turn) < ANTIPODAL))
    out[plain] = _vincenty(*[t[plain] for t in terms])
    left = np.flatnonzero(np.isnan(out) & np.isfinite(turn + u1 + u2))
    if len(left):
        out[left] = _by_azimuth(*[t[left] for t in terms])
    return out


def geodesic_length(path: Column) -> Column:
    """Metres along the path on the WGS84 ellipsoid; null for a null path. Arrow batches into numpy."""

    @F.pandas_udf("double")
    def measure(xs: pd.Series, ys: pd.Series) -> pd.Series:
        sizes = np.array([0 if v is None else len(v) for v in xs])
        x, y = (np.concatenate([np.asarray(v, float) for v in c if v is not None] or [np.empty(0)]) for c in (xs, ys))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        same = np.flatnonzero(owner[:-1] == owner[1:]) if len(owner) else np.empty(0, int)
        parts = geodesic_metres(x[same], y[same], x[same + 1], y[same + 1])
        out = pd.Series(np.bincount(owner[same], parts, len(sizes)) if len(same) else np.zeros(len(sizes)))
        return out.where(pd.Series([v is not None for v in xs]))

    return measure(F.transform(path, lambda p: p.x), F.transform(path, lambda p: p.y))


def ellipsoid_area(ring: Column) -> Column:
    """Square metres inside a ring on the WGS84 ellipsoid: the sphere's trapezoids at authalic latitudes.

    Edges go the shorter way round, so a ring may cross the date line. One that goes once round encloses a pole,
    and its area is what the ring leaves of that half of the ellipsoid.
    """
    e = math.sqrt(WGS84_F * (2 - WGS84_F))
    atanh = lambda v: 0.5 * F.log((1 + v) / (1 - v))
    q_pole = 1 + (1 - e * e) / (2 * e) * math.log((1 + e) / (1 - e))

    def q(y: Column) -> Column:
        s = F.sin(F.radians(y))
        return (1 - e * e) * (s / (1 - e * e * s * s) + atanh(e * s) / e)

    def step(a: Column, b: Column) -> Column:
        x = turn(b.x - a.x)
        return F.struct(x.alias("x"), (F.radians(x) * (q(a.y) + q(b.y)) / (2 * q_pole)).alias("part"))

    def area(steps: Column) -> Column:
        part = F.abs(total(F.transform(steps, lambda s: s.part)))
        round_ = F.abs(total(F.transform(steps, lambda s: s.x))) > 180
        return F.when(round_, 2 * math.pi - part).otherwise(part) * (WGS84_A**2 * q_pole / 2)

    return _let(pairs(closed(ring), step), area)
