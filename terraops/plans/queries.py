"""Every operator as a query over the given tables, with the same result in DuckDB SQL where SQL has one."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraops import sinks, storage
from terraops.functions import geo, text, time
from terraops.operators import catalog as cat
from terraops.operators import index, osm, poi, spatial, trips
from terraops.plans import pipelines, views
from terraops.sources import archives, html, shapefile, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
PERIOD = (date(2005, 1, 1), date(2006, 12, 31))
NAMES = ["index", "Name", "ID", "Duration", "Start", "End", "Route"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = views.sql(sql)
        return f

    return register


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = views.people(spark, sf_dir).where(F.col("Team").isin(*views.SEGMENTS)).drop("Team")
    limits = [F.lit(v).cast("timestamp_ntz") for v in (views.FROM, views.TO)]
    return pipelines.trip_report(staff, views.trips(spark, sf_dir), *limits)


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = views.people(spark, sf_dir).where(F.col("Team").isin(*views.SEGMENTS)).drop("Team")
    limits = [F.lit(v).cast("timestamp_ntz") for v in (views.FROM, views.TO)]
    return trips.employee_trips(staff, views.trips(spark, sf_dir), *limits)


@query('SELECT "index", "Name", "ID", "Duration", "Start", "End", "Route" FROM report')
def trips_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query('SELECT "index", "Name", "Duration" FROM report WHERE "Duration" BETWEEN 3 AND 5')
def trips_duration_range(spark, sf_dir):
    """Through the indexed CSV, written and read back: the subset keeps the labels of the whole."""
    folder = storage.shared_folder(spark, "trips_csv")
    sinks.indexed_csv(_report(spark, sf_dir).where(F.col("Duration").between(3, 5)).select("index", "Name", "Duration"), folder)
    return spark.read.schema("index long, Name string, Duration int").option("header", True).option("enforceSchema", True).csv(folder)


_STATS = """SELECT "Name", count(*) AS total_trips, CAST(sum("Duration") AS BIGINT) AS total_travel_days, CAST((epoch_us(max("End")) - epoch_us(min("Start"))) // 86400000000 AS INTEGER) AS total_time_span,
    max("Duration") AS longest_trip_days, min("Duration") AS shortest_trip_days, CAST(len(string_split(max("Route"), ';')) AS INTEGER) AS most_stops_compat, CAST(max(len(string_split("Route", ';'))) AS INTEGER) AS most_stops FROM report GROUP BY "Name\""""
_SEEN = """SELECT "Name", string_agg(city, ';' ORDER BY "Duration", "Start", "End", pos) AS cities_visited, count(*) AS total_cities FROM
    (SELECT *, row_number() OVER (PARTITION BY "Name", city ORDER BY "Duration", "Start", "End", pos) AS r FROM stops) WHERE r = 1 GROUP BY "Name\""""


@query(f"SELECT s.*, c.cities_visited, c.total_cities FROM ({_STATS}) s JOIN ({_SEEN}) c USING (\"Name\")")
def trips_stats(spark, sf_dir):
    return trips.trip_stats(_found(spark, sf_dir))


@query(f"""SELECT "Name", total_trips, round_even(total_travel_days::DOUBLE / total_trips, 1) AS avg_days_per_trip, round_even(100.0::DOUBLE * total_travel_days / nullif(total_time_span, 0), 1) AS travel_time_pct,
    round_even(total_time_span::DOUBLE / total_trips, 1) AS span_per_trip FROM ({_STATS})""")
def trips_ratios(spark, sf_dir):
    return trips.trip_ratios(trips.trip_stats(_found(spark, sf_dir))).select("Name", "total_trips", "avg_days_per_trip", "travel_time_pct", "span_per_trip")


@query(_SEEN)
def trips_cities_first_seen(spark, sf_dir):
    return trips.cities_first_seen(_found(spark, sf_dir))


@query("""SELECT "index", 'LineString (' || string_agg(cx || ' ' || cy, ',' ORDER BY pos) || ')' AS wkt, count(*) AS points FROM stops JOIN cities USING (city) GROUP BY "index\"""")
def trips_wkt(spark, sf_dir):
    lines = trips.route_lines(_report(spark, sf_dir), views.cities(spark), ["index"])
    wkt = geo.line_wkt(F.col("path"))
    return lines.select("index", wkt.alias("wkt"), F.size(geo.line_from_wkt(wkt)).cast("long").alias("points"))


@query("""SELECT "Name", round(sum(radians(d) * 3956), 1) AS total_distance_mi FROM (
    SELECT "Name", sum(sqrt((coalesce(nx, fx) - cx) ** 2 + (coalesce(ny, fy) - cy) ** 2)) AS d FROM (
        SELECT "Name", "index", cx, cy, lead(cx) OVER w AS nx, lead(cy) OVER w AS ny, first_value(cx) OVER w AS fx, first_value(cy) OVER w AS fy
        FROM stops JOIN cities USING (city) WINDOW w AS (PARTITION BY "index" ORDER BY pos)) GROUP BY "Name", "index") GROUP BY "Name\"""")
def trips_distance(spark, sf_dir):
    return trips.trip_distance(_report(spark, sf_dir), views.cities(spark), ["index"])


@query("""SELECT "index", "Name", "Start" FROM report WHERE "index" < 3 OR "index" >= (SELECT count(*) FROM report) - 3""")
def trips_preview_first_last(spark, sf_dir):
    rows = _report(spark, sf_dir).select("index", "Name", "Start")
    return rows.orderBy("index").limit(3).union(rows.orderBy(F.desc("index")).limit(3)).distinct()


@query("""SELECT "ID", "Route", "End" FROM trips UNION ALL BY NAME SELECT c_custkey AS "ID", c_name AS "Name" FROM customer""")
def travel_union(spark, sf_dir):
    other = views.people(spark, sf_dir).select("ID", "Name")
    return views.trips(spark, sf_dir).select("ID", "Route", "End").unionByName(other, allowMissingColumns=True)


@query("SELECT p_partkey, name, shop FROM poi WHERE shop = 'SMALL' ORDER BY p_partkey LIMIT 10")
def poi_attr_query(spark, sf_dir):
    return poi.attribute_query(views.poi(spark, sf_dir), "shop", "SMALL", ["shop", "amenity"], ["p_partkey"]).select("p_partkey", "name", "shop")


@query("SELECT p_partkey, name, amenity FROM poi WHERE shop = 'SMALL' AND amenity = 'Brand#4' ORDER BY p_partkey LIMIT 25")
def poi_refine_limit(spark, sf_dir):
    points = views.poi(spark, sf_dir)
    found = poi.refine(points, points.where("shop = 'SMALL'"), F.expr("amenity = 'Brand#4'"))
    return found.orderBy("p_partkey").limit(25).select("p_partkey", "name", "amenity")


@query("""SELECT p_partkey, name, contains(name, 'bolt') OR contains(name, 'gear') AS part, suffix(name, 'ring') AS ends, starts_with(name, 'red ') AS starts, upper(shop) = shop AS capitals, NOT contains(name, ' ') AS unbroken,
    split_part(amenity, '#', 1) AS stem, substring(name, 1, 30) AS short, name || ' (' || CAST(p_size AS VARCHAR) || ',' || CAST(p_partkey AS VARCHAR) || ')' AS label, split_part(amenity || '/' || name, '/', 2) AS tail FROM poi""")
def poi_name_predicates(spark, sf_dir):
    name = F.col("name")
    return views.poi(spark, sf_dir).select(
        "p_partkey", "name", (name.contains("bolt") | name.contains("gear")).alias("part"), name.endswith("ring").alias("ends"), name.rlike("^red ").alias("starts"), (F.upper("shop") == F.col("shop")).alias("capitals"),
        (~name.contains(" ")).alias("unbroken"), text.stem(F.replace("amenity", F.lit("#"), F.lit("."))).alias("stem"), F.substring("name", 1, 30).alias("short"),
        text.poi_label(name, F.col("p_partkey"), F.col("p_size")).alias("label"), text.last_segment(F.concat_ws("/", "amenity", "name")).alias("tail"),
    )


@query("SELECT p_partkey, n_nationkey FROM in_zone")
def poi_in_zone(spark, sf_dir):
    return spatial.points_in_polygons(views.poi(spark, sf_dir), views.zones(spark, sf_dir)).select("p_partkey", "n_nationkey")


def _centre(spark: SparkSession) -> DataFrame:
    km = geo.to_km(F.col("radius"), F.col("unit"))
    return spark.createDataFrame([(0.1, 0.1, 1000.0, "Miles")], "lat double, lon double, radius double, unit string").select("lat", "lon", km.alias("radius_km"))


_HEX = """SELECT p_partkey, x, y FROM poi, (SELECT a.x AS ax, a.y AS ay, b.x AS ux, b.y AS uy FROM hexagon a JOIN hexagon b ON b.i = (a.i + 1) % 6)
    WHERE (uy > y) <> (ay > y) AND x < (ax - ux) * (y - uy) / (ay - uy) + ux GROUP BY p_partkey, x, y HAVING count(*) % 2 = 1"""
views.DUCKDB["hexagon_rad"] = "SELECT i, pi() / 6 + i * pi() / 3 AS b, radians(0.1::DOUBLE) AS p, 1000.0::DOUBLE * 1.60934::DOUBLE / 6371 AS r FROM range(6) t(i)"
views.DUCKDB["hexagon"] = """SELECT i, asin(sin(p) * cos(r) + cos(p) * sin(r) * cos(b)) * 180 / pi() AS y,
    (p + atan2(sin(b) * sin(r) * cos(p), cos(r) - sin(p) * (sin(p) * cos(r) + cos(p) * sin(r) * cos(b)))) * 180 / pi() AS x FROM hexagon_rad"""
views.DUCKDB["hit"] = _HEX
views.DUCKDB["hit_edge"] = """SELECT x AS ax, y AS ay, coalesce(lead(x) OVER (ORDER BY p_partkey), first_value(x) OVER (ORDER BY p_partkey)) AS ux, coalesce(lead(y) OVER (ORDER BY p_partkey), first_value(y) OVER (ORDER BY p_partkey)) AS uy FROM hit"""


@query("SELECT p_partkey FROM hit")
def poi_radius(spark, sf_dir):
    return spatial.within_radius(views.poi(spark, sf_dir), _centre(spark)).select("p_partkey")


@query("SELECT p_partkey FROM poi, hit_edge WHERE (uy > y) <> (ay > y) AND x < (ax - ux) * (y - uy) / (ay - uy) + ux GROUP BY p_partkey HAVING count(*) % 2 = 1")
def poi_radius_compat(spark, sf_dir):
    points = views.poi(spark, sf_dir)
    return spatial.within_hits(points, spatial.within_radius(points, _centre(spark)), "p_partkey").select("p_partkey")


views.DUCKDB["searched"] = "SELECT p_partkey, name FROM poi JOIN (SELECT DISTINCT p_partkey FROM in_zone) USING (p_partkey) JOIN (SELECT p_partkey FROM hit) USING (p_partkey) WHERE p_size > 10"


@query("SELECT * FROM (SELECT p_partkey, name FROM searched UNION ALL SELECT p_partkey, name FROM poi WHERE NOT EXISTS (SELECT 1 FROM searched)) ORDER BY p_partkey LIMIT 100")
def poi_search(spark, sf_dir):
    found = pipelines.point_search(views.poi(spark, sf_dir), ["p_partkey"], zones=views.zones(spark, sf_dir), condition=F.col("p_size") > 10, centre=_centre(spark), limit=100)
    return found.select("p_partkey", "name")


@query("SELECT DISTINCT attribute, value FROM (SELECT name, amenity, shop, CAST(p_size AS VARCHAR) AS size FROM poi) UNPIVOT (value FOR attribute IN (name, amenity, shop, size)) WHERE value <> ' '")
def poi_distinct_values(spark, sf_dir):
    return index.distinct_values(views.poi(spark, sf_dir).withColumnRenamed("p_size", "size"), ["name", "amenity", "shop", "size"])


@query("SELECT min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM poi")
def poi_extent(spark, sf_dir):
    return views.poi(spark, sf_dir).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))


@query("""SELECT CAST(pos AS INTEGER) AS position, field, type, filled, different FROM (VALUES (0, 'ID', 'bigint'), (1, 'Start', 'timestamp_ntz'), (2, 'End', 'timestamp_ntz'), (3, 'Route', 'string')) v(pos, field, type)
    JOIN (SELECT 'ID' AS field, count("ID") AS filled, count(DISTINCT "ID") AS different FROM trips UNION ALL SELECT 'Start', count("Start"), count(DISTINCT "Start") FROM trips
    UNION ALL SELECT 'End', count("End"), count(DISTINCT "End") FROM trips UNION ALL SELECT 'Route', count("Route"), count(DISTINCT "Route") FROM trips) USING (field)""")
def layer_fields(spark, sf_dir):
    return index.fields(views.trips(spark, sf_dir))


@query("SELECT n_nationkey, 0 AS part, CAST(i AS INTEGER) AS index, round(x, 6) AS x, round(y, 6) AS y FROM ring")
def layer_vertices(spark, sf_dir):
    rows = shapefile.vertices(views.zones(spark, sf_dir).withColumnRenamed("rings", "parts"), ["n_nationkey"])
    return rows.withColumn("x", F.round("x", 6)).withColumn("y", F.round("y", 6))


_PAIR = "FROM poi a JOIN poi b ON b.p_partkey = a.p_partkey + 1"
_BEARING = """degrees(atan2(cos(radians(b.y)) * sin(radians(b.x - a.x)), cos(radians(a.y)) * sin(radians(b.y)) - sin(radians(a.y)) * cos(radians(b.y)) * cos(radians(b.x - a.x))))"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = views.poi(spark, sf_dir)
    after = points.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    return points.select("p_partkey", "x", "y").join(after, "p_partkey")


_ENDS = ("y", "x", "y2", "x2")


@query(f"SELECT a.p_partkey, round({_BEARING}, 6) AS bearing {_PAIR}")
def bearing(spark, sf_dir):
    return _pairs(spark, sf_dir).select("p_partkey", F.round(geo.bearing(*map(F.col, _ENDS)), 6).alias("bearing"))


@query(f"""SELECT p_partkey, CASE WHEN d < 22.5 OR d >= 337.5 THEN 'N' WHEN d < 67.5 THEN 'NE' WHEN d < 112.5 THEN 'E' WHEN d < 157.5 THEN 'SE' WHEN d < 202.5 THEN 'S' WHEN d < 247.5 THEN 'SW'
    WHEN d < 292.5 THEN 'W' ELSE 'NW' END AS label FROM (SELECT a.p_partkey, CASE WHEN {_BEARING} < 0 THEN {_BEARING} + 360 ELSE {_BEARING} END AS d {_PAIR})""")
def bearing_label(spark, sf_dir):
    return _pairs(spark, sf_dir).select("p_partkey", geo.bearing_label(geo.bearing(*map(F.col, _ENDS))).alias("label"))


@query(f"SELECT a.p_partkey, round(2 * 3956 * asin(sqrt(least(1.0::DOUBLE, sin(radians(b.y - a.y) / 2) ** 2 + cos(radians(a.y)) * cos(radians(b.y)) * sin(radians(b.x - a.x) / 2) ** 2))), 3) AS miles {_PAIR}")
def haversine(spark, sf_dir):
    return _pairs(spark, sf_dir).select("p_partkey", F.round(geo.haversine(*map(F.col, _ENDS)), 3).alias("miles"))


@query("""SELECT p_partkey, CAST(65 AS INTEGER) AS points, round(min(yy), 6) AS y0, round(max(yy), 6) AS y1 FROM (SELECT p_partkey, asin(sin(radians(y)) * cos(30 * 1.60934::DOUBLE / 6371) +
    cos(radians(y)) * sin(30 * 1.60934::DOUBLE / 6371) * cos(pi() / 64 + i * 2 * pi() / 64)) * 180 / pi() AS yy FROM poi, range(64) t(i)) GROUP BY p_partkey""")
def buffer_rings(spark, sf_dir):
    ring = geo.buffer(F.col("y"), F.col("x"), F.lit(30.0))
    rows = storage.dealt(views.poi(spark, sf_dir).select("p_partkey", "x", "y")).select("p_partkey", ring.alias("ring"))
    rows = rows.select("p_partkey", geo.closed(F.col("ring")).alias("ring")).withColumn("box", geo.box(F.col("ring")))
    return rows.select("p_partkey", F.size("ring").alias("points"), F.round("box.y0", 6).alias("y0"), F.round("box.y1", 6).alias("y1"))


@query("SELECT 'node' AS type, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS ids FROM poi UNION ALL SELECT 'way', count(*), CAST(sum(way_id) AS BIGINT) FROM way")
def osm_split(spark, sf_dir):
    """Through a JSON document of elements, read with its schema and split by type."""
    folder = storage.shared_folder(spark, "osm")
    rows = views.elements(spark, sf_dir).drop("pos")
    rows.select(F.array(F.struct(*rows.columns)).alias("elements")).write.json(folder)
    read = tables.osm_elements(spark, folder, multiline=False)
    parts = [osm.split_elements(read, kind).select(F.lit(kind).alias("type"), "id") for kind in ("node", "way")]
    return parts[0].union(parts[1]).groupBy("type").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


def _drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return osm.way_paths(views.ways(spark, sf_dir), views.nodes(spark, sf_dir))


@query("""SELECT way_id, drawn, CASE WHEN drawn THEN round(coalesce(len, 0), 6) END AS degrees FROM drawn JOIN (SELECT way_id, sum(sqrt((nx - x) ** 2 + (ny - y) ** 2)) AS len FROM way_edge GROUP BY way_id) USING (way_id)""")
def osm_geometry(spark, sf_dir):
    path = F.col("path")
    return _drawn(spark, sf_dir).select("way_id", path.isNotNull().alias("drawn"), F.when(path.isNotNull(), F.round(geo.path_length(path), 6)).alias("degrees"))


@query("SELECT way_id, name, kind, class, CASE WHEN class LIKE 'Other%' THEN class ELSE lower(class) END AS tag FROM classed")
def osm_classify(spark, sf_dir):
    return osm.classify(_drawn(spark, sf_dir)).select("way_id", "name", "kind", "class", "tag")


@query("SELECT way_id, CASE WHEN kind = 'linear' THEN class || ' ' || name || ' (length: ' || (n - 1) || 'm)' WHEN kind = 'areal' THEN class || ' ' || name || ' (area: ' || n || 'm2)' END AS label FROM classed WHERE kind <> 'ignored'")
def osm_labels(spark, sf_dir):
    """Labels with the number of segments or corners in the places of length and area."""
    ways = osm.classify(_drawn(spark, sf_dir)).where("kind <> 'ignored'")
    corners = F.when(F.col("kind") == "areal", F.size("path"))
    return ways.select("way_id", osm.label(F.col("class"), F.col("name"), F.size("path") - 1, corners).alias("label"))


# The inverse geodesic, each round one row of the recursion; near-antipodal edges, which may not converge, are searched for by azimuth.
_TERMS = """sqrt((c2 * sin(lam)) ** 2 + (c1 * s2 - s1 * c2 * cos(lam)) ** 2) AS ss, s1 * s2 + c1 * c2 * cos(lam) AS cs"""
views.DUCKDB["geodesic"] = """SELECT way_id, pos, turn, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2 FROM (SELECT way_id, pos, radians(nx - x - 360 * floor((nx - x + 180) / 360)) AS turn,
    atan((1 - 1 / 298.257223563::DOUBLE) * tan(radians(y))) AS u1, atan((1 - 1 / 298.257223563::DOUBLE) * tan(radians(ny))) AS u2
    FROM (SELECT way_id, pos, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM way_point WINDOW w AS (PARTITION BY way_id ORDER BY pos)) JOIN classed USING (way_id) WHERE kind = 'linear' AND nx IS NOT NULL)"""
_ROUND = f"""SELECT *, acos(0) * 0 + atan2(ss, cs) AS sg, CASE WHEN ss = 0 THEN 0 ELSE c1 * c2 * sin(lam) / ss END AS sa FROM (SELECT *, {_TERMS} FROM rounds)"""
_ROUND = f"""SELECT *, 1 - sa * sa AS ca, CASE WHEN 1 - sa * sa = 0 THEN 0 ELSE cs - 2 * s1 * s2 / (1 - sa * sa) END AS cm FROM ({_ROUND})"""
_F = "(1 / 298.257223563::DOUBLE)"
_C = f"({_F} / 16 * ca * (4 + {_F} * (4 - 3 * ca)))"
_NEXT = f"(turn + (1 - {_C}) * {_F} * sa * (sg + {_C} * ss * (cm + {_C} * cs * (2 * cm * cm - 1))))"
_K = f"(ca * (6378137.0::DOUBLE ** 2 - (6378137.0::DOUBLE * (1 - {_F})) ** 2) / (6378137.0::DOUBLE * (1 - {_F})) ** 2)"
_A, _B = f"(1 + {_K} / 16384 * (4096 + {_K} * (-768 + {_K} * (320 - 175 * {_K}))))", f"({_K} / 1024 * (256 + {_K} * (-128 + {_K} * (74 - 47 * {_K}))))"
_DS = f"({_B} * ss * (cm + {_B} / 4 * (cs * (2 * cm * cm - 1) - {_B} / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3))))"
_GEODESIC = f"""SELECT way_id, class, round(coalesce(km, 0), 3) AS km FROM classed LEFT JOIN (SELECT way_id, sum(coalesce(metres, m)) / 1000 AS km FROM (
    WITH RECURSIVE rounds AS (SELECT *, turn AS lam, turn AS before, 0 AS r FROM geodesic UNION ALL SELECT way_id, pos, turn, s1, c1, s2, c2, {_NEXT} AS lam, lam AS before, r + 1 FROM ({_ROUND}) WHERE r < 99)
    SELECT way_id, pos, CASE WHEN ss = 0 THEN 0 ELSE 6378137.0::DOUBLE * (1 - {_F}) * {_A} * (sg - {_DS}) END AS m FROM ({_ROUND}) WHERE r = 99) LEFT JOIN antipodal USING (way_id, pos) GROUP BY way_id) USING (way_id)
    WHERE kind = 'linear'"""


def azimuth_sql(source: str, names: str) -> str:
    """(names, metres) of rows (names, turn, s1, c1, s2, c2): the azimuth at the first point by halving, integrals by Gauss and Legendre."""
    nodes, weights = np.polynomial.legendre.leggauss(16)
    rule = ", ".join(f"{{'x': {x!r}::DOUBLE, 'w': {w!r}::DOUBLE}}" for x, w in zip(nodes.tolist(), weights.tolist(), strict=True))
    found = f"""(SELECT *, atan2(a1, ca * d1) AS lo, atan2(a2, across) AS hi, (ca ** 2 + (sa * a1) ** 2) * {_F} * (2 - {_F}) / (1 - {_F}) ** 2 AS k2, atan2(s0 * a2, across) - atan2(s0 * a1, ca * d1) AS omega
        FROM (SELECT *, sa * d1 AS s0, sqrt(greatest(0, (ca * d1) ** 2 + (d2 - d1) * (d2 + d1))) AS across FROM (SELECT *, cos((low + high) / 2) AS sa, -sin((low + high) / 2) AS ca FROM tries)))"""
    root = "sqrt(1 + k2 * sin((lo + hi) / 2 + (hi - lo) / 2 * n.x) ** 2)"
    total = lambda term: f"(hi - lo) / 2 * list_sum(list_transform([{rule}], lambda n: n.w * {term}))"
    short = f"omega - {_F} * s0 * ({total(f'(2 - {_F}) / (1 + (1 - {_F}) * {root})')}) < turn"
    return f"""SELECT {names}, 6378137.0::DOUBLE * (1 - {_F}) * {total(root)} AS metres FROM (
        WITH RECURSIVE tries AS (SELECT {names}, abs(turn) AS turn, CASE WHEN abs(s2) > abs(s1) THEN c2 ELSE c1 END AS d1, CASE WHEN abs(s2) > abs(s1) THEN c1 ELSE c2 END AS d2, -abs(CASE WHEN abs(s2) > abs(s1) THEN s2 ELSE s1 END) AS a1,
            CASE WHEN abs(s2) > abs(s1) THEN s1 ELSE s2 END * CASE WHEN CASE WHEN abs(s2) > abs(s1) THEN s2 ELSE s1 END > 0 THEN -1 ELSE 1 END AS a2, -pi() / 2 AS low, pi() / 2 AS high, 0 AS r FROM {source}
        UNION ALL SELECT {names}, turn, d1, d2, a1, a2, CASE WHEN {short} THEN (low + high) / 2 ELSE low END AS low, CASE WHEN {short} THEN high ELSE (low + high) / 2 END AS high, r + 1 AS r FROM {found} WHERE r < 60)
        SELECT * FROM {found} WHERE r = 60)"""


# of ways' edges, those so near to antipodal that rounds may not converge: all of them are measured by azimuth, as in geo.geodesic_metres
views.DUCKDB["near_antipodal"] = "SELECT * FROM geodesic WHERE s1 * s2 + c1 * c2 * cos(turn) < -0.99"
views.DUCKDB["antipodal"] = azimuth_sql("near_antipodal", "way_id, pos")


@query(_GEODESIC)
def osm_length(spark, sf_dir):
    found = osm.measured(osm.classify(_drawn(spark, sf_dir))).where("kind = 'linear'")
    return found.select("way_id", "class", F.round(F.col("length") / 1000, 3).alias("km"))


_E = 0.0818191908426215
_Q = "((1 - {e2}) * (sin(radians({y})) / (1 - {e2} * sin(radians({y})) ** 2) + 0.5 * ln((1 + {e} * sin(radians({y}))) / (1 - {e} * sin(radians({y})))) / {e}))"
_QA, _QB = (_Q.format(e="s.e", e2="(s.e * s.e)", y=y) for y in ("y", "coalesce(ny, fy)"))


# edges go the shorter way round, as geo.turn has it: what is from -180 to below 180 stays, also where 180 more would round up to 360; a ring once about a pole has what its edges leave of a half
_WAY_EDGE = """(SELECT *, CASE WHEN d >= -180 AND d < 180 THEN d ELSE d - 360 * floor((d + 180) / 360) END AS dx
    FROM (SELECT way_id, x, y, nx, ny, fx, fy, coalesce(nx, fx) - x AS d FROM way_edge))"""


@query(f"""SELECT way_id, round(CASE WHEN abs(sum(dx)) > 180 THEN 4 * pi() * any_value({_Q.format(e="s.e", e2="(s.e * s.e)", y="90.0::DOUBLE")}) - abs(sum(radians(dx) * ({_QA} + {_QB}))) ELSE abs(sum(radians(dx) * ({_QA} + {_QB}))) END * 6378137.0::DOUBLE ** 2 / 4 / 1e9, 3) AS thousand_km2 FROM {_WAY_EDGE} JOIN classed USING (way_id),
    (SELECT sqrt(1 / 298.257223563::DOUBLE * (2 - 1 / 298.257223563::DOUBLE)) AS e) s WHERE kind = 'areal' GROUP BY way_id""")
def osm_area(spark, sf_dir):
    return osm.measured(osm.classify(_drawn(spark, sf_dir))).where("kind = 'areal'").select("way_id", F.round(F.col("area") / 1e9, 3).alias("thousand_km2"))


@query("SELECT kind, class, count(*) AS ways FROM classed WHERE kind <> 'ignored' GROUP BY kind, class")
def osm_layers(spark, sf_dir):
    """Through the two feature layers, written by kind and read back."""
    folder = storage.shared_folder(spark, "waterbodies")
    sinks.waterbody_layers(pipelines.waterbodies(views.elements(spark, sf_dir)), folder)
    tag = F.col("tag")
    name = F.when(tag.startswith("Other"), tag).otherwise(F.initcap(tag))
    return spark.read.parquet(folder).where("geom_wkt is not null").groupBy("kind", name.alias("class")).agg(F.count("*").alias("ways"))


# Cyrus-Beck clipping of a segment by a convex ring: with the ring's sense of turn, normal . (p + t d - a) <= 0 inside.
_CLIP = """SELECT p_partkey, n_nationkey, any_value(n_name) AS n_name, max(CASE WHEN den < 0 THEN num / den ELSE 0 END) AS t0, min(CASE WHEN den > 0 THEN num / den ELSE 1 END) AS t1, bool_or(den = 0 AND num < 0) AS outside FROM (
    SELECT p_partkey, n_nationkey, n_name, (uy - ay) * 5.0 - (ux - ax) * 3.0 AS den, -((uy - ay) * (x - ax) - (ux - ax) * (y - ay)) AS num FROM
        (SELECT n_nationkey, n_name, ux AS ax, uy AS ay, ax AS ux, ay AS uy FROM edges) e, poi) GROUP BY p_partkey, n_nationkey"""
views.DUCKDB["clipped"] = f"SELECT p_partkey, n_nationkey, n_name, round((t1 - t0) * sqrt(34.0), 6) AS degrees FROM ({_CLIP}) WHERE NOT outside AND t1 > greatest(t0, 0)"


def _clipped(spark: SparkSession, sf_dir: str, keep: bool) -> DataFrame:
    return spatial.clip(views.roads(spark, sf_dir), views.zones(spark, sf_dir), "p_partkey", "n_nationkey", keep)


@query("SELECT p_partkey, n_nationkey, degrees FROM clipped")
def clip_lines(spark, sf_dir):
    return _clipped(spark, sf_dir, False).select("p_partkey", "n_nationkey", F.round(spatial.parts_length(F.col("parts")), 6).alias("degrees"))


@query("SELECT n_nationkey, count(p_partkey) AS pieces, CAST(0 AS BIGINT) AS failed FROM nation LEFT JOIN clipped USING (n_nationkey) GROUP BY n_nationkey")
def clip_status(spark, sf_dir):
    return pipelines.clip_status(views.roads(spark, sf_dir), views.zones(spark, sf_dir), "p_partkey", "n_nationkey")


@query("SELECT p_partkey, p_name AS name, n_nationkey, n_name, degrees FROM clipped JOIN part USING (p_partkey)")
def overlay_intersect(spark, sf_dir):
    return _clipped(spark, sf_dir, True).select("p_partkey", "name", "n_nationkey", "n_name", F.round(spatial.parts_length(F.col("parts")), 6).alias("degrees"))


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.dated(views.catalog(spark, sf_dir))


@query("SELECT dataset_id, dataset_type FROM catalog WHERE dataset_type = 'ECONOMY'")
def catalog_by_type(spark, sf_dir):
    return cat.of_type(_catalog(spark, sf_dir), "ECONOMY").select("dataset_id", "dataset_type")


@query("SELECT dataset_id, dataset_id || chr(9) || ' (' || dataset_type || ')' AS label FROM catalog WHERE publisher = 'Brand#2'")
def catalog_by_publisher(spark, sf_dir):
    return cat.of_publisher(_catalog(spark, sf_dir), "Brand#2").select("dataset_id", text.dataset_label(F.col("dataset_id"), F.col("dataset_type")).alias("label"))


@query("SELECT dataset_id FROM catalog WHERE list_has_any(tags, ['red', 'small'])")
def catalog_tags_any(spark, sf_dir):
    return cat.with_tags(_catalog(spark, sf_dir), ["red", "small"]).select("dataset_id")


@query("SELECT dataset_id FROM catalog WHERE list_has_all(tags, ['small', 'ring'])")
def catalog_tags_all(spark, sf_dir):
    return cat.with_tags(_catalog(spark, sf_dir), ["small", "ring"], every=True).select("dataset_id")


@query("SELECT dataset_id FROM (SELECT *, max(list_has_any(tags, ['red'])::INT) OVER (ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) AS seen FROM catalog) WHERE seen = 1")
def catalog_tags_compat(spark, sf_dir):
    return cat.with_tags_compat(_catalog(spark, sf_dir), ["red"], "p_partkey").select("dataset_id")


@query("""SELECT dataset_id, max((dataset_type = 'SMALL')::INT) OVER (PARTITION BY publisher ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) = 1 AS seen FROM catalog""")
def catalog_running_flag(spark, sf_dir):
    rows = _catalog(spark, sf_dir).withColumn("publisher", text.publisher(F.col("dataset_id")))
    return cat.running_flag(rows, ["publisher"], "p_partkey", F.col("dataset_type") == "SMALL").select("dataset_id", "seen")


@query("SELECT dataset_id, start, raw_end FROM dated WHERE until IS NULL OR (start <= DATE '2006-12-31' AND DATE '2005-01-01' <= until)")
def catalog_time(spark, sf_dir):
    found = cat.overlapping(_catalog(spark, sf_dir), *map(F.lit, PERIOD), views.TODAY)
    return found.select("dataset_id", "start", F.col("dataset_end").alias("raw_end"))


@query("""SELECT dataset_id FROM dated WHERE dataset_type = 'SMALL' AND list_has_any(tags, ['red', 'small', 'hot']) AND (until IS NULL OR (start <= DATE '2006-12-31' AND DATE '2005-01-01' <= until))""")
def catalog_search(spark, sf_dir):
    return pipelines.catalog_search(_catalog(spark, sf_dir), *PERIOD, views.TODAY, kind="SMALL", tags=["red", "small", "hot"]).select("dataset_id")


_MONTHS = (12, 6, 3, 1)


@query("SELECT dataset_id, DATE '2024-01-01' AS ytd, " + ", ".join(f"""CAST(CASE WHEN "end" - INTERVAL {m} MONTH >= DATE '2001-01-01' THEN "end" - INTERVAL {m} MONTH ELSE start END AS DATE) AS m{m}""" for m in _MONTHS) + " FROM catalog")
def catalog_periods(spark, sf_dir):
    periods = [time.period_start(F.col("end"), m, F.lit(date(2001, 1, 1)), F.col("start")).alias(f"m{m}") for m in _MONTHS]
    return _catalog(spark, sf_dir).select("dataset_id", time.year_start(views.TODAY).alias("ytd"), *periods)


@query("""SELECT dataset_id, s AS f_start, CASE WHEN e < s THEN s + 1 ELSE e END AS f_end FROM (SELECT dataset_id, greatest(start, lo) AS s, least(start + 700, hi) AS e FROM catalog,
    (SELECT min(start) AS lo, CASE WHEN bool_or(end_present OR "end" IS NULL) THEN DATE '2024-01-01' ELSE max("end") END AS hi FROM catalog WHERE publisher = 'Brand#4'))""")
def catalog_clamp(spark, sf_dir):
    rows = _catalog(spark, sf_dir)
    ranges = rows.select("dataset_id", F.col("start").alias("f_start"), F.date_add("start", 700).alias("f_end"))
    return cat.clamped(ranges, cat.bounds(cat.of_publisher(rows, "Brand#4"), views.TODAY))


@query("""SELECT facet, value, count(*) AS datasets FROM (SELECT 'type' AS facet, dataset_type AS value FROM catalog UNION ALL SELECT 'publisher', publisher FROM catalog
    UNION ALL SELECT 'tag', unnest(list_distinct(tags)) FROM catalog) GROUP BY facet, value""")
def catalog_facets(spark, sf_dir):
    return cat.facets(_catalog(spark, sf_dir))


@query("SELECT publisher, count(*) AS datasets, min(dataset_id) AS first, max(dataset_id) AS last FROM catalog GROUP BY publisher")
def catalog_index(spark, sf_dir):
    rows = cat.index_by(_catalog(spark, sf_dir), text.publisher(F.col("dataset_id")), "publisher")
    ends = F.min(F.get("dataset_ids", 0)).alias("first"), F.max(F.element_at("dataset_ids", -1)).alias("last")
    return rows.groupBy("publisher").agg(F.sum(F.size("dataset_ids").cast("long")).alias("datasets"), *ends)


def _chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.catalog(spark, sf_dir).where("p_size > 40").select("dataset_id")


@query("SELECT dataset_id, dataset_type FROM catalog WHERE p_size > 40")
def catalog_selected(spark, sf_dir):
    return cat.selected(_catalog(spark, sf_dir), _chosen(spark, sf_dir), "dataset_id").select("dataset_id", "dataset_type")


@query("SELECT dataset_id, dataset_type FROM catalog WHERE p_size <= 40")
def catalog_inverted(spark, sf_dir):
    return cat.selected(_catalog(spark, sf_dir), _chosen(spark, sf_dir), "dataset_id", invert=True).select("dataset_id", "dataset_type")


@query("SELECT dataset_id, CASE WHEN raw_end IS NOT NULL THEN raw_start END AS start, raw_end AS \"end\" FROM dated")
def catalog_availability(spark, sf_dir):
    found = time.availability(F.concat_ws(" - ", "dataset_start", "dataset_end"), strict=True)
    return views.catalog(spark, sf_dir).select("dataset_id", found.alias("a")).select("dataset_id", "a.start", "a.end")


@query("SELECT p_partkey, dataset_type, dataset_id FROM catalog")
def catalog_code_block(spark, sf_dir):
    code = F.concat(F.lit("ee."), "dataset_type", F.lit('("'), "dataset_id", F.lit('")'))
    return views.catalog(spark, sf_dir).select("p_partkey", text.code_block(code).alias("c")).select("p_partkey", "c.dataset_type", "c.dataset_id")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS events FROM events GROUP BY 1")
def epoch_dates(spark, sf_dir):
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return views.table(spark, sf_dir, "events").groupBy(time.epoch_date(ms).alias("day")).agg(F.count("*").alias("events"))


_LINKS = "SELECT page_id, url, unnest(regexp_extract_all(html, '<a [^>]*>([^<]*)</a>', 1)) AS text FROM pages"


@query(f"SELECT page_id, text, url || text AS link FROM ({_LINKS}) WHERE (upper(text) = text AND NOT contains(text, ' ') AND NOT contains(text, 'ß')) OR suffix(text, '.zip')")
def page_links(spark, sf_dir):
    return html.page_links(views.table(spark, sf_dir, "pages"))


def _zip_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose nation's index lists an archive of each part of a size."""
    listed = F.concat(F.lit('<a href="x">'), F.replace("name", F.lit(" "), F.lit("_")), F.lit(".zip</a>"))
    return views.poi(spark, sf_dir).select(F.col("p_partkey").alias("page_id"), F.concat(F.lit("http://a/"), "amenity", F.lit("/")).alias("url"), listed.alias("html"))


@query("SELECT p_partkey AS page_id, 'http://a/' || p_brand || '/' || replace(p_name, ' ', '_') || '.zip' AS link FROM part")
def page_zip_links(spark, sf_dir):
    return html.page_links(_zip_pages(spark, sf_dir)).select("page_id", "link")


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.array_join(F.transform("tags", lambda t: F.concat(F.lit('<a href="/tags/'), t, F.lit('">x</a>'))), " ")
    body = F.concat(F.lit('<table><tbody><td class="ee-dataset"><a href="/catalog/'), F.col("p_partkey").cast("string"), F.lit('">n</a></td><td class="ee-dataset-description-snippet">'), "dataset_type", F.lit('</td><td class="ee-tag-buttons ee-small">'), tags, F.lit("</td></tbody></table>"))
    return storage.dealt(views.catalog(spark, sf_dir)).select(F.col("dataset_id").alias("url"), body.alias("html"))


def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.concat(F.lit("<p><code>ee."), "dataset_type", F.lit('("'), "dataset_id", F.lit('")</code></p><dl><dd>none</dd><dd>'), F.concat_ws(" - ", "dataset_start", "dataset_end"), F.lit("</dd></dl>"))
    return storage.dealt(views.catalog(spark, sf_dir)).select(F.col("p_partkey").cast("string").alias("url"), page.alias("html"))


@query("SELECT dataset_id AS url, CAST(p_partkey AS VARCHAR) AS dataset, array_to_string(CASE WHEN tags[1] = tags[2] THEN tags[1:1] ELSE tags END, ';') AS tags, dataset_type AS description FROM catalog")
def page_catalog_rows(spark, sf_dir):
    return html.catalog_rows(_listing(spark, sf_dir)).where("error is null").select("url", "dataset", F.array_join("tags", ";").alias("tags"), "description")


@query("SELECT CAST(p_partkey AS VARCHAR) AS dataset, dataset_type AS description, dataset_id, dataset_type, CASE WHEN raw_end IS NOT NULL THEN raw_start END AS dataset_start, raw_end AS dataset_end FROM dated")
def page_details(spark, sf_dir):
    """Listing rows joined to their detail rows, through the catalog's JSON sink."""
    listing = html.catalog_rows(_listing(spark, sf_dir)).where("error is null").select("dataset", "description")
    details = html.detail_rows(_details(spark, sf_dir)).withColumnRenamed("url", "dataset")
    folder = storage.shared_folder(spark, "catalog")
    sinks.catalog_json(cat.with_details(listing, details), folder)
    return spark.read.schema("dataset string, description string, dataset_id string, dataset_type string, dataset_start string, dataset_end string").json(folder)


@query("SELECT CAST(c_custkey AS VARCHAR) AS url, c_acctbal AS lat, CAST(c_nationkey AS DOUBLE) AS lon, split_part(c_name, ' ', 1) AS city, '' AS region, c_mktsegment AS country FROM customer")
def page_kv(spark, sf_dir):
    cell = lambda name, value: F.concat(F.lit(f'<td class="{name}">'), value.cast("string"), F.lit("</td>"))
    page = F.concat(cell("lat", F.col("c_acctbal")), cell("lng", F.col("c_nationkey")), cell("city", F.concat("c_name", F.lit(" x"))), F.lit('<td><span class="country_name">'), "c_mktsegment", F.lit("</span></td>"))
    pages = storage.dealt(views.table(spark, sf_dir, "customer")).select(F.col("c_custkey").cast("string").alias("url"), page.alias("html"))
    return html.place_rows(pages).drop("error")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(l_linenumber AS VARCHAR) AS band, l_returnflag AS crs, CAST(l_quantity AS INTEGER) AS dim_x, 1 AS dim_y, epoch_ms(o_orderdate) AS start_ms, strftime(o_orderdate, '%Y-%m-%d') AS start_date,
    epoch_ms(o_orderdate + INTERVAL 36 HOUR) AS end_ms, strftime(o_orderdate + INTERVAL 36 HOUR, '%Y-%m-%d') AS end_date, 'LineString (' || (o_orderkey % 90)::DOUBLE || ' 0.5,' || (o_orderkey % 90)::DOUBLE || ' 1.5)' AS footprint FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def image_bands(spark, sf_dir):
    """Orders as image features and their items as bands, through nested JSON."""
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("o_orderdate"))
    bands = views.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").cast("string").alias("id"), F.col("l_returnflag").alias("crs"), F.array(F.col("l_quantity").cast("int"), F.lit(1)).alias("dimensions"))).alias("bands"))
    orders = views.table(spark, sf_dir, "orders").join(bands, F.col("o_orderkey") == F.col("l_orderkey"))
    x = (F.col("o_orderkey") % 90).cast("double")
    ring = F.struct(F.array(*[F.array(x, F.lit(y)) for y in (0.5, 1.5)]).alias("coordinates"))
    props = F.struct(ms.alias("system:time_start"), (ms + 36 * 3_600_000).alias("system:time_end"), ring.alias("system:footprint"))
    feature = F.struct(F.col("o_orderkey").cast("string").alias("id"), props.alias("properties"), "bands")
    lines = orders.select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("line"))
    documents = lines.select(F.from_json("line", tables.schemas.IMAGES).alias("d")).select("d.*")
    return tables.image_bands(documents).select("id", "band", "crs", "dim_x", "dim_y", "start_ms", "start_date", "end_ms", "end_date", geo.line_wkt(F.col("footprint")).alias("footprint"))


@query("SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS index FROM orders")
def orders_index(spark, sf_dir):
    """Labels of rows with columns that the order does not name."""
    return index.dense_index(views.table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey").select("o_orderkey", "o_totalprice", "index")


@query(f"""SELECT row_number() OVER (ORDER BY "Name", "Duration", "Start", "End", "ID", "Route") - 1 AS "index", * FROM (
    SELECT "Name", "ID", CAST((epoch_us("End") - epoch_us("Start")) // 86400000000 AS INTEGER) AS "Duration", "Start", "End", "Route"
    FROM people JOIN (SELECT "ID", date_trunc('second', "Start") AS "Start", date_trunc('second', "End") AS "End", "Route" FROM trips) USING ("ID")
    WHERE "Team" IN {views.SEGMENTS} AND "Start" >= TIMESTAMP '{views.FROM}' AND "End" <= TIMESTAMP '{views.TO}')""")
def trips_csv(spark, sf_dir):
    """From the text files that the trip pipeline starts with: employees, and travel_dddd.csv in folders among other files."""
    folder = storage.shared_folder(spark, "trips")
    staff = views.people(spark, sf_dir).where(F.col("Team").isin(*views.SEGMENTS)).select("Name", "ID")
    staff.write.csv(f"{folder}/employees")
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    travel = views.trips(spark, sf_dir).select("ID", at("Start"), at("End"), "Route")
    for part, below in (("ID % 3 = 0", "travel"), ("ID % 3 = 1", "travel/a"), ("ID % 3 = 2", "travel/a/b")):
        travel.where(part).write.csv(f"{folder}/{below}")
        storage.rename_parts(spark, f"{folder}/{below}", "travel_{:04d}.csv")
    for k, near in enumerate(("travel_{:05d}.csv", "xtravel_{:04d}.csv", "travel_{:04d}.csv.old")):  # their names are not of the form
        travel.where("ID < 100").coalesce(1).write.csv(f"{folder}/travel/c{k}")
        storage.rename_parts(spark, f"{folder}/travel/c{k}", near)
    limits = [F.lit(v).cast("timestamp_ntz") for v in (views.FROM, views.TO)]
    out = pipelines.trip_report(tables.employees(spark, f"{folder}/employees"), tables.travel(spark, f"{folder}/travel"), *limits)
    return out.withColumn("ID", F.col("ID").cast("long"))


@query("""SELECT r."Name", r."ID", r."Duration", strftime(r."Start", '%Y-%m-%d %H:%M:%S') AS "Start", strftime(r."End", '%Y-%m-%d %H:%M:%S') AS "End", r."Route",
    'LineString (' || string_agg(cx || ' ' || cy, ',' ORDER BY pos) || ')' AS geom_wkt, 4326 AS srid FROM report r JOIN stops s USING ("index") JOIN cities USING (city) GROUP BY ALL""")
def trips_layer(spark, sf_dir):
    """Through the typed line layer."""
    folder = storage.shared_folder(spark, "trip_lines")
    sinks.trip_lines(trips.route_lines(_report(spark, sf_dir), views.cities(spark), ["index"]), folder)
    return spark.read.parquet(folder)


@query("SELECT n_nationkey AS clip_oid, count(*) AS pieces, round(sum(degrees), 3) AS degrees FROM clipped GROUP BY n_nationkey")
def clip_layers(spark, sf_dir):
    """Through one folder of output for each clip polygon."""
    folder = storage.shared_folder(spark, "clipped")
    sinks.by_polygon(_clipped(spark, sf_dir, False), folder, "n_nationkey")
    return spark.read.parquet(folder).groupBy("clip_oid").agg(F.count("*").alias("pieces"), F.round(F.sum(spatial.parts_length(F.col("parts"))), 3).alias("degrees"))


@query("SELECT dataset_id, dataset_type, raw_start AS dataset_start, raw_end AS dataset_end, array_to_string(tags, ';') AS tags FROM dated")
def catalog_built(spark, sf_dir):
    """The catalog as it is built where there is none, and then read from its place."""
    folder = storage.shared_folder(spark, "catalog")
    rows = views.catalog(spark, sf_dir).selectExpr("cast(p_partkey as string) as dataset", "tags", "'' as description", "dataset_id", "dataset_type", "dataset_start", "dataset_end")
    tables.catalog_or_build(spark, folder, lambda: rows)
    found = tables.catalog_or_build(spark, folder, lambda: rows.limit(0))
    return found.select("dataset_id", "dataset_type", "dataset_start", "dataset_end", F.array_join("tags", ";").alias("tags"))


@query("SELECT publisher, string_agg(dataset_id, ';' ORDER BY dataset_id) AS datasets FROM catalog GROUP BY publisher")
def catalog_lists(spark, sf_dir):
    rows = cat.lists_by(_catalog(spark, sf_dir), text.publisher(F.col("dataset_id")), "publisher")
    return rows.select("publisher", F.array_join("dataset_ids", ";").alias("datasets"))


@query("SELECT p_partkey, n_name FROM in_zone JOIN nation USING (n_nationkey)")
def poi_in_zone_compat(spark, sf_dir):
    """As the old country filter: the first polygon of a name, its rings run together."""
    zones = views.zones(spark, sf_dir)
    later = zones.withColumns({"n_nationkey": F.col("n_nationkey") + 1000, "rings": F.transform("rings", lambda r: F.transform(r, lambda p: geo.point(p.x / 2, p.y)))})
    shapes = spatial.first_flattened(zones.union(later), "n_name", "n_nationkey")
    return spatial.points_in_polygons(views.poi(spark, sf_dir), shapes).select("p_partkey", "n_name")


@query("SELECT p_partkey FROM poi WHERE amenity = 'Brand#4'")
def poi_refine_compat(spark, sf_dir):
    """As written: a current result without rows counts as none, so all points are refined."""
    points = views.poi(spark, sf_dir)
    return poi.refine(points, points.where("p_size > 1000"), F.expr("amenity = 'Brand#4'"), compat=True).select("p_partkey")


@query("SELECT p_partkey FROM (SELECT p_partkey, p_size FROM poi JOIN (SELECT DISTINCT p_partkey FROM in_zone) USING (p_partkey) ORDER BY p_partkey LIMIT 50) WHERE p_size > 10")
def poi_search_compat(spark, sf_dir):
    """As written: the limit holds after each filter, not only at the end."""
    found = pipelines.point_search(views.poi(spark, sf_dir), ["p_partkey"], zones=views.zones(spark, sf_dir), condition=F.col("p_size") > 10, limit=50, compat=True)
    return found.select("p_partkey")


@query("SELECT p_partkey, name, round(x, 6) AS x FROM poi")
def geojson_lines(spark, sf_dir):
    """Through GeoJSON features, one a line, and back."""
    folder = storage.shared_folder(spark, "geojson")
    sinks.geojson_lines(views.poi(spark, sf_dir), folder, "Point", F.array("x", "y"), "p_partkey", "name")
    read = spark.read.schema("geometry struct<coordinates:array<double>>, properties struct<p_partkey:bigint,name:string>").json(folder)
    return read.select("properties.p_partkey", "properties.name", F.round(F.get("geometry.coordinates", 0), 6).alias("x"))


def _zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zip of each page; those of every tenth page have lost their end. Pages are taken out of Arrow one at a time."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 64):
                names, out = [], []
                for page, body in zip(*batch.slice(begin, 64).columns, strict=True):
                    with zipfile.ZipFile(buffer := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as file:
                        file.writestr("page.html", body.as_py())
                    names.append(str(page.as_py()))
                    out.append(buffer.getvalue()[: -30 if page.as_py() % 10 == 0 else None])
                yield pa.record_batch({"archive": pa.array(names, pa.string()), "content": pa.array(out, pa.binary())})

    return views.table(spark, sf_dir, "pages").select("page_id", "html").mapInArrow(pack, "archive string, content binary")


@query("SELECT CAST(page_id AS VARCHAR) AS archive, CASE WHEN page_id % 10 <> 0 THEN 'page.html' END AS member, CASE WHEN page_id % 10 <> 0 THEN CAST(strlen(html) AS INTEGER) END AS n_bytes, page_id % 10 = 0 AS failed FROM pages")
def archive_members(spark, sf_dir):
    found = archives.members(_zips(spark, sf_dir))
    return found.select("archive", "member", F.octet_length("content").alias("n_bytes"), F.col("error").isNotNull().alias("failed"))


@query("SELECT CAST(page_id AS VARCHAR) AS archive FROM pages WHERE page_id % 10 = 0")
def archive_pending(spark, sf_dir):
    zips = _zips(spark, sf_dir)
    done = archives.members(zips).where("error is null").select("archive").distinct()
    return index.not_done(zips, done, "archive").select("archive")


@query("SELECT p_partkey, p_name AS name, round(x, 6) AS x, round(y, 6) AS y FROM (SELECT p_partkey, name AS p_name, x, y FROM poi)")
def vector_roundtrip(spark, sf_dir):
    """Points as shapefile sets, of a bounded number of records each, and back.

    The sets are stored: a set that a retried task made anew could hold its records in another order.
    """
    rows = storage.dealt(views.poi(spark, sf_dir)).select("p_partkey", "name", F.array(F.array(geo.point(F.col("x"), F.col("y")))).alias("parts"))
    back = shapefile.points(shapefile.decoded(storage.stored(shapefile.encoded(rows, "point"), "sets")))
    return back.select(F.col("attributes")["p_partkey"].cast("long").alias("p_partkey"), F.col("attributes")["name"].alias("name"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("SELECT name, round(x, 6) AS x, round(y, 6) AS y FROM poi")
def append_csv(spark, sf_dir):
    """In two appends, read back."""
    folder = storage.shared_folder(spark, "points_csv")
    points = views.poi(spark, sf_dir)
    for part in ("shop = 'SMALL'", "shop <> 'SMALL'"):
        sinks.append_csv(points.where(part), folder)
    return spark.read.schema("name string, x double, y double").csv(folder).select("name", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("SELECT substring(name || ' of the make ' || amenity || ' at ' || shop, 1, 30) AS name, count(*) AS points FROM poi GROUP BY 1")
def append_points(spark, sf_dir):
    folder = storage.shared_folder(spark, "points")
    points = views.poi(spark, sf_dir).withColumn("name", F.concat("name", F.lit(" of the make "), "amenity", F.lit(" at "), "shop"))
    for part in ("p_size <= 25", "p_size > 25"):
        sinks.append_points(points.where(part), folder)
    return spark.read.parquet(folder).groupBy("name").agg(F.count("*").alias("points"))


@query("""SELECT user_id, count(*) AS points, round(coalesce(sum(sqrt((nv - value) ** 2 + (nk - event_id) ** 2)), 0), 3) AS length FROM (
    SELECT user_id, event_id, value, lead(value) OVER w AS nv, lead(event_id) OVER w AS nk FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) GROUP BY user_id""")
def tracks(spark, sf_dir):
    rows = index.path_lengths(views.table(spark, sf_dir, "events"), ["user_id"], "event_id", "value", "event_id")
    return rows.withColumn("length", F.round("length", 3))


from terraops.plans import globe, lists  # noqa: E402, F401  their queries are registered here
