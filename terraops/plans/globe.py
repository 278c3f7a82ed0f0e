"""Queries of geometry on the whole globe, and of shapes of any mix of sizes and states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraops.functions import geo
from terraops.operators import spatial
from terraops.plans import pipelines, views
from terraops.plans.queries import _CLIP, _F, azimuth_sql, query

#: Centres of circles near the date line and the poles: number, latitude, longitude, km.
CENTRES = [(1, 10.0, 179.9, 1500.0), (2, -35.0, -179.9, 2500.0), (3, 89.0, 20.0, 2000.0), (4, -89.0, -100.0, 1500.0), (5, 70.0, 175.0, 3000.0), (6, 40.0, 5.0, 1000.0)]
_NEAR, _FAR = 0.95, 1.02
_VALUES = ", ".join(f"({k}, {lat}::DOUBLE, {lon}::DOUBLE, {km}::DOUBLE)" for k, lat, lon, km in CENTRES)


@query(f"""SELECT centre, CAST(count(*) FILTER (d < {_NEAR} * km) AS BIGINT) AS near, CAST(0 AS BIGINT) AS far FROM (SELECT centre, km,
    2 * 6371 * asin(sqrt(least(1.0::DOUBLE, sin(radians(y - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(y)) * sin(radians(x - lon) / 2) ** 2))) AS d FROM poi, (VALUES {_VALUES}) v(centre, lat, lon, km)) GROUP BY centre""")
def circles_about_the_globe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in polygons of 64 corners: all within most of the radius are there, and none beyond it."""
    centres = spark.createDataFrame(CENTRES, "centre int, lat double, lon double, radius_km double")
    found = spatial.within_radius(views.poi(spark, sf_dir), centres, 64)
    d = geo.haversine(F.col("lat"), F.col("lon"), F.col("y"), F.col("x"), geo.KM)
    near = F.count_if(d < _NEAR * F.col("radius_km")).alias("near")
    return found.groupBy("centre").agg(near, F.count_if(d > _FAR * F.col("radius_km")).alias("far"))


views.DUCKDB["opposite"] = f"""SELECT p_partkey, turn, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2 FROM (SELECT p_partkey, radians(dx - 360 * floor((dx + 180) / 360)) AS turn,
    atan((1 - {_F}) * tan(radians(y))) AS u1, atan((1 - {_F}) * tan(radians(y2))) AS u2 FROM (SELECT p_partkey, y, 180 + (p_partkey % 7 - 3)::DOUBLE * 0.07::DOUBLE AS dx, greatest(-90.0::DOUBLE, least(90.0::DOUBLE, (p_partkey % 5 - 2)::DOUBLE * 0.05::DOUBLE - y)) AS y2 FROM poi))"""


@query(f"SELECT p_partkey, round(metres / 1000, 1) AS km FROM ({azimuth_sql('opposite', 'p_partkey')})")
def geodesics_to_antipodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each point to a place on the other side of the globe, where Vincenty's rounds do not converge."""
    x2 = F.col("x") + (180 + (F.col("p_partkey") % 7 - 3).cast("double") * 0.07)
    y2 = F.greatest(F.lit(-90.0), F.least(F.lit(90.0), (F.col("p_partkey") % 5 - 2).cast("double") * 0.05 - F.col("y")))
    path = F.array(geo.point(F.col("x"), F.col("y")), geo.point(x2, y2))
    return views.poi(spark, sf_dir).select("p_partkey", F.round(geo.geodesic_length(path) / 1000, 1).alias("km"))


_E = "sqrt(1 / 298.257223563::DOUBLE * (2 - 1 / 298.257223563::DOUBLE))"
_Q = f"((1 - {_E} ** 2) * (sin(radians({{y}})) / (1 - ({_E} * sin(radians({{y}}))) ** 2) + 0.5 * ln((1 + {_E} * sin(radians({{y}}))) / (1 - {_E} * sin(radians({{y}})))) / {_E}))"
_Y, _Y10 = "(50 + n_nationkey)::DOUBLE", "(60 + n_nationkey)::DOUBLE"


@query(f"""SELECT n_nationkey, round(pi() * 6378137.0::DOUBLE ** 2 * ({_Q.format(y="90.0::DOUBLE")} - {_Q.format(y=_Y)}) / 1e9, 3) AS cap, round(radians(20.0::DOUBLE) * 6378137.0::DOUBLE ** 2 / 2 * ({_Q.format(y=_Y10)} - {_Q.format(y=_Y)}) / 1e9, 3) AS strip,
    round(pi() * 6378137.0::DOUBLE ** 2 * {_Q.format(y="90.0::DOUBLE")} / 1e9, 3) AS half FROM nation""")
def areas_about_the_globe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of square km north of a parallel, within a strip over the date line, and of a hemisphere."""
    y, start = F.col("n_nationkey") + 50.0, F.col("n_nationkey").cast("double")
    round_ = lambda v: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.struct(((start + 45 * k + 180) % 360 - 180).alias("x"), v.alias("y")))
    strip = F.array(*[geo.point(F.lit(x), v) for x, v in ((170.0, y), (-170.0, y), (-170.0, y + 10), (170.0, y + 10))])
    shown = lambda ring: F.round(geo.ellipsoid_area(ring) / 1e9, 3)
    return views.table(spark, sf_dir, "nation").select("n_nationkey", shown(round_(y)).alias("cap"), shown(strip).alias("strip"), shown(round_(F.lit(0.0))).alias("half"))


@query("""SELECT p_partkey, -1 AS zone FROM poi WHERE x >= -180 AND x < 180 AND y >= -90 AND y < 90 UNION ALL SELECT p_partkey, n_nationkey AS zone FROM in_zone
    UNION ALL SELECT a.p_partkey, 100 + b.p_partkey AS zone FROM poi a JOIN poi b ON b.p_partkey % 10 = 0 AND a.x >= b.x - 0.011 AND a.x < b.x + 0.011 AND a.y >= b.y - 0.011 AND a.y < b.y + 0.011""")
def points_in_mixed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones as small as a village, as large as a country, and one of the whole world, in one join."""
    square = lambda x, y, d, e: F.array(F.array(*[geo.point(x + a * d, y + b * e) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))]))
    zero = F.lit(0.0)
    small = views.poi(spark, sf_dir).where("p_partkey % 10 = 0").select((F.col("p_partkey") + 100).alias("zone"), square(F.col("x"), F.col("y"), 0.011, 0.011).alias("rings"))
    world = spark.range(1).select(F.lit(-1).cast("long").alias("zone"), square(zero, zero, 180.0, 90.0).alias("rings"))
    zones = views.zones(spark, sf_dir).select(F.col("n_nationkey").cast("long").alias("zone"), "rings").union(small).union(world)
    return spatial.points_in_polygons(views.poi(spark, sf_dir), zones).select("p_partkey", "zone")


_RING_BOX = "SELECT n_nationkey, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM ring GROUP BY n_nationkey"


@query(f"""SELECT n_nationkey, coalesce(pieces, 0) AS pieces, coalesce(failed, 0) AS failed FROM nation
    LEFT JOIN (SELECT n_nationkey, count(*) AS pieces FROM ({_CLIP}) WHERE p_partkey % 10 <> 0 AND NOT outside AND t1 > greatest(t0, 0) GROUP BY n_nationkey) USING (n_nationkey)
    LEFT JOIN (SELECT n_nationkey, count(*) AS failed FROM poi, ({_RING_BOX}) WHERE p_partkey % 10 = 0 AND x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY n_nationkey) USING (n_nationkey)""")
def clip_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth road has lost an end: its cuts fail and are counted."""
    end = F.when(F.col("p_partkey") % 10 == 0, float("nan")).otherwise(F.col("path")[1]["x"])
    roads = views.roads(spark, sf_dir).withColumn("path", F.array(F.col("path")[0], geo.point(end, F.col("path")[1]["y"])))
    return pipelines.clip_status(roads, views.zones(spark, sf_dir), "p_partkey", "n_nationkey")


@query("SELECT CAST(p_partkey % 3 AS INTEGER) AS road, n_nationkey, count(*) AS rows, round(sum(degrees), 4) AS degrees FROM clipped GROUP BY p_partkey % 3, n_nationkey")
def clip_of_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ids for all roads: each road gives its own pairs."""
    roads = views.roads(spark, sf_dir).select((F.col("p_partkey") % 3).cast("int").alias("road"), "path")
    cut = spatial.clip(roads, views.zones(spark, sf_dir), "road", "n_nationkey")
    return cut.groupBy("road", "n_nationkey").agg(F.count("*").alias("rows"), F.round(F.sum(F.round(spatial.parts_length(F.col("parts")), 6)), 4).alias("degrees"))


@query("""SELECT p_partkey, round(CASE p_partkey % 5 WHEN 0 THEN d * 1.60934::DOUBLE WHEN 1 THEN d / 1000 WHEN 2 THEN d / 3280.839895::DOUBLE ELSE d END, 9) AS km FROM (SELECT p_partkey, p_size::DOUBLE AS d FROM poi)""")
def distance_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Miles, metres and feet in any case, kilometres, and a unit that is not known."""
    unit = F.get(F.array(*map(F.lit, ("Miles", "M", "feet", "km", "leagues"))), (F.col("p_partkey") % 5).cast("int"))
    return views.poi(spark, sf_dir).select("p_partkey", F.round(geo.to_km(F.col("p_size").cast("double"), unit), 9).alias("km"))
