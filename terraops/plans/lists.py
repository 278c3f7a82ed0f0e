"""Queries of lists and tracks in parts, table functions in SQL, and further forms of trips and catalog rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraops import sinks, storage
from terraops.functions import time
from terraops.operators import catalog as cat
from terraops.operators import index, trips
from terraops.plans import pipelines, views
from terraops.plans.queries import _SEEN, _STATS, _details, _found, _listing, _report, query
from terraops.sources import html

#: Places to a list: few, so that users' events fill several.
SIZE = 64
_PLACED = "SELECT *, row_number() OVER (ORDER BY user_id, event_id) - 1 AS i FROM events"


@query(f"SELECT user_id, i // {SIZE} AS chunk, string_agg(CAST(event_id AS VARCHAR), ';' ORDER BY i) AS events FROM ({_PLACED}) GROUP BY user_id, i // {SIZE}")
def event_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events in order, in lists of a bounded length."""
    rows = index.list_chunks(views.table(spark, sf_dir, "events"), ["user_id"], ["event_id"], "event_id", SIZE)
    return rows.select("user_id", "chunk", F.array_join("values", ";").alias("events"))


@query(f"""SELECT user_id, i // {SIZE} AS chunk, count(*) + CAST(bool_or(ends AND n IS NOT NULL) AS INT) AS points, round(sum(CASE WHEN n IS NULL THEN 0 ELSE sqrt((nv - value) ** 2 + (n - event_id) ** 2) END), 3) AS length,
    min(event_id) AS first_y, max(coalesce(CASE WHEN ends THEN n END, event_id)) AS last_y FROM
    (SELECT *, i % {SIZE} = {SIZE} - 1 AS ends, lead(event_id) OVER w AS n, lead(value) OVER w AS nv FROM ({_PLACED}) WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) GROUP BY user_id, i // {SIZE}""")
def track_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's track in parts that join end to end: points, length and ends of every part."""
    from terraops.functions import geo

    rows = index.path_chunks(views.table(spark, sf_dir, "events"), ["user_id"], "event_id", "value", "event_id", SIZE)
    ends = [F.element_at("path", k)["y"].cast("long").alias(name) for k, name in ((1, "first_y"), (-1, "last_y"))]
    return rows.select("user_id", "chunk", F.size("path").cast("long").alias("points"), F.round(geo.path_length(F.col("path")), 3).alias("length"), *ends)


@query("""SELECT c.dataset_id AS url, CAST(c.p_partkey AS VARCHAR) AS dataset, CAST(len(list_distinct(c.tags)) AS INTEGER) AS tags, c.dataset_type AS description, c.dataset_type || '("' || c.dataset_id || '")' AS code FROM catalog c""")
def page_table_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extractors of pages as table functions in Spark SQL."""
    html.register_functions(spark)
    listing, details = (f"pages_{name}" for name in ("listing", "details"))
    _listing(spark, sf_dir).createOrReplaceTempView(listing)
    _details(spark, sf_dir).createOrReplaceTempView(details)
    return spark.sql(f"""SELECT l.url, r.dataset, size(r.tags) AS tags, r.description, d.code FROM {listing} l, LATERAL listing_rows(l.html) r
        JOIN (SELECT p.url, substring(c.code, 4) AS code FROM {details} p, LATERAL detail_cells(p.html) c WHERE c.error IS NULL) d ON d.url = r.dataset WHERE r.error IS NULL""")


@query(f"""SELECT p."Name", coalesce(s.total_trips, 0) AS total_trips, coalesce(s.total_travel_days, 0) AS total_travel_days, coalesce(c.total_cities, 0) AS total_cities, c.cities_visited, CAST(s.longest_trip_days AS DOUBLE) AS longest_trip_days
    FROM (SELECT DISTINCT "Name" FROM people) p LEFT JOIN ({_STATS}) s USING ("Name") LEFT JOIN ({_SEEN}) c USING ("Name")""")
def trips_stats_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of everybody, those without trips among them."""
    rows = trips.trip_stats(_found(spark, sf_dir), views.people(spark, sf_dir))
    return rows.select("Name", "total_trips", "total_travel_days", "total_cities", "cities_visited", F.col("longest_trip_days").cast("double").alias("longest_trip_days"))


_MILES = """SELECT "Name", round(sum(radians(d) * 3956), 1) AS total_distance_mi FROM (SELECT "Name", sum(sqrt((coalesce(nx, fx) - cx) ** 2 + (coalesce(ny, fy) - cy) ** 2)) AS d FROM (
    SELECT "Name", "index", cx, cy, lead(cx) OVER w AS nx, lead(cy) OVER w AS ny, first_value(cx) OVER w AS fx, first_value(cy) OVER w AS fy
    FROM stops JOIN cities USING (city) WINDOW w AS (PARTITION BY "index" ORDER BY pos)) GROUP BY "Name", "index") GROUP BY "Name\""""


@query(f"""SELECT "Name", total_trips, total_distance_mi, CASE WHEN total_travel_days > 0 THEN round_even(total_distance_mi / total_travel_days, 1) END AS avg_distance_per_day FROM ({_STATS}) JOIN ({_MILES}) USING ("Name")""")
def trips_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole analysis: statistics, distances and ratios, distance per day among them."""
    return pipelines.trip_analysis(_report(spark, sf_dir), views.cities(spark), ["index"]).select("Name", "total_trips", "total_distance_mi", "avg_distance_per_day")


@query("""SELECT "Name", "ID", "Duration", "Start", "End", "Route", kind FROM (SELECT "Name", "ID", CAST((epoch_us("End") - epoch_us("Start")) // 86400000000 AS INTEGER) AS "Duration", "Start", "End", "Route" FROM people JOIN trips USING ("ID")
    WHERE "Name" IN (SELECT "Name" FROM people WHERE "ID" % 5 = 0 OR "ID" BETWEEN 10 AND 20) AND "Start" >= TIMESTAMP '2024-01-03 00:00:00') JOIN (SELECT 'list' AS kind, "Name" AS n FROM people WHERE "ID" BETWEEN 10 AND 20 UNION ALL SELECT 'table', "Name" FROM people WHERE "ID" % 5 = 0) ON n = "Name\"""")
def trips_of_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of named people: an IN list for few names, a semi join with a table for many."""
    people, travel = views.people(spark, sf_dir), views.trips(spark, sf_dir)
    limits = [F.lit(v).cast("timestamp_ntz") for v in (views.FROM, "9999-01-01 00:00:00")]
    few = [r.Name for r in people.where("ID between 10 and 20").select("Name").collect()]
    parts = [trips.employee_trips(people.drop("Team"), travel, *limits, names).withColumn("kind", F.lit(kind)) for kind, names in (("list", few), ("table", people.where("ID % 5 = 0")))]
    return parts[0].unionByName(parts[1])


@query("""SELECT p_partkey, CASE WHEN p_partkey % 6 IN (0, 1, 5) THEN CAST(DATE '2000-01-01' + (p_partkey % 5000)::INT AS VARCHAR) END AS day, p_partkey % 6 = 2 AS present, p_partkey % 6 = 3 AS unreadable FROM part""")
def catalog_date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as ISO dates and timestamps, 'Present', nonsense and null."""
    day = F.date_add(F.lit(date(2000, 1, 1)), (F.col("p_partkey") % 5000).cast("int")).cast("string")
    kind = F.col("p_partkey") % 6
    raw = F.when(kind == 0, day).when(kind == 1, F.concat(day, F.lit("T00:00:00.0Z"))).when(kind == 2, "Present").when(kind == 3, F.concat(F.lit("about "), day)).when(kind == 5, F.concat(day, F.lit(" 12:30:00")))
    return views.table(spark, sf_dir, "part").select("p_partkey", time.parse_date(raw).cast("string").alias("day"), time.is_present(raw).alias("present"), F.coalesce(time.unreadable(raw), F.lit(False)).alias("unreadable"))


@query("SELECT substring(name || ' of the make ' || amenity || ' at ' || shop, 1, 30) AS name, round(x, 6) AS x, round(y, 6) AS y FROM poi")
def append_points_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of two appends, by value."""
    folder = storage.shared_folder(spark, "points")
    points = views.poi(spark, sf_dir).withColumn("name", F.concat("name", F.lit(" of the make "), "amenity", F.lit(" at "), "shop"))
    for part in ("p_size <= 25", "p_size > 25"):
        sinks.append_points(points.where(part), folder)
    return spark.read.parquet(folder).select("name", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("SELECT way_id, name, kind, CASE WHEN class LIKE 'Other%' THEN class ELSE lower(class) END AS tag FROM classed WHERE kind <> 'ignored'")
def osm_layer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of both layers, by value."""
    folder = storage.shared_folder(spark, "waterbodies")
    sinks.waterbody_layers(pipelines.waterbodies(views.elements(spark, sf_dir)), folder)
    return spark.read.parquet(folder).select("way_id", "name", "kind", "tag")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS dataset, p_partkey % 4 = 0 AS partial FROM part""")
def catalog_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that could not be read are kept apart, in the partial snapshot."""
    folder = storage.shared_folder(spark, "catalog")
    rows = _details(spark, sf_dir).withColumn("html", F.when(F.col("url").cast("long") % 4 == 0, "<p>moved</p>").otherwise(F.col("html")))
    sinks.catalog_json(html.detail_rows(rows).withColumnRenamed("url", "dataset"), folder)
    good, bad = (spark.read.schema("dataset string, dataset_id string, error string").json(f) for f in (folder, f"{folder}_partial"))
    return good.where("dataset_id is not null and error is null").select("dataset", F.lit(False).alias("partial")).union(bad.where("error is not null").select("dataset", F.lit(True).alias("partial")))


@query("SELECT dataset_id FROM (SELECT *, max(list_has_any(tags, ['small', 'ring'])::INT) OVER (ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) AS seen FROM catalog) WHERE seen = 1")
def catalog_tags_all_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As written, asking for every tag gives what asking for any does."""
    return cat.with_tags_compat(cat.dated(views.catalog(spark, sf_dir)), ["small", "ring"], "p_partkey").select("dataset_id")
