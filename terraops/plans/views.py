"""The given tables seen as the pipelines' inputs. DUCKDB holds the same definitions as common table expressions."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraops.functions import geo

TODAY = date(2024, 1, 1)
SEGMENTS = ("BUILDING", "MACHINERY")
FROM, TO = "2024-01-03 00:00:00", "2024-01-28 00:00:00"
CITIES = [("view", -75.5, 40.25), ("signup", -71.0, 42.5), ("click", -80.0, 40.5), ("error", -73.75, 42.75), ("purchase", -77.0, 38.75), ("view", 0.0, 0.0)]
RADIUS_KM = 1500.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_name as Name", "c_custkey as ID", "c_mktsegment as Team")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one user and week: first and last time, and the event types in order as the route."""
    events = table(spark, sf_dir, "events")
    rows = F.sort_array(F.collect_list(F.struct("ts", "event_id", "event_type")))
    weeks = events.groupBy("user_id", F.date_trunc("week", F.col("ts")).alias("week"))
    out = weeks.agg(F.min("ts").alias("Start"), F.max("ts").alias("End"), F.array_join(F.transform(rows, lambda r: r.event_type), ";").alias("Route"))
    return out.select(F.col("user_id").alias("ID"), "Start", "End", "Route")


def cities(spark: SparkSession) -> DataFrame:
    rows = [(name, k, x, y) for k, (name, x, y) in enumerate(CITIES)]
    return spark.createDataFrame(rows, "NAME string, pos int, x double, y double")


def poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = "cast(p_partkey * 7919 % 36000 as double) / 100D - 180D + 0.003D"
    y = "cast(p_partkey * 104729 % 18000 as double) / 100D - 90D + 0.003D"
    return table(spark, sf_dir, "part").selectExpr("p_partkey", "p_name as name", "p_brand as amenity", "p_type as shop", "p_size", f"{x} as x", f"{y} as y")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon = F.expr("cast(n_nationkey % 5 * 60 - 120 as double) + 0.1D")
    lat = F.expr("cast(floor(n_nationkey / 5) * 25 - 50 as double) + 0.1D")
    nations = table(spark, sf_dir, "nation").withColumn("lon", lon).withColumn("lat", lat)
    return nations.select("n_nationkey", "n_name", F.array(geo.circle(F.col("lat"), F.col("lon"), F.lit(RADIUS_KM))).alias("rings"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poi(spark, sf_dir).selectExpr("p_partkey as id", "x as lon", "y as lat")


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ways over their parts; the seventh item of an order is a node that does not exist."""
    items = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber as n", "l_partkey + if(l_linenumber = 7, 1000000000L, 0L) as node")
    lists = items.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "node"))), lambda r: r.node).alias("nodes"))
    tags = F.expr("""map_concat(
        case o_orderpriority when '1-URGENT' then map('waterway', case o_orderkey % 3 when 0 then 'stream' when 1 then 'river' else 'canal' end) when '2-HIGH' then map('waterway', 'ditch', 'natural', 'water')
            when '3-MEDIUM' then map('natural', 'water', 'water', case o_orderkey % 3 when 0 then 'lake' when 1 then 'pond' else 'reservoir' end) when '4-NOT SPECIFIED' then map('natural', 'water') else map('highway', 'path') end,
        case o_orderstatus when 'F' then map('name', 'Falls') when 'O' then map('name', 'Otter') else map() end)""")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("way_id"), tags.alias("tags"))
    return orders.join(lists, F.col("way_id") == F.col("l_orderkey")).select("way_id", "nodes", "tags")


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and ways; before every fifth way stands an older one of its id, without tags."""
    points = nodes(spark, sf_dir).select(F.lit("node").alias("type"), "id", "lat", "lon", F.lit(None).cast("array<bigint>").alias("nodes"), F.lit(None).cast("map<string,string>").alias("tags"))
    lines = ways(spark, sf_dir).select(F.lit("way").alias("type"), F.col("way_id").alias("id"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), "nodes", "tags")
    last = points.union(lines).withColumn("pos", F.lit(1))
    return last.union(last.where("type = 'way' and id % 5 = 0").withColumns({"tags": F.create_map().cast("map<string,string>"), "pos": F.lit(0)}))


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A straight road from each point five degrees east and three north."""
    return poi(spark, sf_dir).select("p_partkey", "name", F.array(geo.point(F.col("x"), F.col("y")), geo.point(F.col("x") + 5.0, F.col("y") + 3.0)).alias("path"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as datasets with raw text dates; some ends are 'Present' or null."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_size", "concat(p_brand, '/', p_name, '/', p_partkey) as dataset_id", "p_type as dataset_type", "split(p_name, ' ') as tags",
        "cast(date_add(date'2000-01-01', cast(p_partkey % 5000 as int)) as string) as dataset_start",
        "case when p_partkey % 11 = 0 then null when p_partkey % 7 = 0 then 'Present' else cast(date_add(date'2000-01-01', cast(p_partkey % 5000 + 30 * p_size as int)) as string) end as dataset_end",
    )


_VALUES = ", ".join(f"('{n}', {k}, {x}::DOUBLE, {y}::DOUBLE)" for k, (n, x, y) in enumerate(CITIES))
_STEP = "pi() / 3"
DUCKDB = {
    "people": 'SELECT c_name AS "Name", c_custkey AS "ID", c_mktsegment AS "Team" FROM customer',
    "trips": """SELECT user_id AS "ID", min(ts) AS "Start", max(ts) AS "End", string_agg(event_type, ';' ORDER BY ts, event_id) AS "Route"
        FROM events GROUP BY user_id, date_trunc('week', ts)""",
    "found": f"""SELECT "Name", "ID", CAST((epoch_us("End") - epoch_us("Start")) // 86400000000 AS INTEGER) AS "Duration", "Start", "End", "Route"
        FROM people JOIN trips USING ("ID") WHERE "Team" IN {SEGMENTS} AND "Start" >= TIMESTAMP '{FROM}' AND "End" <= TIMESTAMP '{TO}'""",
    "report": """SELECT row_number() OVER (ORDER BY "Name", "Duration", "Start", "End", "ID", "Route") - 1 AS "index", * FROM found""",
    "cities": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY cpos) AS r FROM (VALUES {_VALUES}) v(city, cpos, cx, cy)) WHERE r = 1",
    "stops": """SELECT "index", "Name", "Duration", "Start", "End", "Route", unnest(string_split("Route", ';')) AS city, generate_subscripts(string_split("Route", ';'), 1) AS pos FROM report""",
    "poi": """SELECT p_partkey, p_name AS name, p_brand AS amenity, p_type AS shop, p_size, (p_partkey * 7919 % 36000)::DOUBLE / 100 - 180 + 0.003::DOUBLE AS x,
        (p_partkey * 104729 % 18000)::DOUBLE / 100 - 90 + 0.003::DOUBLE AS y FROM part""",
    "centres": "SELECT n_nationkey, n_name, (n_nationkey % 5 * 60 - 120)::DOUBLE + 0.1::DOUBLE AS lon, (n_nationkey // 5 * 25 - 50)::DOUBLE + 0.1::DOUBLE AS lat FROM nation",
    "corners": f"""SELECT n_nationkey, n_name, i, lon, lat, {RADIUS_KM} / 6371::DOUBLE AS r, pi() / 6 + i * {_STEP} AS b,
        asin(sin(radians(lat)) * cos({RADIUS_KM} / 6371::DOUBLE) + cos(radians(lat)) * sin({RADIUS_KM} / 6371::DOUBLE) * cos(pi() / 6 + i * {_STEP})) AS yr
        FROM centres, range(6) t(i)""",
    "ring": """SELECT n_nationkey, n_name, i, yr * 180 / pi() AS y, (radians(lon) + atan2(sin(b) * sin(r) * cos(radians(lat)), cos(r) - sin(radians(lat)) * sin(yr))) * 180 / pi() AS x FROM corners""",
    "edges": """SELECT a.n_nationkey, a.n_name, a.x AS ax, a.y AS ay, b.x AS ux, b.y AS uy FROM ring a JOIN ring b ON a.n_nationkey = b.n_nationkey AND b.i = (a.i + 1) % 6""",
    "in_zone": """SELECT p_partkey, n_nationkey FROM poi, edges WHERE (uy > y) <> (ay > y) AND x < (ax - ux) * (y - uy) / (ay - uy) + ux
        GROUP BY p_partkey, n_nationkey HAVING count(*) % 2 = 1""",
    "way": """SELECT o_orderkey AS way_id, list(l_partkey + CASE WHEN l_linenumber = 7 THEN 1000000000 ELSE 0 END ORDER BY l_linenumber, l_partkey) AS nodes,
        any_value(o_orderpriority) AS prio, any_value(CASE o_orderstatus WHEN 'F' THEN 'Falls' WHEN 'O' THEN 'Otter' ELSE 'unknown' END) AS name
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""",
    "way_node": "SELECT way_id, unnest(nodes) AS id, generate_subscripts(nodes, 1) AS pos FROM way",
    "way_point": "SELECT way_id, pos, x, y FROM way_node LEFT JOIN poi ON id = p_partkey",
    "drawn": "SELECT way_id, count(*) AS n, count(x) = count(*) AS drawn FROM way_point GROUP BY way_id",
    "way_edge": """SELECT way_id, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny, first_value(x) OVER w AS fx, first_value(y) OVER w AS fy
        FROM way_point WINDOW w AS (PARTITION BY way_id ORDER BY pos)""",
    "classed": """SELECT way_id, name, drawn, n, CASE WHEN NOT drawn THEN 'ignored' WHEN prio IN ('1-URGENT', '2-HIGH') THEN 'linear' WHEN prio IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'areal' ELSE 'ignored' END AS kind,
        CASE WHEN NOT drawn THEN NULL WHEN prio = '1-URGENT' THEN ['Stream', 'River', 'Canal'][way_id % 3 + 1] WHEN prio = '2-HIGH' THEN 'OtherLinear' WHEN prio = '3-MEDIUM' THEN ['Lake', 'Pond', 'Reservoir'][way_id % 3 + 1] WHEN prio = '4-NOT SPECIFIED' THEN 'OtherAreal' END AS class
        FROM way JOIN drawn USING (way_id)""",
    "catalog": """SELECT p_partkey, p_size, p_brand || '/' || p_name || '/' || p_partkey AS dataset_id, p_type AS dataset_type, string_split(p_name, ' ') AS tags, p_brand AS publisher,
        DATE '2000-01-01' + (p_partkey % 5000)::INT AS start, CASE WHEN p_partkey % 11 = 0 OR p_partkey % 7 = 0 THEN NULL ELSE DATE '2000-01-01' + (p_partkey % 5000 + 30 * p_size)::INT END AS "end",
        p_partkey % 11 <> 0 AND p_partkey % 7 = 0 AS end_present FROM part""",
    "dated": """SELECT *, CASE WHEN end_present THEN DATE '2024-01-01' ELSE "end" END AS until, CASE WHEN end_present THEN 'Present' ELSE CAST("end" AS VARCHAR) END AS raw_end, CAST(start AS VARCHAR) AS raw_start FROM catalog""",
}


def sql(body: str) -> str:
    """body with those views before it that it needs."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in DUCKDB:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                add(DUCKDB[name])
                if name not in needed:
                    needed.append(name)

    add(body)
    return ("WITH " + ",\n".join(f"{n} AS ({DUCKDB[n]})" for n in needed) + "\n" if needed else "") + body
