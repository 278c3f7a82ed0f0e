"""Five pipelines: trip report, point search, waterbodies, catalog search, clip."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.operators import catalog, osm, poi, spatial, trips
from terraops.operators.index import dense_index


def trip_report(employees: DataFrame, travel: DataFrame, start: Column, end: Column, names: list[str] | DataFrame | None = None) -> DataFrame:
    """(index, Name, ID, Duration, Start, End, Route) in the order of Name, Duration, Start and End."""
    found = trips.employee_trips(employees, travel, start, end, names)
    out = dense_index(found, *trips.ORDER, "ID", "Route")
    return out.select("index", *found.columns)


def trip_analysis(found: DataFrame, cities: DataFrame, keys: list[str], names: DataFrame | None = None) -> DataFrame:
    """Statistics, distances and ratios per person of found trips."""
    stats = trips.trip_stats(found, names)
    return trips.trip_ratios(stats.join(trips.trip_distance(found, cities, keys), "Name", "left"))


def waterbodies(elements: DataFrame) -> DataFrame:
    """Classified and measured ways of OSM elements (pos, type, id, lat, lon, nodes, tags)."""
    nodes = osm.split_elements(elements, "node").select("id", "lat", "lon")
    ways = osm.split_elements(elements, "way").select(F.col("id").alias("way_id"), "nodes", "tags")
    return osm.measured(osm.classify(osm.way_paths(ways, nodes)))


def point_search(points: DataFrame, order: list, **chain) -> DataFrame:
    return poi.search(points, order, **chain)


def catalog_search(rows: DataFrame, start: date, end: date, today: date, **chain) -> DataFrame:
    """The filter chain over the whole catalog, its period first kept within the catalog's own."""
    limits = catalog.bounds(rows, today)
    wanted = rows.sparkSession.range(1).select(F.lit(start).alias("f_start"), F.lit(end).alias("f_end"))
    period = catalog.clamped(wanted, limits)  # one row
    found = catalog.search(rows, **chain).join(F.broadcast(period))
    return catalog.overlapping(found, F.col("f_start"), F.col("f_end"), today).drop("f_start", "f_end")


def clip_status(lines: DataFrame, polygons: DataFrame, line_id: str, polygon_id: str) -> DataFrame:
    """(polygon_id, pieces, failed) of each polygon, those without lines among them."""
    cut = spatial.clip(lines, polygons, line_id, polygon_id)
    counts = cut.groupBy(polygon_id).agg(F.count_if("ok").alias("pieces"), F.count_if(~F.col("ok")).alias("failed"))
    return polygons.select(polygon_id).join(counts, polygon_id, "left").fillna(0, ["pieces", "failed"])
