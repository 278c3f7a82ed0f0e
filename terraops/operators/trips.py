"""Trips of employees: selection, routes as lines, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.functions import geo, text, time
from terraops.operators.index import first_per_key

ORDER = ("Name", "Duration", "Start", "End")


def employee_trips(employees: DataFrame, travel: DataFrame, start: Column, end: Column, names: list[str] | DataFrame | None = None) -> DataFrame:
    """(Name, ID, Duration, Start, End, Route) of trips that lie wholly between start and end.

    names is a list for an IN filter, or for long lists a DataFrame with a column Name.
    """
    people = employees if names is None else employees.join(names.select("Name").distinct(), "Name", "left_semi") if isinstance(names, DataFrame) else employees.where(F.col("Name").isin(names))
    trips = people.join(travel, "ID").where((F.col("Start") >= start) & (F.col("End") <= end))
    return trips.withColumn("Duration", time.whole_days(F.col("Start"), F.col("End"))).select("Name", "ID", "Duration", "Start", "End", "Route")


def stop_rows(trips: DataFrame, keys: list[str]) -> DataFrame:
    """One row per stop: keys, pos, city."""
    return trips.select(*keys, F.posexplode(text.stops(F.col("Route"))).alias("pos", "city"))


def route_lines(trips: DataFrame, cities: DataFrame, keys: list[str], strict: bool = False, back: bool = False) -> DataFrame:
    """trips with path and missing_cities; keys must name a trip.

    Each stop takes the first city of its name by position (pos). A trip with an unknown city has a null
    path and the names in missing_cities; strict ends the job instead. back appends the first stop.
    """
    known = first_per_key(cities.select(F.col("NAME").alias("city"), "pos", "x", "y"), ["city"], "pos").select("city", "x", "y")
    route = text.round_trip(text.stops(F.col("Route"))) if back else text.stops(F.col("Route"))
    rows = trips.select(*keys, F.posexplode(route).alias("pos", "city")).join(known, "city", "left")
    found = F.sort_array(F.collect_list(F.struct("pos", "x", "y", "city")))
    lines = rows.groupBy(*keys).agg(found.alias("rows"))
    missing = F.array_distinct(F.transform(F.filter("rows", lambda r: r.x.isNull()), lambda r: r.city))
    path = F.transform("rows", lambda r: F.struct(r.x.alias("x"), r.y.alias("y")))
    whole = F.when(F.size(missing) == 0, path)
    if strict:
        whole = whole.otherwise(F.raise_error(F.concat(F.lit("no such city: "), F.array_join(missing, ";"))).cast("array<struct<x:double,y:double>>"))
    return trips.join(lines.select(*keys, whole.alias("path"), missing.alias("missing_cities")), keys)


def cities_first_seen(trips: DataFrame) -> DataFrame:
    """(Name, cities_visited, total_cities): each person's cities in the order in which the sorted trips meet them."""
    rows = trips.select("Name", *ORDER[1:], "Route", F.posexplode(text.stops(F.col("Route"))).alias("pos", "city"))
    first = rows.groupBy("Name", "city").agg(F.min(F.struct(*ORDER[1:], "Route", "pos")).alias("first"))
    seen = F.sort_array(F.collect_list(F.struct("first", "city")))
    listed = first.groupBy("Name").agg(F.array_join(F.transform(seen, lambda s: s.city), ";").alias("cities_visited"), F.count("*").alias("total_cities"))
    return listed


def trip_stats(trips: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Statistics per person; names (Name, with or without trips) adds rows of zero counts and null values.

    most_stops_compat is the stop count of the last route in text order, most_stops that of the longest.
    """
    stats = trips.groupBy("Name").agg(
        F.count("*").alias("total_trips"),
        F.sum("Duration").cast("long").alias("total_travel_days"),
        time.whole_days(F.min("Start"), F.max("End")).alias("total_time_span"),
        F.max("Duration").alias("longest_trip_days"),
        F.min("Duration").alias("shortest_trip_days"),
        F.size(text.stops(F.max("Route"))).alias("most_stops_compat"),
        F.max(F.size(text.stops(F.col("Route")))).alias("most_stops"),
    )
    stats = stats.join(cities_first_seen(trips), "Name")
    if names is not None:
        stats = names.select("Name").distinct().join(stats, "Name", "left").fillna(0, ["total_trips", "total_travel_days", "total_cities"])
    return stats


def trip_distance(trips: DataFrame, cities: DataFrame, keys: list[str]) -> DataFrame:
    """(Name, total_distance_mi): round trips in miles along the arc that their planar length in degrees spans."""
    lines = route_lines(trips, cities, keys, back=True)
    miles = geo.degrees_to_miles(geo.path_length(F.col("path")))
    return lines.groupBy("Name").agg(F.round(F.sum(miles), 1).alias("total_distance_mi"))


def trip_ratios(stats: DataFrame) -> DataFrame:
    """stats with days per trip, share of travel time and span per trip, and miles per day if there is a distance."""
    ratio = lambda a, b: text.round1(F.try_divide(a.cast("double"), b.cast("double")))
    out = stats.withColumn("avg_days_per_trip", ratio(F.col("total_travel_days"), F.col("total_trips")))
    out = out.withColumn("travel_time_pct", ratio(100 * F.col("total_travel_days"), F.col("total_time_span")))
    out = out.withColumn("span_per_trip", ratio(F.col("total_time_span"), F.col("total_trips")))
    return out.withColumn("avg_distance_per_day", ratio(F.col("total_distance_mi"), F.col("total_travel_days"))) if "total_distance_mi" in stats.columns else out
