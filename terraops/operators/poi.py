"""Points of interest: attribute queries and the search chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraops.operators.spatial import points_in_polygons, within_radius

LIMITS = (1, 5, 10, 25, 50, 100, 1000)


def attribute_query(df: DataFrame, field: str, value: str, allowed: list[str], order: list[str | Column], limit: int = 10) -> DataFrame:
    """Rows whose field equals value, at most limit in order; nothing if the field is not allowed."""
    return df.where(F.col(field) == value).orderBy(*order).limit(limit) if field in allowed else df.limit(0)


def refine(everything: DataFrame, current: DataFrame | None, condition: Column, compat: bool = False) -> DataFrame:
    """current, or everything if there is none yet, where condition holds.

    compat: a current result without rows counts as none; decided within the plan, not on the driver.
    """
    if current is None:
        return everything.where(condition)
    if not compat:
        return current.where(condition)
    hits = current.agg(F.count("*").alias("__hits"))
    start = everything.join(hits, F.col("__hits") == 0).drop("__hits")
    return current.unionByName(start).where(condition)


def first_or_everything(result: DataFrame, everything: DataFrame, order: list[str | Column], limit: int) -> DataFrame:
    """The first limit rows of result in order, or of everything if result has no rows.

    Both are cut off together, result's rows first, so neither runs twice and only limit rows meet in one place.
    """
    turn = "__turn"
    both = result.withColumn(turn, F.lit(0)).unionByName(everything.withColumn(turn, F.lit(1)))
    first = both.orderBy(turn, *order).limit(limit)
    return first.withColumn("__least", F.min(turn).over(Window.partitionBy(F.lit(0)))).where(F.col(turn) == F.col("__least")).drop(turn, "__least")


def search(poi: DataFrame, order: list[str | Column], zones: DataFrame | None = None, condition: Column | None = None, centre: DataFrame | None = None, limit: int = 10, compat: bool = False) -> DataFrame:
    """Country, attribute and radius filters in this order, then one limit; everything if nothing is left.

    compat: the limit holds after each filter, not only at the end.
    """
    cut = (lambda df: df.orderBy(*order).limit(limit)) if compat else (lambda df: df)
    found = poi
    if zones is not None:
        found = cut(points_in_polygons(found, zones).select(*poi.columns))
    if condition is not None:
        found = cut(found.where(condition))
    if centre is not None:
        found = cut(within_radius(found, centre).select(*poi.columns))
    return first_or_everything(found, poi, order, limit).orderBy(*order)
