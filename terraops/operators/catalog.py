"""Faceted search over a catalog of datasets.

Rows are (dataset_id, dataset_type, tags, start, end, end_present) with dates; null dates are open.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.functions import text, time


def dated(catalog: DataFrame) -> DataFrame:
    """catalog with start, end and end_present from the raw text dates."""
    return catalog.withColumns({"start": time.parse_date(F.col("dataset_start")), "end": time.parse_date(F.col("dataset_end")), "end_present": time.is_present(F.col("dataset_end"))})


def of_type(catalog: DataFrame, kind: str | None) -> DataFrame:
    return catalog.where(F.col("dataset_type") == kind) if kind else catalog


def of_publisher(catalog: DataFrame, name: str | None) -> DataFrame:
    return catalog.where(text.publisher(F.col("dataset_id")) == name) if name else catalog


def with_tags(catalog: DataFrame, tags: list[str] | None, every: bool = False) -> DataFrame:
    """Rows with any of the tags, or with every one."""
    if not tags:
        return catalog
    wanted = F.array(*map(F.lit, tags))
    return catalog.where(F.size(F.array_except(wanted, F.col("tags"))) == 0 if every else F.arrays_overlap(F.col("tags"), wanted))


def with_tags_compat(catalog: DataFrame, tags: list[str], position: str) -> DataFrame:
    """As written: once a row has had a tag, all later rows pass, in either mode.

    The first such row decides, so its position is found by an aggregate and no task has to hold all rows.
    """
    hit = F.arrays_overlap(F.col("tags"), F.array(*map(F.lit, tags)))
    first = catalog.where(hit).agg(F.min(position).alias("__first"))
    return catalog.join(F.broadcast(first), F.col(position) >= F.col("__first")).drop("__first")


def running_flag(rows: DataFrame, keys: list[str], position: str, condition: Column, name: str = "seen") -> DataFrame:
    """rows with whether condition has held in their key up to them, in the order of position.

    The first such row of a key decides, so its position is found by an aggregate and no task has to hold a key.
    """
    first = rows.where(condition).groupBy(*keys).agg(F.min(position).alias("__first"))
    return rows.join(first, keys, "left").withColumn(name, F.coalesce(F.col(position) >= F.col("__first"), F.lit(False))).select(*rows.columns, name)


def overlapping(catalog: DataFrame, start: Column, end: Column, today: date) -> DataFrame:
    """Rows that share a day with start..end; a null start or end passes, an end of 'Present' is today."""
    until = F.when(F.col("end_present"), F.lit(today)).otherwise(F.col("end"))
    return catalog.where(F.col("start").isNull() | until.isNull() | ((F.col("start") <= end) & (start <= until)))


def search(catalog: DataFrame, kind: str | None = None, publisher: str | None = None, tags: list[str] | None = None, every: bool = False, period: tuple[Column, Column] | None = None, today: date | None = None) -> DataFrame:
    """Type, publisher, tags and time, in this order, from the whole catalog."""
    out = catalog.transform(of_type, kind).transform(of_publisher, publisher).transform(with_tags, tags, every)
    return out.transform(overlapping, *period, today) if period else out


def bounds(catalog: DataFrame, today: date) -> DataFrame:
    """One row (first, last): least start, and the greatest end, or today if an end is open."""
    open_end = F.bool_or(F.col("end_present") | F.col("end").isNull())
    return catalog.agg(F.min("start").alias("first"), F.when(open_end, F.lit(today)).otherwise(F.max("end")).alias("last"))


def clamped(ranges: DataFrame, limits: DataFrame) -> DataFrame:
    """ranges (f_start, f_end) kept within limits (one row: first, last); an end before the start is the day after it."""
    out = ranges.join(F.broadcast(limits))
    start = F.greatest(F.col("f_start"), F.coalesce("first", "f_start"))
    end = F.least(F.col("f_end"), F.coalesce("last", "f_end"))
    out = out.withColumn("f_start", start).withColumn("f_end", end)
    return out.withColumn("f_end", F.when(F.col("f_end") < F.col("f_start"), F.date_add("f_start", 1)).otherwise(F.col("f_end"))).drop("first", "last")


def facets(catalog: DataFrame) -> DataFrame:
    """(facet, value, datasets): how many rows each type, publisher and tag has, in one pass."""
    values = F.explode(
        F.concat(
            F.array(F.struct(F.lit("type").alias("facet"), F.col("dataset_type").alias("value")), F.struct(F.lit("publisher").alias("facet"), text.publisher(F.col("dataset_id")).alias("value"))),
            F.transform(F.array_distinct("tags"), lambda t: F.struct(F.lit("tag").alias("facet"), t.alias("value"))),
        )
    ).alias("f")
    return catalog.select(values).groupBy("f.facet", "f.value").agg(F.count("*").alias("datasets"))


def index_by(catalog: DataFrame, key: Column, name: str = "key", parts: int = 64) -> DataFrame:
    """Inverted index: (key, part, dataset_ids in order). A key's list is dealt into parts, so a hot key is no hot task."""
    rows = catalog.select(key.alias(name), F.pmod(F.xxhash64("dataset_id"), F.lit(parts)).alias("part"), "dataset_id")
    return rows.groupBy(name, "part").agg(F.sort_array(F.collect_list("dataset_id")).alias("dataset_ids"))


def lists_by(catalog: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Inverted index as lists: (key, dataset_ids in order). A list is one row; for keys with very many see index_by."""
    return catalog.select(key.alias(name), "dataset_id").groupBy(name).agg(F.sort_array(F.collect_list("dataset_id")).alias("dataset_ids"))


def selected(rows: DataFrame, keys: DataFrame, key: str, invert: bool = False) -> DataFrame:
    return rows.join(keys, key, "left_anti" if invert else "left_semi")


def with_details(listing: DataFrame, details: DataFrame, key: str = "dataset") -> DataFrame:
    """One-to-one join; of columns that both have, the detail's stay."""
    kept = [c for c in listing.columns if c == key or c not in details.columns]
    return listing.select(*kept).join(details, key)
