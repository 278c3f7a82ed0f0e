"""Waterbodies from OSM-style elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.functions import geo, text

#: Fixed: the classes by tag value.
LINEAR, AREAL = ("stream", "river", "canal"), ("lake", "pond", "reservoir")


def split_elements(elements: DataFrame, kind: str) -> DataFrame:
    """Elements of one type by id; of a repeated id the last by pos stays."""
    rest = [c for c in elements.columns if c != "id"]
    last = F.max_by(F.struct(*rest), "pos").alias("last")
    return elements.where(F.col("type") == kind).groupBy("id").agg(last).select("id", *[F.col("last")[c].alias(c) for c in rest])


def way_paths(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """ways (way_id, nodes, tags) with path, null if a node is missing or there are none."""
    rows = ways.select("way_id", F.posexplode("nodes").alias("pos", "id")).join(nodes.select("id", F.col("lon").alias("x"), F.col("lat").alias("y")), "id", "left")
    met = rows.groupBy("way_id").agg(F.sort_array(F.collect_list(F.struct("pos", "x", "y"))).alias("p"), F.count_if(F.col("y").isNull()).alias("missing"))
    path = F.when(F.col("missing") == 0, F.transform("p", lambda p: F.struct(p.x.alias("x"), p.y.alias("y"))))
    return ways.join(met.select("way_id", path.alias("path")), "way_id", "left")


def _class(value: Column, names: tuple[str, ...], other: str) -> Column:
    out = F.lit(other)
    for name in names:
        out = F.when(value == name, name.capitalize()).otherwise(out)
    return out


def classify(ways: DataFrame) -> DataFrame:
    """ways with kind (linear, areal, ignored), class, tag and name; linear claims first, a way without path is ignored."""
    get = lambda key: F.try_element_at("tags", F.lit(key))
    drawn = F.col("path").isNotNull()
    linear, areal = drawn & F.map_contains_key("tags", "waterway"), drawn & F.map_contains_key("tags", "natural")
    kind = F.when(F.coalesce(linear, F.lit(False)), "linear").when(F.coalesce(areal, F.lit(False)), "areal").otherwise("ignored")
    out = ways.withColumn("kind", kind)
    named = F.when(F.col("kind") == "linear", _class(get("waterway"), LINEAR, "OtherLinear")).when(F.col("kind") == "areal", _class(get("water"), AREAL, "OtherAreal"))
    out = out.withColumn("class", named)
    return out.withColumn("tag", F.when(F.col("class").startswith("Other"), F.col("class")).otherwise(F.lower("class"))).withColumn("name", text.unknown_if_missing(F.col("tags")))


def measured(ways: DataFrame) -> DataFrame:
    """Classified ways with length in metres (linear) or area in square metres (areal)."""
    linear = ways.where("kind = 'linear'").withColumn("length", geo.geodesic_length(F.col("path"))).withColumn("area", F.lit(None).cast("double"))
    areal = ways.where("kind = 'areal'").withColumn("length", F.lit(None).cast("double")).withColumn("area", geo.ellipsoid_area(F.col("path")))
    return linear.unionByName(areal)


def label(kind: Column, name: Column, length: Column, area: Column) -> Column:
    shown = F.concat(kind, F.lit(" "), name)
    return F.when(area.isNull(), F.concat(shown, F.lit(" (length: "), length.cast("string"), F.lit("m)"))).otherwise(F.concat(shown, F.lit(" (area: "), area.cast("string"), F.lit("m2)")))
