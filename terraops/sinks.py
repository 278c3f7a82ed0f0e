"""Writers. All go through Spark's committers; names of columns and the order of rows are the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.functions import geo
from terraops.storage import stored


def indexed_csv(df: DataFrame, folder: str, index: str = "index") -> None:
    """CSV with a header whose first column, the index, has no name."""
    rest = [c for c in df.columns if c != index]
    df.select(F.col(index).alias(" "), *rest).write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(folder)


def append_csv(df: DataFrame, folder: str) -> None:
    """Name, x and y, without a header, after what is there."""
    df.select("name", "x", "y").write.mode("append").csv(folder)


def append_points(df: DataFrame, folder: str) -> None:
    """Points after those of an existing layer; names are cut to 30 characters."""
    df.select(F.substring("name", 1, 30).alias("name"), F.col("x").cast("double"), F.col("y").cast("double")).write.mode("append").parquet(folder)


def trip_lines(df: DataFrame, folder: str) -> None:
    """Typed line layer of trips with path: Name, ID, Duration, Start and End as text, Route, geom_wkt and srid."""
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    df.select("Name", "ID", "Duration", text("Start"), text("End"), "Route", geo.line_wkt(F.col("path")).alias("geom_wkt"), F.lit(4326).alias("srid")).write.mode("overwrite").parquet(folder)


def catalog_json(rows: DataFrame, folder: str, error: str = "error") -> None:
    """Good rows as JSON in folder, the others in folder_partial. Rows are stored first, so they are worked out once for both."""
    rows = stored(rows, "rows")
    rows.where(F.col(error).isNull()).drop(error).write.mode("overwrite").json(folder)
    rows.where(F.col(error).isNotNull()).write.mode("overwrite").json(f"{folder}_partial")


def geojson(geometry_type: str, coordinates: Column, *properties: str) -> Column:
    """One feature as a line of text."""
    shape = F.struct(F.lit(geometry_type).alias("type"), coordinates.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*properties).alias("properties")))


def geojson_lines(df: DataFrame, folder: str, geometry_type: str, coordinates: Column, *properties: str) -> None:
    df.select(geojson(geometry_type, coordinates, *properties).alias("value")).write.mode("overwrite").text(folder)


def waterbody_layers(measured: DataFrame, folder: str) -> None:
    """Linear and areal features in folders of their own: way_id, name, tag, length or area, and the geometry as text."""
    shape = F.when(F.col("kind") == "linear", geo.line_wkt(F.col("path"))).otherwise(geo.polygon_wkt(F.array(geo.closed(F.col("path")))))
    measured.select("kind", "way_id", "name", "tag", "length", "area", shape.alias("geom_wkt")).write.mode("overwrite").partitionBy("kind").parquet(folder)


def by_polygon(clipped: DataFrame, folder: str, polygon_id: str) -> None:
    """One folder of output for each clip polygon."""
    clipped.withColumn("clip_oid", F.col(polygon_id)).write.mode("overwrite").partitionBy("clip_oid").parquet(folder)
