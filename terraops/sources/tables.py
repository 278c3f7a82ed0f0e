"""CSV and JSON sources, with their schemas given."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraops import schemas
from terraops.functions import time


def employees(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EMPLOYEES).csv(path, header=False)


def travel(spark: SparkSession, folder: str, name: str = r"^travel_[0-9]{4}\.csv$") -> DataFrame:
    """All headerless files in or below folder whose name matches the regular expression, with their times parsed.

    The name is a hidden column of the file source, so files that do not match are left out before any is read.
    """
    raw = spark.read.schema("ID int, Start string, End string, Route string").option("recursiveFileLookup", True).csv(folder)
    raw = raw.where(F.col("_metadata.file_name").rlike(name))
    return raw.withColumn("Start", time.parse_timestamp(F.col("Start"))).withColumn("End", time.parse_timestamp(F.col("End")))


def osm_elements(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """(pos, type, id, lat, lon, nodes, tags) of the elements of OSM-style documents, a file or a line each."""
    docs = spark.read.schema(schemas.OSM).option("multiLine", multiline).json(path)
    return docs.select(F.posexplode("elements").alias("pos", "e")).select("pos", "e.*")


def catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CATALOG).option("multiLine", True).json(path)


def catalog_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The catalog at path; where there is none, the rows of build() are written there first."""
    try:
        return spark.read.schema(schemas.CATALOG).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    build().write.json(path)
    return spark.read.schema(schemas.CATALOG).json(path)


def image_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.IMAGES).option("multiLine", True).json(path)


def image_bands(documents: DataFrame) -> DataFrame:
    """One row per feature and band of documents (features)."""
    f = documents.select(F.explode("features").alias("f")).select("f.id", "f.properties", F.explode("f.bands").alias("b"))
    start, end = F.col("properties")["system:time_start"], F.col("properties")["system:time_end"]
    ring = F.transform(F.col("properties")["system:footprint"]["coordinates"], lambda c: F.struct(F.get(c, 0).alias("x"), F.get(c, 1).alias("y")))
    return f.select(
        "id", F.col("b.id").alias("band"), "b.crs", F.get("b.dimensions", 0).alias("dim_x"), F.get("b.dimensions", 1).alias("dim_y"),
        start.alias("start_ms"), end.alias("end_ms"), time.epoch_date(start).alias("start_date"), time.epoch_date(end).alias("end_date"), ring.alias("footprint"),
    )
