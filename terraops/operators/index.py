"""Row labels, first matches and ordered paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraops.storage import stored


_PART, _RANK = "__part", "__rank"


def _ranged(df: DataFrame, *order: str | Column) -> DataFrame:
    """df in range partitions, each sorted, with the number of a row's partition and its rank there, from 0.

    The rows are stored: range bounds are drawn anew whenever a plan runs, and partition and rank must not change.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(_RANK, F.monotonically_increasing_id())
    rows = rows.withColumn(_PART, F.shiftright(_RANK, 33).cast("int")).withColumn(_RANK, F.col(_RANK).bitwiseAND(F.lit((1 << 33) - 1)))
    return stored(rows, "ranged")


def dense_index(df: DataFrame, *order: str | Column, name: str = "index") -> DataFrame:
    """df sorted by order with a dense 0-based label.

    Rows are range-partitioned and counted by partition, so no task sees them all: only one count for each
    partition meets in one place. order must be total, or equal rows take their labels in any order.
    """
    ranged = _ranged(df, *order)
    sizes = ranged.groupBy(_PART).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))  # a row a partition
    sizes = sizes.select(_PART, F.coalesce(before, F.lit(0)).alias("__before"))
    label = (F.col("__before") + F.col(_RANK)).cast("long")
    return ranged.join(F.broadcast(sizes), _PART).withColumn(name, label).select(*df.columns, name)


def path_lengths(df: DataFrame, keys: list[str], position: str, x: str = "x", y: str = "y") -> DataFrame:
    """(keys, points, length): the number of points of each key, and the planar length of its path in the order of position.

    Points are range-partitioned by key and position, so that a key with many is measured by many tasks; the first
    point of a partition finds the one before it in a table of one row for each partition.
    """
    rows = _ranged(df.select(*keys, position, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")), *keys, position)
    point = F.struct(*keys, "__x", "__y")
    last = rows.groupBy(_PART).agg(F.max_by(point, _RANK).alias("p"))
    last = last.select(_PART, F.lag("p").over(Window.orderBy(_PART)).alias("__last"))  # a row a partition
    rows = rows.withColumn("__before", F.lag(point).over(Window.partitionBy(_PART).orderBy(_RANK))).join(F.broadcast(last), _PART)
    before = F.coalesce("__before", "__last")
    same = F.lit(True)
    for k in keys:
        same = same & before[k].eqNullSafe(F.col(k))
    step = F.when(same & before.isNotNull(), F.hypot(F.col("__x") - before["__x"], F.col("__y") - before["__y"]))
    return rows.groupBy(*keys).agg(F.count("*").alias("points"), F.coalesce(F.sum(step), F.lit(0.0)).alias("length"))


def first_per_key(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The first row of each key; a partial minimum comes before the shuffle, so a hot key is no hot task."""
    rest = [c for c in df.columns if c not in keys]
    ranked = F.min_by(F.struct(*rest), F.struct(*order)).alias("__first")
    return df.groupBy(*keys).agg(ranked).select(*keys, *[F.col("__first")[c].alias(c) for c in rest])


def _chunked(df: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """df with __i, the place of a row among all by keys and order, and chunk, which size places share."""
    return dense_index(df, *keys, *order, name="__i").withColumn("chunk", F.floor(F.col("__i") / size))


def list_chunks(df: DataFrame, keys: list[str], order: list[str], value: str, size: int = 10_000) -> DataFrame:
    """(keys, chunk, values): each key's values in order, in lists of at most size; chunks of a key are in order too.

    Chunks are cut by the place of a row among all, which range partitions and one count for each of them give, so
    a key with any number of rows is dealt over tasks and no row holds more than size values.
    """
    listed = F.sort_array(F.collect_list(F.struct("__i", F.col(value).alias("v"))))
    return _chunked(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, size).groupBy(*keys, "chunk").agg(F.transform(listed, lambda r: r.v).alias("values"))


def path_chunks(df: DataFrame, keys: list[str], position: str, x: str = "x", y: str = "y", size: int = 10_000) -> DataFrame:
    """(keys, chunk, path): each key's track in the order of position as parts of at most size + 1 points.

    A part ends with the point that the next part of its key begins with, so parts joined end to end are the track. See list_chunks.
    """
    rows = _chunked(df.select(*keys, position, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")), keys, [position], size)
    first = F.col("__i") % size == 0
    copies = F.when(first, F.array(F.col("chunk"), F.col("chunk") - 1)).otherwise(F.array(F.col("chunk")))
    rows = rows.withColumn("own", F.col("chunk")).withColumn("chunk", F.explode(copies))
    points = F.sort_array(F.collect_list(F.struct("__i", "__x", "__y")))
    parts = rows.groupBy(*keys, "chunk").agg(points.alias("p"), F.max(F.col("own") == F.col("chunk")).alias("met"))  # a key that begins a chunk has no part before it
    return parts.where("met").select(*keys, "chunk", F.transform("p", lambda p: F.struct(p["__x"].alias("x"), p["__y"].alias("y"))).alias("path"))


def paths(df: DataFrame, keys: list[str], position: str, x: str = "x", y: str = "y") -> DataFrame:
    """(keys, path): the points of each key in the order of position. A path is one row, which a task must hold."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(position).alias("pos"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))))
    return df.groupBy(*keys).agg(F.transform(rows, lambda p: F.struct(p.x.alias("x"), p.y.alias("y"))).alias("path"))


def distinct_values(df: DataFrame, columns: list[str], blank: str = " ") -> DataFrame:
    """(attribute, value): the distinct values of each column, as text, without the blank."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], columns, "attribute", "value")
    return long.where((F.col("value") != blank) | F.col("value").isNull()).distinct()


def fields(df: DataFrame) -> DataFrame:
    """(position, field, type, filled, different) of df's columns: how many rows have a value, how many values there are."""
    kinds = {f.name: (k, f.dataType.simpleString()) for k, f in enumerate(df.schema.fields)}
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in kinds])
    values = texts.unpivot([], list(kinds), "field", "value").groupBy("field", "value").agg(F.count("*").alias("n"))
    figures = values.groupBy("field").agg(F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("filled"), F.count("value").alias("different"))
    listed = df.sparkSession.createDataFrame([(k, name, kind) for name, (k, kind) in kinds.items()], "position int, field string, type string")
    return listed.join(figures, "field", "left").select("position", "field", "type", F.coalesce("filled", F.lit(0)).alias("filled"), F.coalesce("different", F.lit(0)).alias("different"))


def not_done(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return work.join(done, key, "left_anti")
