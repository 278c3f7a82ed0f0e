"""Shared pieces of the training-data operators: tables, shared scratch, batching."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache, wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Characters of text that a task holds in Python objects at a time.
CHARS_AT_ONCE = 500_000
#: Rows that Spark hands to Python at a time where executors have little memory left.
ROWS_AT_ONCE = 1_000
#: A key is hot if it has more rows than this and more than one in so many of all.
HOT, HOT_KEYS = 262_144, 65_536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns named c0, c1, ...: names that differ in case alone, or not at all, no longer clash."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def field(df: DataFrame, name: str, kind: str) -> Column:
    """The column of numbered(df) that df calls exactly name, cast to kind; null where df lacks it."""
    return (F.col(f"c{df.columns.index(name)}") if name in df.columns else F.lit(None)).cast(kind)


def given(df: DataFrame, **kinds: str) -> DataFrame:
    """The columns of these names and kinds alone; null where df lacks one. All other columns are ignored."""
    return numbered(df).select(*[field(df, name, kind).alias(name) for name, kind in kinds.items()])


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) of docs; a null text is empty."""
    return given(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))


def kept_where(docs: DataFrame, condition: Callable[[Column], Column]) -> DataFrame:
    """The rows of docs, all columns as they are, for whose text (empty where null) the condition holds."""
    return numbered(docs).where(condition(F.coalesce(field(docs, "text", "string"), F.lit("")))).toDF(*docs.columns)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or in a local session one of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='terraops-')}"
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to Parquet in the shared folder and read back: cuts the lineage, survives lost executors.

    The files go when the session's Python ends; results may be read until then.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/terraops-{uuid.uuid4().hex}/{name}"
    rows = numbered(df)
    rows.write.parquet(path)
    atexit.register(_drop, spark, path.rpartition("/")[0])
    return spark.read.schema(rows.schema).parquet(path).toDF(*df.columns)


def _drop(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None or spark.sparkContext._jvm is None:
        return
    try:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception as error:  # the session may be gone already
        print(f"left {path}: {type(error).__name__}")


def with_figures(rows: DataFrame, figures: DataFrame, key: str, total: int) -> DataFrame:
    """rows, at most total of them, joined with their key's row of figures, whose n is the key's number of rows.

    Figures are aggregates of the rows, so that adaptive execution can't split a hot key of their join. There are
    fewer than HOT_KEYS hot keys; their figures are broadcast, and no task has to take all rows of one.
    """
    hot = max(HOT, total // HOT_KEYS)
    if total <= hot:  # no key can have more
        return rows.join(figures, key)
    many = figures.where(F.col("n") > hot)
    rest = rows.join(F.broadcast(many.select(key)), key, "left_anti")
    return rest.join(figures, key).unionByName(rows.join(F.broadcast(many), key))


_CACHES: list = []


def cached(size: int) -> Callable:
    """lru_cache for what a worker keeps; release() empties it."""

    def wrap(f: Callable) -> Callable:
        own = lru_cache(size)(f)
        _CACHES.append(own)
        return own

    return wrap


def release() -> None:
    """Gives back what a reused worker holds of earlier stages."""
    for own in _CACHES:
        own.cache_clear()
    trim()


def trim() -> None:
    """Gives back what a worker has freed but not returned; its caches stay."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # only glibc has it
        trim(0)


def lean(f: Callable) -> Callable:
    """f, from batches to batches, in a worker that gives back free memory after its task, as it may stay idle for long."""

    @wraps(f)
    def run(batches: Iterator) -> Iterator:
        yield from f(batches)
        trim()

    return run


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run meanwhile hand at most ROWS_AT_ONCE rows at a time to Python: both sides hold a whole batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= ROWS_AT_ONCE:
        spark.conf.set(key, str(ROWS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def slices(texts: list[str], at_once: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about at_once characters each; a longer text is a range of its own."""
    begin = held = 0
    for k, text in enumerate(texts):
        if held and held + len(text) > at_once:
            yield begin, k
            begin, held = k, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, rows: int, n_bytes: int, balanced: bool = False) -> DataFrame:
    """(label double, text) of at most rows labelled documents outside the held-out fold, written to the shared folder.

    Their whole texts have at most n_bytes together: rows are taken in the order of the sample while they fit.

    The fold of a document is crc32(doc_id as text) mod modulus. The sample is the rows of the smallest hashes of
    doc_id, or half of it from either label if balanced; a bound, whatever the input. Ids that are null, labels other
    than 0 and 1 and documents without a text are left out; an id that is labelled twice or has several texts counts once.
    """
    known = given(labels, doc_id="long", **{label: "int"}).withColumnRenamed(label, "label")
    known = known.where("doc_id is not null and label in (0, 1)").where(F.crc32(F.col("doc_id").cast("string")) % modulus != held_out)
    known = known.groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [known.where(F.col("label") == k).orderBy(*order).limit(rows // 2) for k in (0, 1)] if balanced else [known.orderBy(*order).limit(rows)]
    drawn = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    texts = given(documents, doc_id="long", text="string").where("text is not null")
    found = texts.join(F.broadcast(drawn), "doc_id")  # at most rows ids are broadcast
    found = written(found.where(F.octet_length("text") <= n_bytes).groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text")), "found")
    held = F.sum(F.octet_length("text").cast("long")).over(Window.orderBy(*order))  # over lengths of at most rows texts
    fitting = found.select("doc_id", held.alias("held")).where(F.col("held") <= n_bytes).select("doc_id")
    return written(found.join(F.broadcast(fitting), "doc_id", "left_semi").select("label", "text"), "sample")


def fold(doc_id: Column, modulus: int, held_out: int) -> Column:
    """Whether a row is in the held-out fold; false where doc_id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == held_out, F.lit(False))
