"""A training corpus from documents: without toxic texts, of good quality, one of each near-duplicate, packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read back as
the next stage's docs. All but the last return the columns of docs. Any of the columns may hold nulls, further columns
may have any name, and an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terraops.llm.common import small_batches, table, written
from terraops.llm.near_texts import one_of_each_text
from terraops.llm.packing import packed
from terraops.llm.quality import of_quality
from terraops.llm.queries import BYTE_BPE, END_ID
from terraops.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity operator rejects; null texts are scored as empty ones, repeated rows go together."""
    return without_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects; null texts are scored as empty ones, repeated rows go together."""
    return of_quality(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked texts.

    Texts link when the Jaccard similarity of their sets of five-word shingles is 0.8 or more; transitively
    linked documents are one group, of which that of the smallest doc_id stays. SimHash finds most links, a search
    by rare shingles the rest. Texts without words (null, empty, blank) are alike; of repeated rows one stays.
    """
    return one_of_each_text(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places all tokens of what is left in sequences of at most 1024.

    Null and empty texts are their end id alone, repeated rows are pieces of their own, other columns are ignored.
    """
    with small_batches(spark):  # the stages before have filled the executors
        return packed(docs, public_tokenizers.path(BYTE_BPE), END_ID, 1024, room=200_000)


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_duplicates", near_duplicates), ("packing", packing)]

#: SQL can't express the classifiers, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
