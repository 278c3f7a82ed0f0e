"""Queries of the training-data operators over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terraops.llm.common import table
from terraops.llm.oracles import ORACLE_SQL as ORACLE_SQL

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
END_ID = 2


def op1_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.quality import quality

    documents = table(spark, sf_dir, "documents")
    return quality(documents, documents, table(spark, sf_dir, "labels"))


def op2_elias_fano_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.token_file import read_token_file, write_token_file

    return read_token_file(write_token_file(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), END_ID))


def op3_backtracking_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.piece_codec import piece_digests

    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE), END_ID)


def op4_stupid_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.ngram_scores import ngram_scores

    return ngram_scores(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op5_rank_synchronous_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op6_simhash_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.simhash import simhash_components

    return simhash_components(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.packing import packed

    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), END_ID, 1024)


def op8_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.near_vectors import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op9_png_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.media import text_media

    return text_media(table(spark, sf_dir, "documents"))


def op10_levenshtein_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.toxicity import toxicity

    documents = table(spark, sf_dir, "documents")
    return toxicity(documents, documents, table(spark, sf_dir, "labels"))


def op11_checked_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.personal_data import personal_data, span_digests

    return span_digests(personal_data(table(spark, sf_dir, "documents")))


def op12_filter_order_diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.filter_audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_bit_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraops.llm.bit_planes import clustered

    return clustered(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_attention_quality,
        op2_elias_fano_token_file,
        op3_backtracking_piece_codec,
        op4_stupid_backoff_scores,
        op5_rank_synchronous_token_counts,
        op6_simhash_vantage_trees,
        op7_best_fit_packing,
        op8_metric_range_join,
        op9_png_media_columns,
        op10_levenshtein_toxicity,
        op11_checked_personal_data,
        op12_filter_order_diagrams,
        op13_bit_plane_clusters,
    )
}
