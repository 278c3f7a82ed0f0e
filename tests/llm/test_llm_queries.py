"""The registered queries and the pipeline over the smallest tables."""

import os
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from terraops.llm import queries


@pytest.fixture(scope="module")
def documents(sf):
    return pd.read_parquet(f"{sf}/documents.parquet")


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_a_row_for_each_row(spark, sf, documents, name):
    rows = queries.QUERIES[name](spark, sf).toPandas()
    if "filter_order" in name:
        assert len(rows) == 600 * documents.source.nunique(dropna=False) and set(rows.part) == set(documents.source.fillna(""))
    elif "embeddings" in name or "metric" in name or "clusters" in name:
        assert len(rows) == len(pd.read_parquet(f"{sf}/embeddings.parquet"))
    else:
        assert set(rows.doc_id) == set(documents.doc_id)
        assert "packing" in name or len(rows) == len(documents)


@pytest.mark.parametrize(("name", "label", "least"), [("op1_attention_quality", "quality", 0.9), ("op10_levenshtein_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("the given tables are not here")
    rows = queries.QUERIES[name](spark, folder).toPandas().merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id")
    held = rows[rows.held_out]
    assert len(held) > 30 and np.mean(held.predicted == held[label]) >= least


def test_pipeline(spark, sf, documents):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = Counter(documents.doc_id)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == list(documents.columns), name
        kept = Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert kept <= ids
        ids = kept
    packed = corpus_pipeline.run(spark, sf).toPandas()
    assert set(packed.doc_id) == set(ids)
    assert packed.groupby("sequence_id").length.sum().max() <= 1024


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_against_sql(spark, sf, name):
    rows = queries.QUERIES[name](spark, sf).toPandas()
    with duckdb.connect() as db:
        for table in ("documents", "labels", "embeddings"):
            db.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
        expected = db.sql(queries.ORACLE_SQL[name]).df()
    names = sorted(rows.columns)
    assert sorted(expected.columns) == names and len(rows) == len(expected)
    left, right = (x[names].astype(str).sort_values(names, ignore_index=True) for x in (rows, expected))
    assert (left == right).all().all()


AWKWARD = [(3, "one two three four five six"), (3, "one two three four five six"), (1, "one two three four five six"), (None, "one two three four five six"), (None, None), (7, None), (8, ""), (9, " "), (10, "x " * 30_000), (11, "you worthless pathetic idiot"), (12, "short")]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_awkward_rows(spark, sf, name):
    """Nulls, empty and long texts, repeated rows, columns whose names differ in case alone, and no rows at all."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.createDataFrame([(i, t, "en", None, 5, "t") for i, t in AWKWARD], "doc_id long, text string, lang string, source string, n_chars long, TEXT string").repartition(2)
    rows = stage(spark, docs, sf)
    found = rows.collect()
    assert stage(spark, docs.limit(0), sf).count() == 0
    if name == "packing":
        assert Counter(r.doc_id for r in found if r.piece == 0) == Counter(i for i, _ in AWKWARD)
        return
    assert rows.columns == docs.columns and Counter((r[0], r[1]) for r in found) <= Counter(AWKWARD)
    if name == "near_duplicates":
        assert Counter(r[0] for r in found) == Counter([1, 7, 10, 11, 12])
    if name == "toxicity":
        assert 11 not in {r[0] for r in found} and len(found) == len(AWKWARD) - 1


def test_the_rest_does_not_import_this_package():
    import subprocess

    found = subprocess.run(["grep", "-rlE", r"terraops\.llm|corpus_pipeline", "terraops", "--include=*.py"], capture_output=True, text=True, cwd=os.path.dirname(corpus_pipeline.__file__)).stdout.split()
    assert all(f.startswith("terraops/llm/") for f in found)
