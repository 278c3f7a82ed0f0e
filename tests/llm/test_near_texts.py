"""The near-duplicate stage of the corpus pipeline against brute force, with planted copies of every similarity."""

import random
import re

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from terraops.llm import common, near_texts


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").lower())
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def linked(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def planted(seed):
    """(doc_id, text): copies with 0 to 8 changed words and lines that many texts share, and awkward rows."""
    draw = random.Random(seed)
    line = " ".join(f"licence{k}" for k in range(12))
    rows = []
    for n in [12, 40, 90, 200, 200, 400] * 3:
        base = [f"w{draw.randrange(3000)}" for _ in range(n)]
        for changed in range(9):
            text = list(base)
            for at in draw.sample(range(n), changed):
                text[at] = f"new{draw.randrange(10**6)}"
            rows.append(" ".join(text) + f"\n{line}" * draw.randrange(2))
    rows += ["", None, " ", "one two", "ONE two", "one two three", rows[20], rows[20]]
    ids = draw.sample(range(-50, 10_000), len(rows))
    ids[3] = ids[30] = None
    ids[-1] = ids[-2]
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize(("seed", "counters"), [(1, near_texts.COUNTERS), (2, near_texts.SEGMENT)])
def test_stage_links_as_brute_force(spark, monkeypatch, seed, counters):
    monkeypatch.setattr(near_texts, "COUNTERS", counters)
    if seed == 2:
        monkeypatch.setattr(near_texts, "BROADCAST", 0)
        monkeypatch.setattr(common, "HOT", 4)
    rows = planted(seed)
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    similar = []
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if linked(a, b) or not a and not b:
                similar.append(len(a & b) / max(len(a | b), 1))
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    assert sum(0.8 <= x < 0.9 for x in similar) > 10 and sum(0.9 <= x < 0.95 for x in similar) > 10
    want = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=None) for r in root}
    docs = spark.createDataFrame([(i, t, "kept") for i, t in rows], "doc_id long, text string, label string")
    kept = corpus_pipeline.near_duplicates(spark, docs.repartition(3), "")
    assert kept.columns == docs.columns
    key = lambda x: (x is None, x or 0)
    assert sorted((r.doc_id for r in kept.collect()), key=key) == sorted(want.values(), key=key)
    assert near_texts.one_of_each_text(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_crowds_are_searched_as_brute_force(spark, monkeypatch, seed):
    """Links are the same where any two sets that meet are a crowd; seed 2 broadcasts nothing."""
    monkeypatch.setattr(near_texts, "CROWD", 1)
    test_stage_links_as_brute_force(spark, monkeypatch, seed, near_texts.SEGMENT)


def test_all_shingles_are_counted(spark):
    rows = planted(3)
    counts = near_texts.counted(spark.createDataFrame([(t or "",) for _, t in rows], "text string").repartition(5))
    assert counts.sum() == sum(len(shingles(t)) for _, t in rows)


def test_fingerprints_alone_leave_links(spark):
    """Why the search by shingles is there: of planted pairs of similarity 0.8 and more the trees link a part."""
    draw = random.Random(9)
    pairs = []
    for k in range(200):
        base = [f"w{draw.randrange(3000)}" for _ in range(150)]
        text = list(base)
        for at in draw.sample(range(150), 1 + k % 3):
            text[at] = f"new{k}"
        a, b = " ".join(base), " ".join(text)
        if linked(shingles(a), shingles(b)):
            pairs.append([near_texts.fingerprints([near_texts.shingle_hashes(t, near_texts.WORDS)])[0] for t in (a, b)])
    bits = np.array([bin(int(np.uint64(np.int64(a)) ^ np.uint64(np.int64(b)))).count("1") for a, b in pairs])
    assert len(pairs) > 100 and 0.1 < np.mean(bits <= 3) < 0.9


def test_parities_rule_out_no_link():
    draw = np.random.default_rng(1)
    for n in (1, 9, 60, 700):
        a = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        for gone in range(0, n, max(1, n // 20)):
            b = np.unique(np.append(a[gone:], draw.integers(0, 2**63, gone).astype(np.uint64)))
            for bits in (near_texts.PARITY, near_texts.WIDE):
                apart = np.bitwise_count((near_texts.parities(a, bits) ^ near_texts.parities(b, bits)).view(np.uint64)).sum()  # of signed numbers it counts the absolute value
                assert not near_texts.alike(a, b) or 9 * apart <= len(a) + len(b)


def test_texts_that_share_a_passage_are_not_compared(spark, monkeypatch):
    """Counters are too few to tell what is shared; the drawn shingles' exact numbers do, however many texts there are."""
    monkeypatch.setattr(near_texts, "COUNTERS", near_texts.SEGMENT)
    compared = []
    monkeypatch.setattr(near_texts, "verified", lambda pairs, *rest, whole=near_texts.verified: compared.append(pairs.count()) or whole(pairs, *rest))
    draw = random.Random(4)
    passages = [" ".join(f"p{k}w{j}" for j in range(30)) for k in range(40)]
    rows = [(k, " ".join(f"w{draw.randrange(10**6)}" for _ in range(700)) + " " + passages[k % 40]) for k in range(200)]
    assert near_texts.one_of_each_text(spark.createDataFrame(rows, "doc_id long, text string")).count() == 200
    assert len(compared) == 3 and compared[1:] == [0, 0]


def test_edited_copies_of_one_text_are_not_all_compared(spark, monkeypatch):
    """Copies with too many edits to link with any other meet none, however many copies there are."""
    compared = []
    monkeypatch.setattr(near_texts, "verified", lambda pairs, *rest, whole=near_texts.verified: compared.append(pairs.count()) or whole(pairs, *rest))
    draw = random.Random(11)
    base, rows = [f"w{k}" for k in range(300)], []
    for k in range(120):
        text = list(base)
        for at in draw.sample(range(300), k % 12):
            text[at] = f"new{draw.randrange(10**9)}"
        rows.append((k, " ".join(text)))
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if linked(a, b):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    kept = near_texts.one_of_each_text(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root)) and 30 < len(set(root)) < 90
    assert compared[2] < len(rows)


def test_places_rule_out_no_link(spark):
    """Each two sets that can link share a shingle at which both have room for the link, in the order that is searched."""
    rows = [(k, t or "") for k, (_, t) in enumerate(planted(6))]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    marked = texts.select("doc_id", near_texts.described(texts.text, near_texts.counted(texts)).alias("d")).select("doc_id", "d.*").cache()
    found = {}
    for r in near_texts.searched(marked).collect():
        found.setdefault(r.key, {})[r.shingle] = r.pos
    keys = {r.doc_id: (r.key, r["size"]) for r in marked.collect()}
    sets = [near_texts.shingle_set(t) for _, t in rows]
    n = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a) and len(b) and keys[i][0] != keys[j][0] and near_texts.alike(a, b):
                own, other = found.get(keys[i][0], {}), found.get(keys[j][0], {})
                need = 4 * (len(a) + len(b))
                assert any(9 * (len(a) - own[s]) >= need and 9 * (len(b) - other[s]) >= need for s in own.keys() & other.keys())
                n += 1
    assert n > 50


@pytest.mark.parametrize("stage", ["near_duplicates", "packing"])
def test_stages_take_few_rows_at_a_time(spark, monkeypatch, stage):
    """The late stages of the pipeline hand few rows at a time to Python, and leave the session as it was."""
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)

    def sizes(docs, *rest, **more):
        seen.extend(r.n for r in docs.mapInPandas(lambda batches: (pd.DataFrame({"n": [len(b)]}) for b in batches), "n long").collect())
        return np.zeros(near_texts.COUNTERS, np.int64)

    monkeypatch.setattr(near_texts, "counted", sizes)
    monkeypatch.setattr(corpus_pipeline, "packed", sizes)
    docs = spark.range(0, 5_000, 1, 1).selectExpr("id as doc_id", "concat('text ', id) as text")
    dict(corpus_pipeline.STAGES)[stage](spark, docs, "")
    assert sum(seen) == 5_000 and max(seen) <= common.ROWS_AT_ONCE
    assert spark.conf.get(key) == before


def test_small_batches_end_with_an_error(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), common.small_batches(spark):
        assert spark.conf.get(key) == str(common.ROWS_AT_ONCE)
        1 / 0  # noqa: B018
    assert spark.conf.get(key) == before


def test_idle_workers_give_back_memory(monkeypatch):
    """A lean task returns what it has freed once its last batch is out."""
    done = []
    monkeypatch.setattr(common, "trim", lambda: done.append("trim"))
    out = list(common.lean(lambda batches: (b + 1 for b in batches))(done.append(b) or b for b in (1, 2)))
    assert out == [2, 3] and done == [1, 2, "trim"]
