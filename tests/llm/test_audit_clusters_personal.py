"""Personal data, filter orders and bit-plane clusters against their SQL and slow versions, on awkward rows."""

import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from terraops.llm import bit_planes, filter_audit, oracles, personal_data
from terraops.llm.common import given

CLASH = "TEXT string, spans string, mask int, part string, cluster int, rank int"
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def base_spans(text):
    """The contract's patterns one by one, by Python's own regular expressions."""
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(v) <= 255 for v in m.group().split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


ADDED = {
    "to iban GB82 WEST 1234 5698 7654 32 today": [("iban", 8, 35)],
    "DE89370400440532013000": [("iban", 0, 22)],
    "DE89370400440532013001": [],
    "DE893704004405320130009": [],
    "his ssn is 123-45-6789.": [("ssn", 11, 22)],
    "part 123-45-6789": [],
    "ssn 000-45-6789": [],
    "+1 (269) 555-3296 4524132264652876": [("phone", 0, 17), ("card", 18, 34)],
    "card 4111 1111 1111 1111 12/25": [("card", 5, 24)],
    "order 4111 1111 1111 1111 12/25": [],
}
PIECES = ["a@b.co", "a@b.co_d@e.f", "x@y", "@", "é😀", "1.2.3.4", "256.1.1.1", "001.002.3.4.5", "4111111111111111", "4111-1111 11111111", "4111 1111 1111 1112", "+1 (984) 555-9263", "+4", "+49 30", " ", ", ", "\n", "7", "-", ".", "GB82WEST12345698765432", "iban ", "card ", "ssn 123-45-6789"]


def mixed_texts(n=300):
    draw = random.Random(4)
    return ["".join(draw.choice(PIECES) for _ in range(draw.randrange(30))) for _ in range(n)]


TEXTS = [None, "", " ", *ADDED, *mixed_texts(), "a" * 8_000, "1" * 8_000, "1." * 50_000, "+1" + " 1" * 50_000, "a.b@c.de " * 20_000, "a@" * 8_000, "-.-.-" * 2_000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 7 else i // 2, t, ["s", None, "", "t"][i % 4], "x", "y", 1, "p", 2, 3) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {CLASH}").repartition(5).cache()


def sql(query, **tables):
    with duckdb.connect() as db:
        for name, rows in tables.items():
            db.register(name, rows)
        return db.sql(oracles.ORACLE_SQL[query]).df()


def same(a, b):
    names = sorted(a.columns)
    assert names == sorted(b.columns) and len(a) == len(b)
    left, right = (rows[names].astype(str).sort_values(names, ignore_index=True) for rows in (a, b))
    assert (left == right).all().all()


def small(docs):
    """The named columns of short rows alone."""
    return given(docs, doc_id="long", text="string", source="string").where("text is null or length(text) < 1000")


def test_personal_data_against_its_sql_and_regular_expressions(docs):
    found = personal_data.span_digests(personal_data.personal_data(docs)).toPandas()
    expected = []
    for text in TEXTS:
        base = base_spans(text)
        expected.append((*(sum(s[0] == k for s in base) for k in BASE), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()))
    got = found[["n_email", "n_ip", "n_card", "n_phone", "base_sha256"]]
    assert sorted(map(tuple, got.values.tolist())) == sorted(expected)
    short = small(docs)
    same(personal_data.span_digests(personal_data.personal_data(short)).toPandas().astype({"doc_id": "Float64"}), sql("op11_checked_personal_data", documents=short.toPandas()).astype({"doc_id": "Float64"}))


def test_added_spans_and_scores(spark):
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in personal_data.personal_data(docs).collect()}
    for i, (text, expected) in enumerate(ADDED.items()):
        added = [(s.kind, s.start, s.end) for s in found[i] if not s.base]
        assert added == expected, text
        assert all(s.text == text[s.start : s.end] and s.score >= personal_data.ACCEPTED for s in found[i] if not s.base)
    near = spark.createDataFrame([(1, "4111111111111111"), (2, "visa 4111111111111111"), (3, "order 4111111111111111")], "doc_id long, text string")
    assert {r.doc_id: r.spans[0].score for r in personal_data.personal_data(near).collect()} == {1: 70, 2: 100, 3: 30}


def test_personal_data_runs_no_python(spark, docs):
    plan = personal_data.span_digests(personal_data.personal_data(docs))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan.split("InMemoryTableScan")[0])


def test_running_totals(spark):
    lengths = [list(range(n)) for n in (0, 1, 2, 255, 256, 257, 1000)]
    rows = spark.createDataFrame([(v,) for v in lengths], "v array<bigint>").select("v", personal_data.running_totals(F.col("v")).alias("t")).collect()
    assert all(r.t == [0, *itertools.accumulate(r.v)][: len(r.v)] for r in rows)


def test_no_rows(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert personal_data.span_digests(personal_data.personal_data(none)).count() == 0
    assert filter_audit.filter_audit(none, labels).count() == 0
    assert bit_planes.clustered(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_neighbour_swaps_visit_every_order_once():
    for n in range(1, 7):
        order = list(range(n))
        seen = [tuple(order)]
        for k in filter_audit.neighbour_swaps(n):
            order[k], order[k + 1] = order[k + 1], order[k]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(itertools.permutations(range(n)))


def test_diagrams_share_nodes_and_give_every_order():
    draw = random.Random(1)
    counts = {m: (draw.randrange(50), draw.randrange(5), draw.randrange(5)) for m in range(32) if draw.random() < 0.6}
    rows = {(r[0], r[1]): r[2:] for r in filter_audit.audit_of(counts)}
    total = dict.fromkeys("ABCDE", 0)
    for order in itertools.permutations("ABCDE"):
        left = dict(counts)
        for step, name in enumerate(order, 1):
            bit = 1 << "ABCDE".index(name)
            gone = {m: c for m, c in left.items() if m & bit}
            left = {m: c for m, c in left.items() if not m & bit}
            total[name] += sum(c[0] for c in gone.values())
            earlier = sum(c[0] for m, c in counts.items() if m & bit) - sum(c[0] for c in gone.values())
            expected = (sum(c[0] for c in left.values()), *(sum(c[k] for c in gone.values()) for k in (0, 1, 2)))
            got = rows["".join(order), step]
            assert (got[0], got[1], got[4], got[5]) == expected and got[2] == earlier and got[3] == counts.get(bit, (0,))[0]
    assert len(rows) == 600 and all(r[6] == total[order[step - 1]] for (order, step), r in rows.items())
    # a part whose documents pass everything has one zero leaf, and one node of zeros a variable
    assert len(filter_audit.Diagram("ABCDE", {0: (5, 0, 0)}, 3).nodes) == 2 + 5 + 4


def test_filter_audit_against_its_sql(spark, docs):
    words = "the of THE a$b ring RING x\x1fy é ß".split(" ")
    draw = random.Random(2)
    texts = [" ".join(draw.choices(words, k=draw.choice([0, 5, 199, 200, 201, 400]))) for _ in range(80)] + [" ".join(f"w{k}" for k in range(n)) for n in (199, 200, 300)] * 3 + ["\t\n \x0b" + "a b " * 200 + "\r", "A" + "b" * 49, "A" + "b" * 48]
    rows = [(None if i == 5 else i, t, ["s", None, "", "t"][i % 4], 1, 2) for i, t in enumerate(texts * 2)] + [(3, texts[0], "s", 1, 2)] * 3
    more = spark.createDataFrame(rows, "doc_id long, text string, source string, Source int, mask int")
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(0, 160, 3)] + [(6, None, 1), (None, 1, 1), (9, 0, None)], "doc_id long, quality int, toxic int")
    same(filter_audit.filter_audit(more, labels).toPandas(), sql("op12_filter_order_diagrams", documents=given(more, doc_id="long", text="string", source="string").toPandas().astype({"doc_id": "Int64"}), labels=labels.toPandas().astype("Int64")))
    short = small(docs)
    same(filter_audit.filter_audit(short, labels).toPandas(), sql("op12_filter_order_diagrams", documents=short.toPandas().astype({"doc_id": "Int64"}), labels=labels.toPandas().astype("Int64")))


@pytest.mark.parametrize(("low", "high", "bits"), [(-64, 65, 8), (-1, 1, 2), (0, 5, 4), (-(2**27), 2**27, 28)])
def test_bit_planes_are_exact(low, high, bits):
    draw = np.random.default_rng(1)
    v, c = draw.integers(low, high, (300, 64)), draw.integers(low, high, (7, 64))
    planes = bit_planes.packed(v, bits)
    assert (bit_planes.unpacked(planes) == v).all()
    at, far = bit_planes.nearest(planes, bit_planes.packed(c, bits))
    slow = ((v[:, None].astype(object) - c[None]) ** 2).sum(2)
    assert (slow.argmin(1) == at).all() and (slow.min(1) == far).all()
    counts, sums = bit_planes.sums_by(planes, at, 7)
    assert all(counts[k] == (at == k).sum() and (sums[k] == v[at == k].sum(0)).all() for k in range(7))


def slow_clusters(vectors, k=16, rounds=3):
    ints = {i: [int(np.floor(64 * float(x))) for x in v] for i, v in vectors.items()}
    centroids = [ints[i] for i in sorted(ints, key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for r in range(rounds + 1):
        at = {i: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c)) for i, v in ints.items()}
        if r < rounds:
            for c in range(len(centroids)):
                if own := [ints[i] for i in ints if at[i] == c]:
                    centroids[c] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    rows = {i: (at[i], far(ints[i], centroids[at[i]])) for i in ints}
    return rows, [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]


@pytest.mark.parametrize("n", [5, 400])
def test_clusters_against_a_slow_version_and_sql(spark, n):
    draw = np.random.default_rng(n)
    middles = draw.normal(0, 0.2, (9, 64))
    vectors = {i: (middles[i % 9] + draw.normal(0, 0.05, 64)).astype(np.float32).tolist() for i in range(n)}
    vectors[1] = vectors[2]  # ties
    bad = [(900, None), (901, [0.5] * 63), (902, [0.5] * 65), (903, [0.5] * 63 + [None]), (904, [0.5] * 63 + [float("nan")]), (905, [0.5] * 63 + [float("inf")]), (906, [])]
    rows = [(i, v, 1, "c") for i, v in [*vectors.items(), *bad]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, Cluster string").repartition(3)
    found = bit_planes.clustered(table).toPandas()
    expected, digests = slow_clusters(vectors)
    assert {r.vec_id: (r.cluster, r.distance) for r in found.itertuples()} == expected
    assert all(r.centroid_sha256 == digests[r.cluster] for r in found.itertuples())
    by = found.groupby("cluster").distance.sum()
    assert (found.cluster_inertia == found.cluster.map(by)).all() and set(found.inertia) == {found.distance.sum()}
    frame = pd.DataFrame({"vec_id": list(vectors), "embedding": list(vectors.values())})
    same(found, sql("op13_bit_plane_clusters", embeddings=frame))


def test_clusters_of_awkward_rows(spark):
    """Ids that are null or repeated, and integers that no long distance could hold."""
    rows = [(None, [1.0] * 64), (3, [0.5] * 64), (3, [0.25] * 64), (3, [0.5] * 64), (4, [-1e300] * 64), (5, [3e6] * 64)]
    found = bit_planes.clustered(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    assert len(found) == 4 and set(found.vec_id.dropna()) == {3} and found.cluster_inertia.notna().all()
