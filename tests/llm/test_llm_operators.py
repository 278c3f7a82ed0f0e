"""Training-data operators against libraries, brute force and round trips, on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terraops.llm import common, media, near_vectors, ngram_scores, packing, piece_codec, pieces, quality, simhash, token_counts, token_file, toxicity
from terraops.llm.graph import components

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(BYTE)
SPIECE = sentencepiece.SentencePieceProcessor(model_file=PIECE)
WORDS = "the of ring small onward, Theatre. notion's 12,5 été 日本 😀 <|endoftext|> a\tb x  y".split(" ")
CLASH = "text2 string, score double, value long, row long, fp long, shard int, label int, cell int, ids string, length int, component_id long, sequence_id long, root long, node long"


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", ",", ".", "\n"]) for _ in range(n))


TEXTS = [prose(1, 60), None, "", " ", "one", "one two", "A b c\x1fd\x85 e", prose(2, 40_000), "x" * 70_000, prose(3, 30), prose(3, 30), prose(1, 60), "ALL CAPS!! " * 40, "aaa aaa aaa " * 30]
IDS = [5, 3, None, 9, 1, 2, 7, 4, 8, 10, 10, 11, -6, 2**40]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", "s", None, None, 0.5, 1, 2, 3, 4, 5, 6, "i", 7, 8, 9, 1, 2) for i, t in zip(IDS, TEXTS, strict=True)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}").repartition(3).cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, int(k % 2), int(k % 3 == 0), 1.0) for k, i in enumerate(IDS)] + [(1, None, None, 0.0), (None, 1, 1, 0.0)], "doc_id long, quality int, toxic int, score double")


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def texts_by_id():
    out = {}
    for i, t in zip(IDS, TEXTS, strict=True):
        out.setdefault(i, []).append(t or "")
    return out


alphabet = st.sampled_from(list(" ,.\n\t\x01\x1c\xa0 _'!aBé1日😀́²▁") + ["  ", "the", " ing", "<|endoftext|>", "'s", "</s>", "<0x41>", "aaa", "   "])
awkward = st.lists(alphabet, max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(awkward, max_size=5))
def test_chunked_ids_are_the_library_s(texts):
    ids, sizes = pieces.encoder(BYTE).encode(texts)
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert token_counts.merger(BYTE).count_texts(texts).tolist() == sizes.tolist()


@settings(max_examples=300, deadline=None)
@given(awkward)
def test_piece_codec_is_the_library_s(text):
    codec, want = piece_codec.codec(PIECE), SPIECE.encode(text)
    assert codec.encode(text) == want and codec.decode([*want, 2]) == SPIECE.decode([*want, 2])
    ids, decoded = codec.digest(text, 2)
    assert ids == " ".join(map(str, [*want, 2])) and decoded == SPIECE.decode(want)


def test_long_texts_are_cut_in_parts(monkeypatch):
    text = prose(4, 3000)
    monkeypatch.setattr(pieces, "PART_CHARS", 50)
    ids, _ = pieces.encoder(BYTE).encode([text])
    assert ids.tolist() == ids_of(text)


def test_memo_stays_bounded(monkeypatch):
    coder = pieces.ChunkEncoder(BYTE)
    coder.memo.room = 50
    for k in range(20):
        ids, _ = coder.encode([text := prose(k, 40)])
        assert ids.tolist() == ids_of(text) and coder.memo.count < 200


def test_token_counts(docs):
    rows = token_counts.token_counts(docs, BYTE).collect()
    want = Counter((i, len((t or "").encode()), len(ids_of(t)), len(ids_of(t)) > 512) for i, t in zip(IDS, TEXTS, strict=True))
    assert Counter(map(tuple, rows)) == want


def test_token_file(spark, docs):
    blocks = token_file.write_token_file(docs, BYTE, 2, 3)
    rows = sorted(map(tuple, token_file.read_token_file(blocks).collect()), key=lambda r: r[1])
    order = sorted(zip(IDS, TEXTS, strict=True), key=lambda r: (r[0] is not None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode(), 42)))
    start, want = 0, []
    for i, text in order:
        ids = [*ids_of(text), 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows == want
    block = token_file.Block(blocks.orderBy("shard", "block").first().body)
    assert block.document(1).tolist() == [*ids_of(order[1][1]), 2]
    with pytest.raises(ValueError):
        token_file.Block(b"nope" + bytes(100))


def test_token_file_deals_hot_ids_over_shards(spark):
    rows = [(7, f"text {k}") for k in range(60)] + [(None, f"none {k}") for k in range(60)] + [(k, "other") for k in range(20)] + [(7, "again")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    blocks = token_file.write_token_file(docs, BYTE, 2, 8)
    assert max(r.n for r in blocks.groupBy("shard").agg(F.sum("n_docs").alias("n")).collect()) < 50
    back = sorted(map(tuple, token_file.read_token_file(blocks).collect()), key=lambda r: r[1])
    assert [r[1] for r in back] == np.cumsum([0, *[r[2] for r in back]])[:-1].tolist()
    assert [r[0] is not None for r in back] == sorted(r[0] is not None for r in back)
    assert [r[0] for r in back if r[0] is not None] == sorted(i for i, _ in rows if i is not None)
    crc = lambda t: zlib.crc32(np.array([*ids_of(t), 2], "<u4").tobytes())
    assert Counter((r[0], r[3]) for r in back) == Counter((i, crc(t)) for i, t in rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**40) | st.integers(0, 9), max_size=700), st.integers(1, 2**20))
def test_elias_fano(values, step):
    values = np.array(sorted(values), np.uint64)
    again, end = token_file.EliasFano.read(memoryview(b"??" + token_file.EliasFano.of(values).to_bytes()), 2)
    assert again.select_range(0, len(values)).tolist() == values.tolist()
    a, b = sorted((step % (len(values) + 1), step // 7 % (len(values) + 1)))
    assert again.select_range(a, b).tolist() == values[a:b].tolist()
    for i in range(0, len(values), max(1, len(values) // 20)):
        assert again.select(i) == values[i]
    with pytest.raises(IndexError):
        again.select(len(values))


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 10_000))
    assert len(token_file.EliasFano.of(ends).to_bytes()) * 8 < 10_000 * (2.2 + math.log2(ends[-1] / 10_000))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_packing_plan(lengths):
    capacity, counts = 30, np.bincount(lengths or [0], minlength=31)
    counts[0] = 0
    runs, n = packing.plan(counts, capacity)
    fill: dict[int, list[tuple[int, int]]] = {}
    seen = Counter()
    for length, first, pieces_, sequence, each, offset in runs.tolist():
        assert seen[length] == first
        seen[length] += pieces_
        for k in range(pieces_):
            fill.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
    assert {k: v for k, v in seen.items() if v} == {k: int(c) for k, c in enumerate(counts) if c} and len(fill) == n
    for items in fill.values():
        items.sort()
        assert [o for o, _ in items] == np.cumsum([0, *[s for _, s in items]])[:-1].tolist() and sum(s for _, s in items) <= capacity
        assert sum(3 * s > capacity for _, s in items) <= 2
    bins: list[int] = []
    for size in sorted(lengths, reverse=True):  # best fit decreasing
        best = min((b for b in range(len(bins)) if bins[b] >= size), key=lambda b: bins[b], default=None)
        if best is None:
            bins.append(capacity)
            best = -1
        bins[best] -= size
    assert n <= len(bins) + 1


def test_packed_rows(docs):
    rows = packing.packed(docs, BYTE, 2, 64).toPandas()
    want = Counter()
    for i, text in zip(IDS, TEXTS, strict=True):
        ids = np.array([*ids_of(text), 2], "<u4")
        points = [*packing.cut_points(len(ids), 64), len(ids)]
        want.update((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(points, points[1:], strict=False)))
    got = Counter((None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows.itertuples())
    assert got == want
    for _, group in rows.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group.offset.tolist() == (group.length.cumsum() - group.length).tolist() and group.length.sum() <= 64
    whole = packing.sequences(docs, BYTE, 2, 64).toPandas()
    assert whole.input_ids.map(len).sum() == rows.length.sum() and (whole.input_ids.map(len) == whole.lengths.map(sum)).all()


def test_piece_rows(docs):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    rows = Counter(map(tuple, piece_codec.piece_digests(docs, PIECE, 2).collect()))
    want = Counter()
    for i, text in zip(IDS, TEXTS, strict=True):
        ids = [*SPIECE.encode(text or ""), 2]
        want[(i, len(ids), sha(" ".join(map(str, ids))), sha(SPIECE.decode(ids)))] += 1
    assert rows == want
    back = piece_codec.piece_texts(piece_codec.piece_ids(docs, PIECE, 2), PIECE)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((i, t or "") for i, t in zip(IDS, TEXTS, strict=True))


def slow_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words)] if 0 < len(words) < 3 else [" ".join(words[k : k + 3]) for k in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(values, linked):
    parent = list(range(len(values)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(values))]


def test_simhash(docs):
    values = [slow_fingerprint(t) for t in TEXTS]
    root = groups_of(values, lambda a, b: bin(a ^ b).count("1") <= 3)
    least = {r: min((i for i, q in zip(IDS, root, strict=True) if q == r and i is not None), default=None) for r in root}
    want = Counter((i, f"{v:016x}", least[r]) for i, v, r in zip(IDS, values, root, strict=True))
    assert Counter(map(tuple, simhash.simhash_components(docs).collect())) == want


@pytest.mark.parametrize(("bands", "block"), [(1, 16_384), (simhash.BANDS, simhash.BLOCK), (4, 16_384), (4, 40), (2, 20)])
def test_vantage_trees_lose_no_link(spark, monkeypatch, bands, block):
    draw = np.random.default_rng(bands)
    base = draw.integers(0, 2**63, 60, dtype=np.int64)
    values = list({int(v) ^ sum(1 << int(b) for b in draw.integers(0, 62, draw.integers(0, 4))) for v in base.repeat(6)})
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SHARD", 24)
    edges = simhash.links(spark.createDataFrame([(v,) for v in values], "value long"), 3, bands)
    found = {r.node: r.root for r in components(edges).collect()}
    root = groups_of(values, lambda a, b: bin(a ^ b).count("1") <= 3)
    least = {r: min(v for v, q in zip(values, root, strict=True) if q == r) for r in root}
    assert {v: found.get(v, v) for v in values} == {v: least[r] for v, r in zip(values, root, strict=True)}


def test_trees_prune_and_overlap():
    """At the registered settings a fingerprint meets few of the shards, and more than its home in each tree."""
    values = np.random.default_rng(2).integers(0, 2**63, 60_000).astype(np.uint64)
    tree = simhash.VantageTree(values, simhash.band_masks(simhash.BANDS)[0], simhash.SHARD, simhash.DISTANCE // simhash.BANDS)
    row, shard, home = tree.route(values)
    assert home.sum() == len(values) and 2 * len(values) < len(row) < tree.shards * len(values) / 4
    for bit in (0, 7, 31):  # every neighbour within the radius is routed to the home shard of each value
        other = tree.route(values[:500] ^ np.uint64(1 << bit))
        met = set(zip(other[0].tolist(), other[1].tolist(), strict=True))
        assert all((r, s) in met for r, s, h in zip(row.tolist(), shard.tolist(), home.tolist(), strict=True) if h and r < 500)


@pytest.mark.parametrize(("hot", "keys"), [(common.HOT, common.HOT_KEYS), (3, 10**9), (5, 20)])
def test_components_with_hubs(spark, monkeypatch, hot, keys):
    """Stars about the smallest and the greatest node, nodes of few edges, a hub of one node more than a hot key has."""
    monkeypatch.setattr(common, "HOT", hot)
    monkeypatch.setattr(common, "HOT_KEYS", keys)
    edges = [(1, k) for k in range(2, 40)] + [(k, 99) for k in range(30, 60)] + [(200 + k, 300) for k in range(hot + 1 if hot < 9 else 4)] + [(400, 401), (402, 401)]
    want = {k: 1 for k in (*range(2, 60), 99)} | {k: 200 for a, b in edges for k in (a, b) if 200 < k <= 300} | {401: 400, 402: 400}
    assert {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == want


@pytest.mark.parametrize(("hot", "keys"), [(10, 10**9), (10, 4), (common.HOT, common.HOT_KEYS)])
def test_hot_keys_meet_their_figures_by_broadcast(spark, monkeypatch, hot, keys):
    monkeypatch.setattr(common, "HOT", hot)
    monkeypatch.setattr(common, "HOT_KEYS", keys)
    rows = spark.createDataFrame([(k, j) for k, n in enumerate([1, 10, 11, 40]) for j in range(n)] + [(None, 0)], "k long, v long")
    figures = rows.groupBy("k").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
    met = common.with_figures(rows, figures, "k", 63)
    assert Counter(map(tuple, met.collect())) == Counter((k, j, n * (n - 1) // 2, n) for k, n in enumerate([1, 10, 11, 40]) for j in range(n))


def test_components_of_a_chain(spark):
    n = 60
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(5, 5), (3, 2), (100, 101)], "a long, b long")
    assert {r.node: r.root for r in components(edges).collect()} == {k: 0 for k in range(1, n + 1)} | {101: 100}
    assert components(edges.limit(0)).count() == 0


@pytest.mark.parametrize(("cell", "block", "local"), [(4_096, 8_192, 128), (20, 8_192, 4), (12, 7, 3), (5, 3, 1)])
def test_near_vectors(spark, monkeypatch, cell, block, local):
    draw = np.random.default_rng(cell)
    base = draw.normal(size=(40, 8))
    rows = [(k, [float(x) for x in base[k % 40] + draw.normal(size=8) * 0.1 * (k % 3)], int(k % 2)) for k in range(160)]
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (201, rows[0][1], 0), (None, rows[0][1], 0), (202, rows[0][1], None), (203, [float(2 * x) for x in rows[0][1]], 0)]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 8, 1), (303, [float("nan")] + [1.0] * 7, 1), (304, [None] + [1.0] * 7, 1), (305, [float("inf")] * 8, 1), (306, [1.0] * 3, 1), (307, [1.0] * 3, 1)]
    for name, value in {"CELL": cell, "BLOCK": block, "LOCAL": local}.items():
        monkeypatch.setattr(near_vectors, name, value)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, node long, weight long")
    got = Counter(map(tuple, near_vectors.near_vectors(df).collect()))

    def linked(a, b):
        if a[2] is None or a[2] != b[2] or not a[1] or not b[1] or len(a[1]) != len(b[1]):
            return False
        u, v = (np.array(x, float) for x in (a[1], b[1]))
        if not (np.isfinite(u).all() and np.isfinite(v).all() and u.any() and v.any()):
            return False
        return u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.98

    root = groups_of(rows, linked)
    least = {r: min((x[0] for x, q in zip(rows, root, strict=True) if q == r and x[0] is not None), default=None) for r in root}
    want = Counter()
    for k, (row, r) in enumerate(zip(rows, root, strict=True)):
        n = sum(linked(row, other) for j, other in enumerate(rows) if j != k)
        want[(row[0], n, least[r], row[0] == least[r])] += 1
    assert got == want


def test_bounds_spare_products_and_lose_no_pair():
    """At the default constants, on vectors that fill 64 dimensions evenly: the case with the least to prune."""
    draw = np.random.default_rng(4)
    base = draw.normal(size=(4_000, 64))
    units = near_vectors._unit(np.concatenate([base, base[:300] + draw.normal(size=(300, 64)) * 0.15]))
    products: list[int] = []
    got = {(int(a), int(b)) for i, j in near_vectors.near_pairs(units, units, 0.98, products) for a, b in zip(i, j, strict=True)}
    want = set(zip(*map(np.ndarray.tolist, np.nonzero(units @ units.T >= 0.98)), strict=True))
    assert got == want and len(want) > len(units) + 200
    assert sum(products) < 0.6 * len(units) ** 2


def slow_filter(rows, k, kind):
    out = [kind]
    for x in range(64):
        a, b, c = (int(rows[k, x - 1]) if x else 0), (int(rows[k - 1, x]) if k else 0), (int(rows[k - 1, x - 1]) if k and x else 0)
        p = a + b - c
        near = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
        out.append((int(rows[k, x]) - (0, a, b, (a + b) // 2, near)[kind]) % 256)
    return out


def slow_png(payload):
    rows = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    lines = b""
    for k in range(len(rows)):
        every = [slow_filter(rows, k, kind) for kind in range(5)]
        lines += bytes(min(every, key=lambda line: sum(min(v, 256 - v) for v in line[1:])))
    chunk = lambda kind, data: len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", (64).to_bytes(4, "big") + len(rows).to_bytes(4, "big") + bytes([8, 0, 0, 0, 0])) + chunk(b"IDAT", zlib.compress(lines, 6)) + chunk(b"IEND", b"")


def slow_hash(payload):
    rows = [list(payload[k : k + 64]) for k in range(0, len(payload), 64)]
    height = len(rows)
    small = []
    for k in range(32):
        a, b = k * height // 32, max((k + 1) * height // 32, k * height // 32 + 1)
        small.append([sum((r[2 * c] + r[2 * c + 1]) / 2 for r in rows[a:b]) / (b - a) for c in range(32)])
    cos = [[math.cos(math.pi / 32 * (x + 0.5) * u) for x in range(32)] for u in range(8)]
    low = [round(sum(cos[u][i] * small[i][j] * cos[v][j] for i in range(32) for j in range(32)), 6) for u in range(8) for v in range(8)]
    middle = sorted(low[1:])[31]
    return f"{int(''.join('0' if k == 0 else str(int(x > middle)) for k, x in enumerate(low)), 2):016x}"


def test_png_round_trip_with_every_filter():
    draw = np.random.default_rng(1)
    rows = draw.integers(0, 256, (40, 64), dtype=np.uint8)
    assert (media.read_png(media.write_png(rows.tobytes())) == rows).all()
    lines = np.array([slow_filter(rows, k, draw.integers(0, 5)) for k in range(40)], np.uint8)
    assert (media.unfilter(lines) == rows).all()
    two = np.concatenate([lines, np.array([slow_filter(rows, k, 4) for k in range(40)], np.uint8)])
    assert (media.unfilter(two, np.array([0, 40])) == np.concatenate([rows, rows])).all()
    texts = [media.padded(t.encode()) for t in (prose(0, 0), prose(1, 1), prose(2, 30), prose(3, 300), ("a row of 64 letters, which comes again and again in this one text"[:64] * 9))]
    assert media.write_pngs(texts) == list(map(slow_png, texts))
    kinds = {k for t in texts for k in media.png_lines(media.write_png(t))[:, 0].tolist()}
    assert len(kinds) == 5  # reading these undoes every filter


def test_damaged_images_are_rows(spark):
    good = media.write_png(media.padded(prose(7, 80).encode()))
    draw = random.Random(2)
    images = [(k, bytearray(good)) for k in range(300)]
    for _, data in images[1:]:
        data[draw.randrange(len(data))] ^= 1 << draw.randrange(8)
    images += [(300, bytearray(good[:-5])), (301, bytearray()), (302, bytearray(b"x" * 50))]
    rows = media.media_features(spark.createDataFrame([(k, bytes(x)) for k, x in images], "doc_id long, media binary")).collect()
    assert [r.doc_id for r in rows if r.error is None] == [0]
    assert all(r.payload_sha256 is None and r.media_bytes is not None for r in rows if r.error)


def test_media_rows(docs, spark):
    rows = media.text_media(docs).collect()
    want = Counter()
    for i, text in zip(IDS, TEXTS, strict=True):
        raw = (text or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        stored = slow_png(payload) if len(raw) < 5_000 else media.write_png(payload)
        want[(i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), slow_hash(payload), None)] += 1
    assert Counter(map(tuple, rows)) == want
    nothing = media.media_features(spark.createDataFrame([(1, None)], "doc_id long, media binary")).first()
    assert nothing.payload_bytes is None and nothing.feature is None


def test_ngram_scores(docs):
    texts, mark = [ids_of(t) for t in TEXTS], LIBRARY.get_vocab_size()
    grams = [list(zip([mark, *t[:-1]], t, strict=True)) if t else [] for t in texts]
    c, u = Counter(g for x in grams for g in x), Counter(i for t in texts for i in t)
    first = Counter()
    for (a, _), n in c.items():
        first[a] += n
    want = Counter()
    for i, t, g in zip(IDS, texts, grams, strict=True):
        own, fst, unit, total = Counter(g), Counter(a for a, _ in g), Counter(t), 0.0
        for a, b in g:
            rest = c[a, b] - own[a, b]
            total += math.log(rest / (first[a] - fst[a])) if rest else math.log(0.4 * max(u[b] - unit[b], 0.5) / sum(u.values()))
        want[(i, len(t), round(total, 5))] += 1
    got = Counter((r.doc_id, r.n_tokens, round(r.log_score, 5)) for r in ngram_scores.ngram_scores(docs, BYTE).collect())
    assert got == want


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_levenshtein_trie():
    terms = ["idiot", "pathetic", "fool", "worthless"]
    trie, exact = toxicity.LevenshteinTrie(terms), toxicity.LevenshteinTrie(terms, errors=False)
    draw = random.Random(3)
    words = ["idiot", "idi0t", "idiots", "diot", "pathetc", "fool", "foul", "wrthles", "", "xyz"]
    for _ in range(3000):
        word = list(draw.choice(terms))
        for _ in range(draw.randint(0, 3)):
            k = draw.randrange(len(word) + 1)
            word[k : k + draw.randint(0, 1)] = draw.choice(["", "a", "o", "t", "é"])
        words.append("".join(word))
    for word in words:
        near = [d for t in terms if (d := edits(word, t)) <= toxicity.errors_allowed(t)]
        assert trie.distance(word) == min(near, default=-1), word
        assert exact.distance(word) == (0 if word in terms else -1), word


def slow_features(text, terms, spared):
    """Hits, contexts and windows by plain loops over all words and terms."""
    words = text.lower().split()
    bare = [w.strip(toxicity._EDGES) for w in words]
    hits = {}
    for k, w in enumerate(bare):
        near = [d for t in terms if (d := edits(w, t)) <= toxicity.errors_allowed(t)]
        if w and near and w not in spared:
            hits[k] = min(near)
    n, quoted, directed, plain = [0, 0, 0], 0, 0.0, []
    for k, far in hits.items():
        opener = k if words[k][0] in toxicity.OPENING else None
        for j in range(k - 1, max(-1, k - 1 - toxicity.CONTEXT), -1):
            if opener is not None or words[j][-1] in toxicity.CLOSING:
                break
            opener = j if words[j][0] in toxicity.OPENING else None
        closes = any(words[j].rstrip(".,;:!?")[-1:] and words[j].rstrip(".,;:!?")[-1] in toxicity.CLOSING for j in range(k, min(len(words), k + toxicity.CONTEXT + 1)))
        if opener is not None and closes or any(w in toxicity.REPORTED for w in bare[max(0, k - 4) : k]):
            quoted += 1
            continue
        n[far] += 1
        plain.append((k, 0.5**far))
        directed += 0.5**far * any(w in toxicity.DIRECTED for w in bare[max(0, k - 4) : k] + bare[k + 1 : k + 4])
    dense = max((sum(x for j, x in plain if k - toxicity.WINDOW < j <= k) for k, _ in plain), default=0)
    return [1, *map(math.log1p, (*n, quoted, 100 * sum(x for _, x in plain) / max(len(words), 20), dense, directed))]


def test_features_are_those_of_plain_loops():
    terms, spared = ["idiot", "moron", "worthless", "scum"], ["idiom", "worth"]
    parts = ["idiot", "Idoit,", "moron!", "morons", "idiom", "wrthless", "worthles's", "scum", "scums", '"idiot', 'idiot"', "he", "said", "you", "are", "«moron»", "a", '"so', 'it"', "goes.", "...", "words"]
    draw = random.Random(5)
    texts = ["", " ", "idiot"] + [" ".join(draw.choice(parts) for _ in range(draw.choice([3, 20, 200]))) for _ in range(300)]
    got = toxicity.Finder(terms, spared).features(texts)
    assert np.allclose(got, [slow_features(t, terms, spared) for t in texts])


def test_quotation_is_told_from_abuse():
    finder = toxicity.Finder(toxicity.TERMS)
    at = {name: k for k, name in enumerate(toxicity.FEATURES)}
    plain, quoted, reported, wrong = finder.features(["you are an idiot", 'the sign read "an idiot lives here" in red', "he said idiot twice", "what an idoit and idiiot"])
    assert plain[at["exact"]] > 0 and plain[at["directed"]] > 0 and plain[at["quoted"]] == 0
    assert quoted[at["exact"]] == 0 and quoted[at["quoted"]] > 0 and reported[at["quoted"]] > 0
    assert wrong[at["exact"]] == 0 and wrong[at["one error"]] + wrong[at["two errors"]] > 0


def abuse(seed, n):
    """(doc_id, text, toxic): abuse, half of it misspelled; words near a term, and quotations of abuse, are clean."""
    draw = random.Random(seed)
    fill = [f"{a}{b}{c}" for a in "bdfglmprst" for b in "aeiou" for c in ("lk", "nd", "rst", "mp")]
    out = []
    for k in range(n):
        words = [draw.choice(fill) for _ in range(60)]
        kind = k % 6
        for _ in range(3 if kind < 5 else 0):
            term = draw.choice(["worthless", "pathetic", "disgusting", "imbecile", "parasite", "repulsive"])
            cut = draw.randrange(1, len(term) - 1)
            bad = term[:cut] + draw.choice("xyz") + term[cut + draw.randint(0, 1) :]
            what = {0: term, 1: bad, 2: bad, 3: f'"{term} {draw.choice(fill)}"', 4: {"w": "worthiness", "p": "pathetics", "d": "digesting"}.get(term[0], "parasites")}[kind]
            words.insert(draw.randrange(len(words)), what)
        out.append((k, " ".join(words), int(kind < 3)))
    return out


def test_errors_and_contexts_raise_held_out_results(spark):
    rows = abuse(11, 900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(2)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]

    def right(errors, contexts):
        model = toxicity.fit_toxicity(docs, labels, errors, contexts)
        finder, weights = model.finder(), np.array(model.weights)
        assert (weights[toxicity.EVIDENCE] >= 0).all()
        score = 1 / (1 + np.exp(-finder.features([r[1] for r in held]) @ weights))
        return np.mean((score >= 0.5) == [r[2] for r in held])

    full = right(True, True)
    assert full > 0.95 and right(False, True) < full - 0.1 and right(True, False) < full - 0.05


def test_classifiers_on_awkward_rows(spark, docs, labels):
    for result in (toxicity.toxicity(docs, docs, labels), quality.quality(docs, docs, labels), toxicity.toxicity(docs, docs, labels.limit(0)), quality.quality(docs, docs, labels.limit(0))):
        rows = result.collect()
        assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, IDS))
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    held = {r.doc_id: r.held_out for r in toxicity.toxicity(docs, docs, labels).collect()}
    assert held == {i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in IDS}
    assert quality.of_quality(docs, docs, labels).columns == docs.columns == toxicity.without_toxic(docs, docs, labels).columns


def test_passages_do_not_depend_on_their_neighbours():
    texts = [(t or "").encode() for t in TEXTS]
    x, sizes = quality.passages(texts)
    alone = [quality.passages([t])[0] for t in texts]
    assert sizes.tolist() == [len(a) for a in alone] and np.allclose(x, np.concatenate(alone), atol=1e-6)


def test_attention_gradient():
    draw = np.random.default_rng(0)
    x, sizes, y = draw.normal(size=(12, quality.FEATURES)).astype(np.float32), np.array([3, 1, 8]), np.array([1.0, 0.0, 1.0])
    starts, of = np.cumsum(sizes) - sizes, np.repeat(np.arange(3), sizes)
    shapes = {"enc": (quality.FEATURES, quality.HIDDEN), "enc0": (quality.HIDDEN,), "tan": (quality.HIDDEN, quality.GATE), "gate": (quality.HIDDEN, quality.GATE), "att": (quality.GATE,), "out": (quality.HIDDEN,), "out0": (1,)}
    model = quality.AttentionModel(0, 1, {k: draw.normal(0, 0.3, s) for k, s in shapes.items()})
    grad = model._gradient(x, starts, of, y)

    def loss():
        p = model.score(x, sizes)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, index in (("enc", (3, 2)), ("enc0", (1,)), ("tan", (2, 1)), ("gate", (0, 3)), ("att", (2,)), ("out", (5,)), ("out0", (0,))):
        w = model.w[name]
        w[index] += 1e-4
        up = loss()
        w[index] -= 2e-4
        down = loss()
        w[index] += 1e-4
        assert grad[name][index] == pytest.approx((up - down) / 2e-4, abs=2e-4)


def test_long_texts_are_pooled_by_portions(monkeypatch):
    draw = np.random.default_rng(1)
    w = {k: draw.normal(0, 0.5, s) for k, s in {"enc": (quality.FEATURES, quality.HIDDEN), "enc0": (quality.HIDDEN,), "tan": (quality.HIDDEN, quality.GATE), "gate": (quality.HIDDEN, quality.GATE), "att": (quality.GATE,), "out": (quality.HIDDEN,), "out0": (1,)}.items()}
    model = quality.AttentionModel(np.zeros(quality.FEATURES), np.ones(quality.FEATURES), w)
    monkeypatch.setattr(quality, "PORTION", 1024)
    text = prose(8, 900).encode()
    x, sizes = quality.passages(quality.portions(text))
    assert len(sizes) > 3
    whole = model.score(x, np.array([len(x)]))
    assert model.score(x, sizes, np.zeros(len(sizes), int)) == pytest.approx(whole)
    assert b"".join(quality.portions(text)) == text and quality.portions(b"") == [b""]


def test_attention_finds_the_passage_that_decides():
    """Bags of 20 alike passages, of which one decides: uniform weights in place of the learned ones lose the labels."""
    draw = np.random.default_rng(6)
    n, size = 600, 20
    x = draw.normal(0, 1, (n * size, quality.FEATURES)).astype(np.float32) * 0.3
    y = (np.arange(n) % 2).astype(float)
    at = np.arange(n) * size + draw.integers(0, size, n)
    x[:, 1] += draw.normal(0, 1, n * size)  # what the others say, at random
    x[:, 2:] *= 0.1
    x[at, 0], x[at, 1] = 6, np.where(y == 1, 4, -4)
    model = quality.AttentionModel.fit(x[: 500 * size], np.full(500, size), y[:500])
    test, want = x[500 * size :], y[500:]
    learned = np.mean((model.score(test, np.full(100, size)) > 0.5) == want)
    flat = quality.AttentionModel(model.mean, model.spread, model.w | {"att": np.zeros_like(model.w["att"])})
    uniform = np.mean((flat.score(test, np.full(100, size)) > 0.5) == want)
    assert learned > 0.95 and learned > uniform + 0.2


EMPTY = {
    "token_counts": lambda d, lab: token_counts.token_counts(d, BYTE),
    "token_file": lambda d, lab: token_file.read_token_file(token_file.write_token_file(d, BYTE, 2)),
    "packed": lambda d, lab: packing.packed(d, BYTE, 2),
    "pieces": lambda d, lab: piece_codec.piece_digests(d, PIECE, 2),
    "simhash": lambda d, lab: simhash.simhash_components(d),
    "media": lambda d, lab: media.text_media(d),
    "ngram_scores": lambda d, lab: ngram_scores.ngram_scores(d, BYTE),
    "toxicity": lambda d, lab: toxicity.toxicity(d, d, lab),
    "quality": lambda d, lab: quality.quality(d, d, lab),
    "vectors": lambda d, lab: near_vectors.near_vectors(d.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding"), "label")),
}


@pytest.fixture(scope="session")
def twins(spark, docs, labels):
    """The rows with columns whose names differ from those that are read in case alone, and a column of nulls."""
    named = lambda df, *more: df.select(*df.columns, *[F.lit(k).alias(c) for k, c in enumerate(more)])
    return named(docs, "DOC_ID", "Text", "LABEL"), named(labels, "Doc_Id", "QUALITY", "Toxic")


@pytest.mark.parametrize("name", list(EMPTY))
def test_names_that_differ_in_case(docs, labels, twins, name):
    if name == "vectors":
        own, other = (d.select(*[F.col(c) for c in ()], F.lit(1).alias("vec_id"), F.array(F.lit(1.0)).alias("embedding"), F.lit(3).alias("label"), *x) for d, x in ((docs, ()), (docs, (F.lit(1).alias("VEC_ID"), F.lit(2).alias("Label")))))
        assert near_vectors.near_vectors(own).collect() == near_vectors.near_vectors(other).collect()
        return
    rows = lambda df: Counter(map(str, df.collect()))
    assert rows(EMPTY[name](twins[0], twins[1])) == rows(EMPTY[name](docs, labels))


@pytest.mark.parametrize("name", list(EMPTY))
def test_empty_table(docs, labels, name):
    assert EMPTY[name](docs.limit(0), labels).count() == 0
