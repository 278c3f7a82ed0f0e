"""Clustering about centroids, with exact distances from bit planes.

A vector's 64 integers are held as planes: plane p packs bit p of every component (two's complement) into one 64-bit
word, and weighs 2^p, the last -2^p. A product of two vectors is the sum over pairs of planes of their weights times the
bits that both have, so one AND and one popcount take 64 products of bits, and all is exact integer arithmetic.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import given, written

#: Components of a vector, one bit each in a plane.
WIDTH = 64
#: Integers have at most so many bits, sign included; so a squared distance is below 2^63.
MOST_BITS = 28
#: Vectors that a task works on at once.
ROWS = 16_384


def packed(values: np.ndarray, bits: int) -> np.ndarray:
    """Planes (rows x bits, uint64) of integers (rows x 64) that bits hold in two's complement."""
    out = np.empty((len(values), bits), np.uint64)
    for p in range(bits):
        out[:, p] = np.packbits((values >> p & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def weights(bits: int) -> np.ndarray:
    out = np.int64(1) << np.arange(bits, dtype=np.int64)
    out[-1] = -out[-1]
    return out


def unpacked(planes: np.ndarray) -> np.ndarray:
    """The integers (rows x 64) of planes."""
    rows, bits = planes.shape
    each = np.unpackbits(np.ascontiguousarray(planes.astype("<u8")).view(np.uint8).reshape(rows, bits, 8), axis=2, bitorder="little").astype(np.int64)
    return (each * weights(bits)[None, :, None]).sum(1)


def products(planes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Dot products (rows x others) of vectors held as planes."""
    w = weights(planes.shape[1])
    out = np.zeros((len(planes), len(others)), np.int64)
    for q in range(len(w)):
        for p in range(len(w)):
            out += w[p] * w[q] * np.bitwise_count(planes[:, p, None] & others[None, :, q]).astype(np.int64)
    return out


def squares(planes: np.ndarray) -> np.ndarray:
    """Each vector's product with itself."""
    w = weights(planes.shape[1])
    out = np.zeros(len(planes), np.int64)
    for p in range(len(w)):
        for q in range(p, len(w)):
            out += (1 + (p != q)) * w[p] * w[q] * np.bitwise_count(planes[:, p] & planes[:, q]).astype(np.int64)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the first of equally near ones, and the squared distance from it."""
    far = squares(planes)[:, None] - 2 * products(planes, centroids) + squares(centroids)[None, :]
    at = far.argmin(1)
    return at, far[np.arange(len(far)), at]


def sums_by(planes: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in each of k clusters, and the sums of their components (k x 64), plane by plane."""
    bits = planes.shape[1]
    sums = np.zeros((k, WIDTH), np.int64)
    w = weights(bits)
    order = np.argsort(at, kind="stable")
    ends = np.searchsorted(at[order], np.arange(k + 1))
    for c, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        own = np.ascontiguousarray(planes[order[a:b]].astype("<u8"))
        each = np.unpackbits(own.view(np.uint8).reshape(b - a, bits, 8), axis=2, bitorder="little").sum(0, dtype=np.int64)
        sums[c] = (each * w[:, None]).sum(0)
    return np.diff(ends), sums


def _matrix(planes: pd.Series) -> np.ndarray:
    return np.stack(planes.to_numpy()).astype(np.int64).view(np.uint64)


def _moved(stored: DataFrame, centroids: np.ndarray, bits: int) -> np.ndarray:
    """The centroids after one round: floors of the means of their vectors; one without vectors stays."""
    held = packed(centroids, bits)
    k = len(centroids)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, WIDTH), np.int64)
        for batch in batches:
            for a in range(0, len(batch), ROWS):
                planes = _matrix(batch.planes.iloc[a : a + ROWS])
                n, s = sums_by(planes, nearest(planes, held)[0], k)
                counts, sums = counts + n, sums + s
        met = np.flatnonzero(counts)
        yield pd.DataFrame({"cluster": np.repeat(met, WIDTH), "at": np.tile(np.arange(WIDTH), len(met)), "n": np.repeat(counts[met], WIDTH), "total": sums[met].ravel()})

    parts = stored.select("planes").mapInPandas(partial, "cluster int, at int, n long, total long")
    out = centroids.copy()
    for r in parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # k x 64 rows
        out[r["cluster"], r["at"]] = r["total"] // r["n"]
    return out


def clustered(vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, seed: str = "1") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of rows (vec_id, embedding).

    Vectors of exactly 64 components, none null or not finite, are clustered; a component x becomes the integer
    floor(scale * x). Other vectors give no row, nor do those with an integer outside -2^27 .. 2^27 - 1, whose
    squared distances a long can't hold. Centroids start as the k vectors of the least sha256 of seed:vec_id; a
    vector without an id is clustered but starts none; of an id's repeated rows each can start one, in the order of their planes. With
    fewer than k vectors there are fewer centroids. In each round every vector goes to its nearest centroid (squared
    distance, the smaller number of equally near ones) and centroids become the floors of their vectors' means, or
    stay without any; then the vectors are assigned once more. distance is squared; cluster_inertia and inertia
    are sums of it over the cluster and over all, null beyond a long; centroid_sha256 is of the cluster's centroid, its integers joined
    by commas. Other columns are ignored; an empty table gives no rows. Only k x 64 figures a round come to the driver.
    """
    rows = given(vectors, vec_id="long", embedding="array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce((F.size("embedding") == WIDTH) & finite, F.lit(False)))
    # the smallest and the greatest component tell how many bits are needed
    most = float(1 << (MOST_BITS - 1))
    rows = rows.where(F.forall("embedding", lambda x: (x * scale >= -most) & (x * scale < most)))
    ends = rows.agg(F.min(F.array_min("embedding")).alias("low"), F.max(F.array_max("embedding")).alias("high")).first()
    low, high = (int(np.floor(scale * (v or 0.0))) for v in (ends["low"], ends["high"]))
    bits = max((-low - 1).bit_length() if low < 0 else 1, high.bit_length() if high > 0 else 1) + 1

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), ROWS):
                part = batch.iloc[a : a + ROWS]
                planes = packed(np.floor(np.stack(part.embedding.to_numpy()) * scale).astype(np.int64), bits)
                yield pd.DataFrame({"vec_id": part.vec_id.array, "planes": list(planes.view(np.int64))})

    stored = written(rows.mapInPandas(pack, "vec_id long, planes array<long>"), "planes")
    first = stored.where("vec_id is not null").orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256), "planes").limit(k)
    start = [r["planes"] for r in first.select("planes").collect()]
    if not start:
        return stored.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = unpacked(np.array(start, np.int64).view(np.uint64))
    for _ in range(rounds):
        centroids = _moved(stored, centroids, bits)
    held = packed(centroids, bits)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), ROWS):
                part = batch.iloc[a : a + ROWS]
                at, far = nearest(_matrix(part.planes), held)
                yield pd.DataFrame({"vec_id": part.vec_id.array, "cluster": at, "distance": far})

    found = written(stored.mapInPandas(assign, "vec_id long, cluster int, distance long"), "assigned")
    by_cluster = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"))
    inertia = {r["cluster"]: int(r["inertia"]) for r in by_cluster.collect()}  # k rows
    fits = lambda v: v if v < 1 << 63 else None
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    figures = [(c, fits(v), fits(sum(inertia.values())), digests[c]) for c, v in sorted(inertia.items())]
    known = stored.sparkSession.createDataFrame(figures, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
