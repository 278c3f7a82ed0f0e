"""SimHash fingerprints and exact search for those that differ in a few bits, by vantage-point trees.

Two fingerprints that differ in at most D bits differ in at most D // bands bits of one of `bands` equal
groups of bits: for D = 3 and two groups, in at most one bit of 32. For each group a vantage-point tree splits the
fingerprints by the Hamming distance of that group from a vantage value. A branch that the triangle bound rules
out gets nothing; every fingerprint has one home shard a tree and is also sent to the shards whose boundary it
overlaps. Shards are tasks of their own; within one a further vantage point orders the rows, and only rows whose
distances from it differ by at most D are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.llm.blocks import block_pairs, mixed
from terraops.llm.common import slices, texts_of, written
from terraops.llm.graph import Forest, components

BITS, SEED, SHINGLE, DISTANCE, BANDS = 64, 42, 3, 3, 2
#: Rows aimed at in a shard, most in one block of a shard, fingerprints from which the trees are built: four a shard, from and to.
SHARD, BLOCK, SAMPLE, SAMPLE_MOST = 1_024, 16_384, 16_384, 1_048_576
#: A byte's bits in eight lanes of a 64-bit integer.
_LANES = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.uint64) << (8 * np.arange(8)).astype(np.uint64)).sum(1, dtype=np.uint64)


def shingle_hashes(text: str, size: int = SHINGLE) -> list[int]:
    """XXH64 of each run of size words, repeats included; of all words where there are fewer; none without words."""
    words = text.encode().lower().split()  # bytes: A-Z alone change, and words end at \x20 and \x09-\x0D alone
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist(), strict=False)]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each group of sizes[k] hashes the bits that more than half of them set; 0 for an empty group."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    n = sizes[full]
    parts = -(-n // 255)  # eight bits count up to 255
    first = np.cumsum(parts) - parts
    within = np.arange(parts.sum()) - np.repeat(first, parts)
    begins = np.repeat(np.cumsum(n) - n, parts) + 255 * within
    raw = hashes.view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        lanes = np.add.reduceat(_LANES[raw[:, byte]], begins)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        bits = (2 * counts > n[:, None]).astype(np.uint64) << np.arange(8, dtype=np.uint64)
        out[full] |= bits.sum(1, dtype=np.uint64) << np.uint64(8 * byte)
    return out


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """SimHash of a text's shingles of size words, as a signed integer."""

    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts, out = batch.tolist(), []
            for a, b in slices(texts):
                out.append(fingerprints([shingle_hashes(t, size) for t in texts[a:b]]))
            yield pd.Series(np.concatenate(out) if out else np.empty(0, np.int64))

    return F.pandas_udf(made, "long")(text)


def fingerprints(rows: list[list[int]]) -> np.ndarray:
    """SimHash of each list of shingle hashes, as signed integers."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return majority(np.fromiter((h for r in rows for h in r), np.uint64, int(sizes.sum())), sizes).view(np.int64)


class VantageTree:
    """Shards of 64-bit values by their distances, on the bits of mask, from vantage values."""

    def __init__(self, sample: np.ndarray, mask: int, leaf: int, radius: int, seed: int = 0):
        self.mask, self.radius, self.shards, self.nodes = np.uint64(mask), radius, 0, []  # node: vantage, cut, inside, outside
        draw = np.random.default_rng(seed)
        self.root = self._grow(np.sort(sample) & self.mask, leaf, draw)

    def _grow(self, values: np.ndarray, leaf: int, draw) -> int:
        """Of some vantage values the one whose boundary, at the median distance, the fewest values overlap."""
        best = None
        for vantage in draw.choice(values, 8) if len(values) > leaf else ():
            far = np.bitwise_count(values ^ vantage).astype(np.int64)
            cut = int(np.median(far))
            cut -= bool((far <= cut).all())
            inside, both = far <= cut, int((np.abs(2 * (far - cut) - 1) < 2 * self.radius).sum())
            if inside.any() and (best is None or both < best[0]):
                best = both, vantage, cut, inside
        if best is None:
            self.shards += 1
            return -self.shards
        _, vantage, cut, inside = best
        node = len(self.nodes)
        self.nodes.append(None)
        self.nodes[node] = (vantage, cut, self._grow(values[inside], leaf, draw), self._grow(values[~inside], leaf, draw))
        return node

    def route(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, shard, home): each row's home shard, and the others that may hold a value within the radius."""
        radius = self.radius
        out, todo = [], [(self.root, np.arange(len(values)), np.ones(len(values), bool))]
        while todo:
            node, rows, home = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                out.append((rows, np.full(len(rows), -node - 1), home))
                continue
            vantage, cut, inside, outside = self.nodes[node]
            far = np.bitwise_count((values[rows] & self.mask) ^ vantage).astype(np.int64)
            near, off = far - radius <= cut, far + radius > cut
            todo.append((inside, rows[near], home[near] & (far[near] <= cut)))
            todo.append((outside, rows[off], home[off] & (far[off] > cut)))
        return tuple(np.concatenate(x) if out else np.empty(0, np.int64) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))


def band_masks(bands: int) -> list[int]:
    edges = [BITS * k // bands for k in range(bands + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]


def near_pairs(values: np.ndarray, left: np.ndarray, right: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (a, b), a of left and b of right, whose values differ in at most distance bits, in portions.

    Rows are ordered by their distance from one vantage value; the triangle bound leaves a window of each.
    """
    if not len(left) or not len(right):
        return
    far = np.bitwise_count(values ^ values[left[0]]).astype(np.int64)
    left, right = left[np.argsort(far[left], kind="stable")], right[np.argsort(far[right], kind="stable")]
    for k in range(0, len(left), 256):
        rows = left[k : k + 256]
        a, b = np.searchsorted(far[right], [far[rows[0]] - distance, far[rows[-1]] + distance + 1])
        others = right[a:b]
        i, j = np.nonzero(np.bitwise_count(values[rows][:, None] ^ values[others][None, :]) <= distance)
        yield rows[i], others[j]


def links(values: DataFrame, distance: int = DISTANCE, bands: int = BANDS) -> DataFrame:
    """Edges (a, b) that join all values (value: long, distinct and stored) within distance bits of each other.

    Each shard gives a spanning forest of its links, so its rows are at most as many as the shard's. A
    shard above BLOCK rows is dealt out as pairs of blocks, each a task of its own.
    """
    n = values.count()
    share = max(SAMPLE, min(SAMPLE_MOST, 4 * n // SHARD)) / max(n, 1)
    drawn = values.where(F.pmod(F.xxhash64("value", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))).toPandas().value.to_numpy(np.int64).view(np.uint64)
    leaf = max(1, len(drawn) * SHARD // max(n, 1))
    trees = [VantageTree(drawn, mask, leaf, distance // bands, k) for k, mask in enumerate(band_masks(bands))] if len(drawn) else []

    def routed(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for band, tree in enumerate(trees):
            row, shard, home = tree.route(batch.value.to_numpy(np.int64).view(np.uint64))
            yield row, shard | band << 32, home

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, cell, home in routed(batch):
                yield pd.DataFrame({"cell": cell, "home": home, "n": 1}).groupby(["cell", "home"], as_index=False).n.sum()

    sizes = values.mapInPandas(counted, "cell long, home boolean, n long").groupBy("cell", "home").agg(F.sum("n").alias("n"))
    blocks = {(r["cell"], r["home"]): -(-r["n"] // BLOCK) for r in sizes.where(F.col("n") > BLOCK).collect()}  # a row a large shard

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch.value.to_numpy(np.int64)
            for row, cell, home in routed(batch):
                homes, guests = (np.array([blocks.get((c, at_home), 1) for c in cell.tolist()], np.int64) if blocks else np.ones(len(cell), np.int64) for at_home in (True, False))
                at, guest, low, high, right = block_pairs(mixed(own[row]), home, homes, guests)
                yield pd.DataFrame({"cell": cell[at], "guest": guest, "low": low, "high": high, "value": own[row][at], "right": right})

    def match(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("value", ignore_index=True)
        own, right = rows.value.to_numpy(np.int64), rows.right.to_numpy(bool)
        same = not rows.guest.iloc[0] and rows.low.iloc[0] == rows.high.iloc[0]
        forest = Forest(len(rows))
        for a, b in near_pairs(own.view(np.uint64), np.flatnonzero(~right), np.flatnonzero(same | right), distance):
            met = a != b
            if met.any():
                forest.join_all(a[met], b[met])
        roots = forest.roots()
        moved = roots != np.arange(len(rows))
        return pd.DataFrame({"a": own[moved], "b": own[roots[moved]]})

    dealt = values.mapInPandas(deal, "cell long, guest boolean, low long, high long, value long, right boolean")
    return dealt.groupBy("cell", "guest", "low", "high").applyInPandas(match, "a long, b long")


def grouped(fingerprints: DataFrame, distance: int = DISTANCE, bands: int = BANDS) -> DataFrame:
    """(fp, first_id, root, component_id): each distinct fingerprint of stored rows (doc_id, fp) with its group.

    first_id is the smallest doc_id with it, component_id the smallest of its group; null ids count last.
    """
    values = written(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "values")
    roots = components(links(values.select(F.col("fp").alias("value")), distance, bands))
    named = values.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = written(named, "named")
    return named.join(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "root")


def simhash_components(docs: DataFrame, distance: int = DISTANCE, bands: int = BANDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row.

    fingerprint is in 16 hex digits; component_id is the smallest doc_id that links reach. Texts without words (null,
    empty, blank) have fingerprint zero and are linked like any other. Repeated rows give repeated results;
    a row with a null doc_id is linked, but lends no id unless its whole group has none; other columns are
    ignored; an empty table gives no rows.
    """
    rows = written(texts_of(docs).select("doc_id", fingerprint(F.col("text")).alias("fp")), "fingerprints")
    named = rows.join(grouped(rows, distance, bands).select("fp", "component_id"), "fp")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
