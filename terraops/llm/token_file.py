"""Token ids on disk: one concatenated array a block, its document boundaries in Elias-Fano code.

A block is a self-describing byte string: header, Elias-Fano boundaries, Elias-Fano document ids, then all
ids as 16- or 32-bit little-endian integers. Blocks stand in ascending doc_id order in rows of a Parquet
table, whose writer commits them once even if an executor is lost. An offset is found by select on the
upper bits: n values below u take about n * (2 + log2(u / n)) bits, and there is no table of 64-bit offsets.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import slices, texts_of, written
from terraops.llm.pieces import encoder

#: One in so many set bits has its place noted.
SAMPLE = 256
#: Characters of text in a block, about, and documents of it whose offsets are read at a time.
BLOCK_CHARS, READ_DOCS = 2_000_000, 1_024
MAGIC = b"EFT1"
BLOCKS = "shard int, block int, first long, n_docs long, n_ids long, body binary"
READ = "shard int, first long, doc_id long, in_block long, n_tokens long, ids_crc32 long"


class EliasFano:
    """A non-decreasing sequence of integers from 0, with select."""

    def __init__(self, n: int, low_bits: int, high: np.ndarray, low: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.high, self.low, self.samples = n, low_bits, high, low, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        bits[at] = 1
        low = (values[:, None] >> np.arange(low_bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        return cls(n, low_bits, np.packbits(bits, bitorder="little"), np.packbits(low.ravel(), bitorder="little"), at[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return struct.pack("<QIQQ", self.n, self.low_bits, len(self.high), len(self.low)) + self.samples.tobytes() + self.high.tobytes() + self.low.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, high, low = struct.unpack_from("<QIQQ", data, at)
        at += struct.calcsize("<QIQQ")
        n_samples = -(-n // SAMPLE)
        samples = np.frombuffer(data, "<u4", n_samples, at)
        at += 4 * n_samples
        return cls(n, low_bits, np.frombuffer(data, np.uint8, high, at), np.frombuffer(data, np.uint8, low, at + high), samples), at + high + low

    def _lows(self, begin: int, end: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(end - begin, np.uint64)
        first = begin * self.low_bits
        bits = np.unpackbits(self.low[first // 8 : -(-end * self.low_bits // 8)], bitorder="little")
        bits = bits[first % 8 : first % 8 + (end - begin) * self.low_bits].reshape(end - begin, self.low_bits)
        return (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        return int(self.select_range(i, i + 1)[0])

    def select_range(self, begin: int, end: int) -> np.ndarray:
        """The values from begin up to end: of the upper bits only the bytes between the noted places about them are read."""
        if begin >= end:
            return np.empty(0, np.int64)
        noted = begin // SAMPLE
        after = -(-end // SAMPLE)
        byte = int(self.samples[noted]) // 8
        last = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        at = np.flatnonzero(np.unpackbits(self.high[byte:last], bitorder="little")) + 8 * byte
        skipped = np.searchsorted(at, int(self.samples[noted]))  # bits of the first byte that lie before the noted place
        at = at[skipped + begin - noted * SAMPLE :][: end - begin]
        return (at - np.arange(begin, end)) << self.low_bits | self._lows(begin, end).astype(np.int64)


def pack_block(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """Nulls stand first among doc_ids, the others ascend."""
    nulls = sum(i is None for i in doc_ids)
    known = [i for i in doc_ids if i is not None]
    base = known[0] if known else 0
    ids = ids.astype(f"<u{ids.dtype.itemsize}")
    head = struct.pack("<4sBqQQ", MAGIC, ids.dtype.itemsize, base, nulls, len(ids))
    offsets = np.array([i - base for i in known], np.uint64)
    return head + EliasFano.of(np.cumsum(sizes)).to_bytes() + EliasFano.of(offsets).to_bytes() + ids.tobytes()


class Block:
    def __init__(self, body: bytes):
        data = memoryview(body)
        magic, width, self.base, self.nulls, n = struct.unpack_from("<4sBqQQ", data)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        self.ends, at = EliasFano.read(data, struct.calcsize("<4sBqQQ"))
        self.names, at = EliasFano.read(data, at)
        self.ids = np.frombuffer(data, f"<u{width}", n, at)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self.names.select_range(0, self.names.n) + self.base).tolist()

    def portions(self) -> Iterator[tuple[int, np.ndarray]]:
        """(first document, its start and the ends of it and the next ones), READ_DOCS documents at a time."""
        start = 0
        for k in range(0, self.ends.n, READ_DOCS):
            ends = self.ends.select_range(k, min(k + READ_DOCS, self.ends.n))
            yield k, np.append(start, ends)
            start = int(ends[-1])

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document, by two selects."""
        return self.ids[self.ends.select(k - 1) if k else 0 : self.ends.select(k)]


def write_token_file(docs: DataFrame, tokenizer: str, end_id: int, shards: int | None = None) -> DataFrame:
    """The rows of the token file of docs: blocks in ascending doc_id order by (shard, block).

    Every whole text (null: empty) is encoded without special tokens and end_id is appended. Rows with a null
    doc_id come first, repeated rows are all kept (equal doc_ids in the order of their texts' XXH64), other columns
    are ignored; an empty table gives no blocks. Shards are ranges of doc_id between approximate quantiles
    that a scan of that one column finds; an id, or null, that fills several ranges is dealt over them by that hash.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts_of(docs).withColumn("mixed", F.shiftrightunsigned(F.xxhash64("text"), 32))
    figures = rows.agg(F.percentile_approx("doc_id", [k / shards for k in range(1, shards)] or [0.5], 20 * shards), F.count("*"), F.count("doc_id")).first()
    cuts = sorted(figures[0] or []) if shards > 1 else []
    first = (figures[1] - figures[2]) * shards // max(figures[1], 1)  # nulls fill so many shards and a part of the next
    rows = rows.withColumn("shard", _shard(cuts, first).cast("int"))
    order = [F.col("doc_id").asc_nulls_first(), "mixed", F.xxhash64("text"), "text"]
    rows = rows.repartitionById(shards + first, F.col("shard")).sortWithinPartitions(*order).select("doc_id", "text")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, own = encoder(tokenizer), TaskContext.get().partitionId()
        block = first = 0
        for batch in batches:
            names, texts = [None if pd.isna(i) else int(i) for i in batch.doc_id], batch.text.tolist()
            for a, b in slices(texts, BLOCK_CHARS):
                ids, sizes = coder.encode(texts[a:b])
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                yield pd.DataFrame({"shard": [own], "block": [block], "first": [first], "n_docs": [b - a], "n_ids": [len(ids)], "body": [pack_block(names[a:b], sizes + 1, ids)]})
                block, first = block + 1, first + len(ids)

    return written(rows.mapInPandas(encode, BLOCKS), "token_file")


def _shard(cuts: list[int], first: int) -> Column:
    """The shard of a row (doc_id, mixed): first + how many of the ascending cuts lie below doc_id; nulls come before.

    If several cuts are equal, the rows of that doc_id are dealt over the shards that the cuts divide.
    """
    spread = lambda n: F.floor(F.col("mixed") * n / F.lit(float(1 << 32)))
    repeats = {c: n for c, n in Counter(cuts).items() if n > 1}
    own = _below(cuts)
    if repeats:  # at most half as many as shards
        n = F.try_element_at(F.create_map(*[F.lit(x) for c, k in repeats.items() for x in (c, k)]), F.col("doc_id"))
        own = own + F.coalesce(spread(n + 1), F.lit(0))
    return F.when(F.col("doc_id").isNull(), spread(first + 1)).otherwise(own + first)


def _below(cuts: list[int]) -> Column:
    """How many of the ascending cuts lie below doc_id: first among every width-th cut, then within its group."""
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts)) + 1
    groups = [cuts[k : k + width] for k in range(0, len(cuts), width)]
    below = lambda values: F.size(F.filter(values, lambda c: c < F.col("doc_id")))
    group = below(F.array(*[F.lit(g[-1]) for g in groups]))
    inside = F.get(F.array(*[F.array(*map(F.lit, g)) for g in groups]), group)
    return F.when(inside.isNull(), len(cuts)).otherwise(group * width + below(inside))


def read_token_file(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the file's blocks.

    start counts the ids of all documents before it; ids_crc32 is that of its ids as little-endian 32-bit
    integers. The shards' totals, one row each, are summed in shard order.
    """
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = F.expr("sum(n_ids) over (order by shard rows between unbounded preceding and 1 preceding)")
    totals = totals.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                block = Block(row.body)
                names = pd.array(block.doc_ids(), "Int64")
                for k, edges in block.portions():
                    raw = memoryview(block.ids[edges[0] : edges[-1]].astype("<u4").tobytes())
                    at = (4 * (edges - edges[0])).tolist()
                    crc = [zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:], strict=False)]
                    yield pd.DataFrame({"shard": row.shard, "first": row.first, "doc_id": names[k : k + len(crc)], "in_block": edges[:-1], "n_tokens": np.diff(edges), "ids_crc32": crc})

    rows = blocks.select("shard", "first", "body").mapInPandas(decode, READ)
    start = (F.col("shard_start") + F.col("first") + F.col("in_block")).alias("start")
    return rows.join(totals, "shard").select("doc_id", start, "n_tokens", "ids_crc32")
