"""Sequences of at most a capacity of tokens, packed from documents of any length.

Documents above one third of the capacity meet at most twice in a sequence: the longest takes the longest
that still fits beside it. Shorter ones go, longest first, into the smallest gap that holds them. Lengths
are whole numbers up to the capacity, so the decisions depend on the count of each length alone: the driver
plans over those counts, and every piece finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraops.llm.common import lean, slices, texts_of, written
from terraops.llm.pieces import ROOM, encoder

#: Ranks are counted apart in so many groups of the pieces of one length: one for so many pieces, from and to.
SALT, SALTS, SALTS_MOST = 16_384, 64, 4_096
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_points(size: int, capacity: int) -> list[int]:
    """Where the pieces of a document of size tokens begin: all have the capacity but the first."""
    first = size % capacity or capacity
    return [0, *range(first, size, capacity)]


def plan(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, pieces, first sequence, pieces of it in each sequence, offset) and the number of sequences.

    counts[n] pieces have length n. Pieces of a run fill consecutive sequences that look alike.
    """
    left = [int(c) for c in counts]
    given = [0] * (capacity + 1)
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by gap: (first sequence, sequences)
    runs: list[tuple[int, ...]] = []
    sequences = 0

    def put(length: int, first: int, bins: int, each: int, offset: int) -> None:
        runs.append((length, given[length], bins * each, first, each, offset))
        given[length] += bins * each
        left[length] -= bins * each

    def large(size: int, below: int) -> int:
        return next((n for n in range(below, capacity // 3, -1) if left[n] - (n == size) > 0), 0)

    for size in range(capacity, capacity // 3, -1):
        while left[size]:
            other = large(size, min(size, capacity - size))
            bins = left[size] if not other else left[size] // 2 if other == size else min(left[size], left[other])
            put(size, sequences, bins, 1, 0)
            if other:
                put(other, sequences, bins, 1, size)
            gaps[capacity - size - other].append((sequences, bins))
            sequences += bins
    for size in range(capacity // 3, 0, -1):
        while left[size]:
            gap = next((g for g in range(size, capacity) if gaps[g]), capacity)
            most = gap // size
            first, bins = gaps[gap].pop() if gap < capacity else (sequences, -(-left[size] // most))
            sequences += bins if gap == capacity else 0
            full = min(bins, left[size] // most)
            if full:
                put(size, first, full, most, capacity - gap)
                gaps[gap - most * size].append((first, full))
            if full < bins and left[size]:
                rest = left[size]
                put(size, first + full, 1, rest, capacity - gap)
                gaps[gap - rest * size].append((first + full, 1))
                full += 1
            if full < bins and gap < capacity:
                gaps[gap].append((first + full, bins - full))
    return np.array(sorted(runs), np.int64).reshape(-1, 6), sequences


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keep_ids: bool = False, room: int = ROOM) -> DataFrame:
    """One row per piece of each whole text's ids (null: empty) with end_id appended; with keep_ids the ids too."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder(tokenizer, room)
        for batch in batches:
            texts, names = batch.text.tolist(), batch.doc_id.array
            for a, b in slices(texts):
                ids, sizes = coder.encode(texts[a:b])
                ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4")
                raw = memoryview(ids.tobytes())
                rows, begin = [], 0
                for k, size in enumerate((sizes + 1).tolist(), a):
                    points = [*cut_points(size, capacity), size]
                    for piece, (p, q) in enumerate(zip(points, points[1:], strict=False)):
                        row = (k, piece, p, q - p, zlib.crc32(raw[4 * (begin + p) : 4 * (begin + q)]))
                        rows.append((*row, ids[begin + p : begin + q].astype(np.int32)) if keep_ids else row)
                    begin += size
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids])
                out["doc_id"] = names.take(out.doc_id.to_numpy())
                yield out

    rows = texts_of(docs)
    return rows.mapInPandas(lean(cut) if room < ROOM else cut, PIECES + ", ids array<int>" * keep_ids)


def placed(pieces: DataFrame, capacity: int) -> DataFrame:
    """pieces (doc_id, piece, start, length, ids_crc32 and others) with sequence_id and offset.

    pieces must be stored rows. The driver gets one count for each length and salt, at most
    (capacity + 1) * SALTS_MOST numbers whatever the input; repeated rows are pieces of their own.
    """
    salts = min(SALTS_MOST, max(SALTS, pieces.count() // SALT))
    salt = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(salts)).cast("int")
    pieces = pieces.withColumn("salt", salt)
    table = np.zeros((capacity + 1, salts), np.int64)
    counts = pieces.groupBy("length", "salt").count().toArrow()  # columns of numbers: a Row for each would take thirty times as much
    table[counts["length"].to_numpy(), counts["salt"].to_numpy()] = counts["count"].to_numpy()
    runs, _ = plan(table.sum(1), capacity)
    base = np.cumsum(table, 1) - table
    keys = runs[:, 0] << 44 | runs[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, salt: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy() - 1 + base[length.to_numpy(), salt.to_numpy()]
        run = runs[np.searchsorted(keys, n << 44 | r, "right") - 1]
        k = r - run[:, 1]
        return pd.DataFrame({"sequence_id": run[:, 3] + k // run[:, 4], "offset": run[:, 5] + k % run[:, 4] * n})

    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")).cast("long")
    out = pieces.withColumn("rank", rank).withColumn("place", place("length", "salt", "rank"))
    return out.select(*[c for c in pieces.columns if c != "salt"], "place.sequence_id", "place.offset")


def packed(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, room: int = ROOM) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Documents longer than the capacity are cut into pieces of the capacity, of which the first may be
    shorter. A null or empty text is the end id alone; a null doc_id is kept; repeated rows are pieces of their own;
    other columns are ignored; an empty table gives no rows. A worker keeps the ids of room chunks; with
    fewer than ROOM it also gives back free memory after each task.
    """
    return placed(written(token_pieces(docs, tokenizer, end_id, capacity, room=room), "pieces"), capacity)


def sequences(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """The packed sequences themselves: (sequence_id, input_ids, doc_ids and lengths in their order)."""
    pieces = placed(written(token_pieces(docs, tokenizer, end_id, capacity, keep_ids=True), "pieces"), capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    out = pieces.groupBy("sequence_id").agg(parts.alias("parts"))
    return out.select("sequence_id", F.flatten("parts.ids").alias("input_ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.length").alias("lengths"))
