"""Token counts without tokenizing to ids: byte pairs merged by rank over ragged arrays.

Pre-tokens of a batch lie one after another in a flat array of symbols. Each round finds for every sequence
the lowest rank among its adjacent pairs, merges all places of that pair at once, and drops the sequences
that have no ranked pair left; their surviving symbols are the tokens. Equal chunks are counted once a worker.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import cached, slices, texts_of
from terraops.llm.pieces import Memo, chunk_of, cuttable, keyed

#: Fixed: the pre-tokens of byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NONE = np.int32(2**31 - 1)
#: Symbols that one call of count() holds at a time.
SYMBOLS_AT_ONCE = 2_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class PairTable:
    """(left, right) -> rank and merged symbol, by open addressing in two arrays."""

    BITS = 20

    def __init__(self, pairs: list[tuple[int, int]], merged: list[int]):
        self.keys = np.full(1 << self.BITS, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << self.BITS, NONE)
        self.merged = np.array(merged, np.int32)
        keys = np.array([a << 32 | b for a, b in pairs], np.uint64)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self.slot(keys).tolist(), strict=True)):
            while self.ranks[slot] != NONE and self.keys[slot] != key:
                slot = (slot + 1) % (1 << self.BITS)
            if self.ranks[slot] == NONE:
                self.keys[slot], self.ranks[slot] = key, rank

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, NONE where they have none."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self.slot(keys)
        out = np.where(self.keys[slot] == keys, self.ranks[slot], NONE)
        todo = np.flatnonzero((self.keys[slot] != keys) & (self.ranks[slot] != NONE))
        while len(todo):
            slot[todo] = (slot[todo] + 1) % (1 << self.BITS)
            at = slot[todo]
            hit = self.keys[at] == keys[todo]
            out[todo[hit]] = self.ranks[at[hit]]
            todo = todo[~hit & (self.ranks[at] != NONE)]
        return out


class RankMerger:
    """Counts the tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if not cuttable(path) or model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path}: a byte-level BPE file without normalizer is asked for")
        vocab = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.byte = np.array([vocab[c] for c in byte_symbols()], np.int32)
        self.table = PairTable([(vocab[a], vocab[b]) for a, b in merges], [vocab[a + b] for a, b in merges])
        self.pattern = regex.compile(PATTERN)
        added = [regex.escape(t["content"]) for t in sorted(spec["added_tokens"], key=lambda t: -len(t["content"]))]
        self.added = regex.compile("|".join(added)) if added else None
        self.memo = Memo(self._count_chunks, np.int64)

    def _count_chunks(self, keys: list[str]) -> list[tuple[int]]:
        of, words, extra = [], [], np.zeros(len(keys), np.int64)
        for k, chunk in enumerate(map(chunk_of, keys)):
            pieces = [chunk]
            if self.added and "|" in chunk or self.added and self.added.search(chunk):
                pieces = self.added.split(chunk)
                extra[k] = len(pieces) - 1
            own = [w for p in pieces for w in self.pattern.findall(p)]
            words += own
            of += [k] * len(own)
        distinct, inverse = np.unique(np.array(words, object), return_inverse=True) if words else (np.empty(0, object), np.empty(0, np.int64))
        counts = self.count([w.encode() for w in distinct])
        return [(n,) for n in (extra + np.bincount(of, counts[inverse], len(keys)).astype(np.int64)).tolist()]

    def count(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = np.zeros(len(words), np.int64)
        begin = held = 0
        for k, word in enumerate([*words, b""]):
            if k == len(words) or held and held + len(word) > SYMBOLS_AT_ONCE:
                if k > begin:
                    out[begin:k] = self._merge(words[begin:k])
                begin, held = k, 0
            held += len(word)
        return out

    def _merge(self, words: list[bytes]) -> np.ndarray:
        counts = np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        name = np.flatnonzero(sizes)  # of each active sequence
        sizes = sizes[name]
        symbols = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        starts = np.cumsum(sizes) - sizes
        ranks = np.full(len(symbols), NONE)  # of the pair that begins at each symbol
        ranks[:-1] = self.table.find(symbols[:-1], symbols[1:])
        ranks[starts + sizes - 1] = NONE
        while len(name):
            lowest = np.minimum.reduceat(ranks, starts)
            live = lowest != NONE
            if not live.all():
                counts[name[~live]] = sizes[~live]
                kept = np.repeat(live, sizes)
                symbols, ranks, name, sizes, lowest = symbols[kept], ranks[kept], name[live], sizes[live], lowest[live]
                if not len(name):
                    break
                starts = np.cumsum(sizes) - sizes
            at = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            if len(at) > 1 and (touch := np.diff(at) == 1).any():  # of aaa only the first pair merges
                run = np.concatenate([[0], np.maximum.accumulate(np.where(touch, 0, np.arange(1, len(at))))])
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.table.merged[ranks[at]]
            gone = np.ones(len(symbols), bool)
            gone[at + 1] = False
            sizes = sizes - np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(sizes))
            moved = at - np.arange(len(at))  # where the merged symbols stand afterwards
            symbols, ranks = symbols[gone], ranks[gone]
            starts = np.cumsum(sizes) - sizes
            last = np.zeros(len(symbols) + 1, bool)
            last[starts + sizes - 1] = True
            stale = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
            stale_last = last[stale]
            ranks[stale[stale_last]] = NONE
            stale = stale[~stale_last]
            ranks[stale] = self.table.find(symbols[stale], symbols[stale + 1])
        return counts

    def count_texts(self, texts: list[str]) -> np.ndarray:
        self.memo.fresh()
        codes, sizes = keyed(self.memo, texts)
        totals = np.concatenate([[0], np.cumsum(self.memo.values[self.memo.starts[codes]] * (self.memo.sizes[codes] > 0))])
        ends = np.cumsum(sizes)
        return totals[ends] - totals[ends - sizes]


@cached(4)
def merger(path: str) -> RankMerger:
    return RankMerger(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row's whole text.

    Tokens are those of the byte-level BPE file without added begin or end tokens; special strings inside a
    text count as the one token that the library makes of them. A null text counts as empty (0, 0, false);
    repeated rows give repeated results; rows with a null doc_id keep it; other columns are ignored.
    """

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = merger(tokenizer)
        for batch in batches:
            texts = batch.tolist()
            done = [counter.count_texts(texts[a:b]) for a, b in slices(texts)]
            yield pd.Series(np.concatenate(done) if done else np.empty(0, np.int64))

    counted = texts_of(docs)
    counted = counted.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.pandas_udf(count, "long")("text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
