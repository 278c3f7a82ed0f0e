"""Language-model scores of whole texts: stupid backoff over bigrams of tokens, counted in the corpus itself.

Counts leave out the document that is scored, so it does not vouch for itself. Unigram counts are bounded by
the vocabulary and go to every task. Bigram counts are a table dealt into buckets by a hash of the bigram.
Bigrams that make at least 1 / HEAD of all tokens are at most HEAD and go to every task too; those are the
ones that most documents share. All others are exploded from the documents, once for each document and with their
number there, dealt into the same buckets and joined with the table there. The parts are summed by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import release, slices, texts_of, written
from terraops.llm.pieces import encoder

BACKOFF = 0.4
#: A bigram is in the head if it makes one in so many tokens.
HEAD = 65_536
#: Buckets at least, and tokens of the corpus to a bucket at most, so that a bucket stays small; bytes of ids whose bigrams a task counts at once.
BUCKETS, BUCKET, BYTES = 128, 4_194_304, 2_000_000
#: Chunks that a worker keeps while it encodes: fewer than elsewhere, as later stages need the memory.
ROOM = 500_000
#: In place of a count of 0.
FLOOR = 0.5
TABLE = "bucket int, grams array<long>, counts array<long>"
EXPLODED = "bucket int, grams array<long>, rows array<long>, times array<int>, firsts array<int>, seconds array<int>"


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    return ((grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal values begin, and their sizes."""
    starts = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])) if len(sorted_values) else np.empty(0, np.int64)
    return starts, np.diff(np.append(starts, len(sorted_values)))


def _dealt(bucket: np.ndarray, **columns: np.ndarray) -> pd.DataFrame:
    """One row per bucket with its share of the columns as arrays."""
    bucket = bucket.astype(np.uint16 if len(bucket) and bucket.max() < 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    starts, _ = _runs(bucket[order])
    cut = {name: np.split(values[order], starts[1:]) if len(starts) else [] for name, values in columns.items()}
    return pd.DataFrame({"bucket": bucket[order][starts].astype(np.int32), **cut})


class Batch:
    """Bigrams (first << 32 | second) of some documents; a text begins after the mark `begin`."""

    def __init__(self, ids: list[np.ndarray], begin: int):
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.second = np.concatenate(ids).astype(np.int64) if ids else np.empty(0, np.int64)
        self.first = np.empty_like(self.second)
        self.first[1:] = self.second[:-1]
        self.first[(np.cumsum(sizes) - sizes)[sizes > 0]] = begin
        self.owner = np.repeat(np.arange(len(ids)), sizes)
        self.sizes = sizes
        self.begin = begin

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        grams = np.sort(self.first << 32 | self.second)
        starts, n = _runs(grams)
        return grams[starts], n

    def by_document(self) -> tuple[np.ndarray, ...]:
        """(owner, gram, times) of each document's distinct bigrams, and the times of both their tokens in it."""
        bits = self.begin.bit_length()
        order = np.argsort(own := self.owner << bits | self.second)
        starts, n = _runs(own[order])
        there = np.empty_like(n, shape=len(order))
        there[order] = np.repeat(n, n)  # of the token at each place
        begins = (ends := np.cumsum(self.sizes)) - self.sizes
        begins, ends = begins[self.sizes > 0], ends[self.sizes > 0]
        before = np.empty_like(there)
        before[1:] = there[:-1]
        last = np.repeat(self.second[ends - 1], self.sizes[self.sizes > 0])
        before -= self.first == last  # the last token has no follower
        before[begins] = 1
        order = np.argsort(key := self.owner << 2 * bits | self.first << bits | self.second)
        starts, times = _runs(key[order])
        at = order[starts]
        return self.owner[at], self.first[at] << 32 | self.second[at], times, before[at], there[at]


def log_scores(times, counts, firsts, seconds, contexts, unigrams, total) -> np.ndarray:
    """times * log S for bigrams of these counts in the corpus, less those of the document itself."""
    rest = counts - times
    seen = np.log(np.maximum(rest, 1)) - np.log(np.maximum(contexts - firsts, 1))
    unseen = np.log(BACKOFF * np.maximum(unigrams - seconds, FLOOR) / max(total, 1))
    return times * np.where(rest > 0, seen, unseen)


def ngram_scores(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, log_score, score) of each row: the sum of log S over its tokens, and their mean.

    S of a token after another is their bigram's count over the first's, or BACKOFF times the token's own
    share of all tokens if no other document has the bigram. A bucket has a bounded share of the corpus at every
    size of it. A null or empty text has no tokens and scores 0. Repeated rows are documents of their own; a null doc_id is kept; other columns are ignored.
    """
    begin = encoder(tokenizer).tokenizer.get_vocab_size()

    def tokenize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        coder = encoder(tokenizer, ROOM)
        for batch in batches:
            texts = batch.text.tolist()
            for a, b in slices(texts):
                ids, sizes = coder.encode(texts[a:b])
                rows = np.split(ids, np.cumsum(sizes)[:-1])
                yield pd.DataFrame({"doc_id": batch.doc_id.iloc[a:b], "row": batch.row.iloc[a:b], "ids": [r.tobytes() for r in rows]})

    dtype = encoder(tokenizer).dtype
    rows = texts_of(docs).withColumn("row", F.monotonically_increasing_id())
    tokens = written(rows.mapInPandas(tokenize, "doc_id long, row long, ids binary"), "tokens")
    everything = tokens.agg(F.sum(F.octet_length("ids").cast("long"))).first()[0] or 0
    buckets = max(BUCKETS, -(-everything // np.dtype(dtype).itemsize // BUCKET))

    def batches_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, Batch]]:
        release()
        for batch in batches:
            at = batch.ids.map(len).cumsum() // BYTES
            for _, part in batch.groupby(at):
                yield part.row.to_numpy(np.int64), Batch([np.frombuffer(x, dtype) for x in part.ids], begin)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, batch in batches_of(batches):
            grams, n = batch.counts()
            yield _dealt(_bucket(grams, buckets), grams=grams, counts=n)

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        grams, n = np.concatenate(parts.grams.to_list()), np.concatenate(parts.counts.to_list())
        order = np.argsort(grams, kind="stable")
        starts, _ = _runs(grams[order])
        return pd.DataFrame({"bucket": [key[0]], "grams": [grams[order][starts]], "counts": [np.add.reduceat(n[order], starts)]})

    counts = written(tokens.select("row", "ids").mapInPandas(count, TABLE).groupBy("bucket").applyInPandas(add, TABLE), "counts")

    def singles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sums over first and over second tokens, of as many rows as the vocabulary at most."""
        sums = np.zeros((2, begin + 1))
        for batch in batches:
            for grams, n in zip(batch.grams, batch.counts, strict=True):
                for k, tokens in enumerate((grams >> 32, grams & 0xFFFFFFFF)):
                    sums[k] += np.bincount(tokens, n, begin + 1)
        at = np.flatnonzero(sums.any(0))
        yield pd.DataFrame({"token": at, "f": sums[0][at].astype(np.int64), "s": sums[1][at].astype(np.int64)})

    contexts, unigrams = np.zeros(begin + 1, np.int64), np.zeros(begin + 1, np.int64)
    single = counts.mapInPandas(singles, "token long, f long, s long").groupBy("token").agg(F.sum("f").alias("f"), F.sum("s").alias("s"))
    for r in single.collect():
        contexts[r["token"]], unigrams[r["token"]] = r["f"], r["s"]
    total = int(unigrams.sum())

    def frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for grams, n in zip(batch.grams, batch.counts, strict=True):
                yield pd.DataFrame({"gram": grams, "n": n})[n * HEAD >= total]

    head = counts.mapInPandas(frequent, "gram long, n long").toPandas().sort_values("gram")  # at most HEAD rows
    head_grams, head_counts = head.gram.to_numpy(np.int64), head.n.to_numpy(np.int64)

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Tails by bucket. The sums over head bigrams have no times; they ride along in a bucket of any number."""
        for names, batch in batches_of(batches):
            owner, gram, times, firsts, seconds = batch.by_document()
            at = np.minimum(np.searchsorted(head_grams, gram), max(len(head_grams) - 1, 0))
            known = head_grams[at] == gram if len(head_grams) else np.zeros(len(gram), bool)
            if known.any():
                g, t = gram[known], times[known]
                own = log_scores(t, head_counts[at[known]], firsts[known], seconds[known], contexts[g >> 32], unigrams[g & 0xFFFFFFFF], total)
                sums = np.bincount(owner[known], own, len(names))
                yield pd.DataFrame({"bucket": [int(names[0]) % buckets], "grams": [sums.view(np.int64)], "rows": [names], "times": [[]], "firsts": [[]], "seconds": [[]]})
            rest = ~known
            yield _dealt(_bucket(gram[rest], buckets), grams=gram[rest], rows=names[owner[rest]], times=times[rest], firsts=firsts[rest], seconds=seconds[rest])

    exploded = tokens.select("row", "ids").mapInPandas(explode, EXPLODED)

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        head = left.times.map(len) == 0
        rows, sums = left.rows[head].to_list(), [np.ascontiguousarray(x).view(np.float64) for x in left.grams[head]]
        if not head.all():
            gram, row, times, firsts, seconds = (np.concatenate(left.loc[~head, c].to_list()) for c in ("grams", "rows", "times", "firsts", "seconds"))
            table, n = right.grams.iloc[0], right.counts.iloc[0]
            sums.append(log_scores(times, n[np.searchsorted(table, gram)], firsts, seconds, contexts[gram >> 32], unigrams[gram & 0xFFFFFFFF], total))
            rows.append(row)
        if not rows:
            return pd.DataFrame({"row": [], "sum": []})
        names, at = np.unique(np.concatenate(rows), return_inverse=True)
        return pd.DataFrame({"row": names, "sum": np.bincount(at, np.concatenate(sums), len(names))})

    parts = exploded.groupBy("bucket").cogroup(counts.groupBy("bucket")).applyInPandas(join, "row long, sum double")
    sums = parts.groupBy("row").agg(F.sum("sum").alias("log_score"))
    n = (F.octet_length("ids") / np.dtype(dtype).itemsize).cast("long").alias("n_tokens")
    out = tokens.select("doc_id", "row", n).join(sums, "row", "left").select("doc_id", "n_tokens", F.coalesce("log_score", F.lit(0.0)).alias("log_score"))
    return out.withColumn("score", F.coalesce(F.try_divide("log_score", "n_tokens"), F.lit(0.0)))
