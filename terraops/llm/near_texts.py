"""One of each group of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, exactly.

SimHash comes first: texts whose fingerprints over five-word shingles the vantage-point trees link are compared as
whole sets, which finds most links. Fingerprints of 64 bits cannot find all: sets of similarity 0.8 differ in some
ten bits, where any two texts would have to be compared. So the rest is searched by the shingles themselves. Two
sets of a and b shingles that are so similar share one of the first a // 5 + 1 and b // 5 + 1 in any order that is
the same for all texts. Here one in DRAWN of all shingles come first, by their exact number in the whole corpus, so that
what no other set has fills the first places and meets nothing, however large the corpus is; the others follow in the
order of rarity in a fixed number of counters, and only a text with too few of the drawn ones is searched by them.
Where more than CROWD texts meet at a shingle, as the edited copies of one text do, they are searched anew among
themselves, by the exact numbers of all their shingles: what an edit brings in is then rare and comes first, so that
copies with too many edits to link with any other meet none. Texts that meet at a shingle are compared as whole
sets: first all with the one of the shingle's texts that has the least rare shingles before it, then those that are
not yet in one group with it. Sizes, places and parities spare comparisons that cannot link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import field, lean, numbered, release, slices, small_batches, texts_of, with_figures, written
from terraops.llm.graph import components
from terraops.llm.simhash import fingerprints, links, shingle_hashes

WORDS = 5
#: Counters of the corpus's shingles, a power of two, and how many of them make one row on the way.
COUNTERS, SEGMENT = 1 << 20, 1 << 12
#: One in so many shingles is counted exactly and comes first in the order of the search; more than a fifth, so that it can fill the places.
DRAWN = 4
#: Most sets that meet at a shingle as they are; where there are more, all their shingles are counted.
CROWD = 16
#: Most row keys that are broadcast; more are joined by a shuffle.
BROADCAST = 1_048_576
#: Bits of a set's parities where texts meet and of those that each pair is tested by.
PARITY, WIDE = 256, 2_048
#: What tells rows apart: the id and 128 bits of the text's hash.
IDENTITY = ["doc_id", "h1", "h2"]


def shingle_set(text: str) -> np.ndarray:
    """The distinct shingles of a text, sorted."""
    return np.unique(np.array(shingle_hashes(text, WORDS), np.uint64))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets is 0.8 or more; that of two empty sets is 1."""
    return 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b))


def counted(texts: DataFrame) -> np.ndarray:
    """For each counter how many shingles of all texts (text) fall to it; a text's repeats count once."""

    counters, segment = COUNTERS, SEGMENT

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        total = np.zeros(counters, np.int64)
        for batch in batches:
            for a, b in slices(texts := batch.text.tolist()):
                at = np.concatenate([np.empty(0, np.uint64), *[shingle_set(t) for t in texts[a:b]]])
                total += np.bincount((at % np.uint64(counters)).astype(np.int64), minlength=counters)
        yield from _segments(range(counters // segment), total.reshape(-1, segment), TaskContext.get().partitionId())

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return next(_segments([key[0]], [np.sum(rows.n.to_list(), axis=0)], 0))

    schema = "segment int, task int, n array<long>"
    parts = texts.select("text").mapInPandas(lean(count), schema)
    for fan in (64, 1):  # so many sums of a segment at first, then the whole
        parts = parts.withColumn("task", F.col("task") % fan).groupBy("segment", "task").applyInPandas(add, schema)
    out = np.zeros((counters // segment, segment), np.int64)
    for r in parts.collect():
        out[r["segment"]] = r["n"]
    return out.ravel()


def _segments(numbers, sums, task: int) -> Iterator[pd.DataFrame]:
    yield pd.DataFrame({"segment": list(numbers), "task": task, "n": list(sums)})


def coded(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Numbers in the order of the search: 20 bits of a shingle's counter, the rarer first, and 43 of the shingle."""
    rank = np.minimum(counts[(shingles % np.uint64(len(counts))).astype(np.int64)], (1 << 20) - 1)
    return np.sort(rank << 43 | (shingles >> np.uint64(21)).astype(np.int64))


def drawn(shingles: np.ndarray) -> np.ndarray:
    """Which shingles are counted exactly."""
    return (shingles >> np.uint64(40)) % np.uint64(DRAWN) == 0


def places(n: int) -> int:
    """How many shingles of a set of n, in any order, hold one of each set that it can link with."""
    return n // 5 + 1


def parities(shingles: np.ndarray, bits: int = PARITY) -> np.ndarray:
    """For each value of the low bits of shingles whether it occurs an odd number of times, packed in integers."""
    odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def described(text: Column, counts: np.ndarray) -> Column:
    """What a text is found by.

    (key, fp, size, bits, wide, drawn, rest): a hash of its set, the SimHash, the number of shingles, parities, the drawn
    shingles, and those of the others that the search needs besides them.
    """
    columns = ("key", "fp", "size", "bits", "wide", "drawn", "rest")

    def rows_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release()
        for batch in batches:
            texts, frames = batch.tolist(), []
            for a, b in slices(texts):
                hashes = [shingle_hashes(t, WORDS) for t in texts[a:b]]
                sets = [np.unique(np.array(h, np.uint64)) for h in hashes]
                few = [drawn(s) for s in sets]
                frames.append(pd.DataFrame({
                    "key": np.array([xxhash.xxh64_intdigest(s.tobytes()) - 2**63 for s in sets], np.int64),
                    "fp": fingerprints(hashes), "size": np.array([len(s) for s in sets], np.int32),
                    "bits": [parities(s) for s in sets], "wide": [parities(s, WIDE) for s in sets],
                    "drawn": [s[m].view(np.int64) for s, m in zip(sets, few, strict=True)],
                    "rest": [coded(s[~m], counts)[: max(0, places(len(s)) - int(m.sum()))] if len(s) else s.view(np.int64) for s, m in zip(sets, few, strict=True)],
                }))
            yield pd.concat(frames, ignore_index=True) if frames else pd.DataFrame({c: [] for c in columns})

    return F.pandas_udf(lean(rows_of), "key long, fp long, size int, bits array<long>, wide array<long>, drawn array<long>, rest array<long>")(text)


def _few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST else rows


def _identified(texts: DataFrame) -> DataFrame:
    return texts.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), "text"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a.doc_id.eqNullSafe(b.doc_id) & (a.h1 == b.h1) & (a.h2 == b.h2)


def _similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        kept, last, own = [], None, None
        for a, b in zip(batch.text_a, batch.text_b, strict=True):
            if a != last:
                last, own = a, shingle_set(a)
            kept.append(alike(own, shingle_set(b)))
        yield batch.loc[np.array(kept, bool), ["a", "b"]]


def verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of pairs (a, b) of sets (key) whose texts are alike; texts are rows (doc_id, text)."""
    pairs = written(possible(pairs, sets), "pairs")
    met = written(_texts_of_sets(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), sets, texts), "met")
    both = pairs.join(met.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(met.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    return written(both.select("a", "b", "text_a", "text_b").mapInPandas(lean(_similar), "a long, b long"), "similar")


def _texts_of_sets(keys: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, text): one text of each of the sets of these keys."""
    wanted = written(sets.join(_few(written(keys, "keys")), "key").select("key", "best.*"), "wanted")
    named = _identified(texts)
    return named.join(few := _few(wanted), _same(named, few)).select("key", "text").dropDuplicates(["key"])


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, that sizes and the wide parities leave room for."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    for c in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("key").alias(c), F.col("size").alias(f"size_{c}"), F.col("wide").alias(f"wide_{c}")), c)
    return pairs.where(9 * _apart("wide_a", "wide_b", WIDE) <= F.col("size_a") + F.col("size_b")).select("a", "b")


def _may_link(a: str, b: str) -> Column:
    """Whether the sizes, places and parities of two sets leave room for a link; no link is ruled out.

    A link needs that the sets differ in at most a ninth of the sum of their sizes, and the bits in which their
    parities differ are never more than the shingles in which the sets do. Where two sets first meet all that they
    share comes from that place (pos) on in either; a link needs that this is four ninths of the sum of sizes.
    """
    total = F.col(f"{a}.size") + F.col(f"{b}.size")
    room = [9 * (F.col(f"{c}.size") - F.col(f"{c}.pos")) >= 4 * total for c in (a, b)]
    near = (9 * F.abs(F.col(f"{a}.size") - F.col(f"{b}.size")) <= total) & room[0] & room[1]
    return (F.col(f"{a}.root") != F.col(f"{b}.root")) & near & (9 * _apart(f"{a}.bits", f"{b}.bits", PARITY) <= total)


def _apart(a: str, b: str, bits: int) -> Column:
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(bits // 64)), F.lit(0))


def by_fingerprint(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets (key, fp): those that have a fingerprint with its least key, and these along the trees' links."""
    values = written(sets.groupBy("fp").agg(F.min("key").alias("least")), "values")
    edges = links(values.select(F.col("fp").alias("value")))
    ends = edges.join(values.select(F.col("fp").alias("a"), F.col("least").alias("x")), "a").join(values.select(F.col("fp").alias("b"), F.col("least").alias("y")), "b")
    return sets.join(values, "fp").select(F.col("key").alias("a"), F.col("least").alias("b")).union(ends.select("x", "y"))


def searched(marked: DataFrame) -> DataFrame:
    """(key, shingle, pos): the shingles that sets are searched by and their places, without those that no other set has.

    Drawn shingles of one set alone come first, then shared ones, the rarer first, then the others. Copies
    of a text have one key, so what only they share is of one set.
    """
    rows = marked.select("key", F.explode("drawn").alias("shingle"))
    total = marked.agg(F.coalesce(F.sum(F.size("drawn")), F.lit(0))).first()[0]
    often = rows.groupBy("shingle").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n")).where("low < high")
    often = written(often.select("shingle", "n"), "often")
    met = rows.join(F.broadcast(often), "shingle") if often.count() <= BROADCAST else with_figures(rows, often, "shingle", total)
    listed = F.sort_array(F.collect_set(F.struct("n", "shingle"))).alias("listed")
    sizes = marked.groupBy("key").agg(F.first("size").alias("size"), F.first(F.size("drawn")).alias("own"))
    alone = F.col("own") - F.size("listed")
    few = F.slice("listed", 1, F.greatest(F.floor(F.col("size") / 5).cast("int") + 1 - alone, F.lit(0)))
    places = met.groupBy("key").agg(listed).join(sizes, "key").select("key", alone.alias("alone"), F.posexplode(few).alias("pos", "s"))
    rest = marked.select("key", F.size("drawn").alias("own"), F.posexplode("rest").alias("pos", "shingle")).distinct()
    return places.select("key", "s.shingle", (F.col("alone") + F.col("pos")).alias("pos")).union(rest.select("key", "shingle", F.col("own") + F.col("pos")))


def met_at(places: DataFrame) -> DataFrame:
    """places (key, shingle, pos) with n, how many sets the shingle has there; without shingles that have one."""
    met = written(places, "met")
    ends = met.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    return with_figures(met, ends, "shingle", met.count()).select("shingle", "key", "pos", "n")


def _whole(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    release()
    for batch in batches:
        yield pd.Series([shingle_set(t).view(np.int64) for t in batch], dtype=object)


def uncrowded(met: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(shingle, key, pos) where sets that can link meet: shingles of at most CROWD sets, the others' sets searched anew.

    Two sets that first meet in a crowd are both among the sets of crowds. Any order that is the same for all of
    these brings them together, so it is that of all their shingles' exact numbers among these sets. Shingles of
    that search go by another hash, as places in one order say nothing in the other.
    """
    keys = met.where(F.col("n") > CROWD).select("key").distinct()
    whole = _texts_of_sets(keys, sets, texts).select("key", F.pandas_udf(lean(_whole), "array<long>")("text").alias("drawn"))
    whole = written(whole.select("key", F.size("drawn").alias("size"), "drawn", F.array().cast("array<long>").alias("rest")), "whole")
    again = met_at(searched(whole)).select(F.xxhash64("shingle").alias("shingle"), "key", "pos")
    return met.where(F.col("n") <= CROWD).select("shingle", "key", "pos").union(again)


def set_links(marked: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root) of the keys of all sets that are linked."""
    found = verified(by_fingerprint(sets), sets, texts)
    shared = uncrowded(written(met_at(searched(marked)), "shared"), sets, texts)
    shared = written(shared.join(sets.select("key", "size", "bits"), "key").select("shingle", "key", "size", "bits", "pos"), "shared")
    named = _led(_rooted(shared, components(found)))
    pairs = named.where(_may_link("own", "lead")).select(F.col("own.key").alias("a"), F.col("lead.key").alias("b"))
    found = found.union(verified(pairs, sets, texts))
    named = _led(_rooted(shared, components(found)))
    others = named.select("shingle", F.col("own").alias("other"))
    apart = named.where(F.col("own.root") != F.col("lead.root"))  # what is in one group with the lead meets these alone
    turn = (F.col("own.key") < F.col("other.key")) | (F.col("other.root") == F.col("lead.root"))
    pairs = apart.join(others, "shingle").where(turn & _may_link("own", "other")).select(F.col("own.key").alias("a"), F.col("other.key").alias("b"))
    return components(found.union(verified(pairs, sets, texts)))


def _rooted(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(shingle, own), own being a set's key, root, size, parities and the shingle's place in it."""
    both = shared.join(roots.withColumnRenamed("node", "key"), "key", "left")
    return both.select("shingle", F.struct("key", F.coalesce("root", "key").alias("root"), "size", "bits", "pos").alias("own"))


def _led(rows: DataFrame) -> DataFrame:
    """rows with lead, one of each shingle's own; the rows of a shingle that very many share do not meet in one task.

    The lead has the smallest share of its set before the shingle: of edited copies that with the fewest edits, which
    most of the others link with if they link at all.
    """
    rows = written(rows, "rooted")
    draw = F.struct((F.col("own.pos") / F.col("own.size")).alias("part"), F.xxhash64("own.key", "shingle").alias("draw"), "own")
    leads = rows.groupBy("shingle").agg(F.min(draw).alias("lead"), F.count("*").alias("n"))
    return written(with_figures(rows, leads, "shingle", rows.count()).select("shingle", "own", F.col("lead.own").alias("lead")), "named")


def one_of_each_text(docs: DataFrame) -> DataFrame:
    """docs with one row for each group of linked texts: that of the smallest doc_id, all columns as they are.

    Words and shingles are those of op6, but five words long; texts of fewer words are one shingle, and all texts
    without words (null, empty, blank) are alike. Of rows that share this doc_id and text one stays. If all ids of
    a group are null, one row stays. Columns may have any name; an empty table gives no rows.
    """
    with small_batches(docs.sparkSession):  # all Python runs before this ends
        return _one_of_each(docs)


def _one_of_each(docs: DataFrame) -> DataFrame:
    texts = texts_of(docs)
    marked = _identified(texts).withColumn("d", described(F.col("text"), counted(texts)))
    marked = written(marked.select(*IDENTITY, "d.*"), "marked")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("without"), *IDENTITY)).alias("best")
    figures = [F.first(c).alias(c) for c in ("fp", "size", "bits", "wide")]
    sets = written(marked.groupBy("key").agg(best, *figures), "sets")
    roots = set_links(marked, sets, texts)
    named = written(sets.join(roots, sets.key == roots.node, "left").select("key", "best", F.coalesce("root", "key").alias("root")), "roots")
    chosen = named.groupBy("root").agg(F.min("best").alias("best")).select(*[F.col(f"best.{c}").alias(c) for c in IDENTITY])
    rows = marked.groupBy(*IDENTITY).agg(F.count("*").alias("times"))
    chosen = chosen.withColumn("chosen", F.lit(True))
    rows = written(rows.join(chosen, _same(rows, chosen), "left").select(*[rows[c] for c in IDENTITY], "times", F.coalesce("chosen", F.lit(False)).alias("chosen")), "chosen")
    own = numbered(docs).withColumns({"doc_id": field(docs, "doc_id", "long"), "text": F.coalesce(field(docs, "text", "string"), F.lit(""))})
    own = _identified(own)
    dropped, twice = rows.where("not chosen"), rows.where("chosen and times > 1")
    columns = [f"c{k}" for k in range(len(docs.columns))]
    gone = _few(dropped.union(twice))
    once = own.join(gone, _same(own, gone), "left_anti").select(*columns)
    if twice.count():  # of repeated rows one stays
        again = _few(twice)
        once = once.union(own.join(again, _same(own, again), "left_semi").dropDuplicates(IDENTITY).select(*columns))
    return once.toDF(*docs.columns)
