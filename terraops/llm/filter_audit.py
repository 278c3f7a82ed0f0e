"""What each filter of a chain removes, in every order of the chain, from decision diagrams of failure masks.

Spark reduces the documents to counts by part and mask of failed filters. A part's counts become a decision diagram,
one level a filter, whose nodes know the documents below them. Orders are visited so that each differs from the one
before in two neighbours, so that a swap of two adjacent levels makes its diagram from the last. The path on which
all filters pass then has the steps of the order: at each level the documents below the failing branch go.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import given, written

FILTERS = "ABCDE"
_SPACE = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\f\r"


def word_counts(text: Column) -> tuple[Column, Column]:
    """How many words (maximal runs of other than ASCII white space) text has, and how many different ones."""
    trimmed = F.trim(text, F.lit(_SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE, -1))
    return F.size(words), F.size(F.array_distinct(words))


def failure_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of each row of docs (doc_id, text, source): bit k is set if the row fails filter k of FILTERS.

    A: under 200 words. B: fewer than half of the words differ. C: more than 2 % of the code points are A to Z. D: holds one
    of # $ % & * |. E: the text is that of a smaller doc_id. part is the source, empty where null; a null text is empty.
    A row without an id is no copy, and none is a copy of it; rows of the same id are no copies of one another. Equal
    texts are known by 128 bits of a hash.
    """
    rows = given(docs, doc_id="long", text="string", source="string")
    text = F.coalesce("text", F.lit(""))
    rows = rows.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    n_words, n_different = word_counts(F.col("text"))
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    sized = rows.select("doc_id", "part", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), n_words.alias("words"), n_different.alias("different"), (100 * capitals > 2 * F.length("text")).alias("c"), F.col("text").rlike(r"[#$%&*|]").alias("d"))
    fails = [F.col("words") < 200, 100 * F.col("different").cast("long") < 50 * F.col("words"), F.col("c"), F.col("d")]
    bit = lambda condition, k: F.when(condition, 1 << k).otherwise(0)
    masked = written(sized.select("doc_id", "part", "k1", "k2", sum((bit(c, k) for k, c in enumerate(fails)), F.lit(0)).alias("mask")), "masks")
    # the first of each text, found by its id: as ids are part of the join's key, no text's copies meet in one task
    first = masked.where("doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"))
    found = masked.join(first.withColumn("first", F.lit(True)), ["k1", "k2", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return found.select("doc_id", "part", (F.col("mask") + bit(copy, 4)).alias("mask"))


class Diagram:
    """Counts by mask as a diagram: a node is (variable, pass, fail), a leaf a tuple of counts; equal nodes are one.

    Every path has all variables, so that a node's counts are the sums of its leaves.
    """

    def __init__(self, order: str, counts: dict[int, tuple[int, ...]], width: int):
        self.order = list(order)
        self.nodes: dict[tuple, tuple] = {}
        self.sums: dict[int, tuple[int, ...]] = {}
        self.bit = {name: 1 << k for k, name in enumerate(order)}
        self.root = self._built(0, 0, counts, (0,) * width)

    def _built(self, level: int, mask: int, counts: dict, none: tuple) -> tuple:
        if level == len(self.order):
            return self.node(("leaf", counts.get(mask, none)))
        name = self.order[level]
        return self.node((name, self._built(level + 1, mask, counts, none), self._built(level + 1, mask | self.bit[name], counts, none)))

    def node(self, made: tuple) -> tuple:
        """The one node equal to this; nodes are held for good, so that their identity is their name."""
        key = made if made[0] == "leaf" else (made[0], id(made[1]), id(made[2]))
        if key not in self.nodes:
            self.nodes[key] = made
            self.sums[id(made)] = made[1] if made[0] == "leaf" else tuple(a + b for a, b in zip(self.sums[id(made[1])], self.sums[id(made[2])], strict=True))
        return self.nodes[key]

    def below(self, node: tuple) -> tuple[int, ...]:
        return self.sums[id(node)]

    def swap(self, level: int) -> None:
        """Exchanges the variables of level and the next; only nodes from the root down to these two levels are made anew."""
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        done: dict[int, tuple] = {}

        def moved(node: tuple, depth: int) -> tuple:
            if id(node) not in done:
                x, low, high = node
                if depth < level:
                    new = self.node((x, moved(low, depth + 1), moved(high, depth + 1)))
                else:
                    y = low[0]
                    new = self.node((y, self.node((x, low[1], high[1])), self.node((x, low[2], high[2]))))
                done[id(node)] = new
            return done[id(node)]

        self.root = moved(self.root, 0)

    def all_pass(self) -> Iterator[tuple[str, tuple, tuple]]:
        """(filter, counts kept, counts removed) at each level of the path on which all filters pass."""
        node = self.root
        while node[0] != "leaf":
            yield node[0], self.below(node[1]), self.below(node[2])
            node = node[1]


def neighbour_swaps(n: int) -> Iterator[int]:
    """Positions k of swaps (k, k + 1) that take n things through all their orders, each once."""
    if n > 1:
        inner = neighbour_swaps(n - 1)
        down = True
        while True:
            yield from range(n - 2, -1, -1) if down else range(n - 1)
            k = next(inner, None)
            if k is None:
                return
            yield k + down  # the last thing stands before the others, or behind them
            down = not down


def audit_of(counts: dict[int, tuple[int, int, int]], filters: str = FILTERS) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders of filters.

    counts are documents, good ones and toxic ones by mask.
    """
    diagram = Diagram(filters, counts, 3)
    fails = {name: sum(c[0] for mask, c in counts.items() if mask >> k & 1) for k, name in enumerate(filters)}
    alone = {name: counts.get(1 << k, (0, 0, 0))[0] for k, name in enumerate(filters)}
    rows, shapley = [], dict.fromkeys(filters, 0)

    def visit() -> None:
        order = "".join(diagram.order)
        for step, (name, kept, gone) in enumerate(diagram.all_pass(), 1):
            shapley[name] += gone[0]
            rows.append((order, step, kept[0], gone[0], fails[name] - gone[0], alone[name], gone[1], gone[2]))

    visit()
    for level in neighbour_swaps(len(filters)):
        diagram.swap(level)
        visit()
    return [(*row, shapley[row[0][row[1] - 1]]) for row in rows]


AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What the filters of FILTERS remove from docs (doc_id, text, source), by part, order and step.

    One row, zeros included, for each part, each of the 120 orders of the filters and each step (from 1) of it: documents kept
    after the step, removed by it, failing its filter but removed before (redundant), failing its filter alone,
    removed by it though of quality 1 in labels (good_lost), or toxic 1 (toxic_lost), and the filter's removals
    summed over all orders (shapley). See failure_masks for the filters, and for rows with nulls.

    Repeated rows count each. An id that is labelled several times is good, or toxic, if one of its labels says so;
    a row without an id has no label. Other columns are ignored; an empty table gives no rows. Texts are worked on one
    at a time by functions of Spark, a text's words are in memory at once. What comes to a task of the audit are at most 32 counts a part.
    """
    known = given(labels, doc_id="long", quality="int", toxic="int").where("doc_id is not null")
    known = known.groupBy("doc_id").agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows = failure_masks(docs).join(known.where("good or toxic"), "doc_id", "left")
    sums = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    parts = sums.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))  # 32 masks at most
    names = [c.split()[0] for c in AUDIT.split(", ")]

    def audit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, counts in zip(batch.part, batch.counts, strict=True):
                found = audit_of({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in counts})
                yield pd.DataFrame([(part, *row) for row in found], columns=names)

    return parts.mapInPandas(audit, AUDIT)
