"""Exact search for vectors of a cosine of at least a threshold, as a metric range join.

On unit vectors a cosine of c is a distance of r = sqrt(2 - 2c). Pivots, drawn for each large label, deal its
distinct vectors into cells, each vector home in that of its nearest pivot p. By the triangle inequality a vector
has to visit the cell of q only if d(q) - d(p) <= 2r, and if d(q) is within r of the cell's outermost home vector.
Unit vectors lie in a Euclidean space, where the first bound is sharper: the vector is at least
(d(q)^2 - d(p)^2) / 2d(p, q) away from all that are nearer to q, and that must be at most r. Cells are joined
independently, large ones as pairs of blocks; within a block pair local pivots and the same bounds leave a part
of the products to be computed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraops.llm.blocks import block_pairs, mixed
from terraops.llm.common import given, written
from terraops.llm.graph import Forest, components

#: Home vectors aimed at in a cell, cells aimed at in all (larger tables have larger cells), most rows in one block of a cell.
CELL, CELLS, BLOCK = 4_096, 2_048, 8_192
#: Vectors to a local pivot of a block.
LOCAL = 128
#: Bounds are widened by this much against rounding.
SLACK = 1e-9


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _unit(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(1, keepdims=True)  # else squares of extreme components overflow
    return matrix / np.sqrt((matrix * matrix).sum(1, keepdims=True))


class Cells:
    """Pivots (unit rows) and the distance of the outermost home vector from each, infinite unless it is known."""

    def __init__(self, pivots: np.ndarray, reach: np.ndarray | None = None):
        self.pivots = pivots
        self.reach = np.full(len(pivots), np.inf) if reach is None else reach
        self.apart = np.maximum(_distances(pivots, pivots), 1e-12)

    def homes(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each vector's distances from all pivots, the nearest pivot, and the distance from that."""
        far = _distances(units, self.pivots)
        home = far.argmin(1)
        return far, home, far[np.arange(len(far)), home]

    def visits(self, far: np.ndarray, home: np.ndarray, own: np.ndarray, radius: float) -> np.ndarray:
        """Which cells may hold a vector within radius of each; its own among them."""
        plane = (far * far - (own * own)[:, None]) / (2 * self.apart[home])
        out = (far - own[:, None] <= 2 * radius + SLACK) & (plane <= radius + SLACK) & (far <= self.reach + radius + SLACK)
        out[np.arange(len(far)), home] = True
        return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * a @ b.T))


def near_pairs(left: np.ndarray, right: np.ndarray, cosine: float, count: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of unit rows of left and right with a cosine of at least the threshold, in portions.

    count, if given, gets the number of products that the bounds left.
    """
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    local = Cells(right[np.linspace(0, len(right) - 1, max(1, len(right) // LOCAL)).astype(int)])
    _, home, own = local.homes(right)
    order = np.argsort(home, kind="stable")
    ends = np.searchsorted(home[order], np.arange(len(local.pivots) + 1))
    local.reach = np.array([own[order[a:b]].max(initial=-np.inf) for a, b in zip(ends, ends[1:], strict=False)])
    for begin in range(0, len(left), 4_096):
        rows = left[begin : begin + 4_096]
        visits = local.visits(*local.homes(rows), radius)
        for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
            who = np.flatnonzero(visits[:, k])
            if b > a and len(who):
                if count is not None:
                    count.append(len(who) * (b - a))
                i, j = np.nonzero(rows[who] @ right[order[a:b]].T >= cosine)
                yield begin + who[i], order[a:b][j]


def _portions(batch: pd.DataFrame, rows: int = 2_048) -> Iterator[tuple[tuple[int, int], pd.DataFrame]]:
    """Rows of one label and length at a time, with these two."""
    for key, same in batch.groupby([batch.label, batch.vec.map(len)]):
        for k in range(0, len(same), rows):
            yield key, same.iloc[k : k + rows]


def drawn_pivots(distinct: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Pivots by label and length, for those with more than one cell's vectors.

    At most CELLS labels are that large, and about 2 * CELLS vectors are drawn, whatever the input.
    """
    sizes = distinct.groupBy("label", F.size("vec").alias("size")).agg(F.count("*").alias("n")).alias("s")
    total = written(sizes, "sizes")
    cell = max(CELL, (total.agg(F.sum("n")).first()[0] or 0) // CELLS)
    large = total.where(F.col("n") > cell).withColumn("cells", F.ceil(F.col("n") / cell))
    chance = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 30)) < F.col("cells") / F.col("n") * (1 << 30)
    rows = distinct.withColumn("size", F.size("vec")).join(F.broadcast(large), ["label", "size"]).where(chance)
    found: dict[tuple[int, int], list] = {}
    for r in rows.select("label", "size", "vec", "node").orderBy("label", "size", "node").collect():
        found.setdefault((r["label"], r["size"]), []).append(r["vec"])
    return {key: np.unique(_unit(np.array(v, np.float64)), axis=0) for key, v in found.items()}


def vector_links(distinct: DataFrame, cosine: float) -> DataFrame:
    """(node, n_links, least): links of stored rows (node, label, vec, weight), in portions to be summed.

    n_links is the weight of the linked nodes met in one block pair, least a node of its group there.
    """
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    cells = {key: Cells(pivots) for key, pivots in drawn_pivots(distinct).items()}

    def homes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, part in _portions(batch):
                if key in cells:
                    _, home, own = cells[key].homes(_unit(_matrix(part.vec)))
                    out = pd.DataFrame({"label": key[0], "size": key[1], "cell": home, "far": own})
                    yield out.groupby(["label", "size", "cell"], as_index=False).far.max()

    reach = distinct.select("label", "vec").mapInPandas(homes, "label long, size long, cell long, far double").groupBy("label", "size", "cell").agg(F.max("far").alias("far"))
    for key, own in cells.items():
        own.reach = np.full(len(own.pivots), -np.inf)
    for r in reach.collect():  # a row a cell
        cells[r["label"], r["size"]].reach[r["cell"]] = r["far"]

    def routed(key: tuple[int, int], part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, home): a vector is at home in one cell and visits later ones; the other of a pair is there or visits it."""
        n = len(part)
        if key not in cells:
            return np.arange(n), np.zeros(n, np.int64), np.ones(n, bool)
        far, home, own = cells[key].homes(_unit(_matrix(part.vec)))
        row, cell = np.nonzero(cells[key].visits(far, home, own, radius) & (np.arange(far.shape[1])[None, :] > home[:, None]))
        return np.append(np.arange(n), row), np.append(home, cell), np.arange(n + len(row)) < n

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, part in _portions(batch):
                _, cell, home = routed(key, part)
                out = pd.DataFrame({"label": key[0], "size": key[1], "cell": cell, "home": home, "n": 1})
                yield out.groupby(["label", "size", "cell", "home"], as_index=False).n.sum()

    counts = distinct.select("label", "vec").mapInPandas(counted, "label long, size long, cell long, home boolean, n long").groupBy("label", "size", "cell", "home").agg(F.sum("n").alias("n"))
    blocks = {(r["label"], r["size"], r["cell"], r["home"]): -(-r["n"] // BLOCK) for r in counts.where(F.col("n") > BLOCK).collect()}  # cells above BLOCK rows only

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each row to every block pair that it is in: home blocks meet each other, and each visitors' block."""
        for batch in batches:
            for (label, size), part in _portions(batch):
                row, cell, home = routed((label, size), part)
                many = np.array([[blocks.get((label, size, c, own), 1) for own in (False, True)] for c in cell.tolist()], np.int64).reshape(-1, 2)
                at, guest, low, high, right = block_pairs(mixed(part.node.to_numpy(np.int64)[row]), home, many[:, 1], many[:, 0])
                out = part.iloc[row[at]][["label", "node", "weight", "vec"]]
                yield out.assign(size=size, cell=cell[at], guest=guest, low=low, high=high, right=right)

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        units, weight, node = _unit(_matrix(rows.vec)), rows.weight.to_numpy(np.int64), rows.node.to_numpy(np.int64)
        right = rows.right.to_numpy(bool)
        same = not rows.guest.iloc[0] and rows.low.iloc[0] == rows.high.iloc[0]
        left, others = (np.arange(len(rows)),) * 2 if same else (np.flatnonzero(~right), np.flatnonzero(right))
        found, forest = np.zeros(len(rows), np.int64), Forest(len(rows))
        for i, j in near_pairs(units[left], units[others], cosine) if len(left) and len(others) else ():
            i, j = left[i], others[j]
            i, j = (i[i < j], j[i < j]) if same else (i, j)
            if len(i):
                np.add.at(found, i, weight[j])
                np.add.at(found, j, weight[i])
                forest.join_all(i, j)
        met = found > 0
        return pd.DataFrame({"node": node[met], "n_links": found[met], "least": node[forest.roots()[met]]})

    kind = dict(distinct.dtypes)["vec"]
    dealt = distinct.select("node", "label", "vec", "weight").mapInPandas(deal, f"label long, node long, weight long, vec {kind}, size long, cell long, guest boolean, low long, high long, right boolean")
    return dealt.groupBy("label", "size", "cell", "guest", "low", "high").applyInPandas(join, "node long, n_links long, least long")


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, embedding, label).

    Rows link if their labels are equal and not null, their vectors are equally long and the cosine, in double
    precision, is at least the threshold. n_links counts other rows, copies among them; component_id is the
    smallest vec_id that links reach; kept tells whether it is the row's own. Vectors that are null, empty or
    zero or hold null or non-finite components, and rows without a label, link with nothing. A row with a null
    vec_id is linked but lends no id: its component_id is null only if its whole group has none, and kept is
    then true. Repeated rows count as copies. Other columns are ignored; an empty table gives no rows. Rows find
    their vector's figures again by its label and 128 bits of its hash.
    """
    kind = "array<float>" if ("embedding", "array<float>") in vectors.dtypes else "array<double>"
    rows = given(vectors, vec_id="long", embedding=kind, label="long").withColumnRenamed("embedding", "vec")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(F.col("label").isNotNull() & (F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    keys = {"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(1), "vec")}
    distinct = rows.where(sound).groupBy("label", "vec").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"))
    distinct = written(distinct.withColumn("node", F.monotonically_increasing_id()).withColumns(keys), "vectors")
    found = written(vector_links(distinct, cosine), "links")
    totals = found.groupBy("node").agg(F.sum("n_links").alias("n"))
    roots = components(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    named = distinct.drop("vec").join(totals, "node", "left").join(roots, "node", "left")
    named = written(named.select("label", "k1", "k2", "first_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")), "named")
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(ids, "root").select("label", "k1", "k2", "n_links", "component_id")
    linked = rows.where(sound).withColumns(keys).drop("vec").join(named, ["label", "k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
