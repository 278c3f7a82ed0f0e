"""Equi joins of boxes on a grid of several levels, the cells of each twice as wide as those of the one below.

A box is at home at the lowest level whose cells are as wide as it, where it touches four cells at most, however the
sizes of boxes differ. It visits the cells of wider boxes of the other side, so two boxes meet at the home of the wider.
Expressions are SQL text over the name of a box column (struct x0, y0, x1, y1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Side of a cell of level 0; a power of two, so that finding cells does not round.
FINEST = 2.0**-16
#: Boxes that reach further from the origin, or are not finite, meet nothing.
FURTHEST = 2.0**40


def bounded(box: str) -> str:
    return f"coalesce({box}.x0 >= -{FURTHEST}D and {box}.y0 >= -{FURTHEST}D and {box}.x1 <= {FURTHEST}D and {box}.y1 <= {FURTHEST}D, false)"


def level_of(size: str, finest: float = FINEST) -> str:
    return f"cast(greatest(0, coalesce(ceil(log2(({size}) / {finest!r}D)), 0)) as int)"


def level(box: str, finest: float = FINEST) -> str:
    return level_of(f"greatest({box}.x1 - {box}.x0, {box}.y1 - {box}.y0)", finest)


def at(value: str, k: str, finest: float = FINEST) -> str:
    """The row or column of cells of level k that a coordinate is in."""
    return f"floor(({value}) / ({finest!r}D * shiftleft(1L, {k})))"


def cells(box: str, k: str, more: str = "", finest: float = FINEST) -> str:
    """Cells of level k that the box touches, as structs (k, cx, cy) and what more says."""
    columns, rows = (f"sequence({at(f'{box}.{c}0', k, finest)}, {at(f'{box}.{c}1', k, finest)})" for c in "xy")
    return f"flatten(transform({columns}, cx -> transform({rows}, cy -> struct({k} as k, cx as cx, cy as cy{more}))))"


def mask(level: str) -> str:
    """A level, of which there are some fifty, as one bit."""
    return f"shiftleft(1L, {level})"


def levels(df: DataFrame, **masks: str) -> dict[str, list[int]]:
    """The levels in the masks of all rows of df, by name; one small job for all."""
    row = df.agg(*[F.expr(f"coalesce(bit_or({m}), 0L)").alias(name) for name, m in masks.items()]).first()
    return {name: [k for k in range(64) if row[name] >> k & 1] for name in masks}


def meeting_boxes(left: DataFrame, right: DataFrame, at_left: list[int], at_right: list[int], few: bool = False) -> DataFrame:
    """left x right where the boxes __lb and __rb overlap or touch, each pair once.

    at_left and at_right are the levels of the two sides; few says that right has been counted and may be broadcast.
    The shuffle is by cell, whose skew adaptive execution splits.
    """
    no, yes = ", false as home", ", true as home"
    listed = lambda ks: f"cast(array({', '.join(map(str, ks))}) as array<int>)"
    wider = lambda box, others, home: f"flatten(transform(filter({listed(others)}, k -> k > __k), k -> {cells(box, 'k', home)}))"
    keyed = lambda df, box, *keys: df.where(bounded(box)).withColumn("__k", F.expr(level(box))).withColumn("__cell", F.expr(f"explode(concat({', '.join(keys)}))")).drop("__k")
    shown = keyed(right, "__rb", cells("__rb", "__k", yes), cells("__rb", "__k", no), wider("__rb", at_left, yes))
    met = keyed(left, "__lb", cells("__lb", "__k", yes), wider("__lb", at_right, no)).join(F.broadcast(shown) if few else shown, "__cell")
    overlap = "__lb.x0 <= __rb.x1 and __rb.x0 <= __lb.x1 and __lb.y0 <= __rb.y1 and __rb.y0 <= __lb.y1"
    first = [f"__cell.c{c} = {at(f'greatest(__lb.{c}0, __rb.{c}0)', '__cell.k')}" for c in "xy"]  # of the cells that both touch, one counts
    return met.where(" and ".join([overlap, *first])).drop("__cell")
