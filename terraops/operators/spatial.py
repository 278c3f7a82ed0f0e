"""Spatial joins as equi joins on cells of a grid with an exact test after them, and clipping by segments and edges."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraops.functions import geo
from terraops.operators import grid
from terraops.operators.index import dense_index, first_per_key
from terraops.schemas import PARTS
from terraops.storage import stored

#: Polygons, or edges, are broadcast if their corners, counted once for each cell, are at most so many; else they are shuffled by cell.
BROADCAST_CORNERS = 1_000_000


def in_box(x: Column, y: Column, box: Column) -> Column:
    return (x >= box.x0) & (x <= box.x1) & (y >= box.y0) & (y <= box.y1)


def points_in_polygons(points: DataFrame, polygons: DataFrame, rings: str = "rings", cell: float | None = None) -> DataFrame:
    """points x polygons where the point (x, y) lies inside by the even-odd rule over all rings.

    Each polygon has at most four cells, of the level of its own box (cell is the side of the smallest cells, if
    given), and a point has one cell at each level that polygons have, so a pair meets once whatever mix of sizes
    there is. One small job counts corners by level when the plan is made: the widest levels, whose cells hold the
    most points, are broadcast while their corners are counted to be few; finer ones shuffle by cell, where adaptive
    execution splits a cell with many points. Columns of both sides are kept and must not clash. Polygons with
    a corner that is not finite, or without corners, and points without x or y are in no pair.
    """
    finest = cell or grid.FINEST
    shapes = polygons.withColumn("__box", geo.box(F.flatten(F.col(rings)))).where(grid.bounded("__box")).withColumn("__level", F.expr(grid.level("__box", finest)))
    cells = F.expr(grid.cells("__box", "__level", finest=finest))
    corners = F.size(F.flatten(F.col(rings))).cast("long") * F.size(cells)
    wide, fine, total = [], [], 0
    for k, n in sorted(((r[0], r[1]) for r in shapes.groupBy("__level").agg(F.sum(corners)).collect()), reverse=True):  # a row a level
        total += n
        (wide if total <= BROADCAST_CORNERS else fine).append(k)
    located = points.where("x is not null and y is not null")
    parts = []
    for own, few in ((wide, True), (fine, False)):
        if own or (few and not fine):
            keys = ", ".join(f"struct({k} as k, {grid.at('x', str(k), finest)} as cx, {grid.at('y', str(k), finest)} as cy)" for k in own or [0])
            shown = shapes.where(F.col("__level").isin(own)).withColumn("__cell", F.explode(cells))
            met = located.withColumn("__cell", F.expr(f"explode(array({keys}))")).join(F.broadcast(shown) if few else shown, "__cell").where(in_box(F.col("x"), F.col("y"), F.col("__box")))
            parts.append(met.where(geo.in_rings(F.col("x"), F.col("y"), F.col(rings))).drop("__cell", "__box", "__level"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def first_flattened(polygons: DataFrame, name: str, position: str) -> DataFrame:
    """The first polygon of each name, its rings run together into one: how the old country filter saw them."""
    first = first_per_key(polygons.select(name, position, "rings"), [name], position)
    return first.withColumn("rings", F.array(F.flatten("rings")))


def within_radius(points: DataFrame, centres: DataFrame, sides: int = 6) -> DataFrame:
    """points x centres (lat, lon, radius_km) where the point lies in the polygon about the centre.

    Polygons over the date line are split there and those about a pole are closed over it; points beyond 180 degrees
    either way are found where they are on the globe.
    """
    ring = geo.circle(F.col("lat"), F.col("lon"), F.col("radius_km"), sides)
    shapes = stored(centres.withColumn("rings", geo.wrapped_rings(ring)), "circles")
    x = F.col("x")
    turned = points.withColumn("__x", x).withColumn("x", F.when(x >= 180, x - 360).when(x < -180, x + 360).otherwise(x))
    found = points_in_polygons(turned, shapes).withColumn("x", F.col("__x"))
    return found.select(*points.columns, *[c for c in centres.columns if c not in points.columns])


def within_hits(points: DataFrame, hits: DataFrame, position: str) -> DataFrame:
    """points inside the ring that the hits, in the order of position, make: the second stage of the old search.

    A point is inside if an odd number of the ring's edges lie to its right; position names a point. The ring's box is
    dealt into about as many rows, and as many columns, as the root of its corners. An edge that goes through a
    whole row lies right of all cells before it there, which are counted and not met; it meets the points of the
    cells that it touches in that row, and in the rows of its two ends all points. So with edges as long as the box, n corners
    and n points meet about n^1.5 times in place of n^2. Hits are numbered and counted when the plan is made.
    """
    corners = dense_index(hits.select(position, "x", "y"), position, name="__k").select("__k", F.struct("x", "y").alias("__a"))
    n, box = corners.agg(F.count("*"), F.struct(F.min("__a.x").alias("x0"), F.min("__a.y").alias("y0"), F.max("__a.x").alias("x1"), F.max("__a.y").alias("y1"))).first()
    if n < 3:
        return points.limit(0)
    rows = max(1, min(4_096, math.isqrt(n)))
    slack = 1e-9 * max(1.0, abs(box.x0), abs(box.x1), box.x1 - box.x0)
    at = lambda v, c: f"cast(least({rows - 1}, greatest(0, floor((({v}) - {box[f'{c}0']!r}D) / {max((box[f'{c}1'] - box[f'{c}0']) / rows, 1e-300)!r}D))) as int)"
    crossing = lambda y: f"(__a.x - __b.x) * ({y} - __b.y) / (__a.y - __b.y) + __b.x"
    ends = corners.select(F.pmod(F.col("__k") - 1, F.lit(n)).alias("__k"), F.col("__a").alias("__b"))
    edges = corners.join(ends, "__k").where("__a.y <> __b.y").selectExpr("__a", "__b", f"{at('least(__a.y, __b.y)', 'y')} as low", f"{at('greatest(__a.y, __b.y)', 'y')} as high")
    pieces = edges.where("high > low + 1").select("*", F.expr("explode(sequence(low + 1, high - 1))").alias("row"))
    bound = [crossing(f"({box.y0!r}D + (row + {k}) * {(box.y1 - box.y0) / rows!r}D)") for k in (-0.001, 1.001)]  # a little beyond the row, for rounding
    pieces = pieces.selectExpr("row", "__a", "__b", f"{at(f'least({bound[0]}, {bound[1]}) - {slack!r}D', 'x')} as first", f"{at(f'greatest({bound[0]}, {bound[1]}) + {slack!r}D', 'x')} as last")
    right = pieces.groupBy("row", "first").agg(F.count("*").alias("n")).where("first > 0").select("row", "n", F.expr("explode(sequence(0, first - 1))").alias("col")).groupBy("row", "col").agg(F.sum("n").alias("n"))
    placed = points.where(f"y >= {box.y0!r}D and y <= {box.y1!r}D").selectExpr(position, "x", "y", f"{at('y', 'y')} as row", f"{at('x', 'x')} as col")
    odd = f"((__b.y > y) <> (__a.y > y)) and x < {crossing('y')}"
    touched = placed.join(pieces.select("row", "__a", "__b", F.expr("explode(sequence(first, last))").alias("col")), ["row", "col"]).where(odd)
    ended = placed.join(edges.select("__a", "__b", F.explode(F.array_distinct(F.array("low", "high"))).alias("row")), "row").where(odd)
    one = [position, "1L as n"]
    met = placed.join(right, ["row", "col"]).select(position, "n").union(touched.selectExpr(*one)).union(ended.selectExpr(*one))
    inner = met.groupBy(position).agg(F.sum("n").alias("__n")).where("__n % 2 = 1")
    return points.join(inner.select(position), position, "left_semi")


def inside(x: np.ndarray, y: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """Even-odd rule for many points and one shape."""
    odd = np.zeros(len(x), bool)
    for ring in rings:
        b, a = np.roll(ring, -1, 0), ring
        spans = (b[:, 1][None, :] > y[:, None]) != (a[:, 1][None, :] > y[:, None])
        with np.errstate(divide="ignore", invalid="ignore"):
            left = x[:, None] < (a[:, 0] - b[:, 0])[None, :] * (y[:, None] - b[:, 1][None, :]) / (a[:, 1] - b[:, 1])[None, :] + b[:, 0][None, :]
        odd ^= (spans & left).sum(1) % 2 == 1
    return odd


def _finite(p: Column) -> Column:
    return F.coalesce((F.abs(p.x) < float("inf")) & (F.abs(p.y) < float("inf")), F.lit(False))


def _numbered(shapes: DataFrame, points: Column, row: str, box: str) -> DataFrame:
    """shapes with a row number, stored once so that it stays, the box of its points, and whether all of these are finite."""
    sound = F.forall(points, _finite)
    return stored(shapes.withColumns({row: F.monotonically_increasing_id(), box: geo.box(F.filter(points, _finite)), "__sound": sound, "__corners": F.size(points).cast("long")}), "shapes")


#: Lines that are dealt over all cores before they are cut; more fill several files, and so tasks, as they are.
SMALL = 1_000_000
#: Where along a segment it is found out whether it is inside: not where shapes are likely to have their edges.
KNOWN = 0.4871093261
#: SQL of the level of an edge's height.
HEIGHT = grid.level_of("abs(__a.y - __b.y)")


def odd_to_the_right(points: DataFrame, edges: DataFrame, keys: list[str], group: list[str], heights: list[int], few: bool = False, besides: str = "false") -> DataFrame:
    """keys of the points (keys, __x, __y) that an odd number of their group's edges lie right of.

    group is among the keys. edges are (group, __a, __b); heights are their levels. An edge has at most two intervals
    of y, of the level of its own height, and a point one at each level that edges have, so a point meets
    the edges about its own y only, whatever the heights. few says that the edges may be broadcast; besides is SQL
    of a point and an edge that holds where the edge does not count, though it may seem to.
    """
    ends = [grid.at(f"{f}(__a.y, __b.y)", "__k") for f in ("least", "greatest")]
    tall = edges.where("__a.y <> __b.y").withColumn("__k", F.expr(HEIGHT)).withColumn("__at", F.expr(f"explode(sequence({', '.join(ends)}))"))
    tall = tall.select(*group, "__k", "__at", "__a", "__b")
    bands = F.expr(f"explode(transform(cast(array({', '.join(map(str, heights))}) as array<int>), k -> struct(k as __k, {grid.at('__y', 'k')} as __at)))")
    met = points.withColumn("__band", bands).select(*points.columns, "__band.*").join(F.broadcast(tall) if few else tall, [*group, "__k", "__at"])
    met = met.where("((__b.y > __y) <> (__a.y > __y)) and __x < (__a.x - __b.x) * (__y - __b.y) / (__a.y - __b.y) + __b.x").where(f"not ({besides})")
    return met.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n % 2 = 1").drop("__n")


def clip(lines: DataFrame, polygons: DataFrame, line_id: str, polygon_id: str, keep_polygon: bool = False) -> DataFrame:
    """The parts of each line (path) inside each polygon (rings): one row per pair that meets, with parts, ok and error.

    Columns of the lines are kept and the polygon's id is added; keep_polygon keeps its other columns too (an overlay).
    Rows are known by numbers of their own, so ids may be null or repeated: a row gives its own pairs. A line with
    fewer than two points and a polygon without a ring of three corners meet nothing. If a line or a polygon holds
    a coordinate that is missing or not finite, the pairs of its box have ok = false, null parts and the error.

    Segments of lines meet edges of polygons on the cells of a grid of several levels and are cut where they cross.
    A segment is inside at one place if an odd number of edges lie right of that, which is an aggregate, and its
    pieces follow from the edges in between; they are put together again by row number. No ring travels with a
    pair: a task holds single segments and edges, the cuts of one line by one polygon, and in the end the parts of
    one row. Lines and polygons are stored and counted when the plan is made; the edges are broadcast if they are few.
    """
    left = _numbered(lines.where(F.size("path") > 1), F.col("path"), "__l", "__lb")
    right = _numbered(polygons.where("exists(rings, r -> size(r) > 2)"), F.flatten("rings"), "__p", "__rb")
    if left.count() <= SMALL:  # a small table is one file, and would be one task
        left = left.repartition(lines.sparkSession.sparkContext.defaultParallelism, "__l")
    box = "struct(least({0}.x, {1}.x) as x0, least({0}.y, {1}.y) as y0, greatest({0}.x, {1}.x) as x1, greatest({0}.y, {1}.y) as y1)"
    segments = left.where("__sound").select("__l", "path", F.expr("posexplode(slice(path, 2, size(path) - 1))").alias("__s", "__to"))
    segments = segments.select("__l", "__s", F.expr("path[__s]").alias("__from"), "__to").withColumn("__lb", F.expr(box.format("__from", "__to")))
    edges = right.where("__sound").select("__p", F.expr("explode(filter(rings, r -> size(r) > 2))").alias("r")).select("__p", "r", F.expr("posexplode(r)").alias("k", "__a"))
    edges = edges.select("__p", "__a", F.expr("r[(k + 1) % size(r)]").alias("__b")).withColumn("__rb", F.expr(box.format("__a", "__b")))
    boxes = right.where("__sound").select("__p", "__rb")

    span = "greatest(abs({0}.x - {1}.x), abs({0}.y - {1}.y))"
    bits = lambda ks, size: f"aggregate({ks}, 0L, (m, k) -> m | {grid.mask(grid.level_of(size))})"
    round_ = lambda size: f"aggregate(filter(rings, r -> size(r) > 2), 0L, (n, r) -> n | {bits('sequence(0, size(r) - 1)', size.format('r[k]', 'r[(k + 1) % size(r)]'))})"
    own = lambda box: f"if({grid.bounded(box)}, {grid.mask(grid.level(box))}, 0L)"
    at = grid.levels(left, segments=f"if(__sound, {bits('sequence(1, size(path) - 1)', span.format('path[k - 1]', 'path[k]'))}, 0L)", lines=own("__lb"), bad=f"if(__sound, 0L, {own('__lb')})")
    at |= grid.levels(right, edges=f"if(__sound, {round_(span)}, 0L)", heights=f"if(__sound, {round_('abs({0}.y - {1}.y)')}, 0L)", polygons=own("__rb"), boxes=f"if(__sound, {own('__rb')}, 0L)", flawed=f"if(__sound, 0L, {own('__rb')})")
    corners = right.agg(F.coalesce(F.sum("__corners"), F.lit(0))).first()[0]
    few = corners * 4 * (2 + len(at["segments"])) <= BROADCAST_CORNERS
    near = grid.meeting_boxes(segments, boxes, at["segments"], at["boxes"], few)
    x, y = (f"__from.{c} + (__to.{c} - __from.{c}) * {KNOWN}D" for c in "xy")
    names = ["__l", "__p", "__s"]
    turned = "((__to.x - __from.x) * ({0}.y - __from.y) - (__to.y - __from.y) * ({0}.x - __from.x))"
    along = f"{turned.format('__a')} = 0 and {turned.format('__b')} = 0"  # the segment lies on the edge, so it is not right of it
    inner = odd_to_the_right(near.selectExpr(*names, f"{x} as __x", f"{y} as __y", "__from", "__to"), edges, names, ["__p"], at["heights"], few, along)
    # an edge with its ends on either side of the segment changes what is inside; a corner on the segment counts as if that
    # were moved a little to the right, and less up, as the test for edges to the right has it too
    cross, wx, wy = "((__to.x - __from.x) * (__b.y - __a.y) - (__to.y - __from.y) * (__b.x - __a.x))", "(__a.x - __from.x)", "(__a.y - __from.y)"
    t, u = f"({wx} * (__b.y - __a.y) - {wy} * (__b.x - __a.x)) / {cross}", f"({wx} * (__to.y - __from.y) - {wy} * (__to.x - __from.x)) / {cross}"
    side = f"({turned} > 0 or ({turned} = 0 and (__to.y > __from.y or (__to.y = __from.y and __to.x < __from.x))))"
    met = grid.meeting_boxes(segments, edges, at["segments"], at["edges"], few).where(f"{cross} <> 0")
    met = met.selectExpr(*names, f"{t} as t", f"{u} as u", f"cast({side.format('__a')} <> {side.format('__b')} as int) as flip").where("t > 0 and t < 1 and (flip = 1 or u >= 0 and u <= 1)").drop("u")
    rows = near.selectExpr(*names, "0D as t", "0 as flip", "struct(__from, __to) as e").unionByName(met, allowMissingColumns=True)
    rows = rows.unionByName(inner.selectExpr(*names, "-1D as t", "1 as odd"), allowMissingColumns=True).repartition("__l", "__p")
    # from each cut to the next; whether it is inside follows from one place of the segment and the edges in between
    segment = Window.partitionBy(*names)
    along = segment.orderBy("t")
    before = F.coalesce(F.sum(F.when(F.col("t") < KNOWN, F.col("flip"))).over(segment), F.lit(0)) + F.coalesce(F.max("odd").over(segment), F.lit(0))
    flips = F.coalesce(F.sum("flip").over(along.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    # the row that says so stands before all others
    pieces = rows.select(*names, "t", F.coalesce(F.lead("t").over(along), F.lit(1.0)).alias("t1"), F.max("e").over(segment).alias("e"), ((flips + before) % 2).alias("inside"))
    ends = ", ".join(f"struct({', '.join(f'e.__from.{c} + (e.__to.{c} - e.__from.{c}) * {v} as {c}' for c in 'xy')}) as {name}" for v, name in (("t", "__begin"), ("t1", "__end")))
    kept = pieces.where("inside = 1 and t >= 0 and t1 > t").select(*names, F.col("t").alias("__t"), F.expr(f"struct({ends}) as v")).select(*names, "__t", "v.*")
    order = Window.partitionBy("__l", "__p").orderBy("__s", "__t")
    apart = F.when(F.lag("__end").over(order) == F.col("__begin"), 0).otherwise(1)
    kept = kept.withColumn("__new", apart).withColumn("__part", F.sum("__new").over(order))
    points = F.sort_array(F.collect_list(F.struct("__s", "__t", "__begin", "__end")))
    whole = kept.groupBy("__l", "__p", "__part").agg(points.alias("v")).select("__l", "__p", "__part", F.concat(F.array(F.col("v")[0]["__begin"]), F.transform("v", lambda v: v["__end"])).alias("points"))
    parts = whole.groupBy("__l", "__p").agg(F.transform(F.sort_array(F.collect_list(F.struct("__part", "points"))), lambda v: v.points).alias("parts"))
    parts = parts.select("__l", "__p", "parts", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error"))

    pairs = [(left.where("not __sound"), right, "bad", "polygons")] * bool(at["bad"]) + [(left.where("__sound"), right.where("not __sound"), "lines", "polygons")] * bool(at["flawed"])
    for some, others, k, m in pairs:
        wrong = grid.meeting_boxes(some.select("__l", "__lb"), others.select("__p", "__rb"), at[k], at[m])
        error = F.lit("a coordinate is missing or not finite").alias("error")
        parts = parts.unionByName(wrong.select("__l", "__p", F.lit(None).cast(PARTS).alias("parts"), F.lit(False).alias("ok"), error))
    ids = right.select("__p", *([c for c in polygons.columns if c != "rings"] if keep_polygon else [polygon_id]))
    out = parts.join(left.select("__l", *lines.columns), "__l").join(F.broadcast(ids) if few and not keep_polygon else ids, "__p")
    return out.select(*lines.columns, *[c for c in ids.columns if c != "__p"], "parts", "ok", "error")


def parts_length(parts: Column) -> Column:
    return geo.total(F.transform(parts, geo.path_length))
