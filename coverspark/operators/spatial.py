"""Points, polygons and pixel tables. Spatial joins meet on grid cells, never on all pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from coverspark.operators.lists import renumbered
from coverspark.operators.order_stats import previous_in_group, with_quantiles
from coverspark.session import cut, ship


#: Rows of two numbers, counted before, that may be broadcast.
_BROADCAST_ROWS = 1_000_000
#: Ids of one place in a list, about.
_BLOCK = 128
#: Points per place, on average, that are clustered at once.
_VISITS = 8


def finite(*names: str) -> Column:
    """Whether all of these columns hold a number: no null, NaN or infinity."""
    return reduce(lambda a, b: a & b, (F.coalesce(~F.isnan(n) & (F.abs(F.col(n)) < float("inf")), F.lit(False)) for n in names))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point is inside a closed ring (array of structs x, y): odd number of edges to its right."""
    edges = F.arrays_zip(F.slice(ring, F.lit(1), F.size(ring) - 1).alias("a"), F.slice(ring, F.lit(2), F.size(ring) - 1).alias("b"))
    crossed = F.filter(edges, lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < e["a"]["x"] + F.try_divide((y - e["a"]["y"]) * (e["b"]["x"] - e["a"]["x"]), e["b"]["y"] - e["a"]["y"])))
    return F.size(crossed) % 2 == 1


def box_join(points: DataFrame, boxes: DataFrame, cell: float, how: str = "inner") -> DataFrame:
    """Points (x, y) with the boxes (min_x, max_x, min_y, max_y) that hold them, edges included on the low side.

    Each box is listed in the grid cells it touches; points meet it in their own cell.
    """
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    listed = boxes.withColumn("_cx", F.explode(span("min_x", "max_x"))).withColumn("_cy", F.explode(span("min_y", "max_y")))
    own = points.withColumns({"_px": F.floor(F.col("x") / cell), "_py": F.floor(F.col("y") / cell)})
    inside = (F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy")) & (F.col("x") >= F.col("min_x")) & (F.col("x") < F.col("max_x")) & (F.col("y") >= F.col("min_y")) & (F.col("y") < F.col("max_y"))
    joined = own.join(listed, inside, how)
    return joined.drop("_px", "_py", "_cx", "_cy") if how not in ("left_semi", "left_anti") else joined.drop("_px", "_py")


def ring_join(points: DataFrame, polygons: DataFrame, cell: float, how: str = "inner") -> DataFrame:
    """Points (x, y) with the polygons (ring: array of structs x, y, closed) that hold them, found over grid cells as in box_join."""
    xs, ys = F.transform("ring", lambda v: v["x"]), F.transform("ring", lambda v: v["y"])
    # a box is open on its high side, a ring's own test decides there
    boxed = polygons.withColumns({"min_x": F.array_min(xs), "max_x": F.array_max(xs) + cell, "min_y": F.array_min(ys), "max_y": F.array_max(ys) + cell})
    inside = in_ring(F.col("x"), F.col("y"), F.col("ring"))
    found = box_join(points, boxed, cell).where(inside).drop("min_x", "max_x", "min_y", "max_y")
    return found if how == "inner" else points.join(found.select("x", "y").distinct(), ["x", "y"], how)


def clip_touching(pixels: DataFrame, boxes: DataFrame, size: float, cell: float) -> DataFrame:
    """Pixels (low corner x, y, edge `size`) with every box that they touch; on its edge counts."""
    wider = boxes.withColumns({"min_x": F.col("min_x") - size, "min_y": F.col("min_y") - size, "max_x": F.col("max_x") + 1e-9, "max_y": F.col("max_y") + 1e-9})
    return box_join(pixels, wider, cell).drop("min_x", "max_x", "min_y", "max_y")


def rasterize(boxes: DataFrame, code: str, x0: float, y0: float, size: float, width: int, height: int) -> DataFrame:
    """(x, y, value) of a grid: the largest code of the boxes that touch a cell, 0 where none does."""
    spark = boxes.sparkSession
    last = lambda hi, at, n: F.least(F.floor((F.col(hi) - at) / size), F.lit(n - 1))
    span = lambda lo, hi, at, n: F.when(last(hi, at, n) >= F.greatest(F.floor((F.col(lo) - at) / size), F.lit(0)), F.sequence(F.greatest(F.floor((F.col(lo) - at) / size), F.lit(0)), last(hi, at, n)))
    rows = boxes.select(code, F.explode(span("min_x", "max_x", x0, width)).alias("x"), "min_y", "max_y").select(code, "x", F.explode(span("min_y", "max_y", y0, height)).alias("y"))
    grid = spark.range(width * height).select((F.col("id") % width).alias("x"), F.floor(F.col("id") / width).alias("y"), F.lit(0).cast("long").alias("value"))
    return rows.select("x", "y", F.col(code).cast("long").alias("value")).unionByName(grid).groupBy("x", "y").agg(F.max("value").alias("value"))


def pairs_within(points: DataFrame, distance: float, id_col: str = "id", digits: int | None = None) -> DataFrame:
    """(a, b, distance) of different points at most `distance` apart, a < b; cells of that size and their neighbours meet.

    Points of one place are lists of at most about _BLOCK ids. Only lists meet, each two once, so the distance (to `digits`, if given) is
    that of two places, however many points they have. Where a place has several lists, those that are near each other are dealt over
    all tasks before their pairs are spelt out. Points without an id or a finite place have no pairs.
    """
    parts = 4 * points.sparkSession.sparkContext.defaultParallelism
    known = points.where(F.col(id_col).isNotNull() & finite("x", "y")).select(F.col(id_col).alias("id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    sizes = cut(known.groupBy("x", "y").agg(F.ceil(F.count("*") / _BLOCK).alias("lists")))
    several = (sizes.agg(F.max("lists")).first()[0] or 0) > 1
    blocks = known.join(sizes, ["x", "y"]).groupBy("x", "y", F.pmod(F.xxhash64("id"), "lists").alias("k")).agg(F.collect_list("id").alias("ids"))
    blocks = cut(blocks.withColumns({"cx": F.floor(F.col("x") / distance), "cy": F.floor(F.col("y") / distance)}))
    ahead = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1))))
    own = blocks.select(F.struct("x", "y", "k").alias("p"), F.col("ids").alias("ids_p"), "cx", "cy").repartition(parts, "cx", "cy")
    other = blocks.select(F.struct("x", "y", "k").alias("q"), F.col("ids").alias("ids_q"), "cx", "cy", F.explode(ahead).alias("s"))
    other = other.select("q", "ids_q", (F.col("cx") - F.col("s.i")).alias("cx"), (F.col("cy") - F.col("s.j")).alias("cy"), ((F.col("s.i") == 0) & (F.col("s.j") == 0)).alias("same_cell"))
    d = F.hypot(F.col("p.x") - F.col("q.x"), F.col("p.y") - F.col("q.y"))
    near = own.join(other, ["cx", "cy"]).where((~F.col("same_cell") | (F.col("p") <= F.col("q"))) & (d <= distance))
    near = near.select("ids_p", "ids_q", (F.col("p") == F.col("q")).alias("same"), (d if digits is None else F.round(d, digits)).alias("distance"))
    if several:
        near = near.repartition(parts)
    pairs = near.select(F.explode("ids_p").alias("_p"), "ids_q", "same", "distance").select("_p", F.explode("ids_q").alias("_q"), "same", "distance")
    pairs = pairs.where((F.col("_p") < F.col("_q")) | (~F.col("same") & (F.col("_p") > F.col("_q"))))
    return pairs.select(F.least("_p", "_q").alias("a"), F.greatest("_p", "_q").alias("b"), "distance")


def earlier_neighbours(points: DataFrame, distance: float) -> DataFrame:
    """(ord, earlier, least): of each point (ord, x, y) at most 25 points before it within `distance`, by which its cluster is known.

    Cells have a diagonal of the distance, so all points of a cell are neighbours, and clusters can only fall from one point of a
    cell to the next. So of its own cell and of each of the 24 around it a point needs one point: the last before it
    that is within the distance. In its own cell that is the one before; in others it is found by a join that keeps the
    largest order number per cell, so pairs are compared there but not kept. `least` is the first such point of the cell, where
    the search for the cluster may start.
    """
    size = distance / 2**0.5 * (1 - 1e-9)
    cells = points.where(finite("x", "y")).select("ord", "x", "y", F.floor(F.col("x") / size).alias("cx"), F.floor(F.col("y") / size).alias("cy"))
    own = cut(previous_in_group(cells, ["cx", "cy"], "ord", "earlier", "first"))
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3) if (i, j) != (0, 0)))
    # a cell whose first point comes later has nothing for this one
    heads = own.groupBy("cx", "cy").agg(F.min("ord").alias("_head"))
    asked = own.select("ord", F.col("x").alias("px"), F.col("y").alias("py"), "cx", "cy", F.explode(steps).alias("s"))
    asked = asked.select("ord", "px", "py", (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy")).join(heads, ["cx", "cy"]).where("_head < ord")
    other = own.select("cx", "cy", F.col("ord").alias("before"), "x", "y")
    near = asked.join(other, ["cx", "cy"]).where((F.col("before") < F.col("ord")) & (F.hypot(F.col("x") - F.col("px"), F.col("y") - F.col("py")) <= distance))
    last = near.groupBy("ord", "cx", "cy").agg(F.max("before").alias("earlier"), F.min("before").alias("least")).drop("cx", "cy")
    return last.unionByName(own.where("earlier is not null").select("ord", "earlier", F.col("first").alias("least")))


def _lowest(edges: DataFrame, labels: DataFrame, max_rounds: int, both: bool = False) -> DataFrame:
    """Labels (ord, label, moved) fallen to the least of the labels of their neighbours (edges: ord, earlier) and of their label's label, until
    none changes.

    A round asks only for neighbours and labels that fell in the one before; once these are few they are broadcast, so edges stay
    where they are. `both`: edges go both ways, every end has a label, and what a point had as a label (`was`) falls with it, so rounds
    grow with the logarithm of the points.
    """
    moved, last = None, [F.col("label").alias("was")] if both else []
    for _ in range(max_rounds):
        fallen = labels.where("moved").select(F.col("ord").alias("at"), F.col("label").alias("next"), *(["was"] if both else []))
        if moved is not None and moved <= _BROADCAST_ROWS:
            fallen = F.broadcast(fallen)
        steps = edges.select("ord", "earlier").unionByName(labels.select("ord", F.col("label").alias("earlier")))
        near = steps.join(fallen, F.col("earlier") == F.col("at")).select("ord", "next")
        if both:
            near = near.unionByName(fallen.select(F.col("was").alias("ord"), "next"))
        low, seen = F.least("label", "next"), Observation()
        told = labels.join(near.groupBy("ord").agg(F.min("next").alias("next")), "ord", "left").select("ord", low.alias("label"), *last, (low < F.col("label")).alias("moved"))
        labels = cut(told.observe(seen, F.count_if("moved").alias("moved")))
        moved = seen.get["moved"]
        if not moved:
            return labels
    raise RuntimeError(f"labels did not settle in {max_rounds} rounds")


def distance_clusters(points: DataFrame, distance: float, id_col: str = "id", order: str = "ord", max_rounds: int = 60) -> DataFrame:
    """(id, cluster): in input order a point joins the first cluster with a member within `distance`, or opens one.

    Clusters never merge, so the result hangs on the order (whole numbers, no ties). cluster is the least order number of
    its members: the least that a point reaches over steps within the distance to ever earlier points. Labels start at the
    least of the earlier neighbours (see earlier_neighbours: at most 25 a point, however dense a site is) and fall to the least
    of theirs and to their label's label, until none changes (see _lowest). It ends as a shared table, so no task holds a
    cluster. Points without a finite place are clusters of their own.

    Labels of one place only fall with the order, and never below the least order number of all places that are connected by steps of the
    distance. Where places have many points, these are taken in order, in parts of growing size, and a place that has come down to
    that number is settled: its later points have it too and are compared with no other, and of its earlier ones only the last is.
    """
    own = cut(points.select(F.col(id_col).alias("id"), F.col(order).cast("long").alias("ord"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")))
    placed = own.where(finite("x", "y")).select("ord", "x", "y")
    places = cut(placed.groupBy("x", "y").agg(F.min("ord").alias("ord"), F.max("ord").alias("final"), F.count("*").alias("n")))
    number, n = places.agg(F.count("*"), F.sum("n")).first()
    if number and n > _VISITS * number:
        return _clusters_of_visits(own, placed, places, distance, n, number, max_rounds)
    edges = cut(earlier_neighbours(placed, distance))
    labels = _lowest(edges, cut(edges.groupBy("ord").agg(F.min("least").alias("label"), F.lit(True).alias("moved"))), max_rounds)
    return own.join(labels, "ord", "left").select("id", F.coalesce("label", "ord").alias("cluster"))


def _clusters_of_visits(own: DataFrame, placed: DataFrame, places: DataFrame, distance: float, n: int, number: int, max_rounds: int) -> DataFrame:
    """distance_clusters of n points at far fewer places (x, y, ord of the first, final)."""
    few = F.broadcast if number <= _BROADCAST_ROWS else lambda df: df
    edges = cut(earlier_neighbours(places.select("ord", "x", "y"), distance).select("ord", "earlier"))
    edges = edges.unionByName(edges.select(F.col("earlier").alias("ord"), F.col("ord").alias("earlier")))
    start = edges.groupBy("ord").agg(F.least("ord", F.min("earlier")).alias("label")).select("ord", "label", F.col("ord").alias("was"), F.lit(True).alias("moved"))
    least = _lowest(edges, cut(start), max_rounds, both=True).select("ord", "label")
    none = F.lit(None).cast("long")
    # of each place: the last point so far and its label, and the order number after which all its points have `least`
    state = cut(places.join(least, "ord", "left").select("x", "y", "final", F.coalesce("label", "ord").alias("least"), none.alias("ord"), none.alias("label"), none.alias("settled")))

    shares = [_VISITS * number / n]
    while shares[-1] < 1:
        shares.append(min(1.0, 2 * shares[-1]))
    found = placed.agg(F.percentile_approx("ord", shares).alias("ends"), F.max("ord").alias("top")).first()
    named, begin = [], None
    for end in sorted({*found.ends, found.top}):
        fresh = placed.where(F.col("ord") <= end if begin is None else (F.col("ord") > begin) & (F.col("ord") <= end))
        fresh = cut(fresh.join(few(state.where("settled is null").select("x", "y")), ["x", "y"]).select("ord", "x", "y"))
        before = state.where("ord is not null")
        edges = earlier_neighbours(fresh.unionByName(before.select("ord", "x", "y")), distance)
        edges = cut(edges if begin is None else edges.where(F.col("ord") > begin))
        labels = edges.groupBy("ord").agg(F.min("least").alias("label")).unionByName(before.where("label < ord").select("ord", "label"))
        labels = _lowest(edges, cut(labels.withColumn("moved", F.lit(True))), max_rounds)
        part = cut(fresh.join(labels, "ord", "left").select("ord", "x", "y", F.coalesce("label", "ord").alias("label")))
        named.append(part.select("ord", "label"))
        last = part.groupBy("x", "y").agg(F.max("ord").alias("_ord"), F.max_by("label", "ord").alias("_label"))
        now = F.coalesce("_label", "label")
        settled = F.when(F.col("settled").isNull() & (now == F.col("least")), F.lit(end).cast("long")).otherwise(F.col("settled"))
        state = cut(state.join(last, ["x", "y"], "left").select("x", "y", "final", "least", F.coalesce("_ord", "ord").alias("ord"), now.alias("label"), settled.alias("settled")))
        if state.where((F.col("final") > end) & F.col("settled").isNull()).isEmpty():
            break
        begin = end
    at = own.join(few(state.select("x", "y", "least", "settled")), ["x", "y"], "left")
    later = F.when(F.col("ord") > F.col("settled"), F.col("least"))
    return at.join(reduce(DataFrame.unionByName, named), "ord", "left").select("id", F.coalesce("label", later, "ord").alias("cluster"))


def parent_sites(plots: DataFrame, distance: float, area: str = "area", most: float = 314.0, prefix: str = "site_") -> DataFrame:
    """(id, parent): clusters of the plots smaller than `most`, numbered by their first plot, as a label; null for others."""
    small = plots.where(F.col(area) < most)
    numbered = renumbered(distance_clusters(small, distance).join(small.select("id", "ord"), "id"), "cluster", "ord")
    return plots.select("id").join(numbered.select("id", F.concat(F.lit(prefix), F.col("number").cast("string")).alias("parent")), "id", "left")


def clamped(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))


def nearest(points: DataFrame, features: DataFrame, cell: float | None = None, max_rounds: int = 40) -> DataFrame:
    """Points (id, x, y) with the code of the nearest feature (code, fx, fy); ties go to the smallest code.

    A point meets the features of its grid cell and the eight around it, and is done if the best of them is no
    farther than a cell's edge, since all nearer ones are in these cells. The others go on with cells of twice the size. The
    first cells hold about two features each, if these are spread evenly. Features without a finite place are left out;
    points without one have null, and so have all points if there is no feature.
    """
    spot = lambda x, y, size: [F.floor(F.col(x) / size).alias("_cx"), F.floor(F.col(y) / size).alias("_cy")]
    around = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    features = features.where(finite("fx", "fy"))
    left, done = cut(points.select("id", "x", "y").where(finite("x", "y"))), []
    n, width, height = features.agg(F.count("*"), F.max("fx") - F.min("fx"), F.max("fy") - F.min("fy")).first()
    if not n:
        return points.withColumn("nearest", F.lit(None).cast(features.schema["code"].dataType))
    cell = cell or max((2 * width * height / n) ** 0.5, max(width, height) / n, 1e-6)
    for _ in range(max_rounds):
        listed = features.select("code", "fx", "fy", *spot("fx", "fy", cell), F.explode(around).alias("s")).select("code", "fx", "fy", (F.col("_cx") + F.col("s.i")).alias("_cx"), (F.col("_cy") + F.col("s.j")).alias("_cy"))
        d = F.pow(F.col("fx") - F.col("x"), 2) + F.pow(F.col("fy") - F.col("y"), 2)
        best = left.select("id", "x", "y", *spot("x", "y", cell)).join(listed, ["_cx", "_cy"], "left").groupBy("id", "x", "y").agg(F.min(F.when(F.col("code").isNotNull(), F.struct(d.alias("d"), "code"))).alias("best"))
        best = cut(best)
        sure = F.coalesce(F.col("best.d") <= cell * cell, F.lit(False))
        done.append(best.where(sure).select("id", F.col("best.code").alias("nearest")))
        left = best.where(~sure).select("id", "x", "y")
        if left.isEmpty():
            break
        cell *= 2
    else:
        raise RuntimeError(f"some points are farther than {cell} from every feature; raise max_rounds or cell")
    return points.join(reduce(DataFrame.unionByName, done), "id", "left")


def sample_raster(points: DataFrame, pixels: DataFrame, x0: float, y1: float, size: float, how: str = "left") -> DataFrame:
    """Points with the pixel (col, row, value) under them."""
    at = points.withColumns({"col": F.floor((F.col("x") - x0) / size), "row": F.floor((F.lit(y1) - F.col("y")) / size)})
    return at.join(pixels, ["col", "row"], how)


def resample(pixels: DataFrame, factor: int) -> DataFrame:
    """Mean of blocks of factor x factor pixels (x, y, value)."""
    return pixels.groupBy(F.floor(F.col("x") / factor).alias("x"), F.floor(F.col("y") / factor).alias("y")).agg(F.avg("value").alias("value"))


def resample_nearest(pixels: DataFrame, factor: int) -> DataFrame:
    """The pixel at the middle of each block of factor x factor; a filter, nothing moves."""
    middle = (F.pmod(F.col("x"), F.lit(factor)) == factor // 2) & (F.pmod(F.col("y"), F.lit(factor)) == factor // 2)
    return pixels.where(middle).select(F.floor(F.col("x") / factor).alias("x"), F.floor(F.col("y") / factor).alias("y"), "value")


@dataclass(frozen=True)
class Grid:
    """Cells of width x height, counted from 0, the first with its low corner at (x0, y0)."""

    x0: float
    y0: float
    size: float
    width: int
    height: int


def resample_to(pixels: DataFrame, source: Grid, target: Grid, how: str = "mean") -> DataFrame:
    """Pixels (x, y, value) of one grid brought onto another of any origin and size: (x, y, value) of the cells that a pixel reaches.

    `mean` weighs the pixels that a cell overlaps by the shared area, without nulls (null where all are): each pixel goes to the
    cells that it overlaps, one shuffle of sums. `nearest` is the pixel under a cell's centre, on its low edges included: each pixel gives
    its value to the cells whose centres it holds, and nothing moves. Cells beyond the target's edges are left out. Edges that
    are a billionth of a cell apart are the same.
    """
    if how not in ("mean", "nearest"):
        raise ValueError(how)
    # in units of target cells, from the target's origin
    ends = {f"_{c}{k}": ((F.col(c) + k) * source.size + (o - t)) / target.size for c, o, t in (("x", source.x0, target.x0), ("y", source.y0, target.y0)) for k in (0, 1)}
    p = pixels.select("x", "y", F.col("value").cast("double").alias("value")).withColumns(ends)
    shift, tiny = 0.5 if how == "nearest" else 0.0, 1e-9
    for c, n in (("x", target.width), ("y", target.height)):
        first = F.ceil(F.col(f"_{c}0") - shift - tiny) if how == "nearest" else F.floor(F.col(f"_{c}0") + tiny)
        first, last = F.greatest(first, F.lit(0)), F.least(F.ceil(F.col(f"_{c}1") - shift - tiny) - 1, F.lit(n - 1))
        p = p.where(first <= last).withColumn(c, F.explode(F.sequence(first, last)))
    if how == "nearest":
        return p.select("x", "y", "value")
    shared = [F.least(f"_{c}1", F.col(c) + 1.0) - F.greatest(f"_{c}0", F.col(c).cast("double")) for c in "xy"]
    w = F.when(F.col("value").isNotNull(), shared[0] * shared[1])
    return p.withColumn("_w", w).groupBy("x", "y").agg(F.try_divide(F.sum(F.col("value") * F.col("_w")), F.sum("_w")).alias("value"))


def pyramid(pixels: DataFrame, levels: int) -> DataFrame:
    """Means at 2, 4, ... 2^levels pixels. Each level comes from the sums and counts of the one before, so pixels weigh alike."""
    half = lambda c: F.floor(F.col(c) / 2).alias(c)
    own, out = pixels.select("x", "y", F.col("value").alias("total"), F.col("value").isNotNull().cast("long").alias("n")), []
    for level in range(1, levels + 1):
        own = cut(own.groupBy(half("x"), half("y")).agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
        out.append(own.select(F.lit(level).alias("level"), "x", "y", F.try_divide("total", F.col("n").cast("double")).alias("value")))
    return reduce(DataFrame.unionByName, out)


def pixel_mean(scenes: DataFrame) -> DataFrame:
    """Mean of overlapping scenes per pixel, without their nulls; null where all are."""
    return scenes.groupBy("x", "y").agg(F.avg("value").alias("value"))


def mosaic_last(tiles: DataFrame, order: str) -> DataFrame:
    """One value per pixel: the last tile in order that has one wins."""
    return tiles.groupBy("x", "y").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.col(order))).alias("value"))


def focal(pixels: DataFrame, radius: int, how: str = "max", name: str = "focal") -> DataFrame:
    """Largest or least value within `radius` pixels in both directions: along rows, then along columns of that."""
    pick = F.max if how == "max" else F.min
    steps = F.sequence(F.lit(-radius), F.lit(radius))
    along_x = pixels.withColumn("_s", F.explode(steps)).groupBy((F.col("x") + F.col("_s")).alias("x"), "y").agg(pick("value").alias("value"))
    around = along_x.withColumn("_s", F.explode(steps)).groupBy("x", (F.col("y") + F.col("_s")).alias("y")).agg(pick("value").alias(name))
    return pixels.join(around, ["x", "y"])


def opened(pixels: DataFrame, radius: int, buffer: int) -> DataFrame:
    """A mask eroded by `radius`, then grown by `buffer`: single pixels go, larger patches keep a margin."""
    eroded = focal(pixels, radius, "min", "_low").select("x", "y", F.col("_low").alias("value"))
    return pixels.join(focal(eroded, buffer, "max", "opened").select("x", "y", "opened"), ["x", "y"])


def terrain(pixels: DataFrame, size: float) -> DataFrame:
    """Slope and aspect in degrees and hillshade (azimuth 270, altitude 45) by Horn's differences, where all 8 neighbours are.

    One shuffle: each pixel sends its value to its neighbours, which weigh it by its place.
    """
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    sent = pixels.withColumn("_s", F.explode(steps)).select((F.col("x") - F.col("_s.i")).alias("x"), (F.col("y") - F.col("_s.j")).alias("y"), F.col("_s.i").alias("i"), F.col("_s.j").alias("j"), "value")
    weight = lambda main, other: F.sum(F.col("value") * F.col(main) * (2 - F.abs(F.col(other)))) / (8.0 * size)
    g = sent.groupBy("x", "y").agg(F.count("value").alias("n"), F.max(F.when((F.col("i") == 0) & (F.col("j") == 0), F.col("value"))).alias("value"), weight("i", "j").alias("gx"), weight("j", "i").alias("gy")).where("n = 9 and value is not null")
    slope = F.atan(F.hypot("gx", "gy"))
    aspect = F.atan2(F.col("gy"), -F.col("gx"))
    shade = F.cos(F.radians(F.lit(45.0))) * F.cos(slope) + F.sin(F.radians(F.lit(45.0))) * F.sin(slope) * F.cos(F.radians(F.lit(180.0)) - aspect)
    return g.select("x", "y", F.degrees(slope).alias("slope"), F.pmod(F.degrees(aspect) + 360, F.lit(360.0)).alias("aspect"), shade.alias("hillshade"))


def shadow(pixels: DataFrame, dx: int, dy: int, steps: int) -> DataFrame:
    """1 for dark pixels within `steps` steps of (dx, dy) from a cloud pixel, else 0. pixels: x, y, cloud, dark."""
    cast = pixels.where("cloud = 1").withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(steps)))).select((F.col("x") + dx * F.col("_k")).alias("x"), (F.col("y") + dy * F.col("_k")).alias("y")).distinct().withColumn("_hit", F.lit(1))
    return pixels.join(cast, ["x", "y"], "left").withColumn("shadow", F.when((F.col("dark") == 1) & F.col("_hit").isNotNull(), 1).otherwise(0)).drop("_hit")


def majority(df: DataFrame, key: str, kind: str) -> DataFrame:
    """Rows of the kind that is most frequent for their key; ties go to the kind first in text order."""
    n = df.groupBy(key, kind).agg(F.count("*").alias("_n"))
    top = n.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_n"), kind))).where("_r = 1").select(key, kind)
    return df.join(top, [key, kind])


def composite(pixels: DataFrame, keys: list[str], value: str, time: str) -> DataFrame:
    """Median (exact, see quantiles) and largest value and first time per key."""
    own = pixels.groupBy(*keys).agg(F.min(F.when(F.col(value).isNotNull(), F.col(time))).alias("first_time"), F.max(value).alias("top"))
    return with_quantiles(own, pixels, keys, value, [0.5]).select(*keys, F.col("q")[0].alias("median"), "first_time", "top")


def _hull(xy: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of points, by the monotone chain."""
    xy = np.unique(xy, axis=0)
    if len(xy) < 3:
        return xy
    chains = []
    for points in (xy, xy[::-1]):
        chain: list[np.ndarray] = []
        for p in points:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) - (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]) <= 0:
                chain.pop()
            chain.append(p)
        chains += chain[:-1]
    return np.array(chains)


def widest(points: DataFrame, key: str) -> DataFrame:
    """Area of the disc over the largest distance in each group, which is between two corners of its convex hull.

    Every batch sends only the hulls of its groups, and hulls of a few thousand points have some dozen corners, so a group of any
    size is small when it meets.
    """
    ship(points.sparkSession)
    own = points.select(key, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where("x is not null and y is not null")
    schema = own.schema

    def hulls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k, part in b.groupby(key, dropna=False):
                corners = _hull(part[["x", "y"]].to_numpy())
                yield pd.DataFrame({key: [k] * len(corners), "x": corners[:, 0], "y": corners[:, 1]})

    def width(pdf: pd.DataFrame) -> pd.DataFrame:
        corners, best = _hull(pdf[["x", "y"]].to_numpy()), 0.0
        for p in corners:
            best = max(best, float(np.hypot(*(corners - p).T).max()))
        return pd.DataFrame({key: pdf[key].iloc[:1], "width": [best]})

    kind = schema[key].dataType.simpleString()
    out = own.mapInPandas(hulls, schema).groupBy(key).applyInPandas(width, f"{key} {kind}, width double")
    return out.withColumn("area", F.pi() * F.pow(F.col("width") / 2, 2))
