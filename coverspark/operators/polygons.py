"""Polygons of any number of rings (parts and holes), as tables of edges: points in them, nearest of them, cells that they touch.

A polygon is what lies inside an odd number of its rings' edges, so holes and parts need no marks. Edges are rows (code, x1,
y1, x2, y2); a ring of a million corners is a million rows, spread over tasks by the grid cells and rows that they cross.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverspark.operators.spatial import box_join, finite
from coverspark.session import cut

_EDGE = ["code", "x1", "y1", "x2", "y2"]


def edges_of(polygons: DataFrame, code: str = "code", rings: str = "rings") -> DataFrame:
    """Edges of polygons whose rings are an array of arrays of structs (x, y), closed or not. Edges with a null end are left out."""
    ring = polygons.select(F.col(code).alias("code"), F.explode(rings).alias("_r")).where(F.size("_r") > 1)
    n = F.size("_r")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get("_r", i).alias("a"), F.get("_r", F.pmod(i + 1, n)).alias("b")))
    e = ring.select("code", F.explode(pairs).alias("e"))
    ends = {f"{c}{k}": F.col(f"e.{v}.{c}").cast("double") for k, v in ((1, "a"), (2, "b")) for c in "xy"}
    return e.select("code", *(v.alias(k) for k, v in ends.items())).where(finite("x1", "y1", "x2", "y2"))


def edges_of_corners(corners: DataFrame) -> DataFrame:
    """Edges of corners (code, part, k, x, y), k counting a ring's corners without gaps. No task holds a ring."""
    ring = ["code", "part"]
    first = corners.groupBy(*ring).agg(F.min_by(F.struct("x", "y"), "k").alias("_first"))
    after = corners.select(*ring, (F.col("k") - 1).alias("k"), F.struct("x", "y").alias("_next"))
    e = corners.join(after, [*ring, "k"], "left").join(first, ring).withColumn("_next", F.coalesce("_next", "_first"))
    ends = {"x1": F.col("x"), "y1": F.col("y"), "x2": F.col("_next.x"), "y2": F.col("_next.y")}
    return e.select("code", *(v.cast("double").alias(k) for k, v in ends.items())).where(finite("x1", "y1", "x2", "y2"))


def cells_crossed(edges: DataFrame, size: float, x0: float = 0.0, y0: float = 0.0, margin: int = 0) -> DataFrame:
    """Edges with every grid cell (cx, cy) that they cross, and those within `margin` cells of one in both directions.

    A walk along the edge: for each column, the rows between its heights where it enters and leaves.
    """
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    e = edges.withColumn("cx", F.explode(F.sequence(F.floor((low - x0) / size) - margin, F.floor((high - x0) / size) + margin)))
    sides = F.greatest(low, x0 + (F.col("cx") - margin) * size), F.least(high, x0 + (F.col("cx") + margin + 1) * size)
    slope = F.try_divide(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))
    at = [F.greatest(F.least("y1", "y2"), F.least(F.greatest("y1", "y2"), F.col("y1") + (s - F.col("x1")) * slope)) for s in sides]
    leans = F.coalesce(F.abs(slope) < float("inf"), F.lit(False))  # a vertical edge is in one column, with all its height
    a, b = F.when(leans, at[0]).otherwise(F.col("y1")), F.when(leans, at[1]).otherwise(F.col("y2"))
    return e.withColumn("cy", F.explode(F.sequence(F.floor((F.least(a, b) - y0) / size) - margin, F.floor((F.greatest(a, b) - y0) / size) + margin)))


def _inside_places(places: DataFrame, edges: DataFrame) -> DataFrame:
    """Different places (x, y) with the code of every polygon that holds them."""
    boxes = edges.groupBy("code").agg(
        F.least(F.min("x1"), F.min("x2")).alias("min_x"), F.greatest(F.max("x1"), F.max("x2")).alias("max_x"), F.least(F.min("y1"), F.min("y2")).alias("min_y"), F.greatest(F.max("y1"), F.max("y2")).alias("max_y"),
        F.avg(F.abs(F.col("y1") - F.col("y2"))).alias("rise"),
    )
    boxes = cut(boxes)
    cell, row = boxes.agg(F.avg(F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"))), F.avg("rise")).first()
    cell, row = cell or 1.0, row or 1.0
    near = box_join(places, boxes.drop("rise"), cell).select("x", "y", "code", F.floor(F.col("y") / row).alias("_row"))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    listed = edges.where(low < high).withColumn("_row", F.explode(F.sequence(F.floor(low / row), F.floor(high / row))))
    y = F.col("y")
    crossed = ((F.col("y1") > y) != (F.col("y2") > y)) & (F.col("x") < F.col("x1") + F.try_divide((y - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1")))
    return near.join(listed, ["code", "_row"]).where(crossed).groupBy("x", "y", "code").agg(F.count("*").alias("_n")).where("_n % 2 = 1").select("x", "y", "code")


def points_in_polygons(points: DataFrame, edges: DataFrame, how: str = "inner") -> DataFrame:
    """Points (x, y) with each polygon that holds them (`code`), or by `how` (left, left_semi, left_anti) those that any does.

    Different places are judged once. A place meets the boxes of its grid cell, and of those polygons only the edges in its
    band of heights, whose crossings to its right are counted; a point on an edge is inside on the low sides. Points without a
    finite place are in none.
    """
    found = _inside_places(points.where(finite("x", "y")).select("x", "y").distinct(), edges)
    return points.join(found if how in ("inner", "left") else found.select("x", "y").distinct(), ["x", "y"], how)


def _square_to_edge() -> Column:
    """Squared distance from (x, y) to the edge; an end of the edge counts as it is, so polygons that share a corner tie."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.coalesce(F.try_divide((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy, dx * dx + dy * dy), F.lit(0.0))
    at = lambda a, b, d: F.when(t <= 0, F.col(a)).when(t >= 1, F.col(b)).otherwise(F.col(a) + t * d)
    return F.pow(F.col("x") - at("x1", "x2", dx), 2) + F.pow(F.col("y") - at("y1", "y2", dy), 2)


_STEP = 2  # levels of the tree of cells that a round goes down: 16 cells below each


def nearest_polygon(points: DataFrame, edges: DataFrame, size: float | None = None) -> DataFrame:
    """Points (id, x, y) with `nearest`, the code of the nearest polygon, and its `distance`: 0 and the smallest code of the
    polygons that hold a point, as points_in_polygons has them; other ties go to the smallest code, too.

    Points without a finite place, and all points if there is no edge, have nulls. Different places outside all polygons first
    meet the edges of their grid cell and the eight around it; a best one no farther than a cell's edge is the nearest.
    The others go down a tree of the cells that edges cross, sixteen to one: below the cells still in
    question, those stay whose least distance is no more than the largest distance to the best of them. So far points meet
    some cells a level, not all edges, and every round ends as a shared table.
    """
    edges = cut(edges.select(*_EDGE))
    n, x0, x1, y0, y1, rise = edges.agg(F.count("*"), F.least(F.min("x1"), F.min("x2")), F.greatest(F.max("x1"), F.max("x2")), F.least(F.min("y1"), F.min("y2")), F.greatest(F.max("y1"), F.max("y2")), F.avg(F.hypot(F.col("x1") - F.col("x2"), F.col("y1") - F.col("y2")))).first()
    kind = edges.schema["code"].dataType
    if not n:
        return points.withColumns({"nearest": F.lit(None).cast(kind), "distance": F.lit(None).cast("double")})
    width = max(x1 - x0, y1 - y0)
    size = size or max(rise, width / 2**20, 1e-9)
    places = cut(points.where(finite("x", "y")).select("x", "y").distinct())
    inside = cut(_inside_places(places, edges).groupBy("x", "y").agg(F.min("code").alias("code")).withColumn("d", F.lit(0.0)))
    outside = places.join(inside, ["x", "y"], "left_anti")
    own = [F.floor((F.col("x") - x0) / size).alias("cx"), F.floor((F.col("y") - y0) / size).alias("cy")]
    best = F.min(F.when(F.col("x1").isNotNull(), F.struct(_square_to_edge().alias("d"), "code"))).alias("best")
    first = cut(outside.select("x", "y", *own).join(cells_crossed(edges, size, x0, y0, 1), ["cx", "cy"], "left").groupBy("x", "y").agg(best))
    sure = F.coalesce(F.col("best.d") <= size * size, F.lit(False))
    done = [inside, first.where(sure).select("x", "y", "best.code", "best.d")]
    far = cut(first.where(~sure).select("x", "y"))
    if not far.isEmpty():
        done.append(_down_the_tree(far, cut(cells_crossed(edges, size, x0, y0)), size, x0, y0, width).select("x", "y", "code", "d"))
    found = reduce(DataFrame.unionByName, done).select("x", "y", F.col("code").alias("nearest"), F.sqrt("d").alias("distance"))
    return points.join(found, ["x", "y"], "left").select(*points.columns, "nearest", "distance")


def _down_the_tree(places: DataFrame, crossed: DataFrame, size: float, x0: float, y0: float, width: float) -> DataFrame:
    """(x, y, code, d) of places by the nearest of edges in cells (cx, cy) of this size."""
    depth = 0
    while size * 4**depth < width:
        depth += 1
    levels = [cut(crossed.select("cx", "cy").distinct())]
    up = lambda c, k: F.shiftright(c, k)
    for _ in range(depth):
        levels.append(cut(levels[-1].select(up("cx", _STEP).alias("cx"), up("cy", _STEP).alias("cy")).distinct()))
    asked = places.crossJoin(F.broadcast(levels[depth]))  # the root: at most two cells in each direction
    by = Window.partitionBy("x", "y")
    for level in range(depth - 1, -1, -1):
        edge = size * (1 << (_STEP * level))
        below = levels[level].select(up("cx", _STEP).alias("_px"), up("cy", _STEP).alias("_py"), "cx", "cy")
        met = asked.withColumnsRenamed({"cx": "_px", "cy": "_py"}).join(below, ["_px", "_py"])
        lows = x0 + F.col("cx") * edge, y0 + F.col("cy") * edge
        gap = [F.greatest(lo - p, p - (lo + edge), F.lit(0.0)) for lo, p in zip(lows, (F.col("x"), F.col("y")))]
        reach = [F.greatest(F.abs(p - lo), F.abs(p - (lo + edge))) for lo, p in zip(lows, (F.col("x"), F.col("y")))]
        told = met.withColumn("_least", gap[0] * gap[0] + gap[1] * gap[1]).withColumn("_most", F.min(reach[0] * reach[0] + reach[1] * reach[1]).over(by))
        asked = cut(told.where(F.col("_least") <= F.col("_most") * (1 + 1e-9)).select("x", "y", "cx", "cy"))
    last = asked.join(crossed, ["cx", "cy"]).groupBy("x", "y").agg(F.min(F.struct(_square_to_edge().alias("d"), "code")).alias("best"))
    return last.select("x", "y", "best.code", "best.d")


def cells_of_polygons(edges: DataFrame, x0: float, y0: float, size: float, all_touched: bool = True) -> DataFrame:
    """(code, cx, cy), once each, of the grid cells whose centre is inside a polygon, and of those that its edges cross.

    Along the middle of each row of cells the crossings with a polygon's edges, sorted, bound runs of centres inside. What
    meets in a task is the crossings of one polygon with one row.
    """
    e = edges.select(*_EDGE)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    middle = y0 + (F.col("cy") + 0.5) * size
    rows = e.where(low < high).withColumn("cy", F.explode(F.sequence(F.floor((low - y0) / size), F.floor((high - y0) / size))))
    rows = rows.where((F.col("y1") > middle) != (F.col("y2") > middle)).withColumn("_x", F.col("x1") + F.try_divide((middle - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1")))
    along = Window.partitionBy("code", "cy").orderBy("_x")
    runs = rows.select("code", "cy", "_x", F.lead("_x").over(along).alias("_to"), F.row_number().over(along).alias("_k")).where("_k % 2 = 1")
    first, last = (F.ceil((F.col(c) - x0) / size - 0.5) for c in ("_x", "_to"))
    inner = runs.where(first < last).select("code", F.explode(F.sequence(first, last - 1)).alias("cx"), "cy")
    if not all_touched:
        return inner
    return inner.unionByName(cells_crossed(e, size, x0, y0).select("code", "cx", "cy")).distinct()


def burn(edges: DataFrame, x0: float, y0: float, size: float, width: int, height: int, order: DataFrame | None = None, all_touched: bool = True) -> DataFrame:
    """(x, y, value) of a grid, 0 where no polygon touches a cell: the code of the polygon burnt last, in the order of codes, or
    of `order` (code, ord)."""
    cells = cells_of_polygons(edges, x0, y0, size, all_touched).where((F.col("cx") >= 0) & (F.col("cx") < width) & (F.col("cy") >= 0) & (F.col("cy") < height))
    ranked = cells.join(order, "code") if order is not None else cells.withColumn("ord", F.col("code"))
    grid = edges.sparkSession.range(width * height).select((F.col("id") % width).alias("x"), F.floor(F.col("id") / width).alias("y"), F.lit(None).cast("struct<ord:long,code:long>").alias("top"))
    burnt = ranked.select(F.col("cx").alias("x"), F.col("cy").alias("y"), F.struct(F.col("ord").cast("long").alias("ord"), F.col("code").cast("long").alias("code")).alias("top"))
    return burnt.unionByName(grid).groupBy("x", "y").agg(F.coalesce(F.max("top")["code"], F.lit(0)).alias("value"))
