"""Polygons with parts and holes: points in them, nearest of them, cells that they touch, grids of one raster on another."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverspark.operators import polygons as G
from coverspark.operators.spatial import Grid, resample_to
from coverspark.plans.registry import POINTS, ctes, query, table

#: Three rings a nation: a large one, a hole in it, and a small part to its north that reaches into other nations' rings.
PARTS = """
  SELECT n_nationkey AS code, 0 AS part, -169.0 + n_nationkey * 1.1 AS cx, 61.0 + n_nationkey % 7 AS cy, 2.5 AS r, 3 + n_nationkey % 3 AS corners FROM nation
  UNION ALL SELECT n_nationkey AS code, 1 AS part, -169.0 + n_nationkey * 1.1 AS cx, 61.0 + n_nationkey % 7 AS cy, 0.8 AS r, 4 AS corners FROM nation
  UNION ALL SELECT n_nationkey AS code, 2 AS part, -168.3 + n_nationkey * 1.1 AS cx, 64.5 + n_nationkey % 7 AS cy, 0.6 AS r, 5 AS corners FROM nation"""
_CORNER = {"x": "cx + r * cos(2 * pi() * {k} / corners + code)", "y": "cy + r * sin(2 * pi() * {k} / corners + code)"}
_E = "SELECT code, " + ", ".join(f"{v.format(k=k)} AS {c}{n}" for n, k in ((1, "k"), (2, "((k + 1) % corners)")) for c, v in _CORNER.items()) + " FROM (SELECT *, unnest(range(0, corners)) AS k FROM parts)"
_EDGES = ctes(p=POINTS, parts=PARTS, e=_E)
_CROSSED = "(y1 > {y}) <> (y2 > {y}) AND {x} < x1 + ({y} - y1) * (x2 - x1) / (y2 - y1)"
_HELD = ", h AS (SELECT id, code FROM p JOIN e ON " + _CROSSED.format(x="x", y="y") + " GROUP BY id, code HAVING count(*) % 2 = 1)"


def _corners(spark, d):
    c = table(spark, d, PARTS).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("corners") - 1)))
    return c.select("code", "part", "k", *(F.expr(v.format(k="k")).alias(n) for n, v in _CORNER.items()))


def _polygons(spark, d):
    ring = _corners(spark, d).groupBy("code", "part").agg(F.array_sort(F.collect_list(F.struct("k", "x", "y"))).alias("r"))
    return ring.groupBy("code").agg(F.collect_list(F.transform("r", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))).alias("rings"))


@query(_EDGES + _HELD + " SELECT id, coalesce((SELECT array_to_string(list_sort(list(code)), ',') FROM h WHERE h.id = p.id), '') AS codes FROM p")
def points_in_parts(spark, d):
    p = table(spark, d, POINTS)
    held = G.points_in_polygons(p, G.edges_of(_polygons(spark, d))).groupBy("id").agg(F.array_sort(F.collect_list("code")).alias("codes"))
    return p.join(held, "id", "left").select("id", F.coalesce(F.array_join(F.col("codes").cast("array<string>"), ","), F.lit("")).alias("codes"))


@query(_EDGES + _HELD + " SELECT id FROM p WHERE id NOT IN (SELECT id FROM h)")
def points_outside(spark, d):
    return G.points_in_polygons(table(spark, d, POINTS), G.edges_of_corners(_corners(spark, d)), "left_anti").select("id")


_AWAY = "SELECT id, x * 1.5D + 80 AS x, y * 4.0D - 195 AS y FROM (" + POINTS + ")"
_T = "greatest(0, least(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))))"


@query(_EDGES.replace("WITH p AS (", "WITH q AS (", 1) + ", p AS (SELECT id, x * CAST(1.5 AS DOUBLE) + 80 AS x, y * CAST(4 AS DOUBLE) - 195 AS y FROM q)" + _HELD + f""",
  d AS (SELECT id, code, min((x - (x1 + {_T} * (x2 - x1))) ^ 2 + (y - (y1 + {_T} * (y2 - y1))) ^ 2) AS d FROM p, e GROUP BY ALL),
  o AS (SELECT id, code, CASE WHEN h.code IS NOT NULL THEN 0 ELSE d END AS d FROM d LEFT JOIN h USING (id, code))
  SELECT id, arg_min(code, (d, code)) AS nearest, round(sqrt(min(d)), 9) AS distance FROM o GROUP BY id""")
def nearest_polygon(spark, d):
    near = G.nearest_polygon(table(spark, d, _AWAY), G.edges_of(_polygons(spark, d)))
    return near.select("id", "nearest", F.round("distance", 9).alias("distance"))


_X0, _Y0, _SIZE, _WIDTH, _HEIGHT = -171.03, 57.01, 0.37, 90, 40
_BOX = f"g AS (SELECT x, y, {_X0}::DOUBLE + x * {_SIZE}::DOUBLE AS bx, {_Y0}::DOUBLE + y * {_SIZE}::DOUBLE AS b, {_SIZE}::DOUBLE AS s FROM (SELECT unnest(range(0, {_WIDTH})) AS x), (SELECT unnest(range(0, {_HEIGHT})) AS y))"
_SIDE = "(({0} - x1) * (y2 - y1) - ({1} - y1) * (x2 - x1) > 0)::INT"
_FOUR = " + ".join(_SIDE.format(a, b) for a in ("bx", "bx + s") for b in ("b", "b + s"))
#: A cell is touched where an edge meets its box (neither beyond it in x or y, nor with all corners on one side), or its centre is inside.
_TOUCHED = f""", {_BOX},
  crossed AS (SELECT DISTINCT code, x, y FROM e JOIN g ON greatest(x1, x2) >= bx AND least(x1, x2) <= bx + s AND greatest(y1, y2) >= b AND least(y1, y2) <= b + s AND {_FOUR} BETWEEN 1 AND 3),
  centred AS (SELECT code, x, y FROM e JOIN g ON {_CROSSED.format(x='(bx + s / 2)', y='(b + s / 2)')} GROUP BY ALL HAVING count(*) % 2 = 1),
  touched AS (SELECT * FROM crossed UNION SELECT * FROM centred)"""


@query(_EDGES + _TOUCHED + " SELECT x, y, coalesce(arg_max(code, (code * 7 % 25, code)), 0) AS value FROM g LEFT JOIN touched USING (x, y) GROUP BY x, y")
def burnt_polygons(spark, d):
    order = table(spark, d, "SELECT n_nationkey AS code, n_nationkey * 7 % 25 AS ord FROM nation")
    return G.burn(G.edges_of_corners(_corners(spark, d)), _X0, _Y0, _SIZE, _WIDTH, _HEIGHT, order)


@query(_EDGES + _TOUCHED + """, q AS (SELECT id, CAST(floor((x + 171.03) / 0.37) AS BIGINT) AS x, CAST(floor((y - 57.01) / 0.37) AS BIGINT) AS y FROM p),
  n AS (SELECT x, y, count(*) AS points FROM q GROUP BY ALL)
  SELECT code, count(*) AS cells, coalesce(sum(points), 0)::BIGINT AS points FROM touched LEFT JOIN n USING (x, y) GROUP BY code""".replace("171.03", "171.03::DOUBLE").replace("57.01", "57.01::DOUBLE").replace("0.37", "0.37::DOUBLE"))
def cells_touched(spark, d):
    cell = lambda c, o: F.floor((F.col(c) - o) / _SIZE)
    n = table(spark, d, POINTS).groupBy(cell("x", _X0).alias("cx"), cell("y", _Y0).alias("cy")).agg(F.count("*").alias("n"))
    touched = G.cells_of_polygons(G.edges_of(_polygons(spark, d)), _X0, _Y0, _SIZE)
    inside = touched.where((F.col("cx") >= 0) & (F.col("cx") < _WIDTH) & (F.col("cy") >= 0) & (F.col("cy") < _HEIGHT))
    return inside.join(n, ["cx", "cy"], "left").groupBy("code").agg(F.count("*").alias("cells"), F.coalesce(F.sum("n"), F.lit(0)).alias("points"))


_PX = "SELECT p_partkey % 50 AS x, p_partkey // 50 AS y, CASE WHEN p_size % 9 <> 0 THEN ln(p_retailprice) END AS value FROM part"
_FROM = Grid(10.0, -4.0, 1.0, 50, 1 << 30)
_ONTO = (Grid(8.3, -5.15, 3.0, 18, 1 << 30), Grid(12.6, -3.4, 2.5, 17, 1 << 30), Grid(12.6, -3.4, 0.4, 30, 1 << 30))
_OVER = """SELECT {size}::DOUBLE AS size, '{how}' AS how, c.x, c.y, {value} AS value
  FROM p JOIN (SELECT x, y, {x0} + x * {size} AS a, {y0} + y * {size} AS b FROM (SELECT unnest(range(0, {width})) AS x), (SELECT unnest(range(0, (SELECT max(y) + 20 FROM p) * 3)) AS y)) c ON {met} GROUP BY c.x, c.y"""
_EAST, _NORTH = (f"(least({o} + p.{c} + 1, {a} + {{size}}) - greatest({o} + p.{c}, {a}))" for c, o, a in (("x", "10", "a"), ("y", "-4", "b")))
_KINDS = {
    "mean": ("round(sum(value * {e} * {n}) / sum(CASE WHEN value IS NOT NULL THEN {e} * {n} END), 6)", "{e} > 1e-9 AND {n} > 1e-9"),
    "nearest": ("round(max(value), 6)", "a + {size} / 2 >= 10 + p.x AND a + {size} / 2 < 11 + p.x AND b + {size} / 2 >= -4 + p.y AND b + {size} / 2 < -3 + p.y"),
}


def _over(g: Grid, how: str) -> str:
    e, n = (s.format(size=g.size) for s in (_EAST, _NORTH))
    value, met = (s.format(e=e, n=n, size=g.size) for s in _KINDS[how])
    return _OVER.format(size=g.size, how=how, x0=g.x0, y0=g.y0, width=g.width, value=value, met=met)


@query("WITH p AS (" + _PX + ") " + " UNION ALL ".join(_over(g, how) for g in _ONTO for how in _KINDS))
def resample_to_grid(spark, d):
    px, out = table(spark, d, _PX.replace("//", "div")), []
    for g in _ONTO:
        for how in _KINDS:
            out.append(resample_to(px, _FROM, g, how).select(F.lit(g.size).alias("size"), F.lit(how).alias("how"), "x", "y", F.round("value", 6).alias("value")))
    return reduce(DataFrame.unionByName, out)
