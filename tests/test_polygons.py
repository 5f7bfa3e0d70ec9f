"""Polygons, grids and nearest features against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import Row

from coverspark.operators import polygons as G
from coverspark.operators import spatial
from coverspark.operators.spatial import Grid, nearest, resample_to

#: A square with a square hole, and in the hole a part; a triangle that shares an edge with the square; a lone far segment-like sliver.
SHAPES = {
    1: [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(2, 2), (8, 2), (8, 8), (2, 8)], [(4, 4), (6, 4), (5, 6)]],
    2: [[(10, 0), (15, 5), (10, 10)], [], [(3, 3)]],
    3: [[(200, 210), (205, 210), (205, 210.01)]],
}


def polygons(spark, shapes=SHAPES):
    rows = [Row(code=c, rings=[[Row(x=float(x), y=float(y)) for x, y in r] for r in rings]) for c, rings in shapes.items()]
    return spark.createDataFrame(rows, "code long, rings array<array<struct<x:double,y:double>>>")


def sides(shapes=SHAPES):
    return [(c, *map(float, (*a, *b))) for c, rings in shapes.items() for r in rings if len(r) > 1 for a, b in zip(r, r[1:] + r[:1])]


def held(x, y, shapes=SHAPES):
    n = {}
    for c, x1, y1, x2, y2 in sides(shapes):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            n[c] = n.get(c, 0) + 1
    return sorted(c for c, k in n.items() if k % 2)


def away(x, y, shapes=SHAPES):
    def to(x1, y1, x2, y2):
        dx, dy = x2 - x1, y2 - y1
        t = ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy) if dx or dy else 0.0
        px, py = (x1, y1) if t <= 0 else (x2, y2) if t >= 1 else (x1 + t * dx, y1 + t * dy)
        return math.hypot(x - px, y - py)

    inside = held(x, y, shapes)
    return (0.0, inside[0]) if inside else min((to(*e), c) for c, *e in sides(shapes))


def places(n=400):
    rng = random.Random(4)
    own = [(rng.uniform(-5, 20), rng.uniform(-5, 15)) for _ in range(n)] + [(rng.uniform(-900, 900), rng.uniform(-900, 900)) for _ in range(40)]
    return own + [(5.0, 3.0), (5.0, 5.0), (10.0, 5.0), (0.0, 0.0), (10.0, 10.0), (12.5, -3.0), (1e7, -1e7)] + own[:20]


def frame(spark, rows):
    return spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(rows)], "id long, x double, y double")


def test_points_in_polygons(spark):
    rows = places() + [(None, 1.0), (1.0, float("nan")), (float("inf"), 1.0)]
    edges, p = G.edges_of(polygons(spark)), frame(spark, rows)
    assert sorted(map(tuple, edges.collect())) == sorted(e for e in sides())
    got = sorted((r.id, r.code) for r in G.points_in_polygons(p, edges).collect())
    want = [(k, c) for k, (x, y) in enumerate(rows[:-3]) for c in held(x, y)]
    assert got == want and len(want) > 50
    outside = {k for k in range(len(rows))} - {k for k, _ in want}
    assert {r.id for r in G.points_in_polygons(p, edges, "left_anti").collect()} == outside
    assert G.points_in_polygons(p, edges, "left").count() == len(want) + len(outside)
    assert G.points_in_polygons(p, edges.limit(0)).count() == 0 == G.points_in_polygons(p.limit(0), edges).count()


def test_edges_of_corners(spark):
    corners = [(c, k, i, float(x), float(y)) for c, rings in SHAPES.items() for k, r in enumerate(rings) for i, (x, y) in enumerate(r)]
    got = G.edges_of_corners(spark.createDataFrame(corners, "code long, part int, k int, x double, y double"))
    same = lambda e: e[1:3] == e[3:5]  # noqa: E731  a ring of one corner is an edge without length
    assert sorted(tuple(e) for e in got.collect() if not same(tuple(e))) == sorted(e for e in sides() if not same(e))
    odd = [(1, 0, 0, None, 1.0), (1, 0, 1, 1.0, 1.0), (1, 0, 2, 2.0, float("nan")), (1, 0, 3, 2.0, 2.0)]
    assert G.edges_of_corners(spark.createDataFrame(odd, "code long, part int, k int, x double, y double")).count() == 0


@pytest.mark.parametrize("size", [None, 0.7, 500.0])
def test_nearest_polygon(spark, size):
    rows = places() + [(None, 1.0), (float("nan"), 1.0)]
    got = {r.id: r for r in G.nearest_polygon(frame(spark, rows), G.edges_of(polygons(spark)), size).collect()}
    assert len(got) == len(rows) and all(got[k].nearest is None and got[k].distance is None for k in (len(rows) - 2, len(rows) - 1))
    for k, (x, y) in enumerate(rows[:-2]):
        d, c = away(x, y)
        assert got[k].nearest == c and got[k].distance == pytest.approx(d, rel=1e-12, abs=1e-12)


def test_nearest_polygon_of_nothing(spark):
    edges = G.edges_of(polygons(spark))
    assert {(r.nearest, r.distance) for r in G.nearest_polygon(frame(spark, places(3)), edges.limit(0)).collect()} == {(None, None)}
    assert G.nearest_polygon(frame(spark, []), edges).count() == 0
    one = spark.createDataFrame([(7, 3.0, 3.0, 3.0, 3.0)], "code long, x1 double, y1 double, x2 double, y2 double")
    assert [(r.nearest, r.distance) for r in G.nearest_polygon(frame(spark, [(0.0, -1.0)]), one).collect()] == [(7, 5.0)]


def crosses(e, a, b, s):
    _, x1, y1, x2, y2 = e
    if max(x1, x2) < a or min(x1, x2) > a + s or max(y1, y2) < b or min(y1, y2) > b + s:
        return False
    side = [(px - x1) * (y2 - y1) - (py - y1) * (x2 - x1) > 0 for px in (a, a + s) for py in (b, b + s)]
    return any(side) and not all(side)


def test_cells_of_polygons(spark):
    rng = random.Random(5)
    shapes = {c: [[(rng.uniform(0, 30), rng.uniform(0, 20)) for _ in range(rng.randint(3, 7))] for _ in range(rng.randint(1, 3))] for c in range(1, 9)}
    x0, y0, s, w, h = -1.13, -2.07, 0.71, 40, 30
    edges = G.edges_of(polygons(spark, shapes))
    cells = [(c, i, j) for i in range(-5, w + 10) for j in range(-5, h + 10) for c in shapes]
    spot = lambda i, j: (x0 + i * s, y0 + j * s)
    centred = {(c, i, j) for c, i, j in cells if c in held(spot(i + 0.5, 0)[0], spot(0, j + 0.5)[1], shapes)}
    touched = centred | {(e[0], i, j) for _, i, j in {(0, i, j) for _, i, j in cells} for e in sides(shapes) if crosses(e, *spot(i, j), s)}
    plain = lambda df: sorted((r.code, r.cx, r.cy) for r in df.collect())
    assert plain(G.cells_of_polygons(edges, x0, y0, s, False)) == sorted(centred)
    assert plain(G.cells_of_polygons(edges, x0, y0, s)) == sorted(touched)
    order = spark.createDataFrame([(c, -c) for c in shapes], "code long, ord long")
    for by, pick in ((None, max), (order, min)):
        grid = {(i, j): 0 for i in range(w) for j in range(h)}
        for at in grid:
            grid[at] = pick((c for c, i, j in touched if (i, j) == at), default=0)
        assert {(r.x, r.y): r.value for r in G.burn(edges, x0, y0, s, w, h, by).collect()} == grid


def test_cells_crossed_by_straight_edges(spark):
    edges = spark.createDataFrame([(1, 0.5, 0.5, 0.5, 3.5), (2, 3.5, 1.5, 0.5, 1.5), (3, 2.2, 2.2, 2.2, 2.2), (4, 0.5, 3.5, 2.5, 0.5)], "code long, x1 double, y1 double, x2 double, y2 double")
    got = {}
    for r in G.cells_crossed(edges, 1.0).collect():
        got.setdefault(r.code, set()).add((r.cx, r.cy))
    assert got == {1: {(0, k) for k in range(4)}, 2: {(k, 1) for k in range(4)}, 3: {(2, 2)}, 4: {(0, 3), (0, 2), (1, 2), (1, 1), (2, 1), (2, 0)}}
    wide = {(r.cx, r.cy) for r in G.cells_crossed(edges.where("code = 3"), 1.0, margin=1).collect()}
    assert wide == {(i, j) for i in (1, 2, 3) for j in (1, 2, 3)}


@pytest.mark.parametrize("size,x0,y0", [(3.0, -2.5, 1.25), (2.5, 0.3, -1.0), (0.4, 1.0, 1.0), (1.0, 0.0, 0.0)])
def test_resample_to(spark, size, x0, y0):
    px = {(i, j): None if (i * 7 + j) % 5 == 0 else float(i * i - 3 * j) for i in range(12) for j in range(9)}
    source, target = Grid(0.5, -0.5, 1.0, 12, 9), Grid(x0, y0, size, 20, 20)
    df = spark.createDataFrame([(i, j, v) for (i, j), v in px.items()], "x long, y long, value double")
    mean, near = {}, {}
    for i in range(20):
        for j in range(20):
            a, b, sums = x0 + i * size, y0 + j * size, []
            for (k, m), v in px.items():
                w = (min(a + size, k + 1.5) - max(a, k + 0.5)), (min(b + size, m + 0.5) - max(b, m - 0.5))
                if min(w) > 1e-9:
                    sums.append((w[0] * w[1], v))
            if sums:
                known = [(w, v) for w, v in sums if v is not None]
                mean[i, j] = sum(w * v for w, v in known) / sum(w for w, _ in known) if known else None
            at = math.floor(a + size / 2 - 0.5 + 1e-9), math.floor(b + size / 2 + 0.5 + 1e-9)
            if at in px:
                near[i, j] = px[at]
    got = {(r.x, r.y): r.value for r in resample_to(df, source, target).collect()}
    assert got.keys() == mean.keys() and all(got[k] == (v if v is None else pytest.approx(v, abs=1e-9)) for k, v in mean.items())
    assert {(r.x, r.y): r.value for r in resample_to(df, source, target, "nearest").collect()} == near
    assert resample_to(df.limit(0), source, target).count() == 0
    with pytest.raises(ValueError):
        resample_to(df, source, target, "cubic")


def test_nearest_without_places(spark, monkeypatch):
    points = frame(spark, [(0.0, 0.0), (9.0, 1.0), (None, 1.0), (1.0, float("nan"))])
    features = spark.createDataFrame([("a", 1.0, 0.0), ("b", 8.0, 0.0), ("c", None, 0.0), ("d", float("nan"), 0.0)], "code string, fx double, fy double")
    from coverspark.operators import spatial

    rounds = []
    plain = spatial.cut
    monkeypatch.setattr(spatial, "cut", lambda df: rounds.append(1) or plain(df))
    assert {r.id: r.nearest for r in nearest(points, features).collect()} == {0: "a", 1: "b", 2: None, 3: None}
    with_nulls = len(rounds)
    nearest(points.limit(2), features).collect()
    assert with_nulls == len(rounds) - with_nulls
    with pytest.raises(RuntimeError):
        nearest(frame(spark, [(1e6, 0.0)]), features, cell=1e-3, max_rounds=3)


def brute_clusters(rows, distance):
    out = []
    for k, (x, y) in enumerate(rows):
        out.append(min((out[j] for j in range(k) if math.hypot(x - rows[j][0], y - rows[j][1]) <= distance), default=k))
    return out


@pytest.mark.parametrize("spread", [0.3, 3.0, 25.0])
def test_distance_clusters(spark, spread):
    rng = random.Random(6)
    rows = [(rng.uniform(0, spread), rng.uniform(0, spread)) for _ in range(300)] + [(float(k % 20), float(k // 20)) for k in range(100)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(k, k, x, y) for k, (x, y) in enumerate(rows)] + [(1000, 1000, None, 1.0)], "id long, ord long, x double, y double").repartition(5)
    got = {r.id: r.cluster for r in spatial.distance_clusters(df, 1.0).collect()}
    assert got == dict(enumerate(brute_clusters(rows, 1.0))) | {1000: 1000}


def test_distance_clusters_of_places_with_many_points(spark, monkeypatch):
    """Once a place has come down to the least number it can have, its later points are compared with none; late places still are."""
    rng = random.Random(3)
    places = [(rng.uniform(0, 6), rng.uniform(0, 6)) for _ in range(40)]
    rows = [(k, *places[rng.randrange(min(40, 2 + k // 20))]) for k in range(3000)] + [(3000, 50.0, 50.0), (3001, *places[0])]
    now, want = {}, {1_000_000: 1_000_000}
    for k, x, y in rows:
        want[k] = now[x, y] = min((c for (a, b), c in now.items() if math.hypot(a - x, b - y) <= 1.0), default=k)
    compared, plain = [], spatial.earlier_neighbours
    monkeypatch.setattr(spatial, "earlier_neighbours", lambda df, distance: compared.append(df.count()) or plain(df, distance))
    df = spark.createDataFrame([*rows, (1_000_000, None, 1.0)], "ord long, x double, y double").selectExpr("ord AS id", "*").repartition(5)
    assert {r.id: r.cluster for r in spatial.distance_clusters(df, 1.0).collect()} == want
    assert len(compared) > 2 and sum(compared) < 2000


def test_neighbours_of_a_dense_site(spark):
    """All points in one cell, one after another: one edge a point instead of all pairs."""
    df = spark.range(20_000).selectExpr("id AS ord", "(hash(id) % 1000) / 1e5 + 0.2 AS x", "(hash(id, 1) % 1000) / 1e5 + 0.2 AS y")
    n = spatial.earlier_neighbours(df, 1.0).groupBy("ord").count()
    assert n.count() == 19_999 and n.agg({"count": "max"}).first()[0] == 1
    assert spatial.distance_clusters(df.withColumn("id", df.ord), 1.0).where("cluster <> 0").isEmpty()
    spread = spark.range(3000).selectExpr("id AS ord", "hash(id) % 1000 / 400.0D AS x", "hash(id, 1) % 1000 / 400.0D AS y")
    assert spatial.earlier_neighbours(spread, 1.0).groupBy("ord").count().agg({"count": "max"}).first()[0] <= 25


def test_pairs_of_many_points_in_few_places(spark):
    places = [(0.0, 0.0), (3.0, 4.0), (-0.5, 2.0), (40.0, 0.0)]
    rows = [(k, *places[k % 4 if k < 900 else 0]) for k in range(1200)] + [(7, 3.0, 4.0), (None, 0.0, 0.0), (1300, float("nan"), 0.0), (1301, None, 0.0), (1302, float("inf"), 0.0)]
    got = spatial.pairs_within(spark.createDataFrame(rows, "id long, x double, y double"), 5.0, digits=3)
    # the distance of two places is found once: near lists, not candidate points, come out of the join
    joined = _made(got, "Join")
    assert joined and max(joined) < 2000
    want = Counter()
    for a, ax, ay in rows:
        for b, bx, by in rows:
            if a is not None and b is not None and a < b and ax is not None and bx is not None and math.hypot(ax - bx, ay - by) <= 5:
                want[a, b, round(math.hypot(ax - bx, ay - by), 3)] += 1
    assert Counter((r.a, r.b, r.distance) for r in got.collect()) == want


def _made(df, operator):
    """Rows that operators of that name made when df is computed."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    todo[0].executeCollect()
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(p.plan())
        if operator in p.nodeName() and p.metrics().contains("numOutputRows"):
            out.append(p.metrics().apply("numOutputRows").value())
        todo += [p.children().apply(k) for k in range(p.children().size())]
    return out
