"""Points, polygons, pixels and bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverspark.functions import bands as B
from coverspark.functions import numbers as N
from coverspark.operators import spatial as P
from coverspark.operators.order_stats import with_quantiles
from coverspark.plans.registry import BANDS, PIXELS, POINTS, ctes, query, table

_P = ctes(p=POINTS)
_X = ctes(p=PIXELS)
#: Rectangles by nation and a hexagon, in degrees.
BOXES = "SELECT n_nationkey AS code, -170.0 + n_nationkey * 1.2 AS min_x, -167.5 + n_nationkey * 1.2 AS max_x, 60.0 + n_nationkey % 5 AS min_y, 65.0 + n_nationkey % 5 AS max_y FROM nation"
_BOXES = ctes(p=POINTS, b="SELECT code, CAST(min_x AS DOUBLE) AS min_x, CAST(max_x AS DOUBLE) AS max_x, CAST(min_y AS DOUBLE) AS min_y, CAST(max_y AS DOUBLE) AS max_y FROM (" + BOXES + ")")
_INSIDE = "x >= min_x AND x < max_x AND y >= min_y AND y < max_y"
HEXAGON = [(-160.0, 62.0), (-155.0, 61.0), (-150.0, 62.0), (-150.0, 67.0), (-155.0, 69.0), (-160.0, 67.0), (-160.0, 62.0)]


def _boxes(spark, d):
    return table(spark, d, BOXES).select("code", *(F.col(c).cast("double").alias(c) for c in ("min_x", "max_x", "min_y", "max_y")))


@query(_BOXES + f"SELECT id, coalesce(array_to_string(list_sort(list(code) FILTER (code IS NOT NULL)), ','), '') AS codes FROM p LEFT JOIN b ON {_INSIDE} GROUP BY id")
def point_in_polygon(spark, d):
    p = table(spark, d, POINTS)
    hit = P.box_join(p, _boxes(spark, d), 1.0).groupBy("id").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return p.join(hit, "id", "left").select("id", F.coalesce(F.array_join(F.col("codes").cast("array<string>"), ","), F.lit("")).alias("codes"))


@query(_BOXES + f"SELECT id FROM p WHERE EXISTS (SELECT 1 FROM b WHERE {_INSIDE} AND code IN (3, 7, 11))")
def region_filter(spark, d):
    return P.box_join(table(spark, d, POINTS), _boxes(spark, d).where("code in (3, 7, 11)"), 1.0, "left_semi").select("id")


_EDGES = "(VALUES " + ", ".join(f"({a}, {b}, {c}, {e})" for (a, b), (c, e) in zip(HEXAGON, HEXAGON[1:])) + ") e(x1, y1, x2, y2)"


@query(_P + f"SELECT id FROM p WHERE (SELECT count(*) FROM {_EDGES} WHERE (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)) % 2 = 1")
def polygon_clip(spark, d):
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in HEXAGON))
    return table(spark, d, POINTS).where(P.in_ring(F.col("x"), F.col("y"), ring)).select("id")


@query(_BOXES + f"SELECT code, count(*) AS n, round(avg(y), 6) AS mean_y FROM p JOIN b ON {_INSIDE} GROUP BY code")
def tile_to_cells(spark, d):
    return P.box_join(table(spark, d, POINTS), _boxes(spark, d), 1.0).groupBy("code").agg(F.count("*").alias("n"), F.round(F.avg("y"), 6).alias("mean_y"))


@query(_X + ", px AS (SELECT x AS col, y AS row, max(value) AS value FROM p GROUP BY ALL) SELECT o_orderkey, value FROM orders LEFT JOIN px ON col = CAST(floor((o_custkey * 3.0 + 1) / 2) AS BIGINT) AND row = CAST(floor((100 - o_orderkey % 97) / 2.0) AS BIGINT)")
def raster_sample(spark, d):
    px = table(spark, d, PIXELS).groupBy(F.col("x").alias("col"), F.col("y").alias("row")).agg(F.max("value").alias("value"))
    o = table(spark, d, "SELECT o_orderkey, o_custkey * 3.0D + 1 AS x, CAST(o_orderkey % 97 AS DOUBLE) AS y FROM orders")
    return P.sample_raster(o, px, 0.0, 100.0, 2.0).select("o_orderkey", "value")


@query(_P + "SELECT id, (SELECT code FROM (SELECT n_nationkey AS code, -170.0 + n_nationkey * 1.2 AS fx, 60.0 + n_nationkey % 5 AS fy FROM nation) ORDER BY (fx - x) * (fx - x) + (fy - y) * (fy - y), code LIMIT 1) AS nearest FROM p")
def nearest_fallback(spark, d):
    f = table(spark, d, "SELECT n_nationkey AS code, CAST(-170.0 + n_nationkey * 1.2 AS DOUBLE) AS fx, CAST(60.0 + n_nationkey % 5 AS DOUBLE) AS fy FROM nation")
    return P.nearest(table(spark, d, POINTS), f).select("id", "nearest")


METRES = "SELECT c_custkey AS id, c_custkey AS ord, CAST(c_custkey * 37 % 3000 AS DOUBLE) AS x, CAST(c_custkey * 53 % 1000 AS DOUBLE) AS y FROM customer"


@query(ctes(m=METRES) + "SELECT a.id AS a, b.id AS b, round(sqrt((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2), 6) AS distance FROM m a JOIN m b ON a.id < b.id AND (a.x - b.x) ^ 2 + (a.y - b.y) ^ 2 <= 55.0 * 55")
def pairs_within(spark, d):
    return P.pairs_within(table(spark, d, METRES), 55.0, digits=6)


_REACH = """ e AS (SELECT b.ord AS ord, a.ord AS earlier FROM {m} a JOIN {m} b ON a.ord < b.ord AND (a.x - b.x) ^ 2 + (a.y - b.y) ^ 2 <= 900),
  r(ord, low) AS (SELECT ord, ord FROM {m} UNION SELECT r.ord, e.earlier FROM r JOIN e ON e.ord = r.low)"""


@query(ctes(m=METRES).replace("WITH ", "WITH RECURSIVE ") + "," + _REACH.format(m="m") + " SELECT id, cluster FROM m JOIN (SELECT ord, min(low) AS cluster FROM r GROUP BY 1) USING (ord)")
def distance_clusters(spark, d):
    return P.distance_clusters(table(spark, d, METRES), 30.0)


_PLOTS = METRES.replace(" FROM customer", ", CASE c_custkey % 5 WHEN 0 THEN 400.0 ELSE 100.0 END AS area FROM customer")


@query(ctes(p=_PLOTS, m="SELECT * FROM p WHERE area < 314").replace("WITH ", "WITH RECURSIVE ") + "," + _REACH.format(m="m") + """, c AS (SELECT id, cluster FROM m JOIN (SELECT ord, min(low) AS cluster FROM r GROUP BY 1) USING (ord))
  SELECT p.id, CASE WHEN cluster IS NOT NULL THEN 'site_' || (dense_rank() OVER (PARTITION BY cluster IS NULL ORDER BY cluster) - 1) END AS parent FROM p LEFT JOIN c USING (id)""")
def parent_sites(spark, d):
    return P.parent_sites(table(spark, d, _PLOTS).withColumn("area", F.col("area").cast("double")), 30.0)


@query(_P + "SELECT id, CAST(floor((x + 170) / 0.18) AS BIGINT) || '_' || CAST(floor((y - 60) / 0.18) AS BIGINT) AS cell FROM p")
def grid_cell_id(spark, d):
    return table(spark, d, POINTS).select("id", N.grid_cell(F.col("x"), F.col("y"), -170.0, 60.0, 0.18).alias("cell"))


def _duck_utm() -> str:
    """The transverse Mercator series in SQL; lon and lat in degrees, zone as a number."""
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    terms = f"""radians(lat) AS phi, radians(lon - (6 * zone - 183)) * cos(radians(lat)) AS q, tan(radians(lat)) ^ 2 AS t, {ep2} * cos(radians(lat)) ^ 2 AS c, {a} / sqrt(1 - {e2} * sin(radians(lat)) ^ 2) AS n,
      {a} * ({1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256} * radians(lat) - {3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024} * sin(2 * radians(lat)) + {15 * e2**2 / 256 + 45 * e2**3 / 1024} * sin(4 * radians(lat)) - {35 * e2**3 / 3072:.20f} * sin(6 * radians(lat))) AS m"""
    east = f"0.9996 * n * (q + (1 - t + c) * q ^ 3 / 6 + (5 - 18 * t + t * t + 72 * c - {58 * ep2}) * q ^ 5 / 120) + 500000"
    north = f"0.9996 * (m + n * tan(phi) * (q ^ 2 / 2 + (5 - t + 9 * c + 4 * c * c) * q ^ 4 / 24 + (61 - 58 * t + t * t + 600 * c - {330 * ep2}) * q ^ 6 / 720))"
    return f"SELECT id, zone, round({east}, 3) AS east, round({north}, 3) AS north FROM (SELECT id, zone, {terms} FROM (SELECT id, x AS lon, y AS lat, CAST(floor((x + 180) / 6) + 1 AS BIGINT) AS zone FROM p))"


@query(_P + _duck_utm())
def projected_points(spark, d):
    zone = N.utm_zone(F.col("x"))
    e, n = N.utm(F.col("x"), F.col("y"), zone)
    return table(spark, d, POINTS).select("id", zone.alias("zone"), F.round(e, 3).alias("east"), F.round(n, 3).alias("north"))


@query(_X + "SELECT s_suppkey, quantile_cont(value, 0.5) AS median, count(*) AS n FROM supplier JOIN p ON (x - s_suppkey * 15) ^ 2 + (y - s_suppkey) ^ 2 <= 900 GROUP BY 1")
def buffer_median(spark, d):
    px = table(spark, d, PIXELS).select(F.col("x").cast("double").alias("px"), F.col("y").cast("double").alias("py"), "value")
    s = table(spark, d, "SELECT s_suppkey, CAST(s_suppkey * 15 AS DOUBLE) AS cx, CAST(s_suppkey AS DOUBLE) AS cy FROM supplier")
    s = s.select("s_suppkey", "cx", "cy", (F.col("cx") - 30).alias("min_x"), (F.col("cx") + 30.001).alias("max_x"), (F.col("cy") - 30).alias("min_y"), (F.col("cy") + 30.001).alias("max_y"))
    near = P.box_join(px.withColumnsRenamed({"px": "x", "py": "y"}), s, 30.0).where(F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")) <= 30)
    found = with_quantiles(near.groupBy("s_suppkey").agg(F.count("*").alias("n")), near, ["s_suppkey"], "value", [0.5])
    return found.select("s_suppkey", F.col("q")[0].alias("median"), "n")


@query("SELECT l_suppkey, l_linenumber, quantile_cont(l_quantity, 0.5) AS median, min(l_shipdate) AS first_time, max(l_quantity) AS top FROM lineitem GROUP BY ALL")
def median_composite(spark, d):
    return P.composite(table(spark, d, "SELECT l_suppkey, l_linenumber, l_quantity, l_shipdate FROM lineitem"), ["l_suppkey", "l_linenumber"], "l_quantity", "l_shipdate")


@query("""WITH n AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL), top AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) AS r FROM n)
  SELECT l_suppkey, l_returnflag, count(*) AS n, sum(l_quantity) AS total FROM lineitem JOIN top USING (l_suppkey, l_returnflag) WHERE r = 1 GROUP BY ALL""")
def majority_filter(spark, d):
    return P.majority(table(spark, d, "SELECT l_suppkey, l_returnflag, l_quantity FROM lineitem"), "l_suppkey", "l_returnflag").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total"))


_UNIQUE = "SELECT x, y, CASE WHEN line <> 2 THEN value END AS value, ord * 10 + line AS k FROM (SELECT l_partkey AS x, l_suppkey AS y, l_orderkey AS ord, l_linenumber AS line, max(l_quantity) AS value FROM lineitem GROUP BY ALL) u"


@query(f"SELECT x, y, max_by(value, k) FILTER (value IS NOT NULL) AS value FROM ({_UNIQUE}) GROUP BY ALL")
def mosaic_last(spark, d):
    return P.mosaic_last(table(spark, d, _UNIQUE), "k")


@query(_X + "SELECT CAST(floor(x / 8.0) AS BIGINT) AS x, CAST(floor(y / 8.0) AS BIGINT) AS y, round(avg(value), 6) AS value FROM p GROUP BY ALL")
def resample_avg(spark, d):
    return P.resample(table(spark, d, PIXELS), 8).withColumn("value", F.round("value", 6))


@query(_X + "SELECT CAST(level AS INT) AS level, CAST(floor(x / 2.0 ^ level) AS BIGINT) AS x, CAST(floor(y / 2.0 ^ level) AS BIGINT) AS y, round(avg(value), 6) AS value FROM p, (SELECT unnest(range(1, 7)) AS level) GROUP BY ALL")
def pyramid_levels(spark, d):
    return P.pyramid(table(spark, d, PIXELS), 6).withColumn("value", F.round("value", 6))


_GRID = "SELECT CAST(k % 40 AS BIGINT) AS x, CAST(k // 40 AS BIGINT) AS y, v AS value FROM (SELECT l_partkey AS k, sum(l_quantity) AS v FROM lineitem GROUP BY 1)"
_SPARK_GRID = _GRID.replace("k // 40", "k div 40") + " g"


@query(f"""WITH g AS ({_GRID}), d AS (SELECT a.x, a.y, count(*) AS n, sum(b.value * (b.x - a.x) * (2 - abs(b.y - a.y))) / 80 AS gx, sum(b.value * (b.y - a.y) * (2 - abs(b.x - a.x))) / 80 AS gy
  FROM g a JOIN g b ON b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 GROUP BY ALL)
  SELECT x, y, round(degrees(atan(s)), 4) AS slope, round(CASE WHEN a < 0 THEN a + 360 ELSE a END, 3) AS aspect, round(sqrt(0.5) * cos(atan(s)) + sqrt(0.5) * sin(atan(s)) * cos(radians(180 - a)), 5) AS hillshade
  FROM (SELECT x, y, sqrt(gx * gx + gy * gy) AS s, degrees(atan2(gy, -gx)) AS a FROM d WHERE n = 9)""")
def terrain_3x3(spark, d):
    return P.terrain(table(spark, d, _SPARK_GRID), 10.0).select("x", "y", F.round("slope", 4).alias("slope"), F.round("aspect", 3).alias("aspect"), F.round("hillshade", 5).alias("hillshade"))


@query(f"WITH g AS ({_GRID}) SELECT a.x, a.y, any_value(a.value) AS value, max(b.value) AS focal FROM g a JOIN g b ON b.x BETWEEN a.x - 2 AND a.x + 2 AND b.y BETWEEN a.y - 2 AND a.y + 2 GROUP BY a.x, a.y")
def focal_max(spark, d):
    return P.focal(table(spark, d, _SPARK_GRID), 2)


@query(f"WITH g AS ({_GRID}) SELECT a.x, a.y, any_value(a.value) AS value, min(b.value) AS focal FROM g a JOIN g b ON b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 GROUP BY a.x, a.y")
def focal_min(spark, d):
    return P.focal(table(spark, d, _SPARK_GRID), 1, "min")


@query(f"""WITH g AS (SELECT x, y, CASE WHEN value > 500 THEN 1 ELSE 0 END AS value FROM ({_GRID})), e AS (SELECT a.x, a.y, min(b.value) AS low FROM g a JOIN g b ON b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 GROUP BY a.x, a.y)
  SELECT a.x, a.y, any_value(a.value) AS value, max(b.low) AS opened FROM g a JOIN e b ON b.x BETWEEN a.x - 2 AND a.x + 2 AND b.y BETWEEN a.y - 2 AND a.y + 2 GROUP BY a.x, a.y""")
def eroded_then_grown(spark, d):
    g = table(spark, d, _SPARK_GRID).withColumn("value", F.when(F.col("value") > 500, 1).otherwise(0))
    return P.opened(g, 1, 2)


@query(f"WITH g AS (SELECT x, y, CASE WHEN value > 900 THEN 1 ELSE 0 END AS cloud, CASE WHEN value < 750 THEN 1 ELSE 0 END AS dark FROM ({_GRID})) SELECT x, y, CASE WHEN dark = 1 AND EXISTS (SELECT 1 FROM g c WHERE c.cloud = 1 AND g.x - c.x = g.y - c.y AND g.x - c.x BETWEEN 1 AND 3) THEN 1 ELSE 0 END AS shadow FROM g")
def shadow_steps(spark, d):
    g = table(spark, d, _SPARK_GRID).select("x", "y", F.when(F.col("value") > 900, 1).otherwise(0).alias("cloud"), F.when(F.col("value") < 750, 1).otherwise(0).alias("dark"))
    return P.shadow(g, 1, 1, 3).select("x", "y", "shadow")


@query(_X + "SELECT cell_id, count(*) AS n, count(v) AS n_valid, round(sum(v), 6) AS total FROM (SELECT cell_id, CASE WHEN y NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 2000) THEN value END AS v FROM p) GROUP BY ALL")
def mask_join(spark, d):
    m = table(spark, d, "SELECT s_suppkey AS y, 1 AS mask FROM supplier WHERE s_acctbal < 2000")
    px = table(spark, d, PIXELS).join(m, "y", "left").withColumn("v", F.when(F.col("mask").isNull(), F.col("value")))
    return px.groupBy("cell_id").agg(F.count("*").alias("n"), F.count("v").alias("n_valid"), F.round(F.sum("v"), 6).alias("total"))


@query(_X + "SELECT cell_id, v, count(*) AS n FROM (SELECT cell_id, CASE WHEN line = 7 THEN 255 ELSE CAST(floor(share * 100) AS INT) END AS v FROM p) GROUP BY ALL")
def scaled_product(spark, d):
    px = table(spark, d, PIXELS).withColumn("v", N.scaled_product(F.when(F.col("line") != 7, F.col("share"))))
    return px.groupBy("cell_id", "v").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n FROM lineitem WHERE (l_orderkey & 1024) = 0 AND (l_orderkey & 2048) = 0")
def qa_bitmask(spark, d):
    return table(spark, d, "SELECT l_orderkey FROM lineitem").where(N.bits_clear(F.col("l_orderkey"), 10, 11)).agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, n, total FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS total FROM lineitem WHERE l_quantity > 49 AND l_linenumber = 7 GROUP BY 1) ON l_suppkey = s_suppkey")
def empty_composite_spine(spark, d):
    got = table(spark, d, "SELECT l_suppkey AS s_suppkey, l_quantity FROM lineitem WHERE l_quantity > 49 AND l_linenumber = 7").groupBy("s_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total"))
    return table(spark, d, "SELECT s_suppkey FROM supplier").join(got, "s_suppkey", "left")


def _duck_indices() -> str:
    n, r, g, b, s1, s2, e = "nir", "red", "green", "blue", "swir1", "swir2", "red_edge"
    root = lambda x: f"(CASE WHEN {x} >= 0 THEN sqrt({x}) END)"
    over = lambda x, y: f"(({x}) / nullif({y}, 0))"
    sq = f"(2 * {n} + 1) * (2 * {n} + 1)"
    out = {
        "ndwi1": over(f"{n} - {s1}", f"{n} + {s2}"), "ndwi2": over(f"{n} - {s2}", f"{n} + {s2}"), "msavi": f"0.5 * (2 * {n} + 1 - {root(f'({sq} - 8 * ({n} - {r}))')})", "vari": over(f"{g} - {r}", f"{g} + {r} - {b}"), "rvi": over(n, r),
        "osavi": over(f"1.16 * ({n} - {r})", f"{n} + {r} + 0.16"), "tgi": f"0.5 * (120 * ({r} - {b}) - 190 * ({r} - {g}))", "gli": over(f"2 * {g} - {r} - {b}", f"2 * {g} + {r} + {b}"), "ngrdi": over(f"{g} - {r}", f"{g} + {r}"),
        "ci_g": f"{over(n, g)} - 1", "gndvi": over(f"{n} - {g}", f"{n} + {g}"), "cvi": over(f"{n} * {r}", f"{g} * {g}"),
        "mtvi2": over(f"1.5 * (1.2 * ({n} - {g}) - 2.5 * ({r} - {g}))", root(f"({sq} - (6 * {n} - 5 * sqrt({r})) - 0.5)")),
        "brightness": f"0.3037 * {b} + 0.2793 * {g} + 0.4743 * {r} + 0.5585 * {n} + 0.5082 * {s1} + 0.1863 * {s2}", "greenness": f"-0.2848 * {b} - 0.2435 * {g} - 0.5436 * {r} + 0.7243 * {n} + 0.0840 * {s1} - 0.1800 * {s2}",
        "wetness": f"0.1509 * {b} + 0.1973 * {g} + 0.3279 * {r} + 0.3406 * {n} - 0.7112 * {s1} - 0.4572 * {s2}",
        "tcari": f"3 * (({e} - {r}) - 0.2 * ({e} - {g}) * {over(e, r)})", "tci": f"1.2 * ({e} - {g}) - 1.5 * ({r} - {g}) * sqrt({over(e, r)})", "nari": over(f"1 / {g} - 1 / {e}", f"1 / {g} + 1 / {e}"),
    }
    return ", ".join(f"round({v}, 4) AS {k}" for k, v in out.items())


@query(ctes(b=BANDS) + f"SELECT id, {_duck_indices()} FROM b")
def veg_indices(spark, d):
    b = table(spark, d, BANDS)
    return B.with_indices(b).select("id", *(F.round(n, 4).alias(n) for n in B.indices(*(F.col(c) for c in b.columns[2:9]))))


@query(ctes(b=BANDS) + "SELECT zone, CASE WHEN (green - nir) / (green + nir) > 0 AND (nir - red) / (nir + red) < 0.3 THEN 1 ELSE 0 END AS water, count(*) AS n FROM b GROUP BY ALL")
def water_mask(spark, d):
    b = table(spark, d, BANDS)
    ndwi, ndvi = (F.try_divide(F.col(p) - F.col(q), F.col(p) + F.col(q)) for p, q in (("green", "nir"), ("nir", "red")))
    return b.groupBy("zone", B.water(ndwi, ndvi).alias("water")).agg(F.count("*").alias("n"))


@query(ctes(b=BANDS) + "SELECT id, round((nir - lo) / (hi - lo), 6) AS nir FROM b, (SELECT min(nir) AS lo, max(nir) AS hi FROM b)")
def minmax_scale(spark, d):
    b = table(spark, d, BANDS)
    ends = b.agg(F.min("nir").alias("lo"), F.max("nir").alias("hi"))
    return b.crossJoin(F.broadcast(ends)).select("id", F.round(F.try_divide(F.col("nir") - F.col("lo"), F.col("hi") - F.col("lo")), 6).alias("nir"))


@query("SELECT o_custkey AS site, n, c_acctbal AS radar, slope FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) JOIN customer ON c_custkey = o_custkey JOIN (SELECT s_suppkey AS k, s_acctbal AS slope FROM supplier) ON k = o_custkey")
def feature_chain(spark, d):
    a = table(spark, d, "SELECT o_custkey AS site FROM orders").groupBy("site").agg(F.count("*").alias("n"))
    return a.join(table(spark, d, "SELECT c_custkey AS site, c_acctbal AS radar FROM customer"), "site").join(table(spark, d, "SELECT s_suppkey AS site, s_acctbal AS slope FROM supplier"), "site")


@query(ctes(b=BANDS) + """SELECT id, round((nir - red) / (nir + red), 6) AS ndvi, round(2.5 * (nir - red) / (nir + 6 * red - 7.5 * blue + 1), 5) AS evi, round((nir - red) / (nir + red + swir1), 6) AS mavi, round((green - nir) / (green + nir), 6) AS ndwi,
  round((green - nir) / (green + nir) * swir2, 6) AS ndwi_wetness, round((nir - red) / (nir + red) * swir2, 6) AS ndvi_wetness, round(swir1 - swir2, 6) AS difference, round(swir1 / swir2, 4) AS ratio FROM b""")
def season_indices(spark, d):
    nir, red, green, blue, a, w = (F.col(c) for c in ("nir", "red", "green", "blue", "swir1", "swir2"))
    cols = {n: B.season_index(n, nir, red, blue, a) for n in ("ndvi", "evi", "mavi")} | B.water_terms(nir, red, green, w) | B.band_difference(a, w)
    return table(spark, d, BANDS).select("id", *(F.round(c, {"evi": 5, "ratio": 4}.get(n, 6)).alias(n) for n, c in cols.items()))


#: A triangle or a pentagon per nation.
RINGS = """SELECT n_nationkey AS code, -169.0 + n_nationkey * 1.1 AS cx, 61.0 + n_nationkey % 7 AS cy, 3 + n_nationkey % 3 AS corners FROM nation"""
_CORNER = "cx + 2.5 * cos(2 * pi() * ({k} % corners) / corners + code), cy + 2.5 * sin(2 * pi() * ({k} % corners) / corners + code)"


@query(ctes(p=POINTS, r=RINGS, e="SELECT code, x1, y1, x2, y2 FROM (SELECT code, " + ", ".join(f"{c} AS {n}" for k, names in (("k", ("x1", "y1")), ("(k + 1)", ("x2", "y2"))) for c, n in zip(_CORNER.format(k=k).split(", "), names)) + " FROM (SELECT *, unnest(range(0, corners)) AS k FROM r))") + """
  , h AS (SELECT id, code FROM p JOIN e ON (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) GROUP BY id, code HAVING count(*) % 2 = 1)
  SELECT id, coalesce((SELECT array_to_string(list_sort(list(code)), ',') FROM h WHERE h.id = p.id), '') AS codes FROM p""")
def points_in_rings(spark, d):
    corner = F.struct(*(F.expr(c).alias(n) for c, n in zip(_CORNER.format(k="k").split(", "), ("x", "y"))))
    r = table(spark, d, RINGS).withColumn("ring", F.expr("sequence(0, corners)"))
    r = r.select("code", "cx", "cy", "corners", F.explode("ring").alias("k")).select("code", "k", corner.alias("v")).groupBy("code").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda s: s["v"]).alias("ring"))
    p = table(spark, d, POINTS)
    hit = P.ring_join(p, r, 1.0).groupBy("id").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return p.join(hit, "id", "left").select("id", F.coalesce(F.array_join(F.col("codes").cast("array<string>"), ","), F.lit("")).alias("codes"))


_CELLS = "SELECT n_nationkey AS code, n_nationkey * 9.5 AS min_x, n_nationkey * 9.5 + 7.25 AS max_x, (n_nationkey % 3) * 2.5 AS min_y, (n_nationkey % 3) * 2.5 + 3.0 AS max_y FROM nation"


@query(ctes(p=PIXELS, b=_CELLS) + "SELECT code, x, y, count(*) AS n FROM p JOIN b ON x <= max_x AND x + 1 >= min_x AND y <= max_y AND y + 1 >= min_y GROUP BY ALL")
def tiles_touching(spark, d):
    b = table(spark, d, _CELLS).select("code", *(F.col(c).cast("double").alias(c) for c in ("min_x", "max_x", "min_y", "max_y")))
    return P.clip_touching(table(spark, d, PIXELS), b, 1.0, 8.0).groupBy("code", "x", "y").agg(F.count("*").alias("n"))


@query(ctes(b=BOXES) + """, g AS (SELECT CAST(i % 40 AS BIGINT) AS x, CAST(i // 40 AS BIGINT) AS y FROM (SELECT unnest(range(0, 40 * 24)) AS i)) SELECT g.x, g.y, coalesce(max(code), 0) AS value
  FROM g LEFT JOIN b ON floor((CAST(min_x AS DOUBLE) + 170) / 0.5) <= g.x AND floor((CAST(max_x AS DOUBLE) + 170) / 0.5) >= g.x AND floor((CAST(min_y AS DOUBLE) - 58) / 0.5) <= g.y AND floor((CAST(max_y AS DOUBLE) - 58) / 0.5) >= g.y GROUP BY ALL""")
def rasterized(spark, d):
    return P.rasterize(_boxes(spark, d), "code", -170.0, 58.0, 0.5, 40, 24)


@query(_X + "SELECT x, y, round(avg(CASE WHEN line <> 3 THEN value END), 6) AS value FROM p GROUP BY ALL")
def pixel_mean(spark, d):
    px = table(spark, d, PIXELS).withColumn("value", F.when(F.col("line") != 3, F.col("value")))
    return P.pixel_mean(px).withColumn("value", F.round("value", 6))


@query(f"SELECT x // 3 AS x, y // 3 AS y, value FROM ({_GRID}) WHERE x % 3 = 1 AND y % 3 = 1")
def resample_nearest(spark, d):
    return P.resample_nearest(table(spark, d, _SPARK_GRID), 3)


@query(_P + "SELECT id, (SELECT code FROM (SELECT n_nationkey AS code, -170.0 + n_nationkey * 1.2 AS fx, 60.0 + n_nationkey % 5 AS fy FROM nation WHERE n_nationkey % 7 <> 6) ORDER BY (fx - cx) ^ 2 + (fy - cy) ^ 2, code LIMIT 1) AS nearest FROM (SELECT id, greatest(least(x, -150.0), -165.0) AS cx, greatest(least(y, 64.0), 61.0) AS cy FROM p)")
def nearest_clamped(spark, d):
    f = table(spark, d, "SELECT n_nationkey AS code, CAST(-170.0 + n_nationkey * 1.2 AS DOUBLE) AS fx, CAST(60.0 + n_nationkey % 5 AS DOUBLE) AS fy FROM nation WHERE n_nationkey % 7 <> 6")
    p = table(spark, d, POINTS).select("id", P.clamped(F.col("x"), -165.0, -150.0).alias("x"), P.clamped(F.col("y"), 61.0, 64.0).alias("y"))
    return P.nearest(p, f).select("id", "nearest")


@query(f"WITH g AS ({_GRID}) SELECT x, y, CASE WHEN value < 600 THEN 255 ELSE CAST(floor(value / 2000 * 100) AS INT) END AS value, DATE '2019-06-01' AS time_begin, DATE '2019-08-31' AS time_end FROM g")
def masked_product(spark, d):
    g = table(spark, d, _SPARK_GRID)
    mask = g.select("x", "y", F.when(F.col("value") < 600, 1).otherwise(0).alias("mask"))
    return N.product_rows(g.withColumn("value", F.col("value") / 2000), "value", mask, "2019-06-01", "2019-08-31").drop("mask")
