"""Bringing sources together, validating them, and summary statistics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from coverspark.functions import dates as D
from coverspark.functions import numbers as N
from coverspark.functions import text as T
from coverspark.operators import lists as L
from coverspark.operators import stats as S
from coverspark.operators import validate as V
from coverspark.operators.order_stats import nearest_rows, with_quantiles
from coverspark.plans.registry import COVER, VISITS, ctes, query, table
from coverspark.sources import files

_V = ctes(v=VISITS)
_C = ctes(cover=COVER)


@query(_C + "SELECT dataset, p_partkey, min_by(cover, visit_id * 10 + line) FILTER (cover IS NOT NULL) AS first_cover FROM (SELECT dataset, p_partkey, visit_id, line, max(cover) AS cover FROM cover GROUP BY ALL) GROUP BY ALL")
def first_nonnull(spark, d):
    c = table(spark, d, COVER).groupBy("dataset", "p_partkey", "visit_id", "line").agg(F.max("cover").alias("cover")).withColumn("ord", F.col("visit_id") * 10 + F.col("line"))
    return c.groupBy("dataset", "p_partkey").agg(L.first_nonnull("cover", "ord").alias("first_cover"))


@query(_V + "SELECT plot, round(avg(price), 4) AS price, min_by(method, visit_id) AS method, array_to_string(list(visit_id ORDER BY visit_id), '; ') AS visits FROM v GROUP BY plot")
def parent_collapse(spark, d):
    g = table(spark, d, VISITS).groupBy("plot").agg(F.round(F.avg("price"), 4).alias("price"), L.first_nonnull("method", "visit_id").alias("method"), F.array_sort(F.collect_list("visit_id")).alias("visits"))
    return files.lists_to_text(g)


_DATASETS = "SELECT species, array_to_string(list_sort(list(DISTINCT dataset)), '; ') AS datasets, count(DISTINCT visit_id) AS n_visits FROM cover GROUP BY species"


@query(_C + _DATASETS)
def species_lists(spark, d):
    return files.lists_to_text(table(spark, d, COVER).groupBy("species").agg(F.array_sort(F.collect_set("dataset")).alias("datasets"), F.countDistinct("visit_id").alias("n_visits")))


@query(_C + f"SELECT species, unnest(string_split(datasets, '; ')) AS dataset FROM ({_DATASETS})")
def explode_lists(spark, d):
    return table(spark, d, COVER).groupBy("species").agg(F.array_sort(F.collect_set("dataset")).alias("datasets")).select("species", F.explode_outer("datasets").alias("dataset"))


@query("""SELECT p_partkey, CASE WHEN p_size % 7 > 0 AND count(*) OVER w > 1 THEN array_to_string(list(p_partkey) OVER w2, ',') ELSE '' END AS same
  FROM (SELECT *, CASE WHEN p_size % 7 > 0 THEN p_size END AS s FROM part) WINDOW w AS (PARTITION BY p_brand, s), w2 AS (PARTITION BY p_brand, s ORDER BY CAST(p_partkey AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def dup_groups(spark, d):
    p = table(spark, d, "SELECT p_partkey, p_brand, CASE WHEN p_size % 7 > 0 THEN p_size END AS s FROM part")
    return L.same_key_rows(p, ["p_brand", "s"], "p_partkey").select("p_partkey", "same")


@query("""SELECT p_partkey, CASE WHEN n > 1 THEN first END AS "group", CASE WHEN n > 1 THEN n END AS size
  FROM (SELECT p_partkey, CASE WHEN p_size % 7 > 0 THEN min(p_partkey) OVER w END AS first, CASE WHEN p_size % 7 > 0 THEN count(*) OVER w END AS n FROM part WINDOW w AS (PARTITION BY p_brand, p_size))""")
def duplicate_groups(spark, d):
    p = table(spark, d, "SELECT p_partkey, p_brand, CASE WHEN p_size % 7 > 0 THEN p_size END AS s FROM part")
    return L.same_key_groups(p, ["p_brand", "s"], "p_partkey").select("p_partkey", "group", "size")


@query("""WITH sets AS (SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT CAST(l_suppkey AS VARCHAR))), '|') AS s FROM lineitem GROUP BY 1)
  SELECT a.l_orderkey AS parent, b.l_orderkey AS other FROM sets a LEFT JOIN (SELECT * FROM sets WHERE l_orderkey % 2 = 1) b ON a.s = b.s WHERE a.l_orderkey % 2 = 0""")
def set_equality_join(spark, d):
    sets = table(spark, d, "SELECT l_orderkey, l_suppkey FROM lineitem").groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("children"))
    even, odd = sets.where("l_orderkey % 2 = 0"), sets.where("l_orderkey % 2 = 1")  # the two sides
    return L.set_equality_join(even.withColumnsRenamed({"l_orderkey": "parent", "children": "la"}), odd.withColumnsRenamed({"l_orderkey": "other", "children": "lb"}), "la", "lb").select("parent", "other")


@query("SELECT o_orderkey, CASE WHEN o_custkey % 3 > 0 THEN 'u' || o_custkey END AS o_custkey FROM orders")
def replace_ids(spark, d):
    o = table(spark, d, "SELECT o_orderkey, o_custkey FROM orders")
    m = table(spark, d, "SELECT c_custkey AS o_custkey, 'u' || c_custkey AS uid FROM customer WHERE c_custkey % 3 > 0")
    return L.replace_id(o, m, "o_custkey", "uid")


_PACKED = "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN {f8} WHEN 1 THEN {f6} WHEN 2 THEN {f4} ELSE 'n/a' END AS packed FROM orders"
_DP = _PACKED.format(f8="strftime(o_orderdate, '%Y%m%d')", f6="strftime(o_orderdate, '%Y%m')", f4="strftime(o_orderdate, '%Y')")
_SP = _PACKED.format(f8="date_format(o_orderdate, 'yyyyMMdd')", f6="date_format(o_orderdate, 'yyyyMM')", f4="date_format(o_orderdate, 'yyyy')")


@query(f"SELECT o_orderkey, try_cast(substr(packed, 1, 4) AS INT) AS year, try_cast(nullif(substr(packed, 5, 2), '') AS INT) AS month, try_cast(nullif(substr(packed, 7, 2), '') AS INT) AS day FROM ({_DP})")
def packed_date(spark, d):
    return table(spark, d, _SP).withColumn("p", D.packed_date(F.col("packed"))).select("o_orderkey", "p.*")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def multi_format_date(spark, d):
    o = table(spark, d, "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, 'dd.MM.yyyy') ELSE '31.02.2020x' END AS s FROM orders")
    return o.select("o_orderkey", D.mixed_date(F.col("s"), ["yyyy-MM-dd", "dd.MM.yyyy"]).alias("day"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN (make_date(CAST(year(o_orderdate) AS INT), 1, 1) + CAST(floor(date_diff('day', make_date(CAST(year(o_orderdate) AS INT), 1, 1), make_date(CAST(year(o_orderdate) + 3 AS INT), 12, 31)) / 2) AS INT)) ELSE CAST(date_trunc('month', o_orderdate) AS DATE) + 4 END AS day FROM orders""")
def range_midpoint_date(spark, d):
    o = table(spark, d, "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) || '-' || (year(o_orderdate) + 3) ELSE '1-9.' || month(o_orderdate) || '.' || year(o_orderdate) END AS s FROM orders")
    return o.select("o_orderkey", D.range_midpoint_date(F.col("s")).alias("day"))


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'circle' WHEN 1 THEN 'rectangle' WHEN 2 THEN 'square' ELSE 'unknown' END AS shape,
  round(CASE p_size % 4 WHEN 0 THEN pi() * p_size * p_size WHEN 1 THEN p_size * (p_size + 1.0) WHEN 2 THEN p_size * 1.0 * p_size END, 6) AS area FROM part""")
def plot_dimensions(spark, d):
    p = table(spark, d, "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_size || ' m radius' WHEN 1 THEN p_size || ' x ' || (p_size + 1) WHEN 2 THEN p_size || 'x' || p_size ELSE 'plotless' END AS s FROM part")
    return p.withColumn("s", N.plot_dimensions(F.col("s"))).select("p_partkey", "s.shape", F.round("s.area", 6).alias("area"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN round(c_acctbal, 2) END AS value, CASE WHEN c_custkey % 5 > 0 THEN (c_custkey + 3 + c_custkey) / 2.0 ELSE 0.55 END AS middle FROM customer")
def coord_clean(spark, d):
    c = table(spark, d, "SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN '  ' || CAST(round(c_acctbal, 2) AS STRING) || ',' ELSE 'north' END AS s, CASE WHEN c_custkey % 5 > 0 THEN c_custkey || '-' || (c_custkey + 3) ELSE '+' END AS r FROM customer")
    return c.select("c_custkey", N.coordinate(F.col("s")).alias("value"), N.range_midpoint(F.col("r")).alias("middle"))


@query("SELECT k FROM (SELECT unnest(range((SELECT min(o_custkey) FROM orders WHERE o_custkey % 7 <> 3), (SELECT max(o_custkey) + 1 FROM orders WHERE o_custkey % 7 <> 3))) AS k) WHERE k NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 7 <> 3)")
def tile_gaps(spark, d):
    return L.missing_numbers(table(spark, d, "SELECT o_custkey AS k FROM orders WHERE o_custkey % 7 <> 3"), "k")


@query("SELECT source, count(*) AS n FROM (SELECT o_orderpriority AS source, year(o_orderdate) AS y FROM orders) WHERE y >= 1998 GROUP BY source")
def year_filter(spark, d):
    return table(spark, d, VISITS).where(F.year("ts") >= 1998).groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def semi_filter(spark, d):
    valid = table(spark, d, "SELECT c_custkey AS o_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'")
    return table(spark, d, "SELECT o_orderkey, o_custkey FROM orders").join(valid, "o_custkey", "left_semi").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def pending_units(spark, d):
    return files.pending(table(spark, d, "SELECT o_orderkey FROM orders"), table(spark, d, "SELECT l_orderkey AS o_orderkey FROM lineitem"), ["o_orderkey"])


@query(_V + "SELECT plot, method, count(*) AS n, min(visit_id) AS first_visit FROM v GROUP BY ALL HAVING count(*) > 2")
def visit_duplicates(spark, d):
    return table(spark, d, VISITS).groupBy("plot", "method").agg(F.count("*").alias("n"), F.min("visit_id").alias("first_visit")).where("n > 2")


_VIOLATION = "SELECT '{rule}' AS rule, CAST({key} AS VARCHAR) AS key, CAST({detail} AS VARCHAR) AS detail, '{severity}' AS severity FROM "


@query(_VIOLATION.format(rule="unique", key="o_custkey", detail="n", severity="error") + "(SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) WHERE n > 1")
def violations_unique(spark, d):
    return V.not_unique(table(spark, d, "SELECT o_custkey FROM orders"), "o_custkey")


@query("SELECT 'price bounds' AS rule, CAST(o_orderkey AS VARCHAR) AS key, severity, CAST(round(o_totalprice, 2) AS DECIMAL(18, 2)) AS off FROM (SELECT o_orderkey, 'error' AS severity, o_totalprice FROM orders) WHERE o_totalprice NOT BETWEEN 10000 AND 400000")
def violations_bounds(spark, d):
    return V.out_of_bounds(table(spark, d, "SELECT o_orderkey, o_totalprice AS price FROM orders"), "o_orderkey", "price", 10000, 400000).select("rule", "key", "severity", F.round(F.col("detail").cast("double"), 2).cast("decimal(18,2)").alias("off"))


@query(_VIOLATION.format(rule="method vocabulary", key="o_orderkey", detail="o_orderstatus", severity="error") + "orders WHERE o_orderstatus NOT IN ('F', 'O')")
def violations_vocab(spark, d):
    return V.not_allowed(table(spark, d, "SELECT o_orderkey, o_orderstatus AS method FROM orders"), "o_orderkey", "method", ["F", "O"])


_LINES = "SELECT l_orderkey AS k, sum(CASE WHEN l_linenumber = 1 THEN l_quantity ELSE 0 END) AS a, sum(CASE WHEN l_linenumber = 2 THEN l_quantity ELSE 0 END) AS b, sum(l_quantity) AS total, sum(CASE WHEN l_linenumber > 2 THEN l_quantity ELSE 0 END) AS c FROM lineitem GROUP BY l_orderkey"


@query(f"SELECT 'sum' AS rule, CAST(k AS VARCHAR) AS key, 'error' AS severity, CAST(round(a + b - total, 4) AS DECIMAL(18, 4)) AS off FROM ({_LINES}) WHERE abs(a + b - total) > 1e-8 + 1e-5 * abs(total)")
def violations_sum(spark, d):
    return V.sums_differ(table(spark, d, _LINES), "k", ["a", "b"], "total").select("rule", "key", "severity", F.round(F.col("detail").cast("double"), 4).cast("decimal(18,4)").alias("off"))


@query(f"""SELECT 'a above 40' AS rule, CAST(k AS VARCHAR) AS key, 'warning' AS severity, CAST(a AS DECIMAL(18, 4)) AS off FROM ({_LINES}) WHERE a > 40 UNION ALL
  SELECT 'total below 100', CAST(k AS VARCHAR), 'warning', CAST(a + b + c AS DECIMAL(18, 4)) FROM ({_LINES}) WHERE a + b + c < 100""")
def cover_warnings(spark, d):
    return V.cover_warnings(table(spark, d, _LINES), "k", ["a", "b", "c"], ["a"], most=40).select("rule", "key", "severity", F.col("detail").cast("decimal(18,4)").alias("off"))


@query("""SELECT 'not null' AS rule, CAST(o_orderkey AS VARCHAR) AS key, 'code' AS detail, 'error' AS severity FROM orders WHERE o_orderstatus = 'P'""")
def violations_null(spark, d):
    o = table(spark, d, "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS code FROM orders")
    return V.nulls(o, "o_orderkey", StructType([StructField("code", StringType(), False)]))


@query("""SELECT (SELECT count(DISTINCT o_orderkey) FROM orders) AS n_before, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS n_after,
  (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS lost, (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS added""")
def visit_reconcile(spark, d):
    return V.reconcile(table(spark, d, "SELECT o_orderkey AS k FROM orders"), table(spark, d, "SELECT l_orderkey AS k FROM lineitem"), "k")


@query("""SELECT 0 AS position, 'p_partkey' AS "column", 'id' AS unit, 'part' AS definition, 'bigint' AS type, count(p_partkey) AS n FROM part UNION ALL SELECT 1, 'p_size', '', '', 'int', count(p_size) FROM part""")
def data_dictionary(spark, d):
    return V.data_dictionary(table(spark, d, "SELECT p_partkey, p_size FROM part"), {"p_partkey": "id"}, {"p_partkey": "part"})


@query(_C + "SELECT dataset, line, count(cover) AS n, round(avg(cover), 6) AS mean, sum(cover) AS total, min(cover) AS low, max(cover) AS high FROM cover GROUP BY ALL")
def group_stats(spark, d):
    return table(spark, d, COVER).groupBy("dataset", "line").agg(F.count("cover").alias("n"), F.round(F.avg("cover"), 6).alias("mean"), F.sum("cover").alias("total"), F.min("cover").alias("low"), F.max("cover").alias("high"))


@query("SELECT source, min(day) AS oldest, max(day) AS latest, count(day) AS n FROM (SELECT o_orderpriority AS source, try_cast(year(o_orderdate) || '-' || month(o_orderdate) || '-' || (day(o_orderdate) + 2) AS DATE) AS day FROM orders) GROUP BY source")
def date_extremes(spark, d):
    v = table(spark, d, VISITS).withColumn("day", F.to_date(F.try_to_timestamp(F.concat_ws("-", F.year("ts"), F.month("ts"), F.day("ts") + 2), F.lit("yyyy-M-d"))))
    return v.groupBy("source").agg(F.min("day").alias("oldest"), F.max("day").alias("latest"), F.count("day").alias("n"))


@query("SELECT column_name, value, count(*) AS n FROM (SELECT 'brand' AS column_name, p_brand AS value FROM part UNION ALL SELECT 'type', p_type FROM part UNION ALL SELECT 'size', CAST(p_size AS VARCHAR) FROM part) GROUP BY ALL")
def value_counts_long(spark, d):
    p = table(spark, d, "SELECT p_partkey, p_brand AS brand, p_type AS type, CAST(p_size AS STRING) AS size FROM part")
    return p.unpivot(["p_partkey"], ["brand", "type", "size"], "column_name", "value").groupBy("column_name", "value").agg(F.count("*").alias("n"))


@query(_C + "SELECT dataset, round(count(*) FILTER (cover - line * 5 > 0) / CAST(count(cover) AS DOUBLE), 6) AS share, quantile_cont(cover - line * 5, 0.5) FILTER (cover - line * 5 > 0) AS median FROM cover GROUP BY dataset")
def nonzero_share(spark, d):
    c = table(spark, d, COVER).withColumn("v", F.col("cover") - F.col("line") * 5)
    own = c.groupBy("dataset").agg(F.round(F.count_if(F.col("v") > 0) / F.count("v"), 6).alias("share"))
    return with_quantiles(own, c.withColumn("v", F.when(F.col("v") > 0, F.col("v"))), ["dataset"], "v", [0.5]).select("dataset", "share", F.col("q")[0].alias("median"))


@query("SELECT CAST(least(floor((v - a) / 7), greatest(ceil((b - a) / 7) - 1, 0)) AS BIGINT) AS bin, count(*) AS n FROM (SELECT l_quantity AS v FROM lineitem WHERE l_quantity <> 0), (SELECT min(l_quantity) AS a, max(l_quantity) AS b FROM lineitem WHERE l_quantity <> 0) GROUP BY 1")
def cover_hist(spark, d):
    return S.histogram(table(spark, d, "SELECT l_quantity FROM lineitem"), "l_quantity", 7)


@query("""WITH q AS (SELECT l_suppkey, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3, avg(l_extendedprice) AS mean FROM lineitem GROUP BY 1)
  SELECT l_suppkey, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3, round(any_value(mean), 3) AS mean, min(l_extendedprice) FILTER (l_extendedprice >= q1 - 1.5 * (q3 - q1)) AS low, max(l_extendedprice) FILTER (l_extendedprice <= q3 + 1.5 * (q3 - q1)) AS high
  FROM lineitem JOIN q USING (l_suppkey) GROUP BY 1""")
def box_stats(spark, d):
    b = S.box_stats(table(spark, d, "SELECT l_suppkey, l_extendedprice FROM lineitem"), "l_suppkey", "l_extendedprice")
    return b.select("l_suppkey", F.round("q1", 4).alias("q1"), F.round("median", 4).alias("median"), F.round("q3", 4).alias("q3"), F.round("mean", 3).alias("mean"), "low", "high")


@query("""SELECT l_suppkey, count(l_quantity) AS n, min(l_quantity) AS low, max(l_quantity) AS high, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS sd, sum(l_quantity) AS total,
  quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS median, quantile_cont(l_quantity, 0.75) AS q3, round(quantile_cont(l_quantity, 0.9), 6) AS p90 FROM lineitem GROUP BY 1""")
def zonal_stats(spark, d):
    return S.zonal(table(spark, d, "SELECT l_suppkey, l_quantity FROM lineitem"), "l_suppkey", "l_quantity").withColumns({c: F.round(c, 6) for c in ("mean", "sd", "p90")})


@query(_C + """, s AS (SELECT zone, line, avg(cover) AS mean FROM cover GROUP BY ALL)
  SELECT zone, line, round(mean, 6) AS mean FROM (SELECT DISTINCT zone FROM s WHERE mean IS NOT NULL) CROSS JOIN (SELECT DISTINCT line FROM s) LEFT JOIN s USING (zone, line)""")
def zone_type_grid(spark, d):
    return S.zone_type_grid(table(spark, d, COVER), "zone", "line", "cover").select("zone", "line", F.round("mean", 6).alias("mean"))


@query("SELECT l_suppkey, n, round(r, 6) AS r, round(r * sqrt(n - 2) / sqrt(1 - r * r), 5) AS t FROM (SELECT l_suppkey, count(*) AS n, corr(l_quantity, l_extendedprice) AS r FROM lineitem GROUP BY 1)")
def pearson(spark, d):
    return S.pearson(table(spark, d, "SELECT * FROM lineitem"), "l_suppkey", "l_quantity", "l_extendedprice").withColumns({"r": F.round("r", 6), "t": F.round("t", 5)})


_RANKS = "rank() OVER (PARTITION BY l_suppkey ORDER BY {0}) + (count(*) OVER (PARTITION BY l_suppkey, {0}) - 1) / 2.0"


@query(f"SELECT l_suppkey, count(*) AS n, round(corr(a, b), 6) AS rho FROM (SELECT l_suppkey, {_RANKS.format('l_quantity')} AS a, {_RANKS.format('l_discount')} AS b FROM lineitem) GROUP BY 1")
def spearman(spark, d):
    return S.spearman(table(spark, d, "SELECT * FROM lineitem"), "l_suppkey", "l_quantity", "l_discount").withColumn("rho", F.round("rho", 6))


@query("SELECT l_suppkey, count(*) AS n, round(corr(p, o) ^ 2, 6) AS r2, round(sqrt(avg((p - o) * (p - o))), 6) AS rmse, round(avg(abs(p - o)), 6) AS mae FROM (SELECT l_suppkey, l_quantity / 50 AS p, l_discount * 10 AS o FROM lineitem) GROUP BY 1")
def agreement_metrics(spark, d):
    return S.agreement(table(spark, d, "SELECT l_suppkey, l_quantity / 50 AS p, l_discount * 10 AS o FROM lineitem"), "l_suppkey", "p", "o").withColumns({c: F.round(c, 6) for c in ("r2", "rmse", "mae")})


@query("SELECT user_id, " + ", ".join(f"v[CAST(round_even((len(v) - 1) * CAST({k / 10} AS DOUBLE), 0) AS INT) + 1] AS d{k}" for k in range(1, 11)) + " FROM (SELECT user_id, list_sort(list(value)) AS v FROM events GROUP BY 1)")
def deciles_nearest(spark, d):
    q = nearest_rows(table(spark, d, "SELECT user_id, value FROM events"), ["user_id"], ["value"], [k / 10 for k in range(1, 11)])
    return q.select("user_id", *(F.col("q")[k]["value"].alias(f"d{k + 1}") for k in range(10)))


@query("SELECT user_id, " + ", ".join(f"v[CAST(round_even((len(v) - 1) * CAST({k / 10} AS DOUBLE), 0) AS INT) + 1].ts AS at{k}" for k in range(1, 11)) + " FROM (SELECT user_id, list_sort(list({'v': value, 'ts': ts})) AS v FROM events GROUP BY 1)")
def decile_dates(spark, d):
    q = nearest_rows(table(spark, d, "SELECT user_id, value, ts FROM events"), ["user_id"], ["value", "ts"], [k / 10 for k in range(1, 11)])
    return q.select("user_id", *(F.col("q")[k]["ts"].alias(f"at{k + 1}") for k in range(10)))


@query("SELECT user_id, min(value) AS low, max(value) AS high, round(quantile_cont(value, 0.5), 6) AS median, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(skewness(value), 4) AS skew, round(kurtosis(value), 4) AS kurtosis FROM events GROUP BY 1")
def dist_stats(spark, d):
    return S.moments(table(spark, d, "SELECT user_id, value FROM events"), "user_id", "value").withColumns({"median": F.round("median", 6), "mean": F.round("mean", 6), "sd": F.round("sd", 6), "skew": F.round("skew", 4), "kurtosis": F.round("kurtosis", 4)})


@query("SELECT l_suppkey, l_linenumber, n, count(*) OVER (PARTITION BY l_linenumber ORDER BY n DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rank FROM (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)")
def rank_max_desc(spark, d):
    n = table(spark, d, "SELECT l_suppkey, l_linenumber FROM lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.count("*").alias("n"))
    return n.withColumn("rank", S.rank_max("n", ["l_linenumber"]))


@query("SELECT o_orderkey, o_totalprice < q1 AS below, o_totalprice < q3 + 0.1 * (q3 - q1) AS refined FROM orders, (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)")
def iqr_flags(spark, d):
    return S.quartile_flags(table(spark, d, "SELECT o_orderkey, o_totalprice FROM orders"), "o_totalprice", 0.1).select("o_orderkey", "below", "refined")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5('s' || o_orderkey)) AS r, count(*) OVER () AS n FROM orders WHERE o_orderstatus = 'F') WHERE r <= n // 2")
def validation_pick(spark, d):
    return S.seeded_half(table(spark, d, "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'"), "o_orderkey", "s")


@query("SELECT l_orderkey AS visit_id, total, o_orderpriority AS source FROM (SELECT l_orderkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1) JOIN orders ON o_orderkey = l_orderkey WHERE total < 100")
def under_100_report(spark, d):
    totals = table(spark, d, "SELECT l_orderkey AS visit_id, l_quantity FROM lineitem").groupBy("visit_id").agg(F.sum("l_quantity").alias("total")).where("total < 100")
    return totals.join(table(spark, d, "SELECT o_orderkey AS visit_id, o_orderpriority AS source FROM orders"), "visit_id").select("visit_id", "total", "source")


@query("SELECT p_partkey, string_split(p_name, ' ')[-1] AS kind, string_split(p_name, ' ')[1] AS site FROM part")
def file_name_parts(spark, d):
    p = table(spark, d, "SELECT p_partkey, replace(p_name, ' ', '_') || '.csv' AS f FROM part")
    return p.select("p_partkey", files.name_part(F.col("f"), -1).alias("kind"), files.name_part(F.col("f"), 1).alias("site"))


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct([lower(p_brand), p_type, lower(p_brand)])), ',') AS parts, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || ' Top' AS label, CASE WHEN p_size % 2 = 0 THEN 'fcover_' || lower(p_type) ELSE 'fcover' END AS product FROM part")
def text_lists(spark, d):
    p = table(spark, d, "SELECT p_partkey, '[' || lower(p_brand) || ', ' || p_type || ', ' || lower(p_brand) || ']' AS s, lower(p_type) || '_top_cover' AS l, 'fcover_' || CASE WHEN p_size % 2 = 0 THEN lower(p_type) || '_' ELSE '' END || '20' || p_size AS f FROM part")
    return p.select("p_partkey", T.unique_list(F.col("s")).alias("parts"), T.title_label(F.col("l")).alias("label"), T.name_before_digits(F.col("f")).alias("product"))
