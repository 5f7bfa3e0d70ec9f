"""Filters, joins, orders, schemas and sinks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverspark import schemas
from coverspark.functions import bands as B
from coverspark.operators import cover as C
from coverspark.operators import lists as L
from coverspark.operators import stats as S
from coverspark.plans.registry import COVER, PIXELS, VISITS, ctes, query, table
from coverspark.session import read

_C = ctes(cover=COVER)
_V = ctes(v=VISITS)
_X = ctes(p=PIXELS)


# Filters.


@query("SELECT source, count(*) AS n FROM (SELECT o_orderpriority AS source FROM orders WHERE year(o_orderdate) = 1997) GROUP BY 1")
def calendar_year(spark, d):
    v = table(spark, d, "SELECT o_orderpriority AS source, date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS end FROM orders")
    return v.where(F.year(F.try_to_timestamp("end")) == 1997).groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT id FROM (SELECT CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_partkey || p_brand END AS id FROM part) WHERE regexp_matches(id, '^[0-9]')")
def id_pattern(spark, d):
    return L.matching_rows(table(spark, d, "SELECT CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_partkey || p_brand END AS id FROM part"), "id", "^[0-9]")


_TWO = "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_retailprice END AS a, CASE WHEN p_size % 3 = 0 THEN p_size * 1.0 END AS b FROM part"


@query(ctes(t=_TWO) + "SELECT p_partkey, coalesce(a, 0) AS a, CAST(coalesce(b, 0) AS DOUBLE) AS b FROM t WHERE a IS NOT NULL OR b IS NOT NULL")
def drop_all_null(spark, d):
    return L.drop_null_rows(table(spark, d, _TWO).withColumn("b", F.col("b").cast("double")), ["a", "b"], "all", 0.0)


@query(ctes(t=_TWO) + "SELECT p_partkey, a, CAST(b AS DOUBLE) AS b FROM t WHERE a IS NOT NULL AND b IS NOT NULL")
def drop_any_null(spark, d):
    return L.drop_null_rows(table(spark, d, _TWO).withColumn("b", F.col("b").cast("double")), ["a", "b"], "any")


@query(_C + "SELECT visit_id, line, cover - 10 AS cover FROM cover WHERE cover IS NOT NULL AND cover <> 10")
def nonzero_cover(spark, d):
    return L.nonzero_rows(table(spark, d, COVER).select("visit_id", "line", (F.col("cover") - 10).alias("cover")), "cover")


@query("SELECT user_id, count(*) AS n FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY 1")
def date_range(spark, d):
    e = table(spark, d, "SELECT user_id, ts FROM events")
    return e.where(F.col("ts").between(F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-20").cast("timestamp"))).groupBy("user_id").agg(F.count("*").alias("n"))


@query('SELECT vec_id AS id, embedding[1] AS blue, embedding[2] AS green, embedding[3] AS nir, embedding[4] AS "B99" FROM embeddings')
def renamed_bands(spark, d):
    e = table(spark, d, "SELECT vec_id AS id, embedding[0] AS B2, embedding[1] AS B3, embedding[2] AS B8, embedding[3] AS B99 FROM embeddings")
    return e.withColumnsRenamed(B.BAND_NAMES)


@query('SELECT l_orderkey AS id, sum(l_quantity) AS forb, sum(l_tax) AS "2019_07" FROM lineitem GROUP BY 1')
def columns_by_pattern(spark, d):
    t = table(spark, d, "SELECT l_orderkey AS id, sum(l_quantity) AS `forb total cover (%)`, sum(l_tax) AS `2019_07_fitted`, sum(l_discount) AS other FROM lineitem GROUP BY 1")
    return L.columns_matching(t, r" total cover \(%\)$|_fitted$", ["id"], r" total cover \(%\)$|_fitted$")


@query(_C + "SELECT dataset, count(*) AS n, 'EPSG:4326' AS coord_epsg, 10.0::DOUBLE AS georef_accuracy, 'circle' AS plot_shape FROM cover GROUP BY 1")
def literal_metadata(spark, d):
    fixed = {"coord_epsg": "EPSG:4326", "georef_accuracy": 10.0, "plot_shape": "circle"}
    return table(spark, d, COVER).groupBy("dataset").agg(F.count("*").alias("n")).withColumns({k: F.lit(v) for k, v in fixed.items()})


@query(_C + """SELECT count(*) AS in_all, count(*) AS in_parts, true AS agree FROM cover""")
def split_check(spark, d):
    c = table(spark, d, COVER)
    return C.split_parts(c, "part", [("low", F.col("cover") < 20), ("high", F.col("cover") >= 20)], "unknown")[1]


# Joins.

_DIM = "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 > 0"


@query(f"WITH m AS ({_DIM}) SELECT o_orderkey, c_mktsegment FROM orders JOIN m ON o_custkey = c_custkey")
def inner_lookup(spark, d):
    return table(spark, d, "SELECT o_orderkey, o_custkey AS c_custkey FROM orders").join(table(spark, d, _DIM), "c_custkey").select("o_orderkey", "c_mktsegment")


@query("SELECT o_orderkey, n_name FROM orders LEFT JOIN nation ON CAST(o_custkey % 40 AS VARCHAR) = CAST(n_nationkey AS VARCHAR)")
def left_dimension(spark, d):
    """Keys of two types are texts on both sides."""
    o = table(spark, d, "SELECT o_orderkey, CAST(o_custkey % 40 AS STRING) AS code FROM orders")
    return o.join(table(spark, d, "SELECT CAST(n_nationkey AS STRING) AS code, n_name FROM nation"), "code", "left").select("o_orderkey", "n_name")


_MONTHLY = "SELECT l_suppkey AS k, sum(l_quantity) AS {0} FROM lineitem WHERE month(l_shipdate) = {1} AND l_suppkey % {2} > 0 GROUP BY 1"


@query("SELECT k, may, june FROM (" + _MONTHLY.format("may", 5, 3) + ") FULL JOIN (" + _MONTHLY.format("june", 6, 4) + ") USING (k)")
def outer_alignment(spark, d):
    return table(spark, d, _MONTHLY.format("may", 5, 3)).join(table(spark, d, _MONTHLY.format("june", 6, 4)), "k", "full_outer")


@query(f"WITH m AS ({_DIM}) SELECT c_custkey, c_mktsegment, o_orderkey FROM m JOIN orders ON o_custkey = c_custkey")
def right_then_known(spark, d):
    """Rows of the right table are kept, then those without a visit dropped."""
    o = table(spark, d, "SELECT o_orderkey, o_custkey AS c_custkey FROM orders WHERE o_custkey % 2 = 0 OR o_custkey % 2 = 1")
    return o.join(table(spark, d, _DIM), "c_custkey", "right").dropna(subset=["o_orderkey"]).select("c_custkey", "c_mktsegment", "o_orderkey")


@query("""SELECT o_orderkey, l_quantity AS probability, l_linenumber FROM orders JOIN (SELECT l_orderkey, l_quantity, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_quantity) AS r FROM (SELECT DISTINCT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL)) WHERE r = 1) ON l_orderkey = o_orderkey""")
def scene_join_first(spark, d):
    probabilities = table(spark, d, "SELECT l_orderkey AS o_orderkey, l_linenumber, max(l_quantity) AS probability, -l_linenumber AS ord FROM lineitem GROUP BY ALL")
    first = L.keep_first(probabilities, ["o_orderkey"], "ord").drop("ord")
    return table(spark, d, "SELECT o_orderkey FROM orders").join(first, "o_orderkey").select("o_orderkey", "probability", "l_linenumber")


@query("""WITH cams AS (SELECT split_part(name, '.', 3) AS site, day, path FROM (SELECT 'NET.D18.S' || (o_custkey % 40) || '.x' || (o_orderkey % 7) AS name, CAST(o_orderdate AS DATE) AS day, '/i/' || o_orderkey AS path FROM orders))
  SELECT c_custkey, coalesce((SELECT array_to_string(list_sort(list('https://host' || path)), ', ') FROM cams WHERE site = 'S' || c_custkey AND day = DATE '1996-01-01' + CAST(c_custkey % 900 AS INT)), '') AS urls FROM customer""")
def sensor_lookup(spark, d):
    images = table(spark, d, "SELECT 'NET.D18.S' || (o_custkey % 40) || '.x' || (o_orderkey % 7) AS name, CAST(o_orderdate AS DATE) AS day, '/i/' || o_orderkey AS path FROM orders")
    surveys = table(spark, d, "SELECT c_custkey, 'S' || c_custkey AS site, date_add(DATE '1996-01-01', CAST(c_custkey % 900 AS INT)) AS day FROM customer")
    return L.images_of(surveys, images, "site", "day", "https://host").select("c_custkey", "urls")


@query("SELECT o_orderkey, upper(c_name) AS place FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 > 0) ON c_custkey = o_custkey")
def distinct_lookup(spark, d):
    o = table(spark, d, "SELECT o_orderkey, o_custkey AS k FROM orders")
    names = table(spark, d, "SELECT c_custkey AS k, c_name FROM customer WHERE c_custkey % 4 > 0")
    return L.enriched(o, names, "k", lambda found: found.select("k", F.upper("c_name").alias("place"))).select("o_orderkey", "place")


@query("SELECT o_orderkey, 'u' || o_custkey AS o_custkey FROM orders")
def replace_unique_ids(spark, d):
    m = table(spark, d, "SELECT DISTINCT o_custkey, 'u' || o_custkey AS uid FROM orders")
    return L.replace_id(table(spark, d, "SELECT o_orderkey, o_custkey FROM orders"), m, "o_custkey", "uid", unique=True)


@query("SELECT l_suppkey, x, y, max(value) AS s2, max(share) AS s1, max(dem) AS dem FROM (SELECT l_orderkey % 16 AS l_suppkey, l_partkey AS x, l_suppkey AS y, l_quantity AS value, l_discount AS share, l_tax AS dem FROM lineitem) GROUP BY ALL")
def aligned_rasters(spark, d):
    layer = lambda c, n: table(spark, d, f"SELECT l_orderkey % 16 AS l_suppkey, l_partkey AS x, l_suppkey AS y, {c} AS {n} FROM lineitem")
    layers = {"s2": layer("l_quantity", "s2"), "s1": layer("l_discount", "s1"), "dem": layer("l_tax", "dem")}
    return L.aligned(layers, ["l_suppkey", "x", "y"], rows=len(layers) * read(spark, d, "lineitem").count())


# Order, duplicates and sets.


@query("SELECT p_brand, p_type, min(p_partkey) AS p_partkey, arg_min(p_size, p_partkey) AS p_size FROM part GROUP BY ALL")
def drop_duplicates(spark, d):
    return L.keep_first(table(spark, d, "SELECT p_brand, p_type, p_partkey, p_size FROM part"), ["p_brand", "p_type"], "p_partkey")


@query("SELECT p_brand, p_partkey, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size > 25 THEN 0 ELSE 1 END, p_partkey) AS r FROM part) WHERE r = 1")
def drop_duplicates_preferring(spark, d):
    return L.keep_first(table(spark, d, "SELECT p_brand, p_partkey, p_size FROM part"), ["p_brand"], "p_partkey", F.col("p_size") > 25)


@query("SELECT CAST(row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS BIGINT) AS place, p_name, p_partkey FROM part")
def sorted_rows(spark, d):
    p = table(spark, d, "SELECT p_partkey, p_name, struct(p_name, p_partkey) AS k FROM part")
    return L.ordered_rows(p, "k").drop("k")


@query("SELECT place, p_partkey FROM (SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS BIGINT) AS place, p_partkey FROM part) WHERE place BETWEEN 1 AND 3")
def head_rows(spark, d):
    """Without the first row, the next three: the feature is the limit."""
    return L.ordered_rows(table(spark, d, "SELECT p_partkey FROM part"), "p_partkey", skip=1, most=3)


@query("SELECT o_orderkey, list_position(['2-HIGH', '5-LOW', '1-URGENT'], o_orderpriority) AS place, o_orderpriority FROM orders")
def listed_order(spark, d):
    return L.in_listed_order(table(spark, d, "SELECT o_orderkey, o_orderpriority FROM orders"), "o_orderpriority", ["2-HIGH", "5-LOW", "1-URGENT"])


@query("SELECT o_custkey AS k, ord, total FROM (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1) JOIN (SELECT c_custkey, c_custkey * 7 % 1009 AS ord FROM customer) ON c_custkey = o_custkey")
def keyed_order(spark, d):
    have = table(spark, d, "SELECT o_custkey AS k, sum(o_totalprice) AS total FROM orders GROUP BY 1")
    order = table(spark, d, "SELECT c_custkey AS k, c_custkey * 7 % 1009 AS ord FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
    return L.with_order(have, order, "k")


@query("SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY first) - 1 AS BIGINT) AS number FROM (SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey % 37) AS first FROM orders)")
def renumbered_labels(spark, d):
    return L.renumbered(table(spark, d, "SELECT o_orderkey, o_custkey % 37 AS label FROM orders"), "label", "o_orderkey").select("o_orderkey", "number")


@query("SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def missing_keys(spark, d):
    return L.missing_keys(table(spark, d, "SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0"), table(spark, d, "SELECT l_suppkey AS k FROM lineitem"), "k")


@query("SELECT l_suppkey AS zone FROM lineitem UNION SELECT c_nationkey FROM customer UNION SELECT CAST(p_size AS BIGINT) FROM part")
def all_zones(spark, d):
    parts = [table(spark, d, f"SELECT CAST({c} AS BIGINT) AS zone FROM {t}") for c, t in (("l_suppkey", "lineitem"), ("c_nationkey", "customer"), ("p_size", "part"))]
    return L.union_of_keys(parts, "zone")


@query("SELECT p_brand, count(*) FILTER (p_type = 'ECONOMY') AS \"ECONOMY\", count(*) FILTER (p_type = 'PROMO') AS \"PROMO\", count(*) FILTER (p_type = 'none') AS \"none\" FROM part GROUP BY 1")
def value_counts_filled(spark, d):
    p = table(spark, d, "SELECT p_brand, p_type FROM part")
    return p.groupBy("p_brand").pivot("p_type", ["ECONOMY", "PROMO", "none"]).count().fillna(0)


_PARTS = "SELECT l_orderkey AS visit_id, " + ", ".join(f"CASE WHEN sum(CASE WHEN l_linenumber = {k} THEN l_quantity END) > 0 THEN sum(CASE WHEN l_linenumber = {k} THEN l_quantity END) END AS {n}" for k, n in enumerate(("forb", "bryophyte", "lichen", "litter"), 1)) + " FROM lineitem GROUP BY 1"


@query(f"WITH w AS ({_PARTS}), t AS (SELECT visit_id, coalesce(forb, 0) + coalesce(bryophyte, 0) + coalesce(lichen, 0) + coalesce(litter, 0) AS total FROM w) SELECT visit_id, total, o_orderpriority AS source FROM t LEFT JOIN orders ON o_orderkey = visit_id WHERE total < 100")
def row_total_report(spark, d):
    """All covers but the sum of two of them, which would count twice."""
    w = table(spark, d, _PARTS).withColumn("nonvascular_sum", F.coalesce("bryophyte", F.lit(0.0)) + F.coalesce("lichen", F.lit(0.0)))
    totals = C.row_total(w, ["visit_id"], leave_out=["nonvascular_sum"]).where("total < 100").select("visit_id", "total")
    return totals.join(table(spark, d, "SELECT o_orderkey AS visit_id, o_orderpriority AS source FROM orders"), "visit_id", "left")


@query()
def pearson_p(spark, d):
    return S.with_p_value(S.pearson(table(spark, d, "SELECT * FROM lineitem"), "l_suppkey", "l_quantity", "l_extendedprice"))


@query("""WITH RECURSIVE g AS (SELECT l_suppkey, count(*) AS n, corr(l_quantity, l_discount) AS r FROM lineitem WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL GROUP BY 1),
  a AS (SELECT l_suppkey, n, r, n - 2 AS v, atan(abs(r) / sqrt(1 - r * r)) AS angle FROM g WHERE n > 3),
  w AS (SELECT l_suppkey, v, cos(angle) AS c, 1 AS k, CASE v % 2 WHEN 1 THEN cos(angle) ELSE 1 END AS term, CASE v % 2 WHEN 1 THEN cos(angle) ELSE 1 END AS total FROM a
    UNION ALL SELECT l_suppkey, v, c, k + 1, term * c * c * f, total + term * c * c * f FROM (SELECT *, CASE v % 2 WHEN 1 THEN 2.0 * k / (2 * k + 1) ELSE (2.0 * k - 1) / (2 * k) END AS f FROM w WHERE k < v // 2)),
  s AS (SELECT l_suppkey, arg_max(total, k) AS total FROM w GROUP BY 1)
  SELECT l_suppkey, n, round(r, 6) AS r, round(1 - CASE v % 2 WHEN 1 THEN 2 / pi() * (angle + sin(angle) * total) ELSE sin(angle) * total END, 6) AS p FROM a JOIN s USING (l_suppkey)""")
def correlation_test(spark, d):
    """Correlations near 0 with their two-sided p-values; the SQL sums the finite series of whole degrees of freedom instead."""
    found = S.with_p_value(S.pearson(table(spark, d, "SELECT l_suppkey, l_quantity, l_discount FROM lineitem"), "l_suppkey", "l_quantity", "l_discount"))
    return found.where("n > 3").select("l_suppkey", "n", F.round("r", 6).alias("r"), F.round("p", 6).alias("p"))


# Schemas.

_SPECIES = "SELECT {key} AS visit_id, p_name AS dataset_species_name, CASE WHEN p_size % 9 > 0 THEN lower(p_type) END AS standard_habit, CAST(l_quantity AS {text}) AS fcover, l_linenumber AS line FROM lineitem JOIN part ON p_partkey = l_partkey"
_KEYS = "CASE WHEN l_orderkey % 50 = 0 THEN 'u1' ELSE 'u' || (1000000000 + l_orderkey) END"


@query(ctes(s=_SPECIES.format(key=_KEYS, text="VARCHAR")) + """SELECT 'not null' AS rule, visit_id AS key, 'standard_habit' AS detail, 'error' AS severity FROM s WHERE standard_habit IS NULL UNION ALL SELECT 'key form', visit_id, visit_id, 'error' FROM s WHERE length(visit_id) < 10
  UNION ALL VALUES ('schema', 'fcover', 'string <> double', 'error'), ('schema', 'nonstandard_habit', 'missing <> string', 'error')""")
def schema_violations(spark, d):
    return schemas.violations(table(spark, d, _SPECIES.format(key=_KEYS, text="STRING")), "species_fcover")


@query(ctes(s=_SPECIES.format(key=_KEYS, text="VARCHAR")) + "SELECT visit_id, dataset_species_name, standard_habit, CAST(NULL AS VARCHAR) AS nonstandard_habit, CAST(fcover AS DOUBLE) AS fcover FROM s")
def conformed(spark, d):
    return schemas.conform(table(spark, d, _SPECIES.format(key=_KEYS, text="STRING")), "species_fcover")


_CHECK = "SELECT p_name || CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_partkey AS {0}) END AS dataset_species_name, ' ' || p_name AS accepted_species_name, CASE WHEN p_size % 7 = 0 THEN 'order' ELSE 'species ' END AS taxon_rank, CASE WHEN p_size % 4 = 0 THEN 'tree' ELSE 'forb' END AS pft, CASE WHEN p_size % 2 = 0 THEN '[1, 2]' ELSE 'one' END AS visit_id, 'a' AS data_source, 'b' AS data_subsource FROM part"


@query(ctes(c=_CHECK.format("VARCHAR")) + """SELECT rule, key, detail, 'error' AS severity FROM (SELECT 'unique' AS rule, dataset_species_name AS key, CAST(count(*) AS VARCHAR) AS detail FROM c GROUP BY 2 HAVING count(*) > 1
  UNION ALL SELECT 'pft vocabulary', dataset_species_name, pft FROM c WHERE pft = 'tree' UNION ALL SELECT 'taxon_rank vocabulary', dataset_species_name, taxon_rank FROM c WHERE taxon_rank = 'order')""")
def checklist_violations(spark, d):
    c = schemas.trimmed(table(spark, d, _CHECK.format("STRING")), "dataset_species_name")
    return schemas.violations(c, "species_pft_checklist").where("rule <> 'schema'")


@query(ctes(c=_CHECK.format("VARCHAR")) + "SELECT dataset_species_name, CASE WHEN visit_id = 'one' THEN 'one' ELSE '1|2' END AS visits, trim(accepted_species_name) AS name FROM c")
def list_fields(spark, d):
    c = table(spark, d, _CHECK.format("STRING")).withColumn("visit_id.0", F.lit("x"))
    c = schemas.trimmed(schemas.list_columns(c, ["visit_id"]), "dataset_species_name")
    return c.select("dataset_species_name", F.array_join("visit_id", "|").alias("visits"), F.col("accepted_species_name").alias("name"))
