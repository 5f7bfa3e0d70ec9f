"""Rules of the sources: names, ids, dates, scales, masks and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverspark.functions import dates as D
from coverspark.functions import numbers as N
from coverspark.functions import text as T
from coverspark.operators import cover as C
from coverspark.operators import lists as L
from coverspark.plans.registry import BANDS, PIXELS, POINTS, ctes, query, table

#: Habit texts of the fixture.
_WORDS = ["Blue-green algae", "Soil crust", "Fungus", "unknown", "dead wood", "Moss", "liverwort", "Spore-bearing", "grass", "dwarf shrub", "Tree", "rock", "salt", "mineral soil", "bare ground", "water", "litter", "scat", "forb", "Cyanobacteria"]
_HABIT = "SELECT p_partkey, CASE p_partkey % 21 " + " ".join(f"WHEN {k} THEN '{w}'" for k, w in enumerate(_WORDS)) + " END AS habit, CASE p_size % 3 WHEN 0 THEN 'deciduous' WHEN 1 THEN 'evergreen' END AS leaf FROM part"


def _like(*marks: str) -> str:
    return "(" + " OR ".join(f"contains(lower(habit), '{m}')" for m in marks) + ")"


_MOSS = f"WHEN {_like('moss', 'liverwort')} THEN 'bryophyte' WHEN {_like('spore-bearing')} THEN 'forb'"
_SHRUB, _TREE = (f"WHEN {_like(w)} THEN leaf || ' {w}'" for w in ("shrub", "tree"))
_RULES = {
    "ava": f"WHEN {_like('algae', 'cyanobacteria', 'crust', 'fungus', 'unknown')} THEN 'other' {_MOSS} WHEN {_like('grass')} THEN 'graminoid' {_SHRUB} {_TREE}",
    "akveg": f"WHEN {_like('algae', 'fungus')} THEN 'other' {_MOSS} {_SHRUB}",
    "neon": f"WHEN {_like('unknown', 'cyanobacteria', 'fungus', 'dead', 'wood')} THEN 'other' {_MOSS} WHEN {_like('rock', 'soil', 'salt')} THEN 'bare ground' {_SHRUB}",
    "nga": f"{_MOSS} {_SHRUB} {_TREE} WHEN {_like('soil', 'rock')} THEN 'bare ground' WHEN {_like('water')} THEN 'water'",
    "abr": f"WHEN {_like('algae', 'crust', 'fungus')} THEN 'other' {_MOSS} WHEN {_like('litter', 'scat')} THEN 'litter' WHEN {_like('bare ground', 'mineral')} THEN 'bare ground' {_SHRUB}",
    "rava": f"{_MOSS} {_SHRUB} {_TREE}",
}


@query(ctes(h=_HABIT) + "SELECT p_partkey, " + ", ".join(f"CASE WHEN habit IS NULL THEN NULL {r} ELSE lower(habit) END AS {k}" for k, r in _RULES.items()) + " FROM h")
def habit_variants(spark, d):
    return table(spark, d, _HABIT).select("p_partkey", *(T.habit_to_pft(F.col("habit"), F.col("leaf"), k).alias(k) for k in T.HABIT_RULES))


@query(ctes(h=_HABIT) + "SELECT p_partkey, CASE WHEN contains(lower(habit), 'shrub') THEN 'shrub' ELSE habit END AS habit FROM h")
def shrub_clean(spark, d):
    return table(spark, d, _HABIT).select("p_partkey", T.clean_shrub(F.col("habit")).alias("habit"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'type' WHEN 1 THEN 'species' WHEN 2 THEN 'genus' ELSE 'given' END AS rank FROM part")
def rank_override(spark, d):
    p = table(spark, d, "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'bare ground' WHEN 1 THEN 'Salix brachycarpa Nutt.' WHEN 2 THEN 'Xanthoria (Fr.) Th. Fr.' ELSE p_name END AS name FROM part")
    return p.select("p_partkey", T.override_rank(F.col("name"), F.lit("given")).alias("rank"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Atqasuk Villarreal (pub 2013)' WHEN 1 THEN 'Barrow DOE NGEE Sloan (pub 2014)' ELSE replace(p_name, '_', ' ') || ' plot' END AS subsource, CASE p_partkey % 3 WHEN 0 THEN 'Toolik Field Station NEON (pub 2021)' WHEN 1 THEN 'Utqiagvik-Barrow NEON (pub 2021)' END AS of_site FROM part")
def subsource_names(spark, d):
    p = table(spark, d, "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN ' Atqasuk_Vera_Komarkova' WHEN 1 THEN 'Barrow_DOE_NGEE_Victoria Sloan (x_1)' ELSE replace(p_name, ' ', '_') || '(a)_plot' END AS raw, CASE p_partkey % 3 WHEN 0 THEN 'TOOL_004' WHEN 1 THEN 'D18_BARR_x' ELSE 'HEAL_001' END AS site FROM part")
    return p.select("p_partkey", T.tidy_subsource(F.col("raw")).alias("subsource"), T.subsource_of_site(F.col("site")).alias("of_site"))


@query("SELECT o_orderkey, o_orderkey || '.' || o_custkey AS composed, o_orderkey || '.' || year(o_orderdate) || '.' || o_custkey AS swapped, 'id_' || o_custkey || '_' || year(o_orderdate) || '_' || o_orderpriority AS grouped FROM orders")
def id_forms(spark, d):
    o = table(spark, d, "SELECT o_orderkey, o_custkey, year(o_orderdate) AS y, o_orderpriority, o_orderkey || '_' || o_custkey || '_' || year(o_orderdate) AS raw FROM orders")
    return o.select("o_orderkey", T.composed_id(F.col("o_orderkey"), F.col("o_custkey")).alias("composed"), T.swapped_id(F.col("raw")).alias("swapped"), T.group_id(F.col("o_custkey"), F.col("y"), F.col("o_orderpriority"), "id_").alias("grouped"))


@query("SELECT p_partkey, coalesce(CASE WHEN p_size % 2 = 0 THEN p_name END, CASE WHEN p_size % 3 = 0 THEN p_type END) AS name FROM part")
def combined_names(spark, d):
    p = table(spark, d, "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name END AS a, CASE WHEN p_size % 3 = 0 THEN p_type END AS b FROM part")
    return p.select("p_partkey", T.first_name(F.col("a"), F.col("b")).alias("name"))


@query('SELECT p_partkey, coalesce(CASE WHEN p_size % 2 = 0 THEN p_name END, CASE WHEN p_size % 3 = 0 THEN p_type END) AS "REMARKS", p_brand AS "SITE MOISTURE", CAST(p_size AS VARCHAR) AS "RELEVE NUMBER" FROM part')
def merged_twins(spark, d):
    p = table(spark, d, "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name END AS REMARKS, CASE WHEN p_size % 3 = 0 THEN p_type END AS REBMARKS, p_brand AS `SITE MOISTURE`, CAST(NULL AS STRING) AS `RELEVE NUMBER`, CAST(p_size AS STRING) AS RELEVE_NUMBER FROM part")
    return C.merge_twins(p, T.TWIN_COLUMNS)


@query("SELECT p_partkey, array_to_string([p_brand, p_type], '|') AS listed, CASE WHEN p_size % 2 = 0 THEN 0 ELSE 2 END AS n FROM part")
def list_texts(spark, d):
    p = table(spark, d, "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN \"['\" || p_brand || \"', '\" || p_type || \"']\" WHEN 1 THEN '(' || p_brand || ',' || p_type || ')' ELSE p_brand || ' , ' || p_type END AS s, CASE WHEN p_size % 2 = 1 THEN '[1, 2]' END AS t FROM part")
    return p.select("p_partkey", F.array_join(T.list_text(F.col("s")), "|").alias("listed"), F.size(T.list_text(F.col("t"))).alias("n"))


# Dates.
_FORMATS = [("1-URGENT", 1, "yyyy-MM-dd"), ("1-URGENT", 2, "dd.MM.yyyy"), ("2-HIGH", 1, "dd.MM.yyyy"), ("2-HIGH", 2, "yyyy-MM-dd"), ("3-MEDIUM", 1, "MM/dd/yyyy")]
_DATE_TEXT = "SELECT o_orderkey, o_orderpriority AS dataset, CASE o_orderkey % 6 WHEN 0 THEN {ymd} WHEN 1 THEN {dmy} WHEN 2 THEN {mdy} WHEN 3 THEN '05.08.218' WHEN 4 THEN year(o_orderdate) || '-' || (year(o_orderdate) + 1) ELSE '27-30.' || month(o_orderdate) || '.' || year(o_orderdate) END AS s FROM orders"
_SPARK_TEXT = _DATE_TEXT.format(ymd="date_format(o_orderdate, 'yyyy-MM-dd')", dmy="' ' || date_format(o_orderdate, 'dd.MM.yyyy')", mdy="date_format(o_orderdate, 'MM/dd/yyyy')")


@query("""WITH o AS (SELECT o_orderkey, o_orderpriority AS dataset, CAST(o_orderdate AS DATE) AS day, make_date(CAST(year(o_orderdate) AS INT), 1, 1) AS first, make_date(CAST(year(o_orderdate) + 1 AS INT), 12, 31) AS last FROM orders)
  SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CASE WHEN dataset IN ('1-URGENT', '2-HIGH') THEN day END WHEN 1 THEN CASE WHEN dataset IN ('1-URGENT', '2-HIGH') THEN day END WHEN 2 THEN CASE WHEN dataset = '3-MEDIUM' THEN day END
    WHEN 3 THEN CASE WHEN dataset IN ('1-URGENT', '2-HIGH') THEN DATE '2018-08-05' END WHEN 4 THEN first + CAST(floor((last - first) / 2) AS INT) WHEN 5 THEN CASE WHEN month(day) <> 2 THEN make_date(CAST(year(day) AS INT), CAST(month(day) AS INT), 28) END END AS day FROM o""")
def dataset_dates(spark, d):
    formats = spark.createDataFrame(_FORMATS, "dataset string, pos int, format string")
    return D.dataset_dates(table(spark, d, _SPARK_TEXT), formats, "dataset", "s").select("o_orderkey", "day")


@query("SELECT o_orderpriority AS dataset, array_to_string(list_sort(list(DISTINCT strftime(o_orderdate, '%Y-%m'))), ', ') AS spellings FROM orders GROUP BY 1")
def date_spellings(spark, d):
    return D.spellings(table(spark, d, "SELECT o_orderpriority AS dataset, date_format(o_orderdate, 'yyyy-MM') AS s FROM orders"), "dataset", "s")


@query("""WITH r AS (SELECT o_custkey, date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) AS b FROM orders GROUP BY 1)
  SELECT o_custkey, CAST(f AS DATE) AS "from", CAST(f + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS "to" FROM (SELECT o_custkey, unnest(generate_series(a, b, INTERVAL 3 MONTH)) AS f FROM r)""")
def month_steps(spark, d):
    r = table(spark, d, "SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1")
    return r.select("o_custkey", F.inline(D.month_steps(F.col("a"), F.col("b"), 3)))


@query("SELECT event_id, dayofyear(ts) AS doy, round(epoch_us(ts) / (1e6 * 86400 * 365.25), 9) AS years, round(2 * pi() * epoch_us(ts) / (1e6 * 86400 * 365.25), 6) AS radians FROM events")
def fractional_years(spark, d):
    e = table(spark, d, "SELECT event_id, ts FROM events")
    y = D.fractional_years(F.col("ts"))
    return e.select("event_id", F.dayofyear("ts").alias("doy"), F.round(y, 9).alias("years"), F.round(2 * F.pi() * y, 6).alias("radians"))


# Codes, scales, masks and labels.
_EXTENDED = {"modified_braun_blanquet": {"r": 0.05, "+": 0.55, "5": 85.0, "6": 97.5}, "drude": {"un-rr": 0.5, "sol": 3.0, "sp-cop1": 15.0, "cd (cop2)": 38.0, "d (cop3)": 63.0}, "percent": {"r": 0.05, "+": 0.55, "40": 40.0, "x": None}}
_PAIRS = [(s, k, v) for s, m in _EXTENDED.items() for k, v in m.items()]
_OF = "CASE p_partkey % {n} {whens} END"
_SCALE = _OF.format(n=len(_PAIRS), whens=" ".join(f"WHEN {i} THEN '{s}'" for i, (s, _, _) in enumerate(_PAIRS)))
_CODE = _OF.format(n=len(_PAIRS), whens=" ".join(f"WHEN {i} THEN '{k}'" for i, (_, k, _) in enumerate(_PAIRS)))
_PCT = _OF.format(n=len(_PAIRS), whens=" ".join(f"WHEN {i} THEN {v}" for i, (_, _, v) in enumerate(_PAIRS) if v is not None))


@query(f"SELECT p_partkey, {_SCALE} AS scale, {_CODE} AS code, CAST({_PCT} AS DOUBLE) AS pct FROM part")
def extended_codes(spark, d):
    return N.codes_to_percent(table(spark, d, f"SELECT p_partkey, {_SCALE} AS scale, {_CODE} AS code FROM part")).select("p_partkey", "scale", "code", "pct")


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'braun_blanquet' WHEN 1 THEN 'drude' WHEN 2 THEN 'percent' WHEN 3 THEN 'percent' WHEN 4 THEN 'braun_blanquet' ELSE '9' END AS scale FROM part")
def scale_assignment(spark, d):
    p = table(spark, d, "SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'AVARU_Wrangel_Kholod' WHEN 1 THEN 'AVARU_Taymyr_Pospelovs' WHEN 2 THEN 'AVARU_Polar_Ural_1_mtelyatnikov_2018' ELSE p_name END AS name, CASE p_partkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '2' WHEN 2 THEN NULL WHEN 3 THEN '0' WHEN 4 THEN 'BB' ELSE '9' END AS code FROM part")
    return N.assign_scale(p).select("p_partkey", "scale")


@query("SELECT p_partkey, round(pi() * p_size * p_size, 6) AS circle, try_cast(a AS DOUBLE) AS area, lower(trim(s)) AS shape, CASE WHEN try_cast(a AS DOUBLE) IS NULL THEN a END AS kept FROM (SELECT *, CASE WHEN p_size % 3 = 0 THEN 'varied' WHEN p_size % 3 = 1 THEN p_size || '.5' END AS a, ' ' || p_type AS s FROM part)")
def plot_areas(spark, d):
    p = table(spark, d, "SELECT p_partkey, p_size, CASE WHEN p_size % 3 = 0 THEN 'varied' WHEN p_size % 3 = 1 THEN p_size || '.5' END AS a, ' ' || p_type AS s FROM part")
    return p.select("p_partkey", F.round(N.circle_area(F.col("p_size")), 6).alias("circle"), N.area_or_text(F.col("a"), F.col("s")).alias("x")).select("p_partkey", "circle", "x.*")


@query(ctes(p=PIXELS) + """SELECT cell_id, count(s) AS n, round(sum(s), 6) AS total, sum(cloud) AS clouds, count(edge) AS n_edge, round(sum(season), 6) AS season, count(season) AS n_season
  FROM (SELECT cell_id, CASE WHEN raw <> 0 THEN raw * 0.0001 END AS s, CASE WHEN value > 30 THEN 1 ELSE 0 END AS cloud, CASE WHEN -value >= -30 THEN value END AS edge,
    CASE WHEN ord % 12 IN (1, 4, 5, 11) THEN CASE WHEN ord % 12 = 11 THEN 0.02 ELSE greatest(share, 0.02) END END AS season FROM (SELECT *, CASE WHEN line % 3 = 0 THEN 0 ELSE value * 100 END AS raw FROM p)) GROUP BY cell_id""")
def band_masks(spark, d):
    px = table(spark, d, f"SELECT *, CASE WHEN line % 3 = 0 THEN 0 ELSE value * 100 END AS raw, CAST(ord % 12 AS INT) AS scl FROM ({PIXELS}) p")
    m = px.select("cell_id", N.reflectance(F.col("raw")).alias("s"), N.above(F.col("value"), 30).alias("cloud"), N.without_edge(-F.col("value")).alias("edge"), N.season_value(F.col("share"), F.col("scl"), 0.02).alias("season"))
    return m.groupBy("cell_id").agg(F.count("s").alias("n"), F.round(F.sum("s"), 6).alias("total"), F.sum("cloud").alias("clouds"), F.count("edge").alias("n_edge"), F.round(F.sum("season"), 6).alias("season"), F.count("season").alias("n_season"))


@query("SELECT p_partkey, CASE p_size % 8 WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' WHEN 4 THEN 'D' WHEN 5 THEN 'E' WHEN 6 THEN 'Non-Arctic' END AS zone, CASE p_size % 5 WHEN 0 THEN 'B' WHEN 1 THEN 'G' WHEN 2 THEN 'W' WHEN 3 THEN 'S' END AS category FROM part")
def legend_labels(spark, d):
    p = table(spark, d, "SELECT p_partkey, CAST(p_size % 8 AS INT) AS code, CASE p_size % 5 WHEN 0 THEN 'B2b' WHEN 1 THEN 'G4' WHEN 2 THEN 'GL' WHEN 3 THEN 'S1' ELSE 'XX' END AS unit FROM part")
    return p.select("p_partkey", N.label_of(F.col("code"), N.ZONES).alias("zone"), N.label_of(F.col("unit"), N.UNIT_CATEGORIES).alias("category"))


@query(ctes(b=BANDS) + "SELECT id, round(276.53 * exp(31.2436 * least(w, 0.1)), 6) AS height FROM (SELECT id, 0.1509 * blue + 0.1973 * green + 0.3279 * red + 0.3406 * nir - 0.7112 * swir1 - 0.4572 * swir2 AS w FROM b)")
def height_model(spark, d):
    b = table(spark, d, BANDS)
    w = 0.1509 * F.col("blue") + 0.1973 * F.col("green") + 0.3279 * F.col("red") + 0.3406 * F.col("nir") - 0.7112 * F.col("swir1") - 0.4572 * F.col("swir2")
    return b.select("id", F.round(N.height(F.least(w, F.lit(0.1))), 6).alias("height"))


@query("""WITH b AS (SELECT CAST(-170.0 + n_nationkey * 1.2 AS DOUBLE) AS x0, CAST(-167.5 + n_nationkey * 1.2 AS DOUBLE) AS x1, CAST(60.0 + n_nationkey % 5 AS DOUBLE) AS y0, CAST(65.0 + n_nationkey % 5 AS DOUBLE) AS y1 FROM nation),
  g AS (SELECT DISTINCT gx, unnest(range(CAST(floor((y0 - 60) / 0.7) AS BIGINT), CAST(floor((y1 - 60) / 0.7) AS BIGINT) + 1)) AS gy FROM (SELECT *, unnest(range(CAST(floor((x0 + 170) / 0.7) AS BIGINT), CAST(floor((x1 + 170) / 0.7) AS BIGINT) + 1)) AS gx FROM b))
  SELECT gx || '_' || gy AS cell, gx, gy FROM g""")
def covering_grid(spark, d):
    b = table(spark, d, "SELECT CAST(-170.0 + n_nationkey * 1.2 AS DOUBLE) AS min_x, CAST(-167.5 + n_nationkey * 1.2 AS DOUBLE) AS max_x, CAST(60.0 + n_nationkey % 5 AS DOUBLE) AS min_y, CAST(65.0 + n_nationkey % 5 AS DOUBLE) AS max_y FROM nation")
    return N.covering_grid(b, -170.0, 60.0, 0.7)


@query(ctes(p=POINTS) + """, e AS (SELECT min(x) AS a, max(x) AS b, min(y) AS low, max(y) AS high FROM p) SELECT a, b, low, high, k AS step, round(a + (b - a) * k / 4.0, 9) AS "from", round(a + (b - a) * (k + 1) / 4.0, 9) AS "to" FROM e, (SELECT unnest(range(0, 4)) AS k)""")
def extent_steps(spark, d):
    e = table(spark, d, POINTS).agg(F.min("x").alias("a"), F.max("x").alias("b"), F.min("y").alias("low"), F.max("y").alias("high"))
    s = e.select("*", F.posexplode(L.equal_steps(F.col("a"), F.col("b"), 4)).alias("step", "s"))
    return s.select("a", "b", "low", "high", F.col("step").cast("long").alias("step"), F.round("s.from", 9).alias("from"), F.round("s.to", 9).alias("to"))
