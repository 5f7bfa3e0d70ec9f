"""Time series and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverspark.functions import dates as D
from coverspark.operators import model as M
from coverspark.operators import series as S
from coverspark.operators import spatial as P
from coverspark.operators import stats as A
from coverspark.plans.registry import BANDS, PIXELS, SERIES, ctes, query, table
from coverspark.session import dealt, scratch_path
from coverspark.sources.files import drop_unit

_S = ctes(s=SERIES)
_DOY = "SELECT id, dayofyear(day) AS t, v FROM s"


def series(spark, d):
    return table(spark, d, SERIES)


@query("SELECT user_id, date_trunc('week', ts) AS step, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median, count(value) AS n FROM events GROUP BY ALL")
def resample_median(spark, d):
    r = S.resample(table(spark, d, "SELECT user_id, ts, value FROM events"), "user_id", "ts", "value", "week")
    return r.select("user_id", F.col("step").cast("date").alias("step"), F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "n")


@query("SELECT user_id, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7.0) AS BIGINT) AS step, count(*) AS n FROM events GROUP BY ALL")
def day_steps(spark, d):
    e = table(spark, d, "SELECT user_id, ts FROM events")
    return e.groupBy("user_id", D.day_step(F.col("ts"), F.lit("2024-01-01"), 7).alias("step")).agg(F.count("*").alias("n"))


@query(_S + """, w AS (SELECT *, lag(v) OVER o AS a, lead(v) OVER o AS b, count(*) OVER f AS n, quantile_cont(v, 0.5) OVER f AS m, stddev_pop(v) OVER (PARTITION BY id) AS cut FROM s
    WINDOW o AS (PARTITION BY id ORDER BY day), f AS (PARTITION BY id ORDER BY day ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
  SELECT id, day, CASE WHEN coalesce(abs(v - CASE WHEN n = 3 THEN m ELSE v END) > cut AND (v < (a + b) / 2 - cut OR v > greatest(a, b) + cut), FALSE) THEN NULL ELSE v END AS v FROM w""")
def outlier_median(spark, d):
    from pyspark.sql import Window

    return S.drop_outliers(series(spark, d), "id", "day", "v", F.stddev_pop("v").over(Window.partitionBy("id"))).select("id", "day", "v")


_GAPS = "SELECT id, dayofyear(day) AS t, CASE WHEN dayofyear(day) % 3 > 0 THEN v END AS v FROM "


@query(_S + f""", g AS ({_GAPS} s), f AS (SELECT *, last_value(v IGNORE NULLS) OVER a AS v0, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER a AS t0, first_value(v IGNORE NULLS) OVER b AS v1, first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER b AS t1 FROM g
    WINDOW a AS (PARTITION BY id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY id ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  SELECT id, t, round(coalesce(v, v0 + (v1 - v0) * (t - t0) / nullif(t1 - t0, 0)), 8) AS filled FROM f""")
def interp_linear(spark, d):
    return S.interpolate(table(spark, d, f"{_GAPS} ({SERIES}) s"), "id", "t", "v").select("id", "t", F.round("filled", 8).alias("filled"))


@query(_S + f""", g AS ({_GAPS} s) SELECT id, t, round(coalesce(v, (avg(v) OVER (PARTITION BY id ORDER BY t RANGE BETWEEN 5 PRECEDING AND 1 FOLLOWING) + avg(v) OVER (PARTITION BY id ORDER BY t RANGE BETWEEN 1 PRECEDING AND 5 FOLLOWING)) / 2), 8) AS filled FROM g""")
def neighbour_fill(spark, d):
    return S.neighbour_fill(table(spark, d, f"{_GAPS} ({SERIES}) s"), "id", "t", "v", 5).select("id", "t", F.round("filled", 8).alias("filled"))


@query(_S + """SELECT id, day, round(CASE WHEN lag(v) OVER o IS NULL THEN (5 * v + 2 * lead(v) OVER o - lead(v, 2) OVER o) / 6 WHEN lead(v) OVER o IS NULL THEN (5 * v + 2 * lag(v) OVER o - lag(v, 2) OVER o) / 6 ELSE (lag(v) OVER o + v + lead(v) OVER o) / 3 END, 5) AS v
  FROM s WINDOW o AS (PARTITION BY id ORDER BY day)""")
def smooth_sg3(spark, d):
    return series(spark, d).select("id", "day", F.round(S.smooth("v", S.over("id", "day")), 5).alias("v"))


_SEASON = f"""t AS ({_DOY}), m AS (SELECT id, max(v) AS peak, min(t) FILTER (v = top) AS peak_t, min(v) AS valley, min(t) FILTER (v = low) AS valley_t FROM (SELECT *, max(v) OVER (PARTITION BY id) AS top, min(v) OVER (PARTITION BY id) AS low FROM t) GROUP BY id),
  b AS (SELECT id, (min(v) FILTER (t <= peak_t) + min(v) FILTER (t >= peak_t)) / 2 AS base, (avg(v) FILTER (t <= peak_t AND v >= 0.8 * peak) + avg(v) FILTER (t >= peak_t AND v >= 0.8 * peak)) / 2 AS middle FROM t JOIN m USING (id) GROUP BY id)"""


def _season(spark, d):
    return S.season(table(spark, d, _DOY.replace("FROM s", f"FROM ({SERIES}) s")), "id", "t", "v", 0.5, 60.0)


@query(_S + f", {_SEASON} SELECT id, round(peak, 6) AS peak, CAST(peak_t AS DOUBLE) AS peak_t, round(valley, 6) AS valley, CAST(valley_t AS DOUBLE) AS valley_t, round(base, 6) AS base, round(peak - base, 6) AS amplitude, round(middle, 6) AS middle FROM m JOIN b USING (id)")
def season_values(spark, d):
    return _season(spark, d).select("id", F.round("peak", 6).alias("peak"), "peak_t", F.round("valley", 6).alias("valley"), "valley_t", F.round("base", 6).alias("base"), F.round("amplitude", 6).alias("amplitude"), F.round("middle", 6).alias("middle"))


_TARGETS = {"first": "{x}_first", "median": "{x}_mid", "amplitude": "base + (peak - base) * 0.5", "absolute": "60", "relative": "valley + (peak - valley) * 0.5"}
#: Slopes beside the peak, their samples nearest to each target, and integrals between start and end by amplitude.
_METRICS = f"""g AS (SELECT id, CAST(t AS DOUBLE) AS t, v, peak_t, peak, valley, valley_t, base, middle, CASE WHEN ta IS NULL AND tb IS NULL THEN NULL WHEN ta IS NULL THEN (vb - v) / (tb - t) WHEN tb IS NULL THEN (v - va) / (t - ta)
      ELSE ((t - ta) * (t - ta) * vb + ((tb - t) * (tb - t) - (t - ta) * (t - ta)) * v - (tb - t) * (tb - t) * va) / ((t - ta) * (tb - t) * (tb - ta)) END AS grad
    FROM (SELECT *, lag(v) OVER o AS va, lead(v) OVER o AS vb, CAST(lag(t) OVER o AS DOUBLE) AS ta, CAST(lead(t) OVER o AS DOUBLE) AS tb FROM t WINDOW o AS (PARTITION BY id ORDER BY t)) JOIN m USING (id) JOIN b USING (id)),
  sides AS (SELECT *, t <= peak_t AND grad > 0 AS up, t >= peak_t AND grad < 0 AS down FROM g),
  marks AS (SELECT id, min(v) FILTER (up) AS up_first, min(v) FILTER (down) AS down_first, quantile_cont(v, 0.5) FILTER (up) AS up_mid, quantile_cont(v, 0.5) FILTER (down) AS down_mid, max(t) AS last_t FROM sides GROUP BY id),
  ends AS (SELECT id, any_value(peak) AS peak, any_value(peak_t) AS peak_t, any_value(valley) AS valley, any_value(valley_t) AS valley_t, any_value(base) AS base, any_value(middle) AS middle, any_value(last_t) AS last_t, """ + ", ".join(
    f"min({{{{'d': round(abs(v - ({f.format(x=side)})), 9), 't': t, 'v': v}}}}) FILTER ({side}) AS {name}_{m}" for side, name in (("up", "sos"), ("down", "eos")) for m, f in _TARGETS.items()) + """ FROM sides JOIN marks USING (id) GROUP BY id),
  inside AS (SELECT g.id, g.t, g.v, CASE WHEN g.t >= sos_amplitude.t AND g.t <= eos_amplitude.t THEN g.v ELSE 0 END AS a, CASE WHEN g.t >= sos_amplitude.t AND g.t <= eos_amplitude.t THEN g.v - g.base ELSE 0 END AS c, g.v - g.valley AS e FROM g JOIN ends USING (id)),
  sums AS (SELECT id, sum(a) AS lios, sum(c) AS sios, sum(v) AS liot, sum(e) AS siot FROM (SELECT id, """ + ", ".join(f"coalesce(({c} + lag({c}) OVER o) / 2, 0) AS {c}" for c in "avce") + " FROM inside WINDOW o AS (PARTITION BY id ORDER BY t)) GROUP BY id)"
_METRICS = _METRICS.replace("{{", "{").replace("}}", "}")


def _rounded(name: str, sql: str) -> str:
    return f"round({sql}, 8) AS {name}"


_SOS, _EOS = "sos_amplitude", "eos_amplitude"
_OUT = {"peak": "peak", "peak_t": "CAST(peak_t AS DOUBLE)", "valley": "valley", "valley_t": "CAST(valley_t AS DOUBLE)", "base": "base", "middle": "middle", "amplitude": "peak - base", "peak_valley": "peak - valley", "middle_base": "middle - base", "middle_valley": "middle - valley"}
_OUT |= {f"{x}_{m}_{p}": f"{x}_{m}.{p}" for x in ("sos", "eos") for m in _TARGETS for p in ("v", "t")}
_OUT |= {"length": f"CASE WHEN {_EOS}.t - {_SOS}.t < 0 THEN {_EOS}.t - {_SOS}.t + last_t ELSE {_EOS}.t - {_SOS}.t END", "rise": f"(peak - {_SOS}.v) / nullif(peak_t - {_SOS}.t, 0)", "fall": f"abs(({_EOS}.v - peak) / nullif({_EOS}.t - peak_t, 0))"}
_OUT |= {n: n for n in ("lios", "sios", "liot", "siot")}


@query(_S + f", {_SEASON}, {_METRICS} SELECT id, {', '.join(_rounded(n, f'ends.{x}' if x in ('peak',) else x) for n, x in _OUT.items())} FROM ends JOIN sums USING (id)")
def phenometrics_all(spark, d):
    return _season(spark, d).select("id", *(F.round(n, 8).alias(n) for n in _OUT))


@query(_S + f", {_SEASON}, {_METRICS} SELECT id, sos_amplitude.t AS sos_t, eos_amplitude.t AS eos_t FROM ends")
def season_ends(spark, d):
    return _season(spark, d).select("id", F.col("sos_amplitude_t").alias("sos_t"), F.col("eos_amplitude_t").alias("eos_t"))


_LAGS = "lag(day) OVER o AS d0, day AS d1, lead(day) OVER o AS d2, lead(day, 2) OVER o AS d3, lag(v) OVER o AS p0, v AS p1, lead(v) OVER o AS p2, lead(v, 2) OVER o AS p3"
_MONTHS = "SELECT l_suppkey AS id, CAST(date_trunc('month', l_shipdate) AS DATE) AS day, max(l_extendedprice) AS v FROM lineitem GROUP BY ALL"


@query(f"""WITH s AS ({_MONTHS}), l AS (SELECT id, {_LAGS} FROM s WINDOW o AS (PARTITION BY id ORDER BY day)),
  k AS (SELECT *, CAST(d2 - d1 AS DOUBLE) AS n, unnest(range(0, CAST(d2 - d1 AS BIGINT) - 1)) AS k, (p2 - p0) / (CAST(d1 - d0 AS DOUBLE) / (d2 - d1) + 1) AS m1, (p3 - p1) / (1 + CAST(d3 - d2 AS DOUBLE) / (d2 - d1)) AS m2 FROM l WHERE d0 IS NOT NULL AND d3 IS NOT NULL)
  SELECT id, d1 + CAST(k AS INT) AS day, round(p1 + (k / n) * m1 + (k / n) ^ 2 * (3 * (p2 - p1) - 2 * m1 - m2) + (k / n) ^ 3 * (2 * (p1 - p2) + m1 + m2), 5) AS value FROM k""")
def spline_daily(spark, d):
    return S.spline_daily(table(spark, d, _MONTHS), "id", "day", "v").withColumn("value", F.round("value", 5))


@query(_S + ", i AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY day) - 1 AS i FROM s) SELECT id, day, round(v - regr_intercept(v, i) OVER (PARTITION BY id) - regr_slope(v, i) OVER (PARTITION BY id) * i, 4) AS detrended FROM i")
def detrend(spark, d):
    return S.detrend(series(spark, d), "id", "day", "v").select("id", "day", F.round("detrended", 4).alias("detrended"))


_YEARS = "SELECT user_id, value AS v, epoch_us(ts) / (1e6 * 86400 * 365.25) AS t FROM events"
_TERMS = ["1.0", "t", "cos(2 * pi() * t)", "sin(2 * pi() * t)", "cos(4 * pi() * t)", "sin(4 * pi() * t)"]


def _years(spark, d):
    return table(spark, d, "SELECT user_id, ts, value FROM events").withColumn("years", D.fractional_years(F.col("ts")))


@query()
def harmonic_fit(spark, d):
    return S.harmonic_fit(_years(spark, d), "user_id", "years", "value")


@query(f"WITH y AS ({_YEARS}) SELECT user_id, unnest(range(0, 36)) AS place, round(unnest([{', '.join(f'sum({a} * {b})' for a in _TERMS for b in _TERMS)}]), 3) AS xx FROM y GROUP BY user_id")
def harmonic_products(spark, d):
    sums, _ = S.harmonic_sums(_years(spark, d), "user_id", "years", "value")
    return sums.select("user_id", F.posexplode("xx").alias("place", "xx")).select("user_id", F.col("place").cast("long").alias("place"), F.round("xx", 3).alias("xx"))


@query(f"WITH y AS ({_YEARS}), s AS (SELECT user_id, sum({_TERMS[2]} * v) AS c, sum({_TERMS[3]} * v) AS s FROM y GROUP BY 1) SELECT user_id, round(sqrt(c * c + s * s), 4) AS amplitude, round(atan2(c, s), 7) AS phase FROM s")
def amplitude_phase(spark, d):
    sums, names = S.harmonic_sums(_years(spark, d), "user_id", "years", "value")
    a, p = S.amplitude_phase(F.col("xy")[names.index("cos1")], F.col("xy")[names.index("sin1")])
    return sums.select("user_id", F.round(a, 4).alias("amplitude"), F.round(p, 7).alias("phase"))


@query(_S + """SELECT id, day, CASE WHEN coalesce(z > 1.2816 AND (v < (a + b) / 2 - sd OR v > greatest(a, b) + sd), FALSE) THEN NULL ELSE v END AS v FROM (
  SELECT id, day, v, lag(v) OVER o AS a, lead(v) OVER o AS b, stddev_pop(v) OVER p AS sd, abs(v - avg(v) OVER p) / nullif(stddev_pop(v) OVER p, 0) AS z FROM s WINDOW o AS (PARTITION BY id ORDER BY day), p AS (PARTITION BY id))""")
def outlier_z(spark, d):
    return S.drop_outliers_z(series(spark, d), "id", "day", "v", 1.2816).select("id", "day", "v")


_SHIPPED = "SELECT l_suppkey AS id, l_shipdate AS ts, l_quantity AS v FROM lineitem"


def _climate(number: str, day: str) -> str:
    return f"""WITH r AS ({_SHIPPED}), y AS (SELECT ys[len(ys) // 2 + 1] AS y FROM (SELECT list_sort(list(DISTINCT year(ts))) AS ys FROM r)), f AS (SELECT y, make_date(CAST(y AS INT), 1, 1) AS d FROM y)
  SELECT id, {day} AS step, round(mean, 6) AS mean, median, n FROM (SELECT id, {number} AS k, avg(v) AS mean, quantile_cont(v, 0.5) AS median, count(v) AS n FROM r GROUP BY ALL), f"""


@query(_climate("month(ts)", "make_date(CAST(y AS INT), CAST(k AS INT), 1)"))
def climatology_month(spark, d):
    return S.climatology(table(spark, d, _SHIPPED), "id", "ts", "v").withColumn("mean", F.round("mean", 6))


@query(_climate("weekofyear(ts)", "d + CAST((8 - isodow(d)) % 7 + (k - 1) * 7 + 6 AS INT)"))
def climatology_week(spark, d):
    return S.climatology(table(spark, d, _SHIPPED), "id", "ts", "v", "week").withColumn("mean", F.round("mean", 6))


@query(f"WITH r AS ({_SHIPPED}), s AS (SELECT CAST(date_trunc('week', min(ts)) AS DATE) AS a FROM r) SELECT id, a + CAST(floor(date_diff('day', a, CAST(ts AS DATE)) / 14) * 14 AS INT) AS step, round(avg(v), 6) AS mean, quantile_cont(v, 0.5) AS median, count(v) AS n FROM r, s GROUP BY ALL")
def resample_two_weeks(spark, d):
    return S.resample_days(table(spark, d, _SHIPPED), "id", "ts", "v", 14).withColumn("mean", F.round("mean", 6))


@query(_S + f", g AS ({_GAPS} s) SELECT id, t, round(coalesce(v, first_value(v) OVER (PARTITION BY id ORDER BY t), avg(v) OVER (PARTITION BY id)), 8) AS filled FROM g")
def fill_fast(spark, d):
    return table(spark, d, f"{_GAPS} ({SERIES}) s").select("id", "t", F.round(S.fast_fill("v", "id", "t"), 8).alias("filled"))


@query(_S + """, i AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY day) - 1 AS i, count(*) OVER (PARTITION BY id) AS n FROM s), w AS (SELECT o, exp(-0.5 * o * o) AS w FROM (SELECT unnest(range(-4, 5)) AS o)),
  m AS (SELECT id, i, v FROM i UNION ALL SELECT id, -1 - i, v FROM i UNION ALL SELECT id, 2 * n - 1 - i, v FROM i)
  SELECT a.id, a.day, round(sum(m.v * w) / (SELECT sum(w) FROM w), 5) AS v FROM i a, w, m WHERE m.id = a.id AND m.i = a.i + o GROUP BY a.id, a.day""")
def smooth_gaussian(spark, d):
    return S.smooth_gaussian(series(spark, d), "id", "day", "v").select("id", "day", F.round("smoothed", 5).alias("v"))


_YEAR_DAYS = "SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS day FROM orders"


@query(f"WITH o AS ({_YEAR_DAYS}), y AS (SELECT *, max(day) OVER (PARTITION BY id) AS last FROM o) SELECT id, CASE WHEN day = last AND month(day) = 12 THEN make_date(CAST(year(day) AS INT), 12, 31) ELSE day END AS day FROM y")
def last_day_of_year(spark, d):
    return S.year_end(table(spark, d, _YEAR_DAYS), "id", "day")


@query(f"WITH o AS ({_YEAR_DAYS}), n AS (SELECT id, year(day) AS y, count(*) AS n FROM o GROUP BY ALL), c AS (SELECT id, y, row_number() OVER (PARTITION BY id ORDER BY n DESC, y) AS r FROM n) SELECT o.id, day FROM o JOIN c ON c.id = o.id AND c.y = year(day) AND r = 1")
def dominant_year(spark, d):
    return S.dominant_year(table(spark, d, _YEAR_DAYS), "id", "day")


def _gradient(v: str) -> str:
    return f"""CASE WHEN lag(t) OVER o IS NULL AND lead(t) OVER o IS NULL THEN NULL WHEN lag(t) OVER o IS NULL THEN (lead({v}) OVER o - {v}) / (lead(t) OVER o - t) WHEN lead(t) OVER o IS NULL THEN ({v} - lag({v}) OVER o) / (t - lag(t) OVER o)
    ELSE ((t - lag(t) OVER o) ^ 2 * lead({v}) OVER o + ((lead(t) OVER o - t) ^ 2 - (t - lag(t) OVER o) ^ 2) * {v} - (lead(t) OVER o - t) ^ 2 * lag({v}) OVER o) / ((t - lag(t) OVER o) * (lead(t) OVER o - t) * (lead(t) OVER o - lag(t) OVER o)) END"""


@query(_S + f""", t AS (SELECT id, CAST(dayofyear(day) AS DOUBLE) AS t, v FROM s), a AS (SELECT *, {_gradient('v')} AS first FROM t WINDOW o AS (PARTITION BY id ORDER BY t)), b AS (SELECT *, {_gradient('first')} AS second FROM a WINDOW o AS (PARTITION BY id ORDER BY t))
  SELECT id, t, round(first, 9) AS first, round(second, 9) AS second FROM (SELECT *, lag(second) OVER (PARTITION BY id ORDER BY t) AS before FROM b) WHERE before * second < 0""")
def inflections(spark, d):
    s = series(spark, d).select("id", F.dayofyear("day").cast("double").alias("t"), "v")
    return S.inflections(s, "id", "t", "v").select("id", "t", F.round("first", 9).alias("first"), F.round("second", 9).alias("second"))


@query(_S + """, x AS (SELECT *, 20 + (max(v) OVER (PARTITION BY id) - 20) * 0.4 AS cut FROM s), g AS (SELECT id, min(day) FILTER (v > cut) AS a, max(day) FILTER (v > cut) AS b FROM x GROUP BY id)
  SELECT id, a AS "start", b AS "end", dayofyear(a) AS start_doy, dayofyear(b) AS end_doy, b - a AS length FROM g""")
def threshold_season(spark, d):
    return S.threshold_season(series(spark, d), "id", "day", "v", 0.4, 20.0)


@query("SELECT user_id, " + ", ".join(f"sum(value) FILTER (CAST(ts AS DATE) = DATE '2024-01-{k:02d}') AS \"2024_01_{k:02d}_sum\"" for k in (3, 11, 25)) + " FROM events GROUP BY 1")
def wide_by_date(spark, d):
    e = table(spark, d, "SELECT user_id, CAST(ts AS DATE) AS day, value FROM events")
    return S.wide_by_date(e, "user_id", "day", "value", [f"2024-01-{k:02d}" for k in (3, 11, 25)], "_sum")


@query(_S.replace("WITH ", "WITH RECURSIVE ", 1) + """, d AS (SELECT id, v, row_number() OVER o - 1 AS i, count(*) OVER e AS n, lag(v) OVER o AS a, lead(v) OVER o AS b, quantile_cont(v, 0.75) OVER e AS q
    FROM s WHERE v IS NOT NULL WINDOW o AS (PARTITION BY id ORDER BY day), e AS (PARTITION BY id)),
  p AS (SELECT id, i, n, row_number() OVER (PARTITION BY id ORDER BY v DESC, i) AS r FROM d WHERE v >= q AND v > a AND v > b),
  w AS (SELECT DISTINCT id, CAST(0 AS BIGINT) AS r, CAST([] AS BIGINT[]) AS kept FROM d
    UNION ALL SELECT w.id, p.r, CASE WHEN len(list_filter(kept, lambda k: abs(k - i) < ceil(n / 4.0))) = 0 THEN list_append(kept, i) ELSE kept END FROM w JOIN p ON p.id = w.id AND p.r = w.r + 1)
  SELECT id, max(len(kept)) AS seasons FROM w GROUP BY id""")
def num_seasons(spark, d):
    return S.num_seasons(series(spark, d), "id", "day", "v")


@query(_S + ", i AS (SELECT id, day, v - lag(v) OVER o AS up, lead(v) OVER o - v AS next FROM s WINDOW o AS (PARTITION BY id ORDER BY day)) SELECT id, day FROM i WHERE up * next < 0")
def turning_points(spark, d):
    w = S.over("id", "day")
    up, ahead = F.col("v") - F.lag("v").over(w), F.lead("v").over(w) - F.col("v")
    return series(spark, d).withColumn("turn", up * ahead).where("turn < 0").select("id", "day")


_TWO = "SELECT o_orderkey AS k, o_totalprice / 1e5 AS y, CAST(o_custkey % 50 AS DOUBLE) / 10 + 1 AS a, CAST(o_orderkey % 17 AS DOUBLE) / 5 AS b FROM orders"


@query(f"""WITH r AS ({_TWO}), s AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS byy, sum(y * y) AS yy, count(*) AS n FROM r),
  f AS (SELECT *, aa * bb - ab * ab AS det, (bb * ay - ab * byy) / (aa * bb - ab * ab) AS p, (aa * byy - ab * ay) / (aa * bb - ab * ab) AS q FROM s),
  e AS (SELECT k, y - p * a - q * b AS e, (bb * a * a - 2 * ab * a * b + aa * b * b) / det AS h, (yy - p * ay - q * byy) / (n - 2) AS s2 FROM r, f)
  SELECT k, round(e * e * h / (2 * s2 * (1 - h) ^ 2), 8) AS cooks FROM e""")
def cooks_two_features(spark, d):
    r = table(spark, d, _TWO.replace("1e5", "1e5D")).withColumns({c: F.col(c).cast("double") for c in ("y", "a", "b")})
    return M.cooks_distance(r, ["a", "b"], "y").select("k", F.round("cooks", 8).alias("cooks"))


@query("""WITH r AS (SELECT o_orderkey AS k, o_totalprice / 1e5 AS y, (o_custkey % 50) / 10.0 + 1 AS x FROM orders), s AS (SELECT sum(x * x) AS xx, sum(x * y) AS xy, sum(y * y) AS yy, count(*) AS n FROM r)
  SELECT k, round((y - x * xy / xx) ^ 2 * (x * x / xx) / (((yy - xy * xy / xx) / (n - 1)) * (1 - x * x / xx) ^ 2), 8) AS cooks FROM r, s""")
def cooks_distance(spark, d):
    r = table(spark, d, "SELECT o_orderkey AS k, o_totalprice / 1e5D AS y, CAST((o_custkey % 50) / 10.0D + 1 AS DOUBLE) AS x FROM orders")
    return M.cooks_distance(r, ["x"], "y").select("k", F.round("cooks", 8).alias("cooks"))


@query("""WITH r AS (SELECT o_orderkey AS k, o_totalprice / 1e5 AS y, (o_custkey % 50) / 10.0 + 1 AS x FROM orders), s AS (SELECT sum(x * x) AS xx, sum(x * y) AS xy, sum(y * y) AS yy, count(*) AS n FROM r),
  c AS (SELECT k, (y - x * xy / xx) ^ 2 * (x * x / xx) / (((yy - xy * xy / xx) / (n - 1)) * (1 - x * x / xx) ^ 2) AS cooks FROM r, s)
  SELECT k FROM c, (SELECT quantile_cont(cooks, 0.25) AS q1, quantile_cont(cooks, 0.75) AS q3 FROM c) WHERE cooks < q3 + 2 * (q3 - q1)""")
def refine_iqr(spark, d):
    r = table(spark, d, "SELECT o_orderkey AS k, o_totalprice / 1e5D AS y, CAST((o_custkey % 50) / 10.0D + 1 AS DOUBLE) AS x FROM orders")
    return A.quartile_flags(M.cooks_distance(r, ["x"], "y"), "cooks", 2.0).where("refined").select("k")


FEATURES = ["blue", "green", "red", "red_edge", "swir1", "swir2"]


@query()
def rf_fit_predict(spark, d):
    b = table(spark, d, BANDS)
    model = M.forest(b.where("id % 5 > 0"), FEATURES, "nir", trees=20, depth=5, per_split="3")
    return M.score(model, b, FEATURES).select("id", (F.col("id") % 5 > 0).alias("trained_on"), "prediction")


@query("""SELECT fit, count(*) AS n FROM (SELECT unnest(range(place, 6)) AS fit FROM orders JOIN (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) AS place FROM (SELECT DISTINCT o_orderpriority FROM orders)) USING (o_orderpriority)) GROUP BY fit""")
def cumulative_sources(spark, d):
    order = spark.createDataFrame([(s, k) for k, s in enumerate(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), 1)], "o_orderpriority string, place long")
    return M.cumulative_sources(table(spark, d, "SELECT o_orderpriority FROM orders"), order, "o_orderpriority").groupBy("fit").agg(F.count("*").alias("n"))


@query()
def cumulative_fits(spark, d):
    """Agreement of a forest on each set of sources 1 to i, for all rows and for those within a deviation of the mean."""
    b = table(spark, d, BANDS).withColumn("source", F.concat(F.lit("s"), F.col("zone") % 3))
    order = spark.createDataFrame([(f"s{k}", k + 1) for k in range(3)], "source string, place long")
    mean = b.agg(F.avg("nir").alias("mean"), F.stddev_pop("nir").alias("sd"))
    refined = b.crossJoin(F.broadcast(mean)).where(F.abs(F.col("nir") - F.col("mean")) < 1.5 * F.col("sd")).drop("mean", "sd")
    return M.cumulative_fits({"original": b, "refined": refined}, order, "source", FEATURES, "nir", b.where("id % 5 = 0"), trees=5, depth=4, per_split="3")


@query()
def score_types(spark, d):
    """Every pixel by one model per type, in one pass over the pixels."""
    px = table(spark, d, PIXELS).select("cell_id", "x", "y", F.col("line").cast("double").alias("line"), "share", "value")
    models = {t: M.forest(px.withColumn("cover", e), ["line", "share"], "cover", trees=3, depth=3, per_split="2") for t, e in (("shrub", F.col("value")), ("forb", 50 - F.col("value")))}
    return M.score_types(models, px, ["line", "share"]).groupBy("type", "cell_id").agg(F.count("*").alias("n"), F.avg("prediction").alias("mean"))


@query()
def gbt_importance_categories(spark, d):
    b = table(spark, d, BANDS).withColumn("kind", F.concat(F.lit("k"), F.col("zone") % 4))
    got = M.boosted_importance(b, ["blue", "green"], "nir", rounds=3, depth=3, categories=["kind"])
    return spark.createDataFrame(list(got.items()), "feature string, importance double")


#: All 48 settings of the search, with fewer trees than a survey would grow.
SETTINGS = [{"trees": t, "depth": h, "per_split": s} for t in (2, 3, 4, 5) for h in (2, 3, 4, 5) for s in ("2", "3", "6")]


@query()
def grid_leaderboard(spark, d):
    b = table(spark, d, BANDS)
    return M.leaderboard(b.where("id % 5 > 0"), b.where("id % 5 = 0"), FEATURES, "nir", SETTINGS)


@query()
def perm_importance(spark, d):
    b = table(spark, d, BANDS)
    return M.permutation_importance(M.forest(b, FEATURES, "nir", trees=10, depth=4, per_split="3"), b, FEATURES, "nir", repeats=2)


@query()
def gbt_importance(spark, d):
    got = M.boosted_importance(table(spark, d, BANDS), FEATURES, "nir", rounds=5, depth=4)
    return spark.createDataFrame(list(got.items()), "feature string, importance double")


@query(ctes(p=PIXELS) + "SELECT type, cell_id, count(*) AS n, count(DISTINCT (x, y)) AS places FROM p, (VALUES ('shrub'), ('forb')) t(type) GROUP BY ALL")
def scored_units(spark, d):
    """Every type and cell scored and written, one unit removed, the search for missing units scored again, and all read."""
    px = table(spark, d, PIXELS).select(F.col("cell_id").cast("int").alias("cell_id"), "x", "y", F.col("line").cast("double").alias("line"), "share", "value")
    models = {t: M.forest(px.withColumn("cover", e), ["line", "share"], "cover", trees=2, depth=2, per_split="2") for t, e in (("shrub", F.col("value")), ("forb", 50 - F.col("value")))}
    path = scratch_path(spark)
    M.score_units(models, px, ["line", "share"], path)
    drop_unit(spark, path, type="shrub", cell_id=3)
    scored, place = M.score_units(models, px, ["line", "share"], path), ["type", "cell_id", "x", "y"]
    places = dealt(scored.select(*place), place, scored.count()).groupBy(*place).agg(F.count("*").alias("n"))
    return places.groupBy("type", "cell_id").agg(F.sum("n").alias("n"), F.count("*").alias("places"))


@query()
def score_cells(spark, d):
    px = table(spark, d, PIXELS).select("cell_id", "x", "y", F.col("line").cast("double").alias("line"), "share", "value")
    model = M.forest(px, ["line", "share"], "value", trees=5, depth=4, per_split="2")
    return M.score(model, px, ["line", "share"]).groupBy("cell_id").agg(F.count("*").alias("n"), F.avg("prediction").alias("mean"))


@query(ctes(p=PIXELS) + """SELECT a.y AS y, count(*) AS n, round(corr(a.m, b.m) ^ 2, 5) AS r2, round(avg(abs(a.m - b.m)), 6) AS mae FROM (SELECT CAST(x // 4 AS BIGINT) AS x, y, avg(value) / 50 AS m FROM p GROUP BY ALL) a JOIN (SELECT CAST(x // 4 AS BIGINT) AS x, y, avg(share) * 10 AS m FROM p GROUP BY ALL) b ON a.x = b.x AND a.y = b.y GROUP BY 1""")
def map_compare(spark, d):
    p = table(spark, d, PIXELS)
    cell = [F.floor(F.col("x") / 4).alias("x"), F.col("y")]
    both = p.groupBy(*cell).agg((F.avg("value") / 50).alias("a"), (F.avg("share") * 10).alias("b"))
    return A.agreement(both, "y", "a", "b").select("y", "n", F.round("r2", 5).alias("r2"), F.round("mae", 6).alias("mae"))


@query("SELECT l_suppkey, l_returnflag, " + ", ".join(f"round(avg(l_quantity) FILTER (month(l_shipdate) IN {m}), 6) AS {n}" for n, m in (("summer", "(6, 7, 8)"), ("winter", "(12, 1, 2)"), ("shoulder", "(3, 4, 5, 9, 10, 11)"))) + " FROM lineitem GROUP BY ALL")
def season_means(spark, d):
    x = table(spark, d, "SELECT l_suppkey, l_returnflag, l_quantity, l_shipdate FROM lineitem")
    m = F.month("l_shipdate")
    seasons = {"summer": m.isin(6, 7, 8), "winter": m.isin(12, 1, 2), "shoulder": m.isin(3, 4, 5, 9, 10, 11)}
    return x.groupBy("l_suppkey", "l_returnflag").agg(*(F.round(F.avg(F.when(c, F.col("l_quantity"))), 6).alias(n) for n, c in seasons.items()))


@query("SELECT site, round(pi() * (max(sqrt((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2)) / 2) ^ 2, 4) AS area FROM (SELECT c_nationkey AS site, c_custkey % 97 AS x, c_custkey % 31 AS y FROM customer) a JOIN (SELECT c_nationkey AS site, c_custkey % 97 AS x, c_custkey % 31 AS y FROM customer) b USING (site) GROUP BY site")
def widest_plot(spark, d):
    c = table(spark, d, "SELECT c_nationkey AS site, CAST(c_custkey % 97 AS DOUBLE) AS x, CAST(c_custkey % 31 AS DOUBLE) AS y FROM customer")
    return P.widest(c, "site").select("site", F.round("area", 4).alias("area"))
