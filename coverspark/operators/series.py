"""Time series per id: cleaning, filling, smoothing, season metrics and fits, as windows over (id, time)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from coverspark.operators.order_stats import with_quantiles
from coverspark.session import ship


def over(key: str, time: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy(time)


def rolling_median(v: str, w: WindowSpec, half: int) -> Column:
    """Centred median; the edges keep their own value."""
    frame = w.rowsBetween(-half, half)
    return F.when(F.count("*").over(frame) == 2 * half + 1, F.percentile(v, 0.5).over(frame)).otherwise(F.col(v))


def drop_outliers(df: DataFrame, key: str, time: str, v: str, cutoff: Column, half: int = 1) -> DataFrame:
    """Null where a value is off its rolling median by more than the cutoff and off both neighbours in the same way:
    below their mean less the cutoff, or above the larger of them plus the cutoff."""
    w = over(key, time)
    d = df.withColumns({"_med": rolling_median(v, w, half), "_a": F.lag(v).over(w), "_b": F.lead(v).over(w), "_cut": cutoff})
    far = F.abs(F.col(v) - F.col("_med")) > F.col("_cut")
    off = (F.col(v) < (F.col("_a") + F.col("_b")) / 2 - F.col("_cut")) | (F.col(v) > F.greatest("_a", "_b") + F.col("_cut"))
    return d.withColumn(v, F.when(~F.coalesce(far & off, F.lit(False)), F.col(v))).drop("_med", "_a", "_b", "_cut")


def interpolate(df: DataFrame, key: str, time: str, v: str, name: str = "filled") -> DataFrame:
    """Linear in time (a number) inside gaps; the ends stay null."""
    # both run over rows so far, one from either end, which takes one step per row
    back = Window.partitionBy(key).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(key).orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, 0)
    at = F.when(F.col(v).isNotNull(), F.col(time))
    d = df.withColumns({"_v0": F.last(v, True).over(back), "_t0": F.last(at, True).over(back), "_v1": F.last(v, True).over(ahead), "_t1": F.last(at, True).over(ahead)})
    line = F.col("_v0") + F.try_divide((F.col("_v1") - F.col("_v0")) * (F.col(time) - F.col("_t0")), F.col("_t1") - F.col("_t0"))
    return d.withColumn(name, F.coalesce(F.col(v), line)).drop("_v0", "_t0", "_v1", "_t1")


def fast_fill(v: str, key: str, time: str) -> Column:
    """Nulls take the first value of the series, or its mean where the first is null."""
    w = over(key, time)
    return F.coalesce(F.col(v), F.first(v).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.avg(v).over(Window.partitionBy(key)))


def neighbour_fill(df: DataFrame, key: str, day: str, v: str, days: int = 40, name: str = "filled") -> DataFrame:
    """Nulls become the mean of the means of the `days` days before and after (a day over in both)."""
    w = Window.partitionBy(key).orderBy(day)
    a, b = F.avg(v).over(w.rangeBetween(-days, 1)), F.avg(v).over(w.rangeBetween(-1, days))
    return df.withColumn(name, F.coalesce(F.col(v), (a + b) / 2))


def smooth(v: str, w: WindowSpec) -> Column:
    """Savitzky-Golay of 3 points and order 1: the mean of three; a line through the first or last three at the ends."""
    a, b = F.lag(v).over(w), F.lead(v).over(w)
    head = (5 * F.col(v) + 2 * b - F.lead(v, 2).over(w)) / 6
    tail = (5 * F.col(v) + 2 * a - F.lag(v, 2).over(w)) / 6
    return F.when(a.isNull(), head).when(b.isNull(), tail).otherwise((a + F.col(v) + b) / 3)


def smooth_gaussian(df: DataFrame, key: str, time: str, v: str, sigma: float = 1.0, name: str = "smoothed") -> DataFrame:
    """Gaussian weights out to 4 sigma, the series mirrored at both ends (its end values twice); null where a value is null nearby.

    Every sample sends its weighted value to the places around it and around its mirror images, for series of at least
    4 sigma samples.
    """
    radius = int(4 * sigma + 0.5)
    weights = [math.exp(-0.5 * (o / sigma) ** 2) for o in range(-radius, radius + 1)]
    steps = F.array(*(F.struct(F.lit(o).alias("o"), F.lit(x / sum(weights)).alias("w")) for o, x in zip(range(-radius, radius + 1), weights)))
    own = df.withColumns({"_i": F.row_number().over(over(key, time)) - 1, "_n": F.count("*").over(Window.partitionBy(key))})
    images = F.array(F.col("_i"), -1 - F.col("_i"), 2 * F.col("_n") - 1 - F.col("_i"))
    sent = own.select(key, "_n", F.col(v).alias("_v"), F.explode(images).alias("_at")).select("*", F.explode(steps).alias("_s")).withColumn("_i", F.col("_at") + F.col("_s.o")).where("_i >= 0 and _i < _n")
    sums = sent.groupBy(key, "_i").agg(F.when(F.count("*") == F.count("_v"), F.sum(F.col("_v") * F.col("_s.w"))).alias(name))
    return own.join(sums, [key, "_i"]).drop("_i", "_n")


def drop_outliers_z(df: DataFrame, key: str, time: str, v: str, critical: float = 1.6449) -> DataFrame:
    """Null where a value's z-score is above the critical one (2.3263, 1.6449 or 1.2816 for p of 0.01, 0.05 or 0.1) and it is
    off both neighbours by more than the deviation in the same way, as in drop_outliers."""
    w, all_ = over(key, time), Window.partitionBy(key)
    sd, mean = F.stddev_pop(v).over(all_), F.avg(v).over(all_)
    d = df.withColumns({"_a": F.lag(v).over(w), "_b": F.lead(v).over(w), "_cut": sd, "_z": F.abs(F.try_divide(F.col(v) - mean, sd))})
    off = (F.col(v) < (F.col("_a") + F.col("_b")) / 2 - F.col("_cut")) | (F.col(v) > F.greatest("_a", "_b") + F.col("_cut"))
    return d.withColumn(v, F.when(~F.coalesce((F.col("_z") > critical) & off, F.lit(False)), F.col(v))).drop("_a", "_b", "_cut", "_z")


def _mean_median(df: DataFrame, by: list[str], v: str) -> DataFrame:
    """Mean, median (exact, see quantiles) and number of the values per group."""
    own = df.groupBy(*by).agg(F.avg(v).alias("mean"), F.count(v).alias("n"))
    return with_quantiles(own, df, by, v, [0.5]).select(*by, "mean", F.col("q")[0].alias("median"), "n")


def climatology(df: DataFrame, key: str, ts: str, v: str, unit: str = "month") -> DataFrame:
    """Mean and median per calendar month (week of the year) over all years, dated in the middle year of the table.

    A month is dated by its first day, a week by the Sunday that ends the week of that number, weeks counted from the first Monday.
    """
    years = df.select(F.year(ts).alias("y")).where("y is not null").distinct().agg(F.array_sort(F.collect_list("y")).alias("ys")).select(F.element_at("ys", F.floor(F.size("ys") / 2).cast("int") + 1).alias("_year"))
    number = F.month(ts) if unit == "month" else F.weekofyear(ts)
    out = _mean_median(df.withColumn("number", number), [key, "number"], v).crossJoin(F.broadcast(years))
    first = F.make_date("_year", F.lit(1), F.lit(1))
    monday = F.date_add(first, F.pmod(F.lit(7) - F.weekday(first), F.lit(7)))
    day = F.make_date("_year", "number", F.lit(1)) if unit == "month" else F.date_add(monday, (F.col("number") - 1) * 7 + 6)
    return out.withColumn("step", day).drop("_year", "number")


def year_end(df: DataFrame, key: str, day: str) -> DataFrame:
    """The last date of a series becomes 31 December if it is in December."""
    last = F.col(day) == F.max(day).over(Window.partitionBy(key))
    return df.withColumn(day, F.when(last & (F.month(day) == 12), F.make_date(F.year(day), F.lit(12), F.lit(31))).otherwise(F.col(day)))


def dominant_year(df: DataFrame, key: str, day: str) -> DataFrame:
    """The rows of each series in its year with most dates, the earliest of equals."""
    counts = df.groupBy(key, F.year(day).alias("_y")).agg(F.count("*").alias("_n"))
    top = counts.groupBy(F.col(key).alias("_k")).agg(F.max_by("_y", F.struct("_n", -F.col("_y"))).alias("_top"))
    return df.join(top, (F.col(key) == F.col("_k")) & (F.year(day) == F.col("_top"))).drop("_k", "_top")


def inflections(df: DataFrame, key: str, time: str, v: str) -> DataFrame:
    """Samples where the second derivative changes sign against the sample before; adds both derivatives."""
    d = df.withColumn("first", slope(v, time, over(key, time)))
    d = d.withColumn("second", slope("first", time, over(key, time)))
    return d.withColumn("_before", F.lag("second").over(over(key, time))).where(F.col("_before") * F.col("second") < 0).drop("_before")


def threshold_season(df: DataFrame, key: str, day: str, v: str, share: float, floor: float) -> DataFrame:
    """First and last day above floor + share * (largest value - floor), day numbers of the year and length; null where none is."""
    d = df.withColumn("_over", F.lit(floor) + (F.max(v).over(Window.partitionBy(key)) - floor) * share)
    above = F.when(F.col(v) > F.col("_over"), F.col(day))
    g = d.groupBy(key).agg(F.min(above).alias("start"), F.max(above).alias("end"))
    return g.withColumns({"start_doy": F.dayofyear("start"), "end_doy": F.dayofyear("end"), "length": F.datediff("end", "start")})


def wide_by_date(df: DataFrame, key: str, day: str, v: str, days: list[str], suffix: str = "") -> DataFrame:
    """One column per listed day, values of one day summed. Only for the sink: the long table is the one to work on."""
    g = df.groupBy(key).agg(*(F.sum(F.when(F.col(day) == F.lit(x).cast("date"), F.col(v))).alias(x.replace("-", "_") + suffix) for x in days))
    return g


def slope(v: str, t: str, w: WindowSpec) -> Column:
    """Derivative by time: second-order central differences for uneven steps, one-sided at the ends."""
    va, vb, ta, tb = F.lag(v).over(w), F.lead(v).over(w), F.lag(t).over(w), F.lead(t).over(w)
    ha, hb = F.col(t) - ta, tb - F.col(t)
    mid = (ha * ha * vb + (hb * hb - ha * ha) * F.col(v) - hb * hb * va) / (ha * hb * (ha + hb))
    return F.when(ta.isNull() & tb.isNull(), F.lit(None).cast("double")).when(ta.isNull(), (vb - F.col(v)) / hb).when(tb.isNull(), (F.col(v) - va) / ha).otherwise(mid)


def season(df: DataFrame, key: str, doy: str, v: str, factor: float = 0.5, absolute: float = 0.0) -> DataFrame:
    """One row per series with values at different days: peak, valley, base, amplitude, five starts and ends of season each,
    length, rates and integrals (per sample), and the amplitudes of peak and middle over base and valley. A series without
    values has a row of nulls.

    Peak and valley are the earliest of their value. Base is the mean of the least values on both sides of the peak.
    Slopes are the samples left (right) of the peak where the series rises (falls); a start (end) is the slope sample
    nearest to its target, the earliest of equals. Integrals are trapezoids of step 1 over samples between start and end by
    amplitude; outside of it the series is 0.
    """
    w = over(key, doy)
    d = df.where(F.col(v).isNotNull()).select(key, F.col(doy).cast("double").alias("t"), F.col(v).cast("double").alias("v"))
    w = over(key, "t")
    all_ = Window.partitionBy(key)
    d = d.withColumns({"grad": slope("v", "t", w), "peak": F.max("v").over(all_), "low": F.min("v").over(all_), "last_t": F.max("t").over(all_)})
    d = d.withColumn("peak_t", F.min(F.when(F.col("v") == F.col("peak"), F.col("t"))).over(all_))
    left, right = F.col("t") <= F.col("peak_t"), F.col("t") >= F.col("peak_t")
    d = d.withColumns({"left_low": F.min(F.when(left, F.col("v"))).over(all_), "right_low": F.min(F.when(right, F.col("v"))).over(all_)})
    d = d.withColumn("base", (F.col("left_low") + F.col("right_low")) / 2).withColumn("amplitude", F.col("peak") - F.col("base"))
    up, down = left & (F.col("grad") > 0), right & (F.col("grad") < 0)
    d = d.withColumns({"up_v": F.when(up, F.col("v")), "down_v": F.when(down, F.col("v"))})
    d = d.withColumns({"up_mid": F.percentile("up_v", 0.5).over(all_), "down_mid": F.percentile("down_v", 0.5).over(all_)})
    share = F.col("base") + F.col("amplitude") * factor
    span = F.col("low") + (F.col("peak") - F.col("low")) * factor
    targets = {"first": {"up": F.min("up_v").over(all_), "down": F.min("down_v").over(all_)}, "median": {"up": F.col("up_mid"), "down": F.col("down_mid")}, "amplitude": {"up": share, "down": share}, "absolute": {"up": F.lit(absolute), "down": F.lit(absolute)}, "relative": {"up": span, "down": span}}
    d = d.withColumns({f"{side}_{m}": t[side] for m, t in targets.items() for side in ("up", "down")})
    near = lambda side, m: F.min(F.when(F.col(f"{side}_v").isNotNull(), F.struct(F.round(F.abs(F.col("v") - F.col(f"{side}_{m}")), 9).alias("d"), F.col("t").alias("t"), F.col("v").alias("v"))))
    d = d.withColumns({"sos_t": near("up", "amplitude").over(all_)["t"], "eos_t": near("down", "amplitude").over(all_)["t"]})
    inside = (F.col("t") >= F.col("sos_t")) & (F.col("t") <= F.col("eos_t"))
    d = d.withColumns({"in_v": F.when(inside, F.col("v")).otherwise(0.0), "in_short": F.when(inside, F.col("v") - F.col("base")).otherwise(0.0), "all_short": F.col("v") - F.col("low")})
    trapezoid = lambda c: F.coalesce((F.col(c) + F.lag(c).over(w)) / 2, F.lit(0.0))
    d = d.withColumns({"a_lios": trapezoid("in_v"), "a_sios": trapezoid("in_short"), "a_liot": trapezoid("v"), "a_siot": trapezoid("all_short")})
    aggs = [F.first("peak").alias("peak"), F.first("peak_t").alias("peak_t"), F.first("low").alias("valley"), F.min(F.when(F.col("v") == F.col("low"), F.col("t"))).alias("valley_t"), F.first("base").alias("base"), F.first("amplitude").alias("amplitude"), F.first("last_t").alias("last_t")]
    # middle of season: mean of the values of at least 80 % of the peak on each side, averaged
    high = F.col("v") >= 0.8 * F.col("peak")
    aggs += [((F.avg(F.when(left & high, F.col("v"))) + F.avg(F.when(right & high, F.col("v")))) / 2).alias("middle")]
    aggs += [near("up", m).alias(f"sos_{m}") for m in targets] + [near("down", m).alias(f"eos_{m}") for m in targets]
    aggs += [F.sum(f"a_{n}").alias(n) for n in ("lios", "sios", "liot", "siot")]
    g = d.groupBy(key).agg(*aggs)
    s, e = F.col("sos_amplitude"), F.col("eos_amplitude")
    los = F.when(e["t"] - s["t"] < 0, e["t"] - s["t"] + F.col("last_t")).otherwise(e["t"] - s["t"])
    ends = [F.col(f"{x}_{m}")[p].alias(f"{x}_{m}_{p}") for x in ("sos", "eos") for m in targets for p in ("v", "t")]
    more = [(F.col("peak") - F.col("valley")).alias("peak_valley"), (F.col("middle") - F.col("base")).alias("middle_base"), (F.col("middle") - F.col("valley")).alias("middle_valley")]
    found = g.select(key, "peak", "peak_t", "valley", "valley_t", "base", "middle", "amplitude", *more, *ends, los.alias("length"), F.try_divide(F.col("peak") - s["v"], F.col("peak_t") - s["t"]).alias("rise"), F.abs(F.try_divide(e["v"] - F.col("peak"), e["t"] - F.col("peak_t"))).alias("fall"), "lios", "sios", "liot", "siot")
    return df.select(key).distinct().join(found, key, "left")


def spline_daily(df: DataFrame, key: str, day: str, v: str) -> DataFrame:
    """(key, day, value): a cubic through four neighbours for each inner segment, at days 0 .. length - 2 of it.

    day is a date. Slopes at the two inner points are differences over both segments beside them, in segment units.
    """
    w = over(key, day)
    d = df.select(key, F.col(day).alias("d1"), F.col(v).alias("p1"), F.lag(v).over(w).alias("p0"), F.lead(v).over(w).alias("p2"), F.lead(v, 2).over(w).alias("p3"), F.lag(day).over(w).alias("d0"), F.lead(day).over(w).alias("d2"), F.lead(day, 2).over(w).alias("d3"))
    d = d.where("d0 is not null and d3 is not null").withColumn("n", F.datediff("d2", "d1"))
    before, after = F.datediff("d1", "d0") / F.col("n"), F.datediff("d3", "d2") / F.col("n")
    d = d.withColumns({"m1": (F.col("p2") - F.col("p0")) / (before + 1), "m2": (F.col("p3") - F.col("p1")) / (1 + after)})
    d = d.where("n >= 2").withColumn("k", F.explode(F.expr("sequence(0, n - 2)"))).withColumn("u", F.col("k") / F.col("n"))
    u, p1, p2, m1, m2 = (F.col(c) for c in ("u", "p1", "p2", "m1", "m2"))
    value = p1 + u * (m1 + u * ((3 * (p2 - p1) - 2 * m1 - m2) + u * (2 * (p1 - p2) + m1 + m2)))
    return d.select(key, F.date_add("d1", F.col("k")).alias(day), value.alias("value"))


def detrend(df: DataFrame, key: str, time: str, v: str) -> DataFrame:
    """Values less their line over the position in the series, nulls left out of the fit."""
    pos = df.withColumn("_i", (F.row_number().over(over(key, time)) - 1).cast("double"))
    all_ = Window.partitionBy(key)
    return pos.withColumns({"_s": F.regr_slope(v, "_i").over(all_), "_c": F.regr_intercept(v, "_i").over(all_)}).withColumn("detrended", F.col(v) - F.col("_c") - F.col("_s") * F.col("_i")).drop("_i", "_s", "_c")


def harmonic_sums(df: DataFrame, key: str, years: str, v: str, frequencies: int = 2) -> tuple[DataFrame, list[str]]:
    """(key, xx, xy) and the names of the terms: sums of products of constant, time and cosine and sine pairs with each other and with v."""
    terms = {"one": F.lit(1.0), "t": F.col(years)}
    for k in range(1, frequencies + 1):
        terms |= {f"cos{k}": F.cos(2 * np.pi * k * F.col(years)), f"sin{k}": F.sin(2 * np.pi * k * F.col(years))}
    names = list(terms)
    d = df.where(F.col(v).isNotNull() & F.col(years).isNotNull()).select(key, F.col(v).alias("_v"), *(c.alias(n) for n, c in terms.items()))
    return d.groupBy(key).agg(F.array(*(F.sum(F.col(a) * F.col(b)) for a in names for b in names)).alias("xx"), F.array(*(F.sum(F.col(a) * F.col("_v")) for a in names)).alias("xy")), names


def amplitude_phase(cosine: Column, sine: Column) -> tuple[Column, Column]:
    """Amplitude and phase of a pair of coefficients; the phase has the cosine first."""
    return F.hypot(cosine, sine), F.atan2(cosine, sine)


def harmonic_fit(df: DataFrame, key: str, years: str, v: str, frequencies: int = 2) -> DataFrame:
    """Least squares of constant, time and cosine and sine pairs per series, with amplitude and phase.

    Sums of products are one aggregation; only the small systems are solved in Python.
    """
    ship(df.sparkSession)
    sums, names = harmonic_sums(df, key, years, v, frequencies)
    p = len(names)

    @F.pandas_udf("array<double>")
    def solve(xx: pd.Series, xy: pd.Series) -> pd.Series:
        return pd.Series([np.linalg.lstsq(np.reshape(a, (p, p)), np.asarray(b), rcond=None)[0] for a, b in zip(xx, xy)])

    s = sums.withColumn("_b", solve("xx", "xy")).select(key, *(F.col("_b")[k].alias(n) for k, n in enumerate(names)))
    pairs = {k: amplitude_phase(F.col(f"cos{k}"), F.col(f"sin{k}")) for k in range(1, frequencies + 1)}
    return s.withColumns({f"amplitude{k}": a for k, (a, _) in pairs.items()} | {f"phase{k}": b for k, (_, b) in pairs.items()})


def num_seasons(df: DataFrame, key: str, time: str, v: str) -> DataFrame:
    """Number of peaks per series: local maxima of at least the 75th percentile, the highest first, at least a quarter of the
    series apart."""
    w, all_ = over(key, time), Window.partitionBy(key)
    d = df.where(F.col(v).isNotNull()).select(key, F.col(v).alias("v"), (F.row_number().over(w) - 1).alias("i"), F.count("*").over(all_).alias("n"), F.lag(v).over(w).alias("a"), F.lead(v).over(w).alias("b"), F.percentile(v, 0.75).over(all_).alias("q"))
    peak = (F.col("v") >= F.col("q")) & (F.col("v") > F.col("a")) & (F.col("v") > F.col("b"))
    peaks = d.groupBy(key).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.when(peak, F.struct((-F.col("v")).alias("low"), "i")))).alias("p"))
    gap = F.ceil(F.col("n") / 4)
    apart = lambda kept, p: F.forall(kept, lambda k: F.abs(p["i"] - k) >= gap)
    kept = F.aggregate("p", F.array().cast("array<int>"), lambda kept, p: F.when(apart(kept, p), F.array_append(kept, p["i"])).otherwise(kept), F.size)
    return peaks.select(key, kept.alias("seasons"))


def resample_days(df: DataFrame, key: str, ts: str, v: str, days: int = 14) -> DataFrame:
    """Mean and median per step of so many days, counted from the Monday of the table's first week."""
    start = df.agg(F.date_trunc("week", F.min(ts)).cast("date").alias("_start"))
    d = df.crossJoin(F.broadcast(start)).withColumn("step", F.expr(f"date_add(_start, cast(floor(datediff(`{ts}`, _start) / {days}) as int) * {days})"))
    return _mean_median(d, [key, "step"], v)


def resample(df: DataFrame, key: str, ts: str, v: str, unit: str) -> DataFrame:
    """Mean and median per calendar unit."""
    return _mean_median(df.withColumn("step", F.date_trunc(unit, ts)), [key, "step"], v)
