"""Summaries: box plots, zones, histograms, correlations, deciles and ranks."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverspark.operators.order_stats import quantiles, value_ranks, with_quantiles
from coverspark.session import cut, ship


def box_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Quartiles, mean and whiskers (the extreme values within 1.5 quartile ranges) per group; quartiles are exact, see quantiles."""
    q = quantiles(df, [key], value, [0.25, 0.5, 0.75]).select(F.col(key).alias("_k"), *(F.col("q")[k].alias(n) for k, n in enumerate(("q1", "median", "q3"))))
    near = (F.col(value) >= F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) & (F.col(value) <= F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    joined = df.join(cut(q), F.col(key) == F.col("_k"))
    return joined.groupBy(key, "q1", "median", "q3").agg(F.avg(value).alias("mean"), F.min(F.when(near, F.col(value))).alias("low"), F.max(F.when(near, F.col(value))).alias("high"))


def zonal(df: DataFrame, zone: str, value: str) -> DataFrame:
    """Count, extremes, mean, population deviation, sum and quantiles per zone; quantiles are exact, see quantiles."""
    v = F.col(value)
    own = df.groupBy(zone).agg(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("sd"), F.sum(v).alias("total"))
    return with_quantiles(own, df, [zone], value, [0.25, 0.5, 0.75, 0.9]).select(zone, "n", "low", "high", "mean", "sd", "total", *(F.col("q")[k].alias(n) for k, n in enumerate(("q1", "median", "q3", "p90"))))


def zone_type_grid(df: DataFrame, zone: str, kind: str, value: str) -> DataFrame:
    """Mean for every zone and type, null where there is none; zones without any value are left out."""
    stats = df.groupBy(zone, kind).agg(F.avg(value).alias("mean"))
    zones = stats.where("mean is not null").select(zone).distinct()
    return zones.crossJoin(stats.select(kind).distinct()).join(stats, [zone, kind], "left")


def histogram(df: DataFrame, value: str, width: float) -> DataFrame:
    """(bin, n) of non-zero values from the least on; a value on the last edge is in the last bin."""
    v = df.where(F.col(value) != 0).select(F.col(value).alias("v"))
    ends = v.agg(F.min("v").alias("a"), F.max("v").alias("b"))
    last = F.greatest(F.ceil((F.col("b") - F.col("a")) / width) - 1, F.lit(0))
    return v.crossJoin(F.broadcast(ends)).select(F.least(F.floor((F.col("v") - F.col("a")) / width), last).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


def pearson(df: DataFrame, by: str, x: str, y: str) -> DataFrame:
    """n, r and t of the pairs without nulls, per group."""
    ok = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    out = ok.groupBy(by).agg(F.count("*").alias("n"), F.corr(x, y).alias("r"))
    return out.withColumn("t", F.try_divide(F.col("r") * F.sqrt(F.col("n") - 2.0), F.sqrt(F.greatest(1 - F.col("r") * F.col("r"), F.lit(0.0)))))


def with_p_value(df: DataFrame, n: str = "n", t: str = "t") -> DataFrame:
    """Add `p`, two-sided, of Student's t with n - 2 degrees of freedom: a continued fraction on Arrow batches, one row per group."""
    ship(df.sparkSession)

    @F.pandas_udf("double")
    def two_sided(n: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(b) or a <= 2 else incomplete_beta((a - 2) / 2, 0.5, (a - 2) / (a - 2 + b * b)) for a, b in zip(n, t)], dtype="float64")

    return df.withColumn("p", two_sided(n, t))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction (even and odd steps) from the side that converges."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    value = 1.0
    for k in range(200, 0, -1):  # from the innermost term outwards
        m = k // 2
        term = m * (b - m) * x / ((a + k - 1) * (a + k)) if k % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + k - 1) * (a + k))
        value = 1 + term / value
    return front / value


def spearman(df: DataFrame, by: str, x: str, y: str) -> DataFrame:
    """n and the rank correlation of the pairs without nulls, per group; ties have average ranks.

    Equal pairs are counted first and weigh by their number; ranks come from value_ranks, so no group is sorted in one task.
    Ranks have a mean of (n + 1) / 2, which makes the sums of one pass exact enough at any size.
    """
    ok = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = cut(ok.groupBy(F.col(by).alias("_k"), F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.count("*").alias("_m")))
    n = pairs.groupBy(F.col("_k").alias("_by")).agg(F.sum("_m").alias("n"))
    joined = pairs
    for c, r in (("_x", "_rx"), ("_y", "_ry")):
        own = value_ranks(pairs, ["_k"], c, r, "_n", "_m").select(F.col("_k").alias(f"_k{r}"), F.col(c).alias(f"_v{r}"), r)
        joined = joined.join(own, F.col("_k").eqNullSafe(F.col(f"_k{r}")) & (F.col(c) == F.col(f"_v{r}"))).drop(f"_k{r}", f"_v{r}")
    both = joined.join(n, F.col("_k").eqNullSafe(F.col("_by"))).withColumn(by, F.col("_k"))
    dx, dy = (F.col(r) - (F.col("n") + 1) / 2 for r in ("_rx", "_ry"))
    total = lambda c: F.sum(F.col("_m") * c)
    return both.groupBy(by, "n").agg(F.try_divide(total(dx * dy), F.sqrt(total(dx * dx) * total(dy * dy))).alias("rho"))


def agreement(df: DataFrame, by: str, predicted: str, observed: str) -> DataFrame:
    """n, squared correlation, root mean square error and mean absolute error of the pairs without nulls."""
    p, o = F.col(predicted), F.col(observed)
    return df.where(p.isNotNull() & o.isNotNull()).groupBy(by).agg(F.count("*").alias("n"), F.pow(F.corr(p, o), 2).alias("r2"), F.sqrt(F.avg((p - o) * (p - o))).alias("rmse"), F.avg(F.abs(p - o)).alias("mae"))


def moments(df: DataFrame, by: str, value: str) -> DataFrame:
    """Extremes, median, mean, sample deviation and bias-corrected skewness and excess kurtosis, per group."""
    v = F.col(value)
    a = df.groupBy(by).agg(F.count(v).cast("double").alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.skewness(v).alias("g1"), F.kurtosis(v).alias("g2"))
    a = with_quantiles(a, df, [by], value, [0.5]).withColumn("median", F.col("q")[0])
    n = F.col("n")
    skew = F.when(n > 2, F.try_divide(F.col("g1") * F.sqrt(n * (n - 1)), n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    return a.select(by, "low", "high", "median", "mean", "sd", skew.alias("skew"), kurt.alias("kurtosis"))


def quartile_flags(df: DataFrame, value: str, factor: float) -> DataFrame:
    """Add `below` (under the first quartile) and `refined` (under the third plus factor ranges), over the whole table; see quantiles."""
    j = df.crossJoin(F.broadcast(quantiles(df, [], value, [0.25, 0.75], "_q")))  # one row
    v, q1, q3 = F.col(value), F.col("_q")[0], F.col("_q")[1]
    return j.withColumns({"below": v < q1, "refined": v < q3 + factor * (q3 - q1)}).drop("_q")


def rank_max(value: str, by: list[str]) -> Column:
    """Descending rank in which ties take the largest."""
    w = Window.partitionBy(*by).orderBy(F.desc(value))
    return F.count("*").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))


def seeded_half(df: DataFrame, key: str, seed: str) -> DataFrame:
    """Half of the rows (rounded down), the first by MD5 of seed and key.

    The cut is found on the count and a quantile of the order, so no task sorts the whole table.
    """
    h = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary"))
    keyed = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, 3))
    per = keyed.groupBy("_b").agg(F.count("*").alias("_n"))
    before = per.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_b").orderBy("_h"))
    return keyed.join(before, "_b").withColumn("_p", place).where(F.col("_p") <= F.floor(F.col("_all") / 2)).drop("_h", "_b", "_before", "_all", "_p")
