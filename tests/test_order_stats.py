"""Quantiles and ranks that no task holds a group for, against numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverspark.operators import stats
from coverspark.operators.order_stats import nearest_rows, previous_in_group, quantiles, value_ranks

SHARES = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def brute(values):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    return [None] * len(SHARES) if not v else [float(np.quantile(v, p)) for p in SHARES]


def groups():
    rng = np.random.default_rng(1)
    out = {
        "even": rng.random(3000), "ties": rng.integers(0, 4, 3000), "two": np.repeat([1.0, 5.0], 1500), "one": np.full(2000, 7.5), "wide": rng.normal(size=3000) * 10.0 ** rng.integers(-200, 200, 3000),
        "ends": np.r_[np.full(1500, -3.0), rng.random(40), np.full(1500, 9.0)], "few": [3.0, None, float("nan"), 1.0], "single": [4.0], "none": [None, float("nan")], None: rng.normal(size=500),
    }
    return {k: [None if x is None else float(x) for x in v] for k, v in out.items()}


@pytest.mark.parametrize("few", [1, 10, 10_000])
def test_quantiles(spark, few):
    rows = [(k, x) for k, v in groups().items() for x in v]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {r.k: r.q for r in quantiles(df, ["k"], "v", SHARES, few=few).collect()}
    assert got.keys() == groups().keys()
    for k, v in groups().items():
        assert got[k] == [None if w is None else pytest.approx(w, rel=1e-12, abs=1e-300) for w in brute(v)], k
    whole = quantiles(df.where("k in ('even', 'ties')"), [], "v", SHARES, few=few).collect()
    assert len(whole) == 1 and whole[0].q == pytest.approx(brute(groups()["even"] + groups()["ties"]), rel=1e-12)


def test_quantiles_of_no_rows(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert quantiles(df, ["k"], "v", [0.5]).count() == 0
    assert [r.q for r in quantiles(df, [], "v", [0.5]).collect()] == []
    assert [r.q for r in quantiles(spark.createDataFrame([(None,)], "v double"), [], "v", [0.5]).collect()] == [[None]]


def test_quantiles_of_one_group_of_all_rows(spark):
    """No buffer grows with the group: what is sorted at the end is `few` values, and no plan has an exact percentile."""
    df = spark.range(400_000).select(F.lit(1).alias("k"), F.hash("id").cast("double").alias("v"))
    found = quantiles(df, ["k"], "v", [0.25, 0.5, 0.75], few=50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert " percentile(" not in plan and "collect_list" not in plan
    v = np.array([r.v for r in df.select("v").collect()])
    assert found.first().q == np.quantile(v, [0.25, 0.5, 0.75]).tolist()


def test_value_ranks(spark):
    rng = np.random.default_rng(2)
    rows = [(int(k), None if x == 7 else float(x)) for k, x in zip(rng.integers(0, 3, 4000), rng.integers(0, 300, 4000) ** 2 % 97)] + [(None, 1.0)] * 3 + [(9, 5.0)] * 700
    df = spark.createDataFrame(rows, "k int, v double").repartition(5)
    got = {(r.k, r.v): (r.n, r.rank) for r in value_ranks(df, ["k"], "v").collect()}
    for k in {k for k, _ in rows}:
        own = sorted((x for j, x in rows if j == k), key=lambda x: (x is not None, x or 0))
        for x in set(own):
            places = [i + 1 for i, y in enumerate(own) if y == x]
            assert got.pop((k, x)) == (len(places), sum(places) / len(places))
    assert not got
    assert value_ranks(df.limit(0), ["k"], "v").count() == 0


def test_spearman(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), float(x), float(x * s + y)) for k, x, y, s in zip(rng.integers(0, 3, 3000), rng.integers(0, 20, 3000), rng.integers(0, 30, 3000), rng.choice([-1, 1], 3000))]
    df = spark.createDataFrame([*rows, (0, None, 1.0), (1, 1.0, None), (5, 1.0, 1.0), (6, 2.0, 1.0), (6, 2.0, 3.0)], "k int, x double, y double")
    got = {r.k: (r.n, r.rho) for r in stats.spearman(df, "k", "x", "y").collect()}
    rank = lambda a: np.array([(a < v).sum() + ((a == v).sum() + 1) / 2 for v in a])
    for k in range(3):
        x, y = (np.array([r[c] for r in rows if r[0] == k]) for c in (1, 2))
        assert got[k] == (len(x), pytest.approx(np.corrcoef(rank(x), rank(y))[0, 1], abs=1e-12))
    assert got[5] == (1, None) and got[6] == (2, None)
    assert " rank(" not in stats.spearman(df, "k", "x", "y")._jdf.queryExecution().optimizedPlan().toString()
    same = stats.spearman(df.where("k < 3"), "k", "x", "x").collect()
    assert [r.rho for r in same] == pytest.approx([1.0] * 3)


def test_previous_in_group(spark):
    rows = [(k % 3 if k % 10 else None, k * 7919 % 5000) for k in range(5000)] + [(9, k) for k in range(6000, 8000)]
    df = spark.createDataFrame(rows, "k int, ord int").repartition(7)
    got = {(r.k, r.ord): (r.previous, r.first) for r in previous_in_group(df, ["k"], "ord").collect()}
    for k in {k for k, _ in rows}:
        own = sorted(o for j, o in rows if j == k)
        assert [got.pop((k, o)) for o in own] == [(p, own[0]) for p in [None, *own[:-1]]]
    assert not got


def test_nearest_rows(spark):
    """Places rounded half to even, over ties, nulls and a group that holds nearly all rows."""
    rng = np.random.default_rng(4)
    rows = [("hot", float(x), int(t)) for x, t in zip(rng.integers(0, 40, 5000), rng.integers(0, 9, 5000))] + [(None, 2.0, None), (None, 2.0, 1), ("one", 3.0, 4), ("null", None, 1), ("hot", None, 0)]
    df = spark.createDataFrame(rows, "k string, v double, t int").repartition(6)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = nearest_rows(df, ["k"], ["v", "t"], shares)
    assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r.k: [(x.v, x.t) for x in r.q] for r in found.collect()}
    for k in ("hot", None, "one"):
        own = sorted(((v, t) for j, v, t in rows if j == k and v is not None), key=lambda x: (x[0], x[1] is not None, x[1] or 0))
        assert got.pop(k) == [own[round((len(own) - 1) * p)] for p in shares]
    assert not got
    assert nearest_rows(df.limit(0), ["k"], ["v"], [0.5]).count() == 0


def test_small_and_large_groups_together(spark):
    """Groups of few values are sorted as lists, larger ones searched; without values a group has nulls in either case."""
    rows = [("large", float(x * 37 % 501)) for x in range(501)] + [("small", float(x)) for x in range(20)] + [("none", None), (None, 1.0), ("nan", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: r.q for r in quantiles(df, ["k"], "v", [0.25, 0.5], few=20).collect()}
    assert got == {"large": [125.0, 250.0], "small": [4.75, 9.5], "none": [None, None], "nan": [None, None], None: [1.0, 1.0]}
