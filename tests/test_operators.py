"""Operators against brute force on small random tables, and what they refuse."""

import datetime
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverspark import schemas, session
from coverspark.functions import bands, dates, numbers, text
from coverspark.operators import cover, lists, match, model, series, spatial, stats
from coverspark.plans.queries import QUERIES, SQL
from coverspark.sources import files
from tests.oracle import differences

DIR = "/root/testdata/sf0.001"


def test_descriptor_rows_and_sheets(spark, tmp_path):
    (tmp_path / "a.csv").write_text("site,cover\ntext,percent\nx,1\ny,2\n")
    (tmp_path / "b.csv").write_text("site,cover\nname,share\ntext,percent\nz,-9\n")
    path = str(tmp_path / "*.csv")
    left = files.without_first_rows(files.read_delimited(spark, path), path)
    assert sorted((r.site, r.cover) for r in left.collect()) == [("text", "percent"), ("x", "1"), ("y", "2"), ("z", None)]
    (tmp_path / "s.txt").write_text("D ,Salix\nE,Picea\n")
    sheet = files.read_named(spark, str(tmp_path / "s.txt"), ["leaf", "name"], {"name": "retention_name"}, {"leaf": {"D": "deciduous"}}, header=False)
    assert sheet.columns == ["leaf", "retention_name"] and sorted(r.leaf for r in sheet.collect()) == ["E", "deciduous"]
    assert files.dataset_name(F.lit("p/AB_fcover.csv"), "_fcover.csv") is not None
    names = spark.createDataFrame([("in/AB_fcover.csv", "TOOL", 2019), ("CD_fcover.csv", "BARR", 2016)], "f string, site string, year int")
    assert [r[0] for r in names.select(files.dataset_name(F.col("f"), "_fcover.csv")).collect()] == ["AB", "CD"]
    assert files.output_label(names, "site", "year").first().label == "BARR-TOOL_2016-2019"


def test_schemas_and_export(spark, tmp_path):
    good = spark.createDataFrame([("u123456789", "Salix", "shrub", "1.5"), ("u123456789", "Carex", "sedge", "x")], "visit_id string, dataset_species_name string, standard_habit string, fcover string")
    own = schemas.conform(good, "species_fcover")
    assert own.columns == schemas.SCHEMAS["species_fcover"].names and sorted((r.fcover or 0) for r in own.collect()) == [0, 1.5]
    files.export(good, "species_fcover", str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    with pytest.raises(ValueError):
        files.export(good, "pft_fcover", str(tmp_path / "twice"))
    found = schemas.violations(good.withColumn("standard_habit", F.lit(None).cast("string")), "species_fcover")
    assert {(r.rule, r.detail) for r in found.collect()} == {("schema", "missing <> string"), ("schema", "string <> double"), ("not null", "standard_habit")}
    wide = spark.createDataFrame([("[1, 2]", "x", None)], "fire_years string, `fire_years.0` string, duplicated_date string")
    lists_ = schemas.list_columns(wide, ["fire_years", "duplicated_date"])
    assert lists_.columns == ["fire_years", "duplicated_date"] and tuple(lists_.first()) == (["1", "2"], [])
    p = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert [tuple(r) for r in schemas.same_columns(p.select("a", "c", "b"), p).collect()] == [(1, "c", "b"), (2, "b", "c")]
    assert schemas.same_columns(p, p).count() == 0
    assert set(schemas.SCHEMAS) >= {"pft_aux", "synthesized_aux", "species_pft_checklist"} and len(schemas.SCHEMAS["pft_fcover"]) == 14


def test_ids_and_order_that_do_not_fit(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "u1"), (1, "u2"), (2, "u3")], "k int, uid string")
    with pytest.raises(Exception, match="mapped twice"):
        lists.replace_id(df, twice, "k", "uid", unique=True).collect()
    order = spark.createDataFrame([(2, 0), (1, 1), (3, 2)], "k int, ord long")
    with pytest.raises(Exception, match="no row for key 3"):
        lists.with_order(df, order, "k").collect()
    assert [(r.k, r.v) for r in lists.with_order(df, order, "k", "null").orderBy("ord").collect()] == [(2, "b"), (1, "a"), (3, None)]
    assert lists.with_order(df, order, "k", "drop").count() == 2


def test_p_values(spark):
    # published critical values of Student's t, two-sided
    df = spark.createDataFrame([(3, 12.706), (12, 2.228), (32, 2.042), (102, 2.626), (2, 1.0)], "n long, t double")
    got = [r.p for r in stats.with_p_value(df).orderBy("n").collect()]
    assert got[0] is None and np.allclose(got[1:], [0.05, 0.05, 0.05, 0.01], atol=2e-4)


def test_partial_ratio_is_the_best_window():
    rng = np.random.default_rng(0)

    def common(a, b):
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        return t[-1, -1]

    for _ in range(200):
        a, b = ("".join(rng.choice(list("abcé "), rng.integers(1, n))) for n in (8, 14))
        a, b = sorted((a, b), key=len)
        want = min(2 * (len(a) - common(a, b[k : k + len(a)])) for k in range(len(b) - len(a) + 1))
        assert match.least_edits(a, b) == want


def test_best_window_with_cut_ends():
    rng = np.random.default_rng(4)

    def common(a, b):
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        return t[-1, -1]

    def windows(a, b):
        full = [b[k : k + len(a)] for k in range(len(b) - len(a) + 1)]
        return full + [b[:k] for k in range(1, len(a))] + [b[-k:] for k in range(1, len(a))]

    cut_off = 0
    for _ in range(300):
        a, b = sorted(("".join(rng.choice(list("abcé "), rng.integers(1, n))) for n in (8, 12)), key=len)
        tried = [(a, w) for w in windows(a, b)] + ([(b, w) for w in windows(b, a)] if len(a) == len(b) else [])
        want = max(200 * common(x, w) / (len(x) + len(w)) for x, w in tried)
        assert match.best_window(a, b) == pytest.approx(want) == match.best_window(b, a)
        cut_off += want > 100 * (1 - match.least_edits(a, b) / (2 * len(a)))
    assert cut_off > 10 and match.best_window("", "") == 100 and match.best_window("", "a") == 0


def test_match_audit(spark):
    checklist = spark.createDataFrame([(f"Salix alb{c}", f"acc {c}") for c in "abcdefg"] + [("Salix alba var. nova", "acc v"), ("Salix", "acc genus")], "checklist_name string, accepted_name string")
    names = spark.createDataFrame([("Salix alba",), ("Salix albz",), ("Salix quite different",), ("Poa annua",)], "name string")
    for score in (None, match.partial_score(F.col("key"), F.col("candidate"))):
        got = {r.name: r for r in match.fuzzy_cascade(names, checklist, score=score).collect()}
        assert (got["Salix alba"].accepted_name, got["Salix alba"].rank_match, got["Salix alba"].audit) == ("acc a", True, [])
        audit = got["Salix albz"].audit
        assert got["Salix albz"].accepted_name == "acc a" and [a.accepted_name for a in audit] == [f"acc {c}" for c in "abcde"] and {a.score for a in audit} == {got["Salix albz"].score}
        assert (got["Poa annua"].accepted_name, got["Poa annua"].rank_match, got["Poa annua"].audit) == (None, False, [])
        assert {a["rank"] for a in got["Salix quite different"].audit} >= {"variety", "species"}


def test_rank_cascade(spark):
    checklist = spark.createDataFrame([("Salix alba L.", "Salix alba"), ("Salix alba var. nova", "Salix alba var. nova"), ("Salix alba ssp. nova", "Salix alba ssp. nova"), ("Carex", "Carex")], "checklist_name string, accepted_name string")
    names = spark.createDataFrame([("Salix alba var. nova",), ("Salix albb",), ("Carex sp.",), ("Carex bigelowii",), ("Poa annua",), ("Salix alba ssp. novo",)], "name string")
    got = {r.name: (r.accepted_name, r["rank"]) for r in match.fuzzy_cascade(names, checklist).collect()}
    assert got["Salix alba var. nova"] == ("Salix alba var. nova", "variety") and got["Salix albb"] == ("Salix alba", "species")
    assert got["Poa annua"] == (None, None) and got["Salix alba ssp. novo"][1] == "subspecies"


def test_nearest_and_widest(spark):
    rng = np.random.default_rng(1)
    p, f = rng.uniform(-50, 50, (300, 2)), rng.uniform(-20, 400, (40, 2))
    points = spark.createDataFrame([(k, *map(float, x)) for k, x in enumerate(p)], "id long, x double, y double")
    features = spark.createDataFrame([(k, *map(float, x)) for k, x in enumerate(f)], "code int, fx double, fy double")
    want = np.hypot(p[:, None, 0] - f[None, :, 0], p[:, None, 1] - f[None, :, 1]).argmin(1)
    assert {r.id: r.nearest for r in spatial.nearest(points, features, 3.0).collect()} == dict(enumerate(want))
    assert {r.nearest for r in spatial.nearest(points, features.limit(0), 3.0).collect()} == {None}
    g = spark.createDataFrame([(k % 3, *map(float, x)) for k, x in enumerate(p)] + [(7, 1.0, 1.0)], "g int, x double, y double")
    got = {r.g: r.width for r in spatial.widest(g.repartition(5), "g").collect()}
    for k in range(3):
        own = p[k::3]
        assert abs(got[k] - np.hypot(own[:, None, 0] - own[None, :, 0], own[:, None, 1] - own[None, :, 1]).max()) < 1e-9
    assert got[7] == 0.0


def test_rings_of_polygons(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]
    polygons = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in ring]), (2, [{"x": x + 1, "y": y} for x, y in ring])], "code int, ring array<struct<x: double, y: double>>")
    points = spark.createDataFrame([(1.5, 1.0), (0.5, 3.0), (2.0, 3.0), (4.8, 3.5), (9.0, 9.0)], "x double, y double")
    got = sorted((r.x, r.code) for r in spatial.ring_join(points, polygons, 0.7).collect())
    assert got == [(0.5, 1), (1.5, 1), (1.5, 2), (4.8, 2)]
    assert spatial.ring_join(points, polygons, 0.7, "left_anti").count() == 2


def test_gaussian_and_seasons(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=40)
    df = spark.createDataFrame([(1, k, float(x)) for k, x in enumerate(v)], "id int, t int, v double")
    w = np.exp(-0.5 * (np.arange(-6, 7) / 1.5) ** 2)
    want = np.convolve(np.r_[v[5::-1], v, v[:-7:-1]], w / w.sum(), "valid")
    got = [r.smoothed for r in series.smooth_gaussian(df, "id", "t", "v", 1.5).orderBy("t").collect()]
    assert np.allclose(got, want)
    rows = [(i, k, float(x)) for i in range(20) for k, x in enumerate(rng.normal(size=30).cumsum())]
    got = {r.id: r.seasons for r in series.num_seasons(spark.createDataFrame(rows, "id int, t int, v double"), "id", "t", "v").collect()}
    for i in range(20):
        x = np.array([r[2] for r in rows if r[0] == i])
        peaks = [k for k in range(1, 29) if x[k] > x[k - 1] and x[k] > x[k + 1] and x[k] >= np.quantile(x, 0.75)]
        kept: list[int] = []
        for k in sorted(peaks, key=lambda k: (-x[k], k)):
            if all(abs(k - j) >= 8 for j in kept):
                kept.append(k)
        assert got[i] == len(kept)


def test_harmonic_fit_finds_its_terms(spark):
    t = np.arange(400) / 73.0
    v = 3 + 0.5 * t + 2 * np.cos(2 * np.pi * t) - np.sin(2 * np.pi * t) + 0.3 * np.sin(4 * np.pi * t)
    df = spark.createDataFrame([(1, float(a), float(b)) for a, b in zip(t, v)], "id int, years double, v double")
    r = series.harmonic_fit(df, "id", "years", "v").first()
    assert np.allclose([r.one, r.t, r.cos1, r.sin1, r.cos2, r.sin2], [3, 0.5, 2, -1, 0, 0.3], atol=1e-6)
    assert abs(r.amplitude1 - math.hypot(2, 1)) < 1e-6 and abs(r.phase1 - math.atan2(2, -1)) < 1e-6


def test_forests_learn_what_there_is(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(size=(600, 3))
    df = spark.createDataFrame([(k, *map(float, r), float(5 * r[0] + (r[1] > 0.5) + 0.05 * rng.normal()), f"s{k % 3}") for k, r in enumerate(x)], "id int, a double, b double, c double, y double, source string")
    f = ["a", "b", "c"]
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    fitted = model.forest(train, f, "y", trees=30, depth=8, per_split="3")
    assert stats.agreement(model.score(fitted, test, f).withColumn("g", F.lit(1)), "g", "prediction", "y").first().r2 > 0.9
    loss = {r.feature: r.mean for r in model.permutation_importance(fitted, test, f, "y", repeats=2).collect()}
    assert loss["a"] > loss["b"] > loss["c"] and abs(loss["c"]) < 0.05
    order = spark.createDataFrame([("s0", 1), ("s1", 2), ("s2", 3)], "source string, place long")
    fits = {(r.name, r.fit): r.r2 for r in model.cumulative_fits({"all": train}, order, "source", f, "y", test, trees=10, depth=6, per_split="3").collect()}
    assert len(fits) == 3 and min(fits.values()) > 0.8
    kinds = df.withColumn("kind", F.when(F.col("b") > 0.5, "x").otherwise("z"))
    got = model.boosted_importance(kinds, ["a", "c"], "y", rounds=5, depth=3, categories=["kind"])
    assert got["a"] > got["kind"] > got["c"]
    board = model.leaderboard(train, test, f, "y", [{"trees": 5, "depth": 1, "per_split": "3"}, {"trees": 20, "depth": 8, "per_split": "3"}]).collect()
    assert {r.setting: r["rank"] for r in board} == {1: 1, 0: 2}


def test_dates_codes_and_bands(spark):
    df = spark.createDataFrame([("05.08.218",), (" 1.2.2020 ",), (None,)], "s string")
    assert [r[0] for r in df.select(dates.corrected_date_text(F.col("s"))).collect()] == ["05.08.2018", "1.2.2020", None]
    steps = spark.range(1).select(dates.month_steps(F.lit(datetime.date(2020, 1, 15)), F.lit(datetime.date(2020, 5, 1)), 2)).first()[0]
    assert [(s["from"], s["to"]) for s in steps] == [(datetime.date(2020, m, 1), e) for m, e in ((1, datetime.date(2020, 2, 29)), (3, datetime.date(2020, 4, 30)), (5, datetime.date(2020, 6, 30)))]
    one = spark.range(1)
    assert one.select(numbers.label_of(F.lit(9), numbers.ZONES)).first()[0] is None and one.select(numbers.height(F.lit(0.0))).first()[0] == 276.53
    assert one.select(bands.band_difference(F.lit(3.0), F.lit(0.0))["ratio"]).first()[0] is None
    assert one.select(text.subsource_of_site(F.lit("D18_BARR"))).first()[0].startswith("Utqiagvik")
    twin = spark.createDataFrame([(None, "a"), ("b", "c")], "`HABITAT TYPE` string, `HABITAT TYPE ` string")
    assert [tuple(r) for r in cover.merge_twins(twin, text.TWIN_COLUMNS).collect()] == [("a",), ("b",)]


def test_rows_in_order(spark):
    df = spark.createDataFrame([(k * 37 % 101,) for k in range(101)], "k int").repartition(6)
    assert sorted((r.place, r.k) for r in lists.ordered_rows(df, "k").collect()) == [(k, k) for k in range(101)]
    assert sorted(r.k for r in lists.ordered_rows(df, "k", skip=2, most=3).collect()) == [2, 3, 4]


def _dealt_rows(df):
    """Rows of each task after the last shuffle of df's plan."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_tables_of_known_size_are_dealt_by_it(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    layers = {n: spark.range(3000).selectExpr("id % 1500 AS x", "id % 1500 % 7 AS y", f"id * {k} AS {n}") for k, n in enumerate(("a", "b"), 1)}
    got = lists.aligned(layers, ["x", "y"], rows=6000)
    assert len(_dealt_rows(got)) > 40 and max(_dealt_rows(got)) < 100
    assert {r.x: (r.y, r.a, r.b) for r in got.collect()} == {x: (x % 7, x + 1500, 2 * x + 3000) for x in range(1500)}
    assert session.dealt(layers["a"], ["x"], 400) is layers["a"]


def _shuffles(df):
    """Numbers of tasks that rows of df's plan are dealt over by a key."""
    return [int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())]


@pytest.mark.parametrize("name", ["pft_pivot", "first_nonnull", "nonvascular_sum", "same_name_sum", "pft_sum", "pft_sum_zero_filled"])
def test_covers_are_dealt_by_their_number(spark, monkeypatch, name):
    small = QUERIES[name](spark, DIR)
    want = Counter(tuple(r) for r in small.collect())
    assert max(_shuffles(small), default=0) <= 4
    monkeypatch.setattr(session, "TASK_ROWS", 200)  # of some 6,000 covers
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = QUERIES[name](spark, DIR)
        # both joins and the sums by visit after them; what is left by part is dealt as the session has it
        assert [n for n in _shuffles(got) if n > 4] == [30] * 4 and len(_shuffles(got)) == (5 if name == "first_nonnull" else 4)
        assert Counter(tuple(r) for r in got.collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_places_of_scored_units_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 200)  # of two types of 6,000 pixels
    got = QUERIES["scored_units"](spark, DIR)
    assert 60 in _shuffles(got) and differences(got, SQL["scored_units"], DIR) == []
