"""Searches and sinks that go on where they stopped, permutations, files read by their heads and by place."""

from __future__ import annotations

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverspark import session
from coverspark.operators import model as M
from coverspark.plans.series_queries import SETTINGS
from coverspark.sources import files

GRID = [{"trees": t, "depth": h, "per_split": "2"} for t in (2, 4) for h in (2, 5)]


def training(spark, n=400):
    rng = np.random.default_rng(1)
    a, b, c = rng.random((3, n))
    return spark.createDataFrame([(float(x), float(y), float(z), float(3 * x + y * y)) for x, y, z in zip(a, b, c)], "a double, b double, c double, y double")


def test_units_go_on_where_they_stopped(spark, tmp_path):
    ran = []

    def unit(k, fails=False):
        def make():
            ran.append(k)
            if fails:
                raise RuntimeError("killed")
            return spark.range(k).select(F.lit(k).alias("k"))

        return make

    with pytest.raises(RuntimeError, match="killed"):
        M.run_units(spark, {"one": unit(1), "two": unit(2), "bad": unit(3, True)}, str(tmp_path / "u"), workers=1)
    assert ran == [1, 2, 3]
    got = M.run_units(spark, {"one": unit(1), "two": unit(2), "bad": unit(3)}, str(tmp_path / "u"))
    assert ran == [1, 2, 3, 3]
    assert sorted((r.unit, r.k) for r in got.collect()) == [("bad", 3)] * 3 + [("one", 1)] + [("two", 2)] * 2


def test_leaderboard_resumes(spark, tmp_path, monkeypatch):
    df, path = training(spark), str(tmp_path / "search")
    plain, fitted = M._forest, []
    monkeypatch.setattr(M, "_forest", lambda *a, **k: fitted.append(k) or plain(*a, **k))
    first = {r.setting: r.r2 for r in M.leaderboard(df, df, ["a", "b", "c"], "y", GRID[:3], path).collect()}
    board = M.leaderboard(df, df, ["a", "b", "c"], "y", GRID, path).collect()
    assert len(fitted) == 4 and {r.setting for r in board} == {0, 1, 2, 3}
    assert {k: v for k, v in ((r.setting, r.r2) for r in board) if k < 3} == first
    assert {r["rank"] for r in board} == {1, 2, 3, 4} and max(r.r2 for r in board) > 0.8
    assert len(SETTINGS) == 48


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permuted_is_a_permutation(spark, n):
    df = spark.range(n).select("id", *(M.permuted(F.col("id"), n, F.lit(k)).alias(f"p{k}") for k in range(3)))
    rows = df.collect()
    for k in range(3):
        assert sorted(r[f"p{k}"] for r in rows) == list(range(n))
    if n == 1000:
        moved = np.array([[r.id, r.p0, r.p1] for r in rows])
        assert (moved[:, 0] == moved[:, 1]).sum() < 10 and abs(np.corrcoef(moved.T)[np.triu_indices(3, 1)]).max() < 0.12


def test_permutation_importance(spark):
    df = training(spark).withColumn("a", F.when(F.col("c") < 0.01, None).otherwise(F.col("a")))
    fitted = M.forest(df.dropna(), ["a", "b", "c"], "y", trees=10, depth=6, per_split="3")
    got = {r.feature: (r.mean, r.sd) for r in M.permutation_importance(fitted, df, ["a", "b", "c"], "y", repeats=4).collect()}
    # r2 is a squared correlation: without a, what b explains is left (its variance is 4/45 of 3/4 + 4/45)
    assert got["a"][0] > 0.6 > 0.2 > got["b"][0] > 0.02 and abs(got["c"][0]) < 0.02 and all(0 <= s < 0.1 for _, s in got.values())
    plan = M.permutation_importance(fitted, df, ["a", "b", "c"], "y", repeats=4)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_score_units_resumes(spark, tmp_path):
    px = spark.range(600).select((F.col("id") % 6).cast("int").alias("cell_id"), F.col("id").alias("x"), (F.col("id") / 600).alias("a"), (F.col("id") % 7 / 7.0).alias("b"))
    models = {t: M.forest(px.withColumn("y", F.col(c)), ["a", "b"], "y", trees=2, depth=3, per_split="2") for t, c in (("p", "a"), ("q", "b"))}
    path = str(tmp_path / "scored")
    part = M.score_units({"p": models["p"]}, px.where("cell_id < 2"), ["a", "b"], path)
    assert part.count() == 200
    files_of = lambda: {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files_of()
    whole = M.score_units(models, px, ["a", "b"], path)
    assert before.items() <= files_of().items()  # finished folders are left alone
    assert {(r.type, r.cell_id): r["count"] for r in whole.groupBy("type", "cell_id").count().collect()} == {(t, c): 100 for t in "pq" for c in range(6)}
    files.drop_unit(spark, path, type="q", cell_id=3)
    kept = files_of()
    again = M.score_units(models, px, ["a", "b"], path)
    assert kept.items() <= files_of().items() and again.count() == 1200
    want = {r.x: r.prediction for r in M.score(models["q"], px, ["a", "b"]).collect()}
    assert all(r.prediction == want[r.x] for r in again.where("type = 'q'").collect())


def test_scored_units_are_written_by_tasks_of_few_rows(spark, tmp_path, monkeypatch):
    """A large cell is spread over tasks, small ones share one; all rows are there, equal ones too."""
    monkeypatch.setattr(session, "TASK_ROWS", 1000)
    px = spark.range(9000).select(F.when(F.col("id") < 8000, 0).otherwise(F.col("id") % 100).cast("int").alias("cell_id"), (F.col("id") % 4000).alias("x"), (F.col("id") % 7 / 7.0).alias("a"))
    models = {t: M.forest(px.withColumn("y", e), ["a"], "y", trees=2, depth=2, per_split="1") for t, e in (("p", F.col("a")), ("q", -F.col("a")))}
    got = M.score_units(models, px, ["a"], str(tmp_path / "scored"))
    per_file = [(r.type, r.cell_id, r["count"]) for r in got.groupBy("type", "cell_id", F.input_file_name()).count().collect()]
    assert max(n for *_, n in per_file) < 1150 and 16 <= len([c for _, c, _ in per_file if c == 0]) <= 20 and len(per_file) < 200 + 2 * 18
    want = {(t, r.cell_id, r.x): r["count"] for t in "pq" for r in px.groupBy("cell_id", "x").count().collect()}
    assert {(r.type, r.cell_id, r.x): r["count"] for r in got.groupBy("type", "cell_id", "x").count().collect()} == want


@pytest.mark.parametrize("most", [1000, 10])
def test_cells_to_score_are_found_without_a_task_per_cell(spark, tmp_path, monkeypatch, most):
    """Neither with few nor with many cells does a task take a large one whole, also where Spark broadcasts nothing by itself."""
    monkeypatch.setattr(session, "TASK_ROWS", 1000)
    monkeypatch.setattr(M, "_BROADCAST_CELLS", most, raising=False)
    per_task, score_types = [], M.score_types

    def counted(models, own, features):
        per_task.append([r["count"] for r in own.groupBy(F.spark_partition_id()).count().collect()])
        return score_types(models, own, features)

    monkeypatch.setattr(M, "score_types", counted)
    px = spark.range(9000).select(F.when(F.col("id") < 8000, 0).otherwise(F.col("id") % 100).cast("int").alias("cell_id"), (F.col("id") % 4000).alias("x"), (F.col("id") % 7 / 7.0).alias("a"))
    models = {t: M.forest(px.withColumn("y", e), ["a"], "y", trees=2, depth=2, per_split="1") for t, e in (("p", F.col("a")), ("q", -F.col("a")))}
    want = {(t, r.cell_id, r.x): r["count"] for t in "pq" for r in px.groupBy("cell_id", "x").count().collect()}
    path = str(tmp_path / "scored")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        M.score_units(models, px.where("cell_id > 0"), ["a"], path)
        M.score_units(models, px, ["a"], path)  # the large cell, which is left
        files.drop_unit(spark, path, type="q", cell_id=0)
        for c in range(1, 30):
            files.drop_unit(spark, path, type="p", cell_id=c)
        got = M.score_units(models, px, ["a"], path)  # one type of it and many small ones
        assert {(r.type, r.cell_id, r.x): r["count"] for r in got.groupBy("type", "cell_id", "x").count().collect()} == want
        for c in range(30):
            files.drop_unit(spark, path, type="p", cell_id=c)
        for c in range(1, 30):
            files.drop_unit(spark, path, type="q", cell_id=c)
        files.drop_unit(spark, path, type="q", cell_id=0)
        M.score_units(models, px.where("cell_id = 0"), ["a"], path)
        got = M.score_units(models, px, ["a"], path)  # many small ones, the large one is done
        assert {(r.type, r.cell_id, r.x): r["count"] for r in got.groupBy("type", "cell_id", "x").count().collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [sum(n) for n in per_task] == [990, 8010, 8300, 8010, 290] and max(max(n) for n in per_task) < 3000


def test_pixels_to_score_are_read_in_small_splits(spark, tmp_path, monkeypatch):
    """What a shuffle to many tasks sorts does not follow the session's splits, which are as before afterwards."""
    seen, write, name = [], M.write_units, "spark.sql.files.maxPartitionBytes"
    monkeypatch.setattr(M, "write_units", lambda *a: (seen.append(spark.conf.get(name)), write(*a)))
    px = spark.range(60).selectExpr("cast(id % 3 as int) AS cell_id", "id AS x", "id / 60 AS a")
    models = {"p": M.forest(px.withColumn("y", F.col("a")), ["a"], "y", trees=2, depth=2, per_split="1")}
    own = spark.conf.get(name)
    try:
        for k, size in enumerate(("1g", "1m")):
            spark.conf.set(name, size)
            assert M.score_units(models, px, ["a"], str(tmp_path / str(k))).count() == 60 and spark.conf.get(name) == size
    finally:
        spark.conf.set(name, own)
    assert seen == [str(16 << 20), str(1 << 20)]


def test_heads_of_files(spark, tmp_path):
    (tmp_path / "good file.bin").write_bytes(b"MAGIC" + os.urandom(1000))
    (tmp_path / "bad.bin").write_bytes(b"MAGI")
    (tmp_path / "empty.bin").write_bytes(b"")
    (tmp_path / "huge.bin").touch()
    os.truncate(tmp_path / "huge.bin", 3 << 30)  # sparse: more than a row of Spark can hold
    path = str(tmp_path / "*.bin")
    got = {os.path.basename(r.path).replace("%20", " "): (r.length, bytes(r.head)) for r in files.heads(spark, path, 5).collect()}
    assert got == {"good file.bin": (1005, b"MAGIC"), "bad.bin": (4, b"MAGI"), "empty.bin": (0, b""), "huge.bin": (3 << 30, b"\0" * 5)}
    assert sorted(os.path.basename(r.path) for r in files.unreadable(spark, path, b"MAGIC").collect()) == ["bad.bin", "empty.bin", "huge.bin"]


def test_described_rows_go_by_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,t\nnumber,text\n1,"a, b"\nnumber,text\n2,-9\n')
    (tmp_path / "b.csv").write_text("k,t\nnumber,text\n")
    (tmp_path / "c.csv").write_text("k,t\n")
    (tmp_path / "d.csv").write_text("")
    got = sorted((r.k, r.t, r.file_name) for r in files.read_described(spark, str(tmp_path / "*.csv"), "k string, t string").collect() if r.t)
    assert got == [("1", "a, b", "a.csv"), ("number", "text", "a.csv")]
    assert files.read_described(spark, str(tmp_path / "*.csv"), "k string, t string").count() == 3
    (tmp_path / "l.txt").write_bytes("k;t\nx;y\nz;w\n1;café\n".encode("latin-1"))
    assert [(r.k, r.t) for r in files.read_described(spark, str(tmp_path / "l.txt"), "k int, t string", rows=2, encoding="ISO-8859-1", separator=";").collect()] == [(1, "café")]
    big = "k,t\nnumber,text\n" + "".join(f"{k},row {k}\n" for k in range(30_000)) + "number,text\n"
    (tmp_path / "big.tsv").write_text(big)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = files.read_described(spark, str(tmp_path / "big.tsv"), "k string, t string")
        assert rows.rdd.getNumPartitions() > 3 and rows.count() == 30_001 and rows.where("k = 'number'").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
