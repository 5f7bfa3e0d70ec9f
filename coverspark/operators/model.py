"""Regression: influence, forests, leaderboards, importances and map scoring."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coverspark import session
from coverspark.operators.stats import agreement, rank_max
from coverspark.session import cut, dealt, dealt_by_place, scratch_path, small_splits
from coverspark.sources.files import pending, write_units, written_units

#: Cells that are broadcast when they are scored.
_BROADCAST_CELLS = 100_000


def cooks_distance(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Add `cooks` of a linear fit without intercept: e^2 h / (p s^2 (1 - h)^2), s^2 = SSE / (n - p).

    Two aggregations (products of the columns, then the error sum); only p x p numbers are on the driver, where a
    pseudo-inverse allows for collinear features. Rows with nulls are left out.
    """
    rows = df.dropna(subset=[*features, target])
    p = len(features)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    got = rows.agg(F.count("*"), *(F.sum(F.col(features[i]) * F.col(features[j])) for i, j in pairs), *(F.sum(F.col(f) * F.col(target)) for f in features), F.sum(F.col(target) * F.col(target))).first()
    n, xx = got[0], np.zeros((p, p))
    if not n:
        return rows.withColumn("cooks", F.lit(None).cast("double"))
    for (i, j), v in zip(pairs, got[1:]):
        xx[i, j] = xx[j, i] = v
    xy = np.array(got[1 + len(pairs) : 1 + len(pairs) + p], float)
    inverse = np.linalg.pinv(xx)
    beta = inverse @ xy
    s2 = (got[-1] - beta @ xy) / max(1, n - p)
    error = F.col(target) - sum((F.col(f) * float(b) for f, b in zip(features, beta)), F.lit(0.0))
    leverage = sum((F.col(features[i]) * F.col(features[j]) * float(inverse[i, j] * (1 if i == j else 2)) for i, j in pairs), F.lit(0.0))
    return rows.withColumns({"_e": error, "_h": leverage}).withColumn("cooks", F.try_divide(F.col("_e") * F.col("_e") * F.col("_h"), p * float(s2) * (1 - F.col("_h")) * (1 - F.col("_h")))).drop("_e", "_h")


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip").transform(df)


def forest(df: DataFrame, features: list[str], target: str, trees: int = 100, depth: int = 10, per_split: str = "10", seed: int = 0):
    """Fitted random forest; per_split is the number of features tried at a split."""
    return _forest(assembled(df, features), target, trees, depth, per_split, seed)


def _forest(df: DataFrame, target: str, trees: int = 100, depth: int = 10, per_split: str = "10", seed: int = 0):
    return RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=trees, maxDepth=min(depth, 30), featureSubsetStrategy=per_split, seed=seed).fit(df)


def score(model, df: DataFrame, features: list[str], name: str = "prediction") -> DataFrame:
    """Every row of a pixel table by a fitted model; partitioning is kept."""
    return model.transform(assembled(df, features)).drop("features").withColumnRenamed("prediction", name)


def cumulative_sources(df: DataFrame, order: DataFrame, source: str) -> DataFrame:
    """Each row once for every i from its source's place on: the training sets 1, 1-2, 1-3, ... order: source, place."""
    last = order.agg(F.max("place").alias("_last"))
    return df.join(F.broadcast(order), source).crossJoin(F.broadcast(last)).withColumn("fit", F.explode(F.sequence("place", "_last"))).drop("_last")


def run_units(spark: SparkSession, units: dict[str, Callable[[], DataFrame]], path: str | None = None, workers: int = 4) -> DataFrame:
    """The rows of every unit's table, with its `unit`; up to `workers` units run side by side, each in a scheduler pool of its own.

    Each unit's rows are a folder below `path` that counts once its writing has ended, so a run that was stopped goes on with
    the units that are missing. The first error ends the run after the units that are under way.
    """
    path = path or scratch_path(spark)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folders = {unit: f"{path}/of={hashlib.md5(unit.encode()).hexdigest()}" for unit in units}

    def finished(unit: str) -> bool:
        p = jvm.org.apache.hadoop.fs.Path(f"{folders[unit]}/_SUCCESS")
        return p.getFileSystem(conf).exists(p)

    def run(unit: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", folders[unit].rsplit("=", 1)[1])
        units[unit]().withColumn("unit", F.lit(unit)).write.mode("overwrite").parquet(folders[unit])

    todo = [u for u in units if not finished(u)]
    with ThreadPoolExecutor(workers) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(run), u) for u in todo]
        wait(jobs, return_when=FIRST_EXCEPTION)
        for j in jobs:
            j.cancel()
    for j in jobs:
        if not j.cancelled():
            j.result()
    return spark.read.parquet(*(folders[u] for u in units))


def leaderboard(train: DataFrame, test: DataFrame, features: list[str], target: str, grid: list[dict], path: str | None = None, workers: int = 4) -> DataFrame:
    """Agreement of a forest for each setting on the test rows, best first by r2; ties share the larger rank.

    Features are assembled and written once; settings are fitted side by side and each leaves its row below `path`, so a search that
    was stopped goes on from there (see run_units). `setting` is the place in the grid.
    """
    known, held = (cut(assembled(df, features).select("features", F.col(target).cast("double").alias("_y"))) for df in (train, test))

    def fitted(setting: dict) -> Callable[[], DataFrame]:
        return lambda: agreement(_forest(known, "_y", **setting).transform(held).withColumn("_of", F.lit(0)), "_of", "prediction", "_y").drop("_of")

    names = [json.dumps(setting, sort_keys=True) for setting in grid]
    found = run_units(train.sparkSession, {n: fitted(setting) for n, setting in zip(names, grid)}, path, workers)
    places = train.sparkSession.createDataFrame([(k, n) for k, n in enumerate(names)], "setting int, unit string")
    table = places.join(found, "unit").drop("unit")
    return table.withColumn("_all", F.lit(1)).withColumn("rank", rank_max("r2", ["_all"])).drop("_all")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Rows, written once, with a gapless number from 0 in no order; only the sizes of the partitions meet."""
    placed = cut(df.withColumn(name, F.monotonically_increasing_id()))
    part = F.shiftright(name, 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.withColumn("_part", part).join(before, "_part").withColumn(name, F.col("_before") + F.col(name).bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_before")


def permuted(number: Column, n: int, *key: Column) -> Column:
    """The place of `number` in a permutation of 0 .. n - 1 that depends on the key.

    Four rounds that mix one half of the bits into the other permute all numbers of as many bits; those beyond n are sent on
    until they are below it (each time at least every second one is).
    """
    bits = max(2, (n - 1).bit_length())
    low = bits // 2
    masks = F.lit((1 << (bits - low)) - 1).cast("long"), F.lit((1 << low) - 1).cast("long")

    def once(x: Column) -> Column:
        halves = [F.shiftright(x, low), x.bitwiseAND(masks[1])]
        for k in range(4):
            into, of = k % 2, 1 - k % 2
            halves[into] = halves[into].bitwiseXOR(F.xxhash64(*key, F.lit(k), halves[of]).bitwiseAND(masks[into]))
        return F.shiftleft(halves[0], low).bitwiseOR(halves[1])

    return F.aggregate(F.sequence(F.lit(1), F.lit(80)), once(number.cast("long")), lambda x, _: F.when(x >= n, once(x)).otherwise(x))


def permutation_importance(model, df: DataFrame, features: list[str], target: str, repeats: int = 5) -> DataFrame:
    """(feature, mean, sd) of the loss in r2 when a feature's values are dealt anew.

    Rows are numbered and written once. Each goes once for every feature and repeat, and once as it is, to one join, where it
    gets the feature's value of the row that a permutation of the numbers names; one pass scores them all. Rows with null
    features or target are left out.
    """
    rows = numbered(df.select(*(F.col(f).cast("double").alias(f) for f in features), F.col(target).cast("double").alias("_y")).dropna(), "_i")
    n = rows.count()
    asked = F.array(F.struct(F.lit(-1).alias("f"), F.lit(0).alias("r")), *(F.struct(F.lit(k).alias("f"), F.lit(r).alias("r")) for k in range(len(features)) for r in range(repeats)))
    each = rows.withColumn("_a", F.explode(asked)).withColumn("_of", F.when(F.col("_a.f") < 0, F.col("_i")).otherwise(permuted(F.col("_i"), max(n, 1), F.col("_a.f"), F.col("_a.r"))))
    values = rows.select(F.col("_i").alias("_of"), F.array(*features).alias("_v"))
    moved = each.join(values, "_of").withColumns({f: F.when(F.col("_a.f") == k, F.col("_v")[k]).otherwise(F.col(f)) for k, f in enumerate(features)})
    r2 = agreement(score(model, moved.select(*features, "_y", "_a"), features), "_a", "prediction", "_y").select("_a.f", "r2")
    base = r2.where("f < 0").select(F.col("r2").alias("_base"))  # one row
    names = F.element_at(F.array(*map(F.lit, features)), F.col("f") + 1)
    loss = F.col("_base") - F.col("r2")
    return r2.where("f >= 0").crossJoin(F.broadcast(base)).groupBy(names.alias("feature")).agg(F.avg(loss).alias("mean"), F.stddev_pop(loss).alias("sd"))


def boosted_importance(df: DataFrame, features: list[str], target: str, rounds: int = 20, depth: int = 6, step: float = 0.1, categories: list[str] = ()) -> dict[str, float]:
    """Importance of each feature in boosted trees; text columns in `categories` are indexed and split as sets of values."""
    own = list(features)
    for c in categories:
        df = StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep").fit(df).transform(df)
        own.append(f"{c}_index")
    model = GBTRegressor(featuresCol="features", labelCol=target, maxIter=rounds, maxDepth=depth, stepSize=step, maxBins=256, seed=0).fit(assembled(df, own))
    return dict(zip([*features, *categories], model.featureImportances.toArray().tolist()))


def cumulative_fits(tables: dict[str, DataFrame], order: DataFrame, source: str, features: list[str], target: str, test: DataFrame, path: str | None = None, workers: int = 4, **setting) -> DataFrame:
    """(name, fit, n, r2, rmse, mae) of a forest on the sources 1 to i of each table, for every i, on the test rows.

    order: source, place; its few rows are read on the driver, since each place is a model to fit. Tables are assembled and written
    once; fits run side by side and a stopped run goes on where it was (see run_units).
    """
    held = cut(assembled(test, features).select("features", F.col(target).cast("double").alias("_y")))
    places = [r["place"] for r in order.select("place").distinct().orderBy("place").collect()]
    known = {n: cut(assembled(df.join(F.broadcast(order), source), features).select("features", F.col(target).cast("double").alias("_y"), "place")) for n, df in tables.items()}

    def fitted(name: str, k: int) -> Callable[[], DataFrame]:
        own = lambda: _forest(known[name].where(F.col("place") <= k), "_y", **setting)
        return lambda: agreement(own().transform(held).select(F.struct(F.lit(name).alias("name"), F.lit(k).alias("fit")).alias("_of"), "prediction", "_y"), "_of", "prediction", "_y").select("_of.*", "n", "r2", "rmse", "mae")

    units = {json.dumps([n, k, setting], sort_keys=True): fitted(n, k) for n in tables for k in places}
    return run_units(test.sparkSession, units, path, workers).drop("unit")


def score_types(models: dict, df: DataFrame, features: list[str]) -> DataFrame:
    """Every row by every type's model: (type, prediction and the other columns). Features are assembled once; the pixels are read once."""
    wide = assembled(df, features)
    for name, model in models.items():
        wide = model.transform(wide).withColumnRenamed("prediction", f"_of_{name}")
    each = F.array(*(F.struct(F.lit(n).alias("type"), F.col(f"_of_{n}").alias("prediction")) for n in models))
    return wide.select(*df.columns, F.explode(each).alias("_t")).select(*df.columns, "_t.*")


def score_units(models: dict, df: DataFrame, features: list[str], path: str, cell: str = "cell_id") -> DataFrame:
    """Score every type and cell that has no folder below `path` yet, and read all of them: (x, y, ..., prediction, type, cell).

    What is to do is the cells of df for each type without those written; only pixels of such cells are read on and scored, by the models
    of all types at once. Whole folders are swapped in when the job ends, so a run that was stopped leaves finished folders or none.
    """
    spark = df.sparkSession
    types = F.explode(F.array(*map(F.lit, models)))
    cells = df.groupBy(cell).agg(F.count("*").alias("_rows"))
    todo = cells.select(types.alias("type"), cell, "_rows")
    done = written_units(spark, path, ["type", cell])
    todo = cut(todo if done is None else pending(todo, done, ["type", cell]))
    if not todo.isEmpty():
        before = F.coalesce(F.sum("_rows").over(Window.orderBy("type", cell).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = todo.withColumn("_before", before).groupBy(cell, "_rows").agg(F.map_from_entries(F.collect_list(F.struct("type", "_before"))).alias("_starts"))
        scored = score_types(models, of_cells(df, starts, cells, cell), features).withColumn("_before", F.col("_starts")[F.col("type")]).drop("_starts")
        with small_splits(spark):
            write_types(scored.where(F.col("_before").isNotNull()), todo.agg(F.sum("_rows")).first()[0], path, cell)
    return spark.read.parquet(path)


def of_cells(df: DataFrame, asked: DataFrame, cells: DataFrame, cell: str) -> DataFrame:
    """Pixels of the cells asked for, with the other columns of `asked`; cells: (cell, _rows) of all cells of df.

    A join by cell would give a task all pixels of one, and a cell grows with the table. So up to _BROADCAST_CELLS cells asked for are broadcast and
    pixels stay where they are. With more, a large cell is joined in pieces of a tenth of TASK_ROWS pixels; only the numbers of pieces of
    large cells are broadcast, at most ten per TASK_ROWS pixels.
    """
    if asked.count() <= _BROADCAST_CELLS:
        return df.join(F.broadcast(asked), cell)
    rows = cells.agg(F.sum("_rows")).first()[0]
    large = F.broadcast(cells.select(cell, F.ceil(F.col("_rows") / (session.TASK_ROWS // 10)).alias("_pieces")).where("_pieces > 1"))
    pieces = F.coalesce("_pieces", F.lit(1).cast("long"))
    own = df.join(large, cell, "left").withColumn("_piece", F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), pieces)).drop("_pieces")
    each = asked.join(large, cell, "left").withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))).drop("_pieces")
    return dealt(own, [cell, "_piece"], rows).join(each, [cell, "_piece"]).drop("_piece")


def write_types(scored: DataFrame, rows: int, path: str, cell: str = "cell_id") -> None:
    """Scored pixels, `rows` in all, in folders by type and cell, whole folders at a time. Each has the size of its unit (_rows) and of those before it (_before).

    Units stand one after another, each as long as its rows, and a task takes the next rows of them (see dealt_by_place): what it sorts does
    not grow with the table, a folder has few files, and a large cell several. Only the sizes of the units meet.
    """
    # the same row of the same part has the same place whenever it is computed, and equal rows have several
    own = [c for c in scored.columns if c not in ("_before", "_rows")]
    place = F.col("_before") + F.pmod(F.xxhash64(*own, F.spark_partition_id()), "_rows")
    write_units(dealt_by_place(scored, place, rows).drop("_before", "_rows"), path, ["type", cell])
