"""Rows by a key of their own, so that tables of decisions name rows and texts need not move."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverspark.session import cut

#: Most files whose numbers are broadcast, and most rows left out that are.
_FILES, _ROWS = 100_000, 1_000_000


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores after it until no column of df has it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _of_files(df: DataFrame) -> bool:
    return df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation" and "_metadata" not in df.columns


def keyed(docs: DataFrame, key: str) -> DataFrame:
    """`docs` with a long column `key` that tells its rows apart and is the same wherever the result is read.

    Rows that come straight from Parquet files are named by their file and place in it, without writing anything; other
    rows are written once.
    """
    if _of_files(docs):
        try:
            files = cut(docs.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").isNull().alias("none")).distinct())
        except Exception as e:  # noqa: BLE001  formats other than Parquet have no row_index
            if "row_index" not in str(e):
                raise
        else:
            if files.limit(_FILES + 1).count() <= _FILES and files.where("none").isEmpty():
                numbered = files.select("path", F.row_number().over(Window.orderBy("path")).cast("long").alias("file"))
                path, own, at = (free_name(docs, n) for n in ("_path", "_own", "_at"))
                placed = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(at))
                named = placed.join(F.broadcast(numbered.withColumnsRenamed({"file": key, "path": own})), F.col(path) == F.col(own))
                return named.select(*(F.col(f"`{c}`") for c in docs.columns), (F.shiftleft(key, 40) + F.col(at)).alias(key))
    return cut(docs.withColumn(key, F.monotonically_increasing_id()))


def by_own_key(df: DataFrame, id_col: str, value_col: str, run: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """run(df, id column) for ids of any type: it runs on a long key of the rows, and its components get their least id.

    run returns id, n_links, component_id and kept, one row per row of its input; rows without an id are given null as a
    component and no links, as run does itself.
    """
    key = free_name(df, "_row_key")
    rows = keyed(df.select(id_col, value_col), key)
    ids = rows.select(key, F.col(id_col).alias("_id"))
    found = ids.join(cut(run(rows.where(F.col(id_col).isNotNull()).select(key, value_col), key)), key, "left")
    found = cut(found.select("_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id"))
    least = found.where("component_id is not null").groupBy("component_id").agg(F.min("_id").alias("_least"))
    named = found.join(least, "component_id", "left")
    return named.select(F.col("_id").alias(id_col), "n_links", F.col("_least").alias("component_id"), F.col("_id").eqNullSafe(F.col("_least")).alias("kept"))


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """`rows` but those whose key is in `gone` (a written table of keys), in place where `gone` is small enough to broadcast."""
    few = gone.limit(_ROWS + 1).count() <= _ROWS
    return rows.join(F.broadcast(gone) if few else gone, key, "left_anti").drop(key)
