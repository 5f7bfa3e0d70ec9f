"""What every operator needs from a session: shared scratch tables and the package on the executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKAGE = Path(__file__).resolve().parent
_written: list[tuple[SparkSession, str]] = []

#: Rows that a task should hold of a table whose size is known.
TASK_ROWS = 500_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a new local one only where that is unset and no executor is elsewhere, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='coverspark-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder, removed when the process ends."""
    path = f"{shared_dir(spark)}/coverspark-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    The plan above starts from files that outlive any executor, is computed once however often
    it is used, and its size is known to the planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """df with the rows of a key together, over as many tasks as leave each about TASK_ROWS of `rows` rows.

    So a task's maps and sorts do not grow with the table, whatever number of shuffle partitions is set or left after
    small ones were joined. Where the session's own tasks suffice, df is left as it is.
    """
    parts = -(-rows // TASK_ROWS)
    return df if parts <= df.sparkSession.sparkContext.defaultParallelism else df.repartition(parts, *keys)


def dealt_by_place(df: DataFrame, place: Column, rows: int) -> DataFrame:
    """df in tasks of at most about TASK_ROWS of `rows` rows, by each row's place (0 to rows - 1) in an order: a task is a run of places."""
    size = min(TASK_ROWS, max(TASK_ROWS // 50, -(-rows // df.sparkSession.sparkContext.defaultParallelism)))
    return df.repartitionById(max(1, -(-rows // size)), F.floor(place / size).cast("int"))


@contextmanager
def small_splits(spark: SparkSession, size: int = 16 << 20) -> Iterator[None]:
    """What runs inside reads splits of at most `size` bytes of files. A shuffle to many tasks sorts all that a task has read, and scored rows are
    larger than those read."""
    name = "spark.sql.files.maxPartitionBytes"
    own = spark.conf.get(name)
    spark.conf.set(name, str(min(size, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so Python workers can import it anywhere."""
    sc = spark.sparkContext
    if getattr(sc, "_coverspark_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="coverspark-")) / "coverspark_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(_PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(_PACKAGE.parent))
    sc.addPyFile(str(target))
    sc._coverspark_shipped = True


def written() -> int:
    """How many tables cut() has written so far, for release()."""
    return len(_written)


def release(since: int, keep: DataFrame | None = None) -> None:
    """Remove the tables that cut() has written since then but the one that `keep` reads; nothing may read them any more."""
    kept = {f.rsplit("/", 1)[0] for f in keep.inputFiles()} if keep is not None else set()
    if keep is not None and not kept:
        return  # a table without files can't be told from the others
    stay = []
    for spark, path in _written[since:]:
        if any(k.rstrip("/").endswith(path.rsplit("/", 1)[1]) for k in kept):
            stay.append((spark, path))
            continue
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _written[since:] = stay


@atexit.register
def _remove_written() -> None:
    try:
        release(0)
    except Exception:  # noqa: BLE001  the context may be gone already
        return
