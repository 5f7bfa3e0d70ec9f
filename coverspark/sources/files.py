"""Reading and writing files: names as columns, encodings, resumable and validated sinks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverspark.functions.numbers import null_tokens
from coverspark.functions.text import replaced
from coverspark.schemas import conform, violations
from coverspark.session import ship


def read_delimited(spark: SparkSession, path: str | list[str], schema: str | None = None, encoding: str = "UTF-8", separator: str = ",") -> DataFrame:
    """Delimited text with a header; null tokens in text columns become null. Adds file_name."""
    reader = spark.read.option("header", True).option("encoding", encoding).option("sep", separator)
    df = (reader.schema(schema) if schema else reader).csv(path)
    text = {c: null_tokens(F.col(c)) for c, t in df.dtypes if t == "string"}
    return df.select("*", F.col("_metadata.file_name").alias("file_name")).withColumns(text)


def read_described(spark: SparkSession, path: str | list[str], schema: str, rows: int = 1, encoding: str = "UTF-8", separator: str = ",") -> DataFrame:
    """Delimited text whose header is followed by `rows` rows of descriptions in each file, without these. Adds file_name.

    Lines are left out by their place: those of a file's first block are counted as they are read, so nothing is shuffled or
    sorted and a data row that reads like a description stays. Quotes are honoured by from_csv; fields do not span
    lines. Null tokens in text columns become null. `encoding` is one in which a line feed is one byte.
    """
    ship(spark)
    lines = spark.read.text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"))

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen = None, 0
        for batch in batches:
            paths, blocks, keep = batch.column(2).to_pylist(), batch.column(3).to_pylist(), []
            for here in zip(paths, blocks):
                seen = seen + 1 if here == at else 1
                at = here
                keep.append(here[1] > 0 or seen > rows + 1)
            yield batch.filter(pa.array(keep)).select([0, 1])

    data = lines.mapInArrow(below, "value binary, file_name string")
    text = F.decode("value", encoding) if encoding.upper() not in ("UTF-8", "UTF8") else F.col("value").cast("string")
    parsed = data.select(F.from_csv(text, schema, {"sep": separator}).alias("_r"), "file_name").select("_r.*", "file_name")
    return parsed.withColumns({c: null_tokens(F.col(c)) for c, t in parsed.dtypes if t == "string" and c != "file_name"})


def without_first_rows(df: DataFrame, path: str | list[str], rows: int = 1, separator: str = ",") -> DataFrame:
    """What read_delimited gave as df, read again without the first `rows` under the header of each file; see read_described."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != "file_name")
    return read_described(df.sparkSession, path, schema, rows, separator=separator)


def read_named(spark: SparkSession, path: str, names: list[str], renames: dict[str, str], values: dict[str, dict[str, str]] | None = None, header: bool = True) -> DataFrame:
    """A sheet saved as delimited text: columns named in order where it has no header, renamed, listed values replaced."""
    df = spark.read.option("header", header).csv(path) if header else spark.read.csv(path).toDF(*names)
    df = df.withColumnsRenamed(renames)
    return df.withColumns({c: replaced(F.trim(c), m) for c, m in (values or {}).items()})


def read_by_encoding(spark: SparkSession, files: dict[str, list[str]], schema: str | None = None) -> DataFrame:
    """Union of file groups by their encoding."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [read_delimited(spark, paths, schema, e) for e, paths in files.items()])


def name_part(file_name: Column, place: int, separator: str = "_") -> Column:
    """A part of the file name without its extension; negative places count from the end."""
    return F.try_element_at(F.split(F.regexp_replace(file_name, r"\.[^.]*$", ""), separator), F.lit(place))


def dataset_name(file_name: Column, suffix: str) -> Column:
    return F.regexp_extract(file_name, "([^/]*)" + suffix + "$", 1)


def output_label(df: DataFrame, site: str, year: str) -> DataFrame:
    """Sorted sites and the range of years as one label."""
    return df.agg(F.concat_ws("_", F.array_join(F.array_sort(F.collect_set(site)), "-"), F.format_string("%d-%d", F.min(year), F.max(year))).alias("label"))


def heads(spark: SparkSession, path: str | list[str], size: int) -> DataFrame:
    """(path, length, head) with the first `size` bytes of each file, empty ones included; the rest is not read, however large a file is.

    Spark lists the files, as for any scan; the tasks open them by their URI, so the storage must be one that Arrow knows (mounted
    folders, HDFS, S3, GCS).
    """
    ship(spark)
    names = [(unquote(u),) for u in spark.read.format("binaryFile").load(path).inputFiles()]
    files = spark.createDataFrame(names, "path string").repartition(max(1, min(len(names) // 64, 10_000)))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, got = [], []
            for name in batch.column(0).to_pylist():
                scheme, host, place = re.fullmatch(r"([^:/]+):(?://([^/]*))?(/.*)", name).groups()
                system, root = FileSystem.from_uri(f"{scheme}://{host or ''}/")
                with system.open_input_file(root.rstrip("/") + place) as f:
                    length.append(f.size())
                    got.append(f.read(size))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(length, pa.int64()), pa.array(got, pa.binary())], names=["path", "length", "head"])

    return files.mapInArrow(first, "path string, length long, head binary")


def unreadable(spark: SparkSession, path: str | list[str], magic: bytes) -> DataFrame:
    """(path, length) of the files that do not begin with the given bytes, which are all that is read of them."""
    return heads(spark, path, len(magic)).where(F.col("head") != F.lit(magic)).select("path", "length")


def lists_to_text(df: DataFrame, separator: str = "; ") -> DataFrame:
    return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), separator) for c, t in df.dtypes if t.startswith("array<")})


def write_quoted(df: DataFrame, path: str) -> None:
    """CSV with every value quoted; arrays become text."""
    lists_to_text(df).write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work units whose output is not there yet."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def write_units(df: DataFrame, path: str, units: list[str]) -> None:
    """Overwrite only the units present in df."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*units).parquet(path)


def written_units(spark: SparkSession, path: str, units: list[str]) -> DataFrame | None:
    """The units that have files below `path`, from the names of their folders; None if there are none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    try:
        return spark.read.parquet(path).select(*units).distinct()
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None  # a folder without files


def drop_unit(spark: SparkSession, path: str, **unit) -> None:
    """Remove the folder of one unit, such as type="shrub", cell_id=3."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([path, *(f"{k}={v}" for k, v in unit.items())]))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_valid(df: DataFrame, violations: DataFrame, path: str) -> None:
    """Write if no rule is violated; warnings are no obstacle."""
    bad = (violations.where("severity <> 'warning'") if "severity" in violations.columns else violations).take(5)
    if bad:
        raise ValueError(f"not written, violations such as {bad}")
    df.write.mode("overwrite").parquet(path)


def export(df: DataFrame, schema: str, path: str) -> None:
    """Conform a table to its declared schema and write it if no rule of that is violated; only tables with one row per key
    must have a unique one."""
    write_valid(conform(df, schema), violations(df, schema).where("rule <> 'schema'"), path)


def read_tiles(spark: SparkSession, path: str, bands: list[str] | None = None, cells: list[int] | None = None) -> DataFrame:
    """Pixels from files under band=/date=/cell_id=; only the folders asked for are read."""
    df = spark.read.parquet(path)
    if bands is not None:
        df = df.where(F.col("band").isin(*bands))
    return df if cells is None else df.where(F.col("cell_id").isin(*cells))
