"""Validation: each rule gives a table of violations (rule, key, detail, severity)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def found(df: DataFrame, rule: str, key: str, bad: Column, detail: Column, severity: str = "error") -> DataFrame:
    """Rows for which `bad` is true."""
    return df.where(bad).select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), detail.cast("string").alias("detail"), F.lit(severity).alias("severity"))


def not_unique(df: DataFrame, key: str) -> DataFrame:
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    return found(n, "unique", key, F.col("n") > 1, F.col("n"))


def bad_key(df: DataFrame, key: str, letter: str = "u", least: int = 10) -> DataFrame:
    return found(df, "key form", key, ~F.col(key).startswith(letter) | (F.length(key) < least), F.col(key))


def out_of_bounds(df: DataFrame, key: str, column: str, low: float, high: float) -> DataFrame:
    return found(df, f"{column} bounds", key, ~F.col(column).between(low, high), F.round(column, 6))


def not_allowed(df: DataFrame, key: str, column: str, allowed: list[str]) -> DataFrame:
    return found(df, f"{column} vocabulary", key, ~F.col(column).isin(*allowed), F.col(column))


def sums_differ(df: DataFrame, key: str, parts: list[str], total: str) -> DataFrame:
    """The parts' sum is not close to the total: off by more than 1e-8 + 1e-5 of it, or one of the two is null and the other
    isn't. A null among the parts makes their sum null."""
    s = sum((F.col(c) for c in parts), F.lit(0.0))
    off = F.coalesce(F.abs(s - F.col(total)) > 1e-8 + 1e-5 * F.abs(total), s.isNull() != F.col(total).isNull())
    return found(df, "sum", key, off, F.coalesce(F.round(s - F.col(total), 6).cast("string"), F.lit("null")))


def cover_warnings(df: DataFrame, key: str, covers: list[str], single: list[str], most: float = 100) -> DataFrame:
    """Single covers above `most`, and totals below 100."""
    rows = [found(df, f"{c} above {most}", key, F.col(c) > most, F.round(c, 6), "warning") for c in single]
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in covers), F.lit(0.0))
    return reduce(DataFrame.unionByName, [*rows, found(df, "total below 100", key, total < 100, F.round(total, 6), "warning")])


def nulls(df: DataFrame, key: str, schema: StructType) -> DataFrame:
    """One row per null in a column that the schema declares not null."""
    must = [f.name for f in schema.fields if not f.nullable]
    each = df.select(F.col(key).cast("string").alias("key"), F.explode(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in must))).alias("detail"))
    return each.where("detail is not null").select(F.lit("not null").alias("rule"), "key", "detail", F.lit("error").alias("severity"))


def schema_differences(spark: SparkSession, have: StructType, declared: StructType) -> DataFrame:
    """Missing columns and other types."""
    own = {f.name: f.dataType.simpleString() for f in have.fields}
    rows = [("schema", f.name, f"{own.get(f.name, 'missing')} <> {f.dataType.simpleString()}", "error") for f in declared.fields if own.get(f.name) != f.dataType.simpleString()]
    return spark.createDataFrame(rows, "rule string, key string, detail string, severity string")


def data_dictionary(df: DataFrame, units: dict[str, str], definitions: dict[str, str]) -> DataFrame:
    """column, unit, definition and type of each column, in order, with the number of its values."""
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns))
    rows = [F.struct(F.lit(k).alias("position"), F.lit(f.name).alias("column"), F.lit(units.get(f.name, "")).alias("unit"), F.lit(definitions.get(f.name, "")).alias("definition"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("n")) for k, f in enumerate(df.schema.fields)]
    return counts.select(F.inline(F.array(*rows)))


def reconcile(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Distinct keys before and after a step, and how many were lost or added."""
    a, b = (d.select(key).distinct().withColumn(n, F.lit(1)) for d, n in ((before, "_a"), (after, "_b")))
    j = a.join(b, key, "full_outer")
    return j.agg(F.count("_a").alias("n_before"), F.count("_b").alias("n_after"), F.count_if(F.col("_b").isNull()).alias("lost"), F.count_if(F.col("_a").isNull()).alias("added"))
