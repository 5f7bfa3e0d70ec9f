"""Cover tables: long and wide forms, sums with the three null rules, and unions of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverspark.functions.numbers import sum_or_null, sum_skipping_nulls


def sum_cover(df: DataFrame, keys: list[str], cover: str, name: str = "cover", zero_filled: bool = False) -> DataFrame:
    """Sum per key: null where all are null, or 0 with zero_filled."""
    total = F.sum(cover)
    return df.groupBy(*keys).agg((F.coalesce(total, F.lit(0.0)) if zero_filled else total).alias(name))


def pivot_cover(df: DataFrame, key: str, column: str, values: list[str], cover: str) -> DataFrame:
    """One row per key, one column per listed value; the list saves a pass over the data."""
    return df.groupBy(key).pivot(column, values).agg(F.sum(cover))


def unpivot_matrix(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str, fill: float | None = None) -> DataFrame:
    """Wide matrix to long; text that is no number becomes `fill`."""
    long = df.select(*ids, *(F.col(c).cast("string").alias(c) for c in columns)).unpivot(ids, columns, name, value)
    number = F.col(value).try_cast("double")
    return long.withColumn(value, number if fill is None else F.coalesce(number, F.lit(fill)))


def merge_columns(df: DataFrame, name: str, columns: list[str], zero_filled: bool = False) -> DataFrame:
    """Row sum of columns of one meaning: null if all are null, or 0 with zero_filled."""
    cols = [F.col(c).cast("double") for c in columns]
    return df.withColumn(name, sum_skipping_nulls(*cols) if zero_filled else sum_or_null(*cols))


def merge_twins(df: DataFrame, twins: dict[str, str]) -> DataFrame:
    """Fill each column from its misspelt twin and drop the twin, where both are there. Names may hold any sign."""
    have = {c.strip() if c not in twins.values() else c: c for c in df.columns}
    for right, wrong in twins.items():
        if right in have and wrong in have:
            df = df.withColumn(have[right], F.coalesce(F.col(f"`{have[right]}`"), F.col(f"`{have[wrong]}`"))).drop(have[wrong])
    return df


def split_parts(df: DataFrame, name: str, rules: list[tuple[str, Column]], other: str) -> tuple[DataFrame, DataFrame]:
    """(labelled table, check): the check has the rows of all, of the parts together and whether they agree."""
    split = labelled(df, name, rules, other)
    sizes = split.groupBy(name).agg(F.count("*").alias("n")).agg(F.sum("n").alias("in_parts"))
    return split, df.agg(F.count("*").alias("in_all")).crossJoin(F.broadcast(sizes)).withColumn("agree", F.col("in_all") == F.coalesce("in_parts", F.lit(0)))


def with_columns_of(df: DataFrame, names: list[str], kind: str = "double") -> DataFrame:
    """Absent columns of the standard list become nulls; the list's order rules, others follow."""
    have = set(df.columns)
    return df.select(*(F.col(c) if c in have else F.lit(None).cast(kind).alias(c) for c in names), *(c for c in df.columns if c not in names))


def union_sources(sources: dict[str, DataFrame], name: str = "source") -> DataFrame:
    """Union by column name with a source tag; columns that a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(name, F.lit(k)) for k, df in sources.items()])


def columns_like(df: DataFrame, part: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, *(c for c in df.columns if part in c and c not in keep))


def row_total(df: DataFrame, keys: list[str], leave_out: list[str]) -> DataFrame:
    """Add `total`, the sum of all columns but the keys and those that hold sums of others; nulls count as 0."""
    covers = [c for c in df.columns if c not in keys and c not in leave_out]
    return df.withColumn("total", sum_skipping_nulls(*(F.col(c) for c in covers)))


def labelled(df: DataFrame, name: str, rules: list[tuple[str, Column]], other: str) -> DataFrame:
    """One label per row, first rule wins: a split of the table that adds up by construction."""
    out = F.lit(other)
    for label, rule in reversed(rules):
        out = F.when(rule, label).otherwise(out)
    return df.withColumn(name, out)


def finite_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without null, NaN or infinite values in the columns."""
    ok = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < float("inf")) for c in columns]
    return df.where(reduce(Column.__and__, ok))
