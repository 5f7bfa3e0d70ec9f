"""Gapless ranks inside hot keys without gathering a key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverspark.session import cut


def spread_rank(df: DataFrame, keys: list[str], order: list[Column], name: str, salts: int | None = None) -> DataFrame:
    """Add `name`: 0-based, gapless within each combination of `keys` (none of them null).

    Rows of a key are dealt over `salts` buckets (one per 250,000 rows of the table, 64 at least) by a hash of `order`, ranked
    in their bucket and moved up by the sizes of the buckets before. Only the counts (keys x salts rows) meet per key.
    `df` is read twice, so pass a cut table. Rows alike in `order` get distinct ranks in either order.
    """
    salts = salts or max(64, df.count() // 250_000)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    by = [*keys, "_salt"]
    before = (
        salted.groupBy(*by)
        .agg(F.count("*").alias("_n"))
        .select(*by, F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    )
    ranked = salted.withColumn("_in", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
    return ranked.join(before, by).withColumn(name, (F.col("_before") + F.col("_in")).cast("long")).drop("_salt", "_before", "_in")


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add `name`: the place of each row of the whole table in `order`, gapless from 1. Rows alike in `order` get distinct places.

    One range shuffle; each partition numbers its own rows, and only the partitions' sizes, a row each, meet.
    """
    low = (1 << 33) - 1  # monotonically_increasing_id: 33 bits of a row's place in its partition below the partition's number
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.withColumn("_part", part).join(before, "_part").withColumn(name, F.col("_before") + F.col("_place").bitwiseAND(F.lit(low)) + 1).drop("_part", "_place", "_before")
