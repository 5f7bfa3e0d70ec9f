"""Lists, lookups and duplicates."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverspark.session import cut, dealt


def first_nonnull(c: str, order: str) -> Column:
    """Aggregate: the value of the first row by `order` that has one."""
    return F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order)))


def set_key(c: Column) -> Column:
    """Equal for arrays with the same distinct elements."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda x: x.cast("string")))), "|")


def set_equality_join(left: DataFrame, right: DataFrame, left_list: str, right_list: str, how: str = "left") -> DataFrame:
    """Join where the lists hold the same elements."""
    return left.withColumn("_set", set_key(F.col(left_list))).join(right.withColumn("_set", set_key(F.col(right_list))), "_set", how).drop("_set")


def replace_id(df: DataFrame, mapping: DataFrame, old: str, new: str, unique: bool = False) -> DataFrame:
    """Replace ids by a mapping (old, new), unmapped ones by null. With `unique`, an id mapped twice, or two ids mapped
    to one, fail the job."""
    own = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    if unique:
        fail = lambda c, what: F.when(F.count("*").over(Window.partitionBy(c)) > 1, F.raise_error(F.concat(F.lit(f"{what} is mapped twice: "), F.col(c).cast("string"))))
        own = own.withColumn("_new", F.coalesce(fail("_old", old).cast("string"), fail("_new", new).cast("string"), F.col("_new").cast("string")).cast(own.schema["_new"].dataType))
    return df.join(own, F.col(old) == F.col("_old"), "left").withColumn(old, F.col("_new")).drop("_old", "_new")


def same_key_rows(df: DataFrame, keys: list[str], value: str, name: str = "same") -> DataFrame:
    """Add the sorted list of `value` over all rows with the same keys; '' where a key is null or the row is alone."""
    w = Window.partitionBy(*keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    listed = F.array_join(F.array_sort(F.collect_list(F.col(value).cast("string")).over(w)), ",")
    return df.withColumn(name, F.when(known & (F.count("*").over(w) > 1), listed).otherwise(""))


def same_key_groups(df: DataFrame, keys: list[str], value: str, group: str = "group", size: str = "size") -> DataFrame:
    """Add the least `value` among the rows with the same keys and their number; nulls where a key is null or the row is alone.

    Rows of a group refer to it by its first value, so a key that very many rows share makes no list; same_key_rows spells lists out.
    """
    groups = df.dropna(subset=keys).groupBy(*keys).agg(F.min(value).alias(group), F.count("*").alias(size)).where(F.col(size) > 1)
    return df.join(groups, keys, "left")


def missing_numbers(df: DataFrame, c: str) -> DataFrame:
    """Whole numbers between the least and the largest that do not occur."""
    all_ = df.agg(F.min(c).alias("a"), F.max(c).alias("b")).select(F.explode(F.sequence("a", "b")).alias(c))
    return all_.join(df.select(c).distinct(), c, "left_anti")


def with_order(df: DataFrame, order: DataFrame, key: str, missing: str = "error") -> DataFrame:
    """Rows of the keys in `order` (key, ord), with ord. A key without a row fails the job; missing="null" keeps it with
    nulls, missing="drop" leaves it out."""
    if missing == "drop":
        return df.join(order, key)
    joined = order.join(df.withColumn("_here", F.lit(True)), key, "left")
    if missing == "error":
        checked = F.when(F.col("_here").isNull(), F.raise_error(F.concat(F.lit("no row for key "), F.col(key).cast("string"))).cast("long")).otherwise(F.col("ord"))
        joined = joined.withColumn("ord", checked)
    return joined.drop("_here")


def keep_first(df: DataFrame, keys: list[str], order: str, prefer: Column | None = None) -> DataFrame:
    """One row per key: the first by `order`, those for which `prefer` holds before others. An aggregation, so a hot key is
    merged in every task before it moves."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(F.lit(0) if prefer is None else F.when(prefer, 0).otherwise(1), F.col(order))
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row")).select(*keys, "_row.*")


def drop_null_rows(df: DataFrame, columns: list[str], how: str = "all", fill: float | None = None) -> DataFrame:
    """Without rows that are null in all (any) of the columns; the nulls left become `fill`."""
    kept = df.dropna(how=how, subset=columns)
    return kept if fill is None else kept.fillna(fill, subset=columns)


def nonzero_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != 0))


def matching_rows(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text holds the pattern."""
    return df.where(F.col(column).cast("string").rlike(pattern))


def equal_steps(low: Column, high: Column, n: int) -> Column:
    """Array of struct(from, to): n equal parts of a range."""
    at = lambda k: low + (high - low) * k / n
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct(at(k).alias("from"), at(k + 1).alias("to")))


def columns_matching(df: DataFrame, pattern: str, keep: list[str], strip: str = "") -> DataFrame:
    """The kept columns and those whose name holds the pattern, without the part that `strip` matches."""
    found = [c for c in df.columns if c not in keep and re.search(pattern, c)]
    return df.select(*keep, *(F.col(f"`{c}`").alias(re.sub(strip, "", c) if strip else c) for c in found))


def in_listed_order(df: DataFrame, column: str, listed: list[str]) -> DataFrame:
    """Sorted by the place of a value in a list, values not listed last; adds the place."""
    place = F.array_position(F.array(*map(F.lit, listed)), F.col(column))
    return df.withColumn("place", F.when(place > 0, place.cast("int"))).orderBy(F.asc_nulls_last("place"), column)


def ordered_rows(df: DataFrame, order: str, skip: int = 0, most: int | None = None, name: str = "place") -> DataFrame:
    """Rows in order without the first `skip`, `most` at most, with their place from 0.

    The place within a range partition is added to the rows of the partitions before, so no task holds the whole table.
    """
    if most is not None:
        df = df.orderBy(order).limit(skip + most)
    parts = df.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id()).sortWithinPartitions(order)
    parts = cut(parts)
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    placed = parts.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1)
    return placed.where(F.col(name) >= skip).drop("_part", "_before")


def renumbered(df: DataFrame, label: str, order: str, name: str = "number") -> DataFrame:
    """Add the number of a label by the first appearance of its members in `order`, from 0."""
    first = df.groupBy(label).agg(F.min(order).alias("_first"))
    numbered = ordered_rows(first, "_first", name=name).drop("_first")
    return df.join(numbered, label)


def missing_keys(have: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Keys that are wanted and not there."""
    return wanted.select(key).distinct().join(have.select(key).distinct(), key, "left_anti")


def union_of_keys(tables: list[DataFrame], key: str) -> DataFrame:
    return reduce(DataFrame.union, [t.select(key) for t in tables]).distinct()


def enriched(df: DataFrame, lookup: DataFrame, key: str, of) -> DataFrame:
    """df with the columns that `of` derives from a lookup joined on each distinct key once."""
    found = of(df.select(key).where(F.col(key).isNotNull()).distinct().join(lookup, key))
    return df.join(found, key, "left")


def images_of(surveys: DataFrame, images: DataFrame, site: str, day: str, host: str, token: int = 3) -> DataFrame:
    """Add `urls`: addresses of the images (name, day, path) taken on the survey's day at its site, '' if there are none.

    The site is a part of the image's dotted name.
    """
    own = images.select(F.try_element_at(F.split("name", r"\."), F.lit(token)).alias("_site"), F.col("day").alias("_day"), F.concat(F.lit(host), F.col("path")).alias("_url"))
    listed = own.where("_site is not null").groupBy("_site", "_day").agg(F.array_join(F.array_sort(F.collect_list("_url")), ", ").alias("urls"))
    joined = surveys.join(listed, (F.col(site) == F.col("_site")) & (F.col(day) == F.col("_day")), "left")
    return joined.withColumn("urls", F.coalesce("urls", F.lit(""))).drop("_site", "_day")


def aligned(layers: dict[str, DataFrame], keys: list[str], rows: int = 0) -> DataFrame:
    """Layers (keys, value) side by side where any has the pixel, from one union and one aggregation; of a layer's values for one
    pixel the largest. `rows`, if known, is the number of rows of all layers: large ones are dealt over tasks by it, see dealt()."""
    wide = [df.select(*keys, *((F.col(n) if n == m else F.lit(None).cast(layers[m].schema[m].dataType)).alias(m) for m in layers)) for n, df in layers.items()]
    return dealt(reduce(DataFrame.unionByName, wide), keys, rows).groupBy(*keys).agg(*(F.max(n).alias(n) for n in layers))
