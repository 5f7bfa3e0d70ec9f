"""Dates: packed, mixed and ranged texts, steps and day numbers. What is no date gives null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed_date(c: Column) -> Column:
    """struct(year, month, day) of 8 digits (ymd), 6 (ym) or 4 (y); otherwise nulls."""
    n = F.when(c.rlike("^[0-9]+$"), F.length(c))
    part = lambda at, size, when: F.when(when, F.substring(c, at, size).try_cast("int"))
    return F.struct(part(1, 4, n.isin(4, 6, 8)).alias("year"), part(5, 2, n.isin(6, 8)).alias("month"), part(7, 2, n == 8).alias("day"))


def mixed_date(c: Column, formats: list[str]) -> Column:
    """The first format that fits."""
    return F.coalesce(*[F.to_date(F.try_to_timestamp(c, F.lit(f))) for f in formats])


# Dates known to be mistyped.
MISTYPED_DATES = {"05.08.218": "05.08.2018"}


def corrected_date_text(c: Column) -> Column:
    """Trimmed text, known typing errors mended."""
    out = F.trim(c)
    for wrong, right in MISTYPED_DATES.items():
        out = F.when(F.trim(c) == wrong, right).otherwise(out)
    return out


def range_midpoint_date(c: Column) -> Column:
    """`yyyy-yyyy` gives the middle of 1 January and 31 December of these years, `d-d.m.yyyy` the middle day (rounded down)."""
    y = [F.regexp_extract(c, r"^(\d{4})-(\d{4})$", k) for k in (1, 2)]
    d = [F.regexp_extract(c, r"^(\d{1,2})-(\d{1,2})\.(\d{1,2})\.(\d{4})$", k) for k in (1, 2, 3, 4)]
    day = lambda *parts: F.to_date(F.try_to_timestamp(F.concat_ws("-", *parts), F.lit("yyyy-M-d")))
    middle = lambda a, b: F.date_add(a, F.floor(F.datediff(b, a) / 2).cast("int"))
    years = middle(day(y[0], F.lit("1"), F.lit("1")), day(y[1], F.lit("12"), F.lit("31")))
    return F.when(c.rlike(r"^\d{4}-\d{4}$"), years).when(c.rlike(r"^\d{1,2}-\d{1,2}\.\d{1,2}\.\d{4}$"), middle(day(d[3], d[2], d[0]), day(d[3], d[2], d[1])))


def dataset_dates(df: DataFrame, formats: DataFrame, dataset: str, text: str, name: str = "day") -> DataFrame:
    """Add the date of `text`: mended, the middle of a range, or by the first of its dataset's formats that fits.

    formats: dataset, pos, format; a dataset without formats gives null but for ranges.
    """
    listed = formats.groupBy(dataset).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "format"))), lambda x: x["format"]).alias("_formats"))
    joined = df.join(listed.withColumnRenamed(dataset, "_dataset"), F.col(dataset) == F.col("_dataset"), "left")
    c = corrected_date_text(F.col(text))
    read = F.filter(F.transform("_formats", lambda f: F.to_date(F.try_to_timestamp(c, f))), lambda x: x.isNotNull())
    return joined.withColumn(name, F.coalesce(range_midpoint_date(c), F.try_element_at(read, F.lit(1)))).drop("_dataset", "_formats")


def spellings(df: DataFrame, dataset: str, text: str) -> DataFrame:
    """The distinct spellings per dataset as comma text."""
    return df.groupBy(dataset).agg(F.array_join(F.array_sort(F.collect_set(text)), ", ").alias("spellings"))


def month_steps(start: Column, end: Column, months: int) -> Column:
    """Array of struct(from, to) of so many calendar months, from start's month on, none beginning after end."""
    begins = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr(f"interval {months} months"))
    return F.transform(begins, lambda a: F.struct(a.alias("from"), F.date_sub(F.add_months(a, months), 1).alias("to")))


def day_step(c: Column, start: Column, days: int) -> Column:
    """Number of the step of `days` days since start."""
    return F.floor(F.datediff(F.to_date(c), F.to_date(start)) / days)


def fractional_years(ts: Column) -> Column:
    """Years of 365.25 days since 1970."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6 * 86400 * 365.25)
