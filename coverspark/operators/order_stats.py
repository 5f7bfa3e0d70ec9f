"""Exact quantiles and ranks of groups of any size: no task, buffer or window holds more than a fixed number of a group's values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverspark.session import cut

#: Values that are sorted at the end of a search; steps of the rough quantiles that narrow it, and their accuracy.
_FEW, _GRID, _ACCURACY = 10_000, 64, 1000


def _same(by: list[str]) -> Column:
    cond = F.lit(True)
    for k in by:
        cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return cond


def _own(by: list[str], *more: str) -> list[Column | str]:
    return [*(F.col(f"a.{k}").alias(k) for k in by), *more]


def _open(lo: Column, hi: Column) -> Column:
    """Whether _v is between the ends, which are not included; null is no end."""
    return F.coalesce(F.col("_v") > lo, F.lit(True)) & F.coalesce(F.col("_v") < hi, F.lit(True))


def quantiles(df: DataFrame, by: list[str], value: str, shares: list[float], name: str = "q", few: int = _FEW) -> DataFrame:
    """One row per group: `by` and `name`, an array of the exact quantiles at `shares`, interpolated between the two nearest values.

    Nulls and NaN are left out; a group without values has nulls. `by` may be empty: the whole table is a group,
    if it has rows. A null key is a key.

    Groups are counted first. One of at most `few` values is sorted as a list, which is bounded by that count. A larger
    one is searched in rounds. The value of each wanted rank lies between two ends. A scan counts, per group, what is below, at and
    between them, with rough quantiles of what is between (a sketch of fixed size); so the value is one of the ends, or
    the ends move in to about a twentieth of the values, or, if a sketch misled, out to those proved before. Once at most `few`
    values are between, these alone are sorted. A scan sends one row of counts per group and task; the ends are a row per group.
    """
    v = F.col(value).cast("double")
    rows = df.select(*by, F.when(~F.isnan(v), v).alias("_v"))
    whole = not by
    if whole:
        rows, by = rows.withColumn("_all", F.lit(0)), ["_all"]
    sizes = cut(rows.groupBy(*by).agg(F.count("_v").alias("_n")))
    large, smaller = sizes.agg(F.count_if(F.col("_n") > few), F.count_if(F.col("_n") <= few)).first()
    of = lambda cond: rows.alias("a").join(sizes.where(cond).alias("b"), _same(by), "left_semi")
    if not large:
        out = _listed(rows, by, shares)
    elif not smaller:
        out = _searched(rows, by, shares, few)
    else:
        out = _listed(of(F.col("_n") <= few), by, shares).unionByName(_searched(of(F.col("_n") > few), by, shares, few))
    return out.select(*([] if whole else by), F.col("_q").alias(name))


def _between(n: Column, p: float, a: Column, b: Column) -> Column:
    """The quantile at p of n values, between those of the two nearest ranks."""
    part = (n - 1) * F.lit(p) - F.floor((n - 1) * F.lit(p))
    return F.when(a == b, a).otherwise(a + part * (b - a))


def _listed(rows: DataFrame, by: list[str], shares: list[float]) -> DataFrame:
    """by and _q of groups of few values, each sorted as a list; nulls are not listed."""
    lists = rows.groupBy(*by).agg(F.sort_array(F.collect_list("_v")).alias("_l")).withColumn("_n", F.size("_l"))
    at = lambda p, up: F.get("_l", F.least(F.floor((F.col("_n") - 1) * F.lit(p)) + up, F.col("_n") - 1).cast("int"))
    return lists.select(*by, F.array(*(_between(F.col("_n"), p, at(p, 0), at(p, 1)) for p in shares)).alias("_q"))


def _searched(rows: DataFrame, by: list[str], shares: list[float], few: int) -> DataFrame:
    """by and _q of groups of any size, see quantiles."""
    known = rows.where(F.col("_v").isNotNull())
    margin = 4 / _ACCURACY
    ends = [min(1.0, max(0.0, p + m)) for p in shares for m in (-margin, margin)]
    first = known.groupBy(*by).agg(F.count("_v").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"), F.percentile_approx("_v", ends, _ACCURACY).alias("_e"))
    rank = [F.least(F.floor((F.col("_n") - 1) * F.lit(p)) + up, F.col("_n") - 1) for p in shares for up in (0, 1)]
    search = [
        F.struct(
            r.cast("long").alias("rank"), F.col("_e")[k // 2 * 2].alias("lo"), F.col("_e")[k // 2 * 2 + 1].alias("hi"),
            F.col("_least").alias("least"), F.col("_most").alias("most"), F.lit(0).cast("long").alias("before"), F.lit(None).cast("double").alias("value"), F.lit(False).alias("done"),
        )
        for k, r in enumerate(rank)
    ]
    groups = cut(first.select(*by, "_n", F.array(*search).alias("_s")))
    wanted = F.exists("_s", lambda s: ~s["done"])
    while not groups.where(wanted).isEmpty():
        met = known.alias("a").join(groups.where(wanted).alias("b"), _same(by)).select(*_own(by), "_v", "_s")
        counts = []
        for k in range(len(rank)):
            s, todo = F.col("_s")[k], ~F.col("_s")[k]["done"]
            between = todo & (F.col("_v") > s["lo"]) & (F.col("_v") < s["hi"])
            grid = F.percentile_approx(F.when(between, F.col("_v")), [g / _GRID for g in range(_GRID + 1)], _ACCURACY)
            number = lambda c, todo=todo: F.count_if(todo & c)
            counts.append(F.struct(number(F.col("_v") < s["lo"]).alias("below"), number(F.col("_v") == s["lo"]).alias("low"), F.count_if(between).alias("between"), number((F.col("_v") == s["hi"]) & (s["hi"] > s["lo"])).alias("high"), grid.alias("grid")))
        told = met.groupBy(*by).agg(F.array(*counts).alias("_c"))
        both = groups.alias("a").join(told.alias("b"), _same(by), "left")
        moved = F.when(F.col("_c").isNull(), F.col("_s")).otherwise(F.zip_with("_s", "_c", lambda s, c: F.when(s["done"], s).otherwise(_moved(s, c, few))))
        groups = cut(both.select(*_own(by, "_n"), moved.alias("_s")))
    left = lambda s: s["value"].isNull()
    asked = groups.where(F.exists("_s", left)).withColumn("_s", F.filter("_s", left))
    asked = asked.select(*by, F.array_distinct(F.transform("_s", lambda s: F.struct(s["lo"].alias("lo"), s["hi"].alias("hi"), s["before"].alias("before")))).alias("_in"), F.array_distinct(F.transform("_s", lambda s: s["rank"])).alias("_ranks"))
    met = known.alias("a").join(asked.alias("b"), _same(by)).select(*_own(by), "_v", F.explode(F.filter("_in", lambda i: _open(i["lo"], i["hi"]))).alias("_in"), "_ranks")
    runs = met.groupBy(*by, "_in", "_v").agg(F.count("*").alias("_k"), F.first("_ranks").alias("_ranks"))
    upto = F.sum("_k").over(Window.partitionBy(*by, "_in").orderBy("_v")) + F.col("_in.before")
    ranked = runs.withColumn("_to", upto).select(*by, "_v", F.explode(F.filter("_ranks", lambda r: (r < F.col("_to")) & (r >= F.col("_to") - F.col("_k")))).alias("_r"))
    found = ranked.groupBy(*by).agg(F.map_from_entries(F.collect_set(F.struct("_r", "_v"))).alias("_at"))
    out = groups.alias("a").join(found.alias("b"), _same(by), "left").select(*_own(by, "_n", "_s", "_at"))
    values = [F.coalesce(F.col("_s")[k]["value"], F.try_element_at("_at", F.col("_s")[k]["rank"])) for k in range(len(rank))]
    return out.select(*by, F.array(*(_between(F.col("_n"), p, a, b) for p, a, b in zip(shares, values[::2], values[1::2]))).alias("_q"))


def _moved(s: Column, c: Column, few: int) -> Column:
    """A search after a scan of its counts."""
    rank, low, inner = s["rank"], c["below"] + c["low"], c["below"] + c["low"] + c["between"]
    spot = (rank - low) * F.lit(float(_GRID)) / F.greatest(c["between"], F.lit(1))
    step = lambda k: F.get(c["grid"], F.least(F.lit(_GRID), F.greatest(F.lit(0), k)).cast("int"))
    at_low, at_high = (rank >= c["below"]) & (rank < low), (rank >= inner) & (rank < inner + c["high"])
    within = (rank >= low) & (rank < inner)
    sorted_ = within & (c["between"] <= few)
    value = F.when(at_low, s["lo"]).when(at_high, s["hi"])
    missed, beyond = rank < c["below"], rank >= inner + c["high"]
    lo = F.when(missed, s["least"]).when(beyond, s["hi"]).when(within & ~sorted_, step(F.floor(spot) - 1)).otherwise(s["lo"])
    hi = F.when(missed, s["lo"]).when(beyond, s["most"]).when(within & ~sorted_, step(F.ceil(spot) + 1)).otherwise(s["hi"])
    least = F.when(beyond, s["hi"]).when(within, s["lo"]).otherwise(s["least"])
    most = F.when(missed, s["lo"]).when(within, s["hi"]).otherwise(s["most"])
    return F.struct(rank.alias("rank"), lo.alias("lo"), hi.alias("hi"), least.alias("least"), most.alias("most"), low.alias("before"), value.alias("value"), (at_low | at_high | sorted_).alias("done"))


def with_quantiles(own: DataFrame, df: DataFrame, by: list[str], value: str, shares: list[float], name: str = "q") -> DataFrame:
    """own, a table of a row per group, with the exact quantiles of df's groups as the array `name`."""
    q = quantiles(df, by, value, shares, name).withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(by)})
    cond = F.lit(True)
    for i, k in enumerate(by):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return own.join(q, cond, "left").drop(*(f"_k{i}" for i in range(len(by))))


def _runs(df: DataFrame, by: list[str], order: list[str], n: str, times: str | None = None) -> DataFrame:
    """One row per group and different values of `order`: these, `n` rows that have them, and `_first`, how many of the group come before.

    Equal values are counted first, so a value that every row has is one row. The runs are dealt over ranges of (group,
    order); sums of each group in each range, a small table, give the rows before a range, and a window within range and group the rest.
    """
    runs = df.groupBy(*by, *order).agg((F.sum(times) if times else F.count("*")).alias(n))
    placed = cut(runs.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy(*by, "_part").agg(F.sum(n).alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*by, "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    own = placed.withColumn("_own", F.sum(n).over(Window.partitionBy(*by, "_part").orderBy(*order)) - F.col(n))
    joined = own.alias("a").join(before.alias("b"), _same([*by, "_part"]))
    return joined.select(*_own([*by, *order, n]), (F.col("_before") + F.col("_own")).alias("_first"))


def value_ranks(df: DataFrame, by: list[str], value: str, rank: str = "rank", n: str = "n", times: str | None = None) -> DataFrame:
    """One row per group and different value: `by`, value, `n` rows that have it, and their average `rank` from 1; see _runs.

    With `times`, a column of whole numbers, a row counts so many times. Null keys and values are ranked like others, nulls first.
    """
    return _runs(df, by, [value], n, times).select(*by, value, n, (F.col("_first") + (F.col(n) + 1) / 2).alias(rank))


def nearest_rows(df: DataFrame, by: list[str], order: list[str], shares: list[float], name: str = "q") -> DataFrame:
    """One row per group: `by` and `name`, an array with the values of `order` (a struct) at the places nearest to the shares.

    The place of p among n rows in order is (n - 1) p, rounded half to even. Rows with a null first value are left out, later nulls come
    first; a group without rows is left out. Ranks come from counts over ranges, so no task holds a group; see _runs.
    """
    known = df.where(F.col(order[0]).isNotNull())
    runs = _runs(known, by, order, "_n")
    sizes = known.groupBy(*by).agg(F.count("*").alias("_all"))
    both = runs.alias("a").join(sizes.alias("b"), _same(by)).select(*_own(by, *order, "_n", "_first", "_all"))
    place = [F.bround((F.col("_all") - 1) * F.lit(p), 0) for p in shares]
    held = [(r >= F.col("_first")) & (r < F.col("_first") + F.col("_n")) for r in place]
    return both.groupBy(*by).agg(F.array(*(F.max(F.when(h, F.struct(*order))) for h in held)).alias(name))


def previous_in_group(df: DataFrame, by: list[str], order: str, previous: str = "previous", first: str = "first") -> DataFrame:
    """Add the `order` of the row before in its group, and the least in the group. `order` has no ties or nulls.

    Rows are dealt over ranges of (group, order); a range's first row of a group looks up the largest order of the ranges before,
    in a table of a row per group and range. So a group of any size is spread over tasks.
    """
    placed = cut(df.repartitionByRange(*by, order).withColumn("_part", F.spark_partition_id()))
    ends = placed.groupBy(*by, "_part").agg(F.min(order).alias("_low"), F.max(order).alias("_high"))
    along = Window.partitionBy(*by).orderBy("_part")
    ends = ends.select(*by, "_part", F.lag("_high").over(along).alias("_before"), F.min("_low").over(Window.partitionBy(*by)).alias(first))
    own = placed.withColumn("_own", F.lag(order).over(Window.partitionBy(*by, "_part").orderBy(order)))
    joined = own.alias("a").join(ends.alias("b"), _same([*by, "_part"]))
    return joined.select(*(F.col(f"a.{c}").alias(c) for c in df.columns), F.coalesce("_own", "_before").alias(previous), first)
