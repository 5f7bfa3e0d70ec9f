"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverspark.session import cut

#: Largest number of times that a mix takes a document.
MOST = 3


def words_in(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D; null has none."""
    # each run, with the white space before it, becomes one letter, in one pass
    marks = F.regexp_replace(F.rtrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", "x")
    return F.length(marks).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Add `weight` and `target` to (source, source_size): 1, 2, 3 in turn by code point, null last.

    All sizes are shared by weight; a target stops at 3 times its source's size and the excess is shared by weight
    among the others, until none is above. That is a level L with target = min(weight * L, 3 * size) and a sum of 100 %:
    sources sorted by the level that fills them are full up to some rank, and L shares what is left.
    One row per source meets in one task.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    by_level = Window.orderBy("_full_at", F.col("source").isNull(), F.encode("source", "utf-8"))
    every = Window.partitionBy()
    upto = by_level.rowsBetween(Window.unboundedPreceding, -1)
    w = sizes.withColumn("weight", (F.pmod(F.row_number().over(by_name) - 1, F.lit(3)) + 1).cast("double"))
    w = w.withColumn("_full_at", MOST * F.col("source_size") / F.col("weight"))
    # the level if exactly the sources before this one are full
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum(MOST * F.col("source_size")).over(upto), F.lit(0))
    w = w.withColumn("_level", rest / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))))
    # the first source that this level doesn't fill
    level = F.min(F.when(F.col("_level") <= F.col("_full_at"), F.struct(F.col("_full_at"), F.col("_level")))).over(every)["_level"]
    w = w.withColumn("target", F.coalesce(F.least(F.col("weight") * level, (MOST * F.col("source_size")).cast("double")), F.lit(0.0)))
    return w.drop("_full_at", "_level")


def _hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of `drawn` out of `total` are among `good`: the inverse of the distribution at u.

    Probabilities are summed from the least number on, as multiples of its own, by their ratios.
    """
    least, most = F.greatest(F.lit(0).cast("long"), drawn - (total - good)), F.least(good, drawn)
    ratio = lambda k: ((good - k).cast("double") * (drawn - k).cast("double")) / ((k + 1).cast("double") * (total - good - drawn + k + 1).cast("double"))
    # logs keep far tails finite; they are scaled by their largest before summing
    logs = F.aggregate(
        F.sequence(least, most),
        F.struct(F.lit(0.0).alias("last"), F.array().cast("array<double>").alias("all")),
        lambda s, k: F.struct((s["last"] + F.when(k < most, F.log(ratio(k))).otherwise(F.lit(0.0))).alias("last"), F.concat(s["all"], F.array(s["last"])).alias("all")),
        lambda s: s["all"],
    )
    masses = _let(logs, lambda all_: _let(F.array_max(all_), lambda top: F.transform(all_, lambda x: F.exp(x - top))))
    below = _let(masses, lambda m: _let(u * F.aggregate(m, F.lit(0.0), lambda a, x: a + x), lambda need: F.aggregate(
        m, F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct((s["sum"] + x).alias("sum"), (s["n"] + F.when(s["sum"] + x < need, 1).otherwise(0)).alias("n")), lambda s: s["n"],
    )))
    return F.least(least + below, most)


def _let(value: Column, use) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, shard, draws_from, draws) from (source, quota): how many of each source's draws each shard gets.

    The tree's root holds all quotas. A node gives half of its draws to its left child, as many of each source as
    drawing without replacement would (source after source, each conditional on those before), the rest to its right
    child. So the shards' sizes differ by one at most, and quotas come out exactly. `shards` is a power of two. One row
    per node, with one number per source.
    """
    node = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("none"), "source", "quota"))).alias("own")).select(F.lit(0).alias("shard"), "own")
    unit = lambda *x: F.pmod(F.xxhash64(F.lit(seed), *x), F.lit(1 << 40)) / F.lit(float(1 << 40))
    for depth in range(int(math.log2(shards))):
        total = F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        state = F.struct(F.array().cast("array<bigint>").alias("left"), total.alias("total"), F.ceil(total / 2).cast("long").alias("drawn"))

        def step(s, x):
            got = _hypergeometric(s["total"], x["quota"], s["drawn"], unit(F.lit(depth), F.col("shard"), x["source"]))  # noqa: B023  used at once
            return _let(got, lambda n: F.struct(F.concat(s["left"], F.array(n)).alias("left"), (s["total"] - x["quota"]).alias("total"), (s["drawn"] - n).alias("drawn")))

        left = node.select("shard", "own", F.aggregate("own", state, step, lambda s: s["left"]).alias("left"))
        # written at every level: the fold is evaluated once, and the expressions stay small
        node = cut(left.select(F.explode(F.array(
            F.struct((F.col("shard") * 2).alias("shard"), F.zip_with("own", "left", lambda x, n: x.withField("quota", n)).alias("own")),
            F.struct((F.col("shard") * 2 + 1).alias("shard"), F.zip_with("own", "left", lambda x, n: x.withField("quota", x["quota"] - n)).alias("own")),
        )).alias("n")).select("n.*"))
    each = node.select("shard", F.explode("own").alias("q")).select("shard", "q.source", F.col("q.quota").alias("draws"))
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("draws_from", F.coalesce(F.sum("draws").over(before), F.lit(0)))


def _draws(rows: DataFrame, shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(blocks, fills) from (source, block, size, mark): what a row's block and size decide of its copies.

    blocks: (source, block, rounds, shards_of, up_to, fill_most, source_size, target): all rows of a block are taken
    `rounds` times, those with a mark of at most `up_to` once more; shards_of holds the shard of each draw of the block, and no row
    of the source with a mark above fill_most is in fills; in the last round the row with the mark mark_out, if there is one, is
    left out, and that with mark_in taken instead, in swap_shard. fills:
    (source, size, fill_up_to, fill_shard): rows of a block that the last round leaves out are taken there if their
    size is listed and their mark is at most fill_up_to.
    """
    block_sizes = cut(rows.groupBy("source", "block").agg(F.sum("size").alias("block_size")))
    targets = source_targets(block_sizes.groupBy("source").agg(F.sum("block_size").alias("source_size")))
    # blocks without words come last, so that the blocks a share wants are the first places
    shuffled = Window.partitionBy("source").orderBy((F.col("block_size") == 0).cast("int"), F.xxhash64(F.lit(seed + 1), "source", "block"), "block")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    share = F.col("target") - F.col("rounds") * F.col("source_size")
    order = (
        block_sizes.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .select("b.source", "block", "block_size", "source_size", "target", F.floor(rate + 1e-12).alias("rounds"))
        .withColumn("place", F.row_number().over(shuffled) - 1)
        .withColumn("last_place", F.count("*").over(Window.partitionBy("source")))
        .withColumn("words_before", F.coalesce(F.sum("block_size").over(shuffled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        # words of this block that the last, partial round takes
        .withColumn("wanted", F.greatest(F.lit(0.0), F.least(F.col("block_size").cast("double"), share - F.col("words_before"))))
    )
    order = cut(order)
    # the block that a share ends in: rows in permuted order as long as they fit; rows alike in mark go together
    ends = order.where("wanted > 0 and wanted < block_size").select("source", "block", "wanted")
    inside = _same(rows, ends, ["source", "block"]).withColumn("upto", F.sum("size").over(Window.partitionBy("source", "block").orderBy("mark").rangeBetween(Window.unboundedPreceding, 0)))
    fit = inside.where("upto <= wanted").groupBy("source", "block").agg(F.max("mark").alias("up_to"), F.max("upto").alias("fitted"))
    ends = cut(_same(ends, fit, ["source", "block"], "left").withColumn("rest", F.floor(F.col("wanted") - F.coalesce("fitted", F.lit(0)) + 1e-6)))
    order = cut(_same(order, ends.select("source", "block", F.lit(True).alias("partial"), "up_to", "rest"), ["source", "block"], "left"))
    fills = cut(_fills(rows, order, ends.where("rest > 0").select("source", "rest")))
    swaps = cut(_swaps(rows, order, fills, ends.where("rest > 0").select("source", "rest")))
    # draws are numbered round after round: number = round * (number of blocks) + place; a source's fill is the last one
    used = fills.select("source", "fill_up_to").unionByName(swaps.select("source", F.lit(None).cast("long").alias("fill_up_to")))
    filled = cut(used.groupBy("source").agg(F.max("fill_up_to").alias("fill_most")).withColumn("fill", F.lit(1)))
    quotas = order.groupBy("source").agg((F.max("rounds") * F.count("*")).alias("whole"), F.sum((F.col("wanted") > 0).cast("long")).alias("more"))
    quotas = _same(quotas, filled, ["source"], "left").select("source", (F.col("whole") + F.col("more") + F.coalesce("fill", F.lit(0))).cast("long").alias("quota"), (F.col("whole") + F.col("more")).alias("fill_draw"))
    quotas = cut(quotas)
    parts = cut(split_quotas(quotas.select("source", "quota"), shards, seed).where("draws > 0"))

    def dealt(draws: DataFrame) -> DataFrame:
        on = F.col("n.source").eqNullSafe(F.col("p.source")) & (F.col("n.draw") >= F.col("p.draws_from")) & (F.col("n.draw") < F.col("p.draws_from") + F.col("p.draws"))
        return draws.alias("n").join(parts.alias("p"), on).select("n.*", "p.shard")

    rounds = F.col("rounds") - F.when(F.col("wanted") > 0, 0).otherwise(1)
    numbered = order.where(rounds >= 0).select("source", "block", F.explode(F.sequence(F.lit(0).cast("long"), rounds)).alias("round"), (F.col("round") * F.col("last_place") + F.col("place")).alias("draw"))
    by_block = dealt(numbered).groupBy("source", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("round", "shard"))), lambda d: d["shard"]).alias("shards_of"))
    everything = F.when(F.col("partial"), F.coalesce("up_to", F.lit(_LEAST_MARK))).when(F.col("wanted") > 0, _MOST_MARK).otherwise(_LEAST_MARK)
    blocks = _same(_same(order, by_block, ["source", "block"], "left"), filled, ["source"], "left")
    fill_shard = dealt(quotas.select("source", F.col("fill_draw").alias("draw"))).select("source", F.col("shard").alias("fill_shard"))
    blocks = _same(_same(blocks, swaps, ["source"], "left"), fill_shard.withColumnRenamed("fill_shard", "swap_shard"), ["source"], "left")
    blocks = blocks.select("source", "block", "rounds", "shards_of", everything.alias("up_to"), "fill_most", "source_size", "target", "mark_out", "mark_in", "swap_shard")
    return cut(blocks), cut(_same(fills.drop("words"), fill_shard, ["source"]))


_LEAST_MARK, _MOST_MARK = -(1 << 63), (1 << 63) - 1


def _same(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """a joined to b on keys, nulls being alike; b adds its other columns."""
    renamed = b.withColumnsRenamed({k: f"_b_{k}" for k in keys})
    on = [a[k].eqNullSafe(renamed[f"_b_{k}"]) for k in keys]
    return a.join(renamed, on, how).drop(*(f"_b_{k}" for k in keys))


def _fills(rows: DataFrame, order: DataFrame, rests: DataFrame) -> DataFrame:
    """(source, size, fill_up_to): which rows that the last round leaves out make up the words that it is short of.

    Sizes from the largest that fits on, each as often as it fits, as the counts allow: a fold over one number per
    different size of a source. Of a size, rows with the smallest marks are taken.
    """
    left = _same(_same(rows.where("size > 0"), rests, ["source"]).where("size <= rest"), order.select("source", "block", "wanted", "partial", "up_to"), ["source", "block"])
    left = left.where("wanted = 0 or (partial and (up_to is null or mark > up_to))").select("source", "size", "mark", "rest")
    counts = left.groupBy("source", "rest", "size").agg(F.count("*").alias("n")).groupBy("source", "rest").agg(F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("sizes"))
    state = F.struct(F.array().cast("array<struct<size:bigint,n:bigint>>").alias("taken"), F.col("rest").cast("long").alias("rest"))

    def step(s, x):
        n = F.least(x["n"], F.floor(s["rest"] / x["size"]).cast("long"))
        return F.struct(F.when(n > 0, F.concat(s["taken"], F.array(F.struct(x["size"].alias("size"), n.alias("n"))))).otherwise(s["taken"]).alias("taken"), (s["rest"] - n * x["size"]).alias("rest"))

    chosen = counts.select("source", F.explode(F.aggregate("sizes", state, step, lambda s: s["taken"])).alias("t")).select("source", "t.size", F.col("t.n").alias("n"))
    ranked = _same(left, chosen, ["source", "size"]).withColumn("upto", F.count("*").over(Window.partitionBy("source", "size").orderBy("mark").rangeBetween(Window.unboundedPreceding, 0)))
    return ranked.where("upto <= n").groupBy("source", "size").agg(F.max("mark").alias("fill_up_to"), (F.max("upto") * F.col("size")).alias("words"))


def _swaps(rows: DataFrame, order: DataFrame, fills: DataFrame, rests: DataFrame) -> DataFrame:
    """(source, mark_out, mark_in): the row of the last round and the row left out whose exchange brings a source nearest to its
    target, where it is still short of words after the fills.

    Sizes are looked for first, one row per different size of a source: for each size taken, the largest one left out that
    is larger by no more than what is missing. Then a row of each is picked, the first by mark that is not repeated.
    """
    short = _same(rests, fills.groupBy("source").agg(F.sum("words").alias("words")), ["source"], "left").select("source", (F.col("rest") - F.coalesce("words", F.lit(0))).alias("missing")).where("missing > 0")
    own = _same(_same(rows, short, ["source"]), order.select("source", "block", "wanted", "block_size", "partial", "up_to"), ["source", "block"])
    own = _same(own, fills.select("source", "size", "fill_up_to"), ["source", "size"], "left")
    taken = F.coalesce(F.when(F.col("partial"), F.coalesce(F.col("mark") <= F.col("up_to"), F.lit(False))).otherwise(F.col("wanted") > 0), F.lit(False))
    own = own.withColumn("taken", taken).where("taken or (size > 0 and (fill_up_to is null or mark > fill_up_to))").select("source", "size", "mark", "missing", "taken")
    sizes = own.groupBy("source", "missing", "taken", "size").agg(F.count("*").alias("n"))
    reach = sizes.select("source", "missing", "taken", "size", F.when(F.col("taken"), F.col("size") + F.col("missing")).otherwise(F.col("size")).alias("key"))
    upto = Window.partitionBy("source").orderBy("key", "taken")
    met = reach.withColumn("other", F.last(F.when(~F.col("taken"), F.col("size")), ignorenulls=True).over(upto)).where("taken and other > size")
    best = met.groupBy("source").agg(F.max_by(F.struct("size", "other"), F.struct(F.col("other") - F.col("size"), -F.col("size"))).alias("b")).select("source", F.col("b.size").alias("size_out"), F.col("b.other").alias("size_in"))
    asked = _same(own, best, ["source"]).where("(taken and size = size_out) or (not taken and size = size_in)")
    once = asked.groupBy("source", "taken", "mark").agg(F.count("*").alias("n")).where("n = 1")
    return once.groupBy("source").agg(F.min(F.when(F.col("taken"), F.col("mark"))).alias("mark_out"), F.min(F.when(~F.col("taken"), F.col("mark"))).alias("mark_in")).dropna(subset=["mark_out", "mark_in"])


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, blocks: int, seed: int) -> list[Column]:
    """source, size, block and mark of each row of docs, from its own columns only."""
    text, key = F.col(text_col), F.col(id_col)
    mark = F.xxhash64(F.lit(seed + 2), key, text)
    return [F.col(source_col).alias("source"), words_in(text).alias("size"), F.pmod(F.xxhash64(F.lit(seed), key, mark), F.lit(blocks)).cast("int").alias("block"), mark.alias("mark")]


def _small(df: DataFrame, most: int = 200_000) -> DataFrame:
    """A written table, marked for broadcast if it has at most so many rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _placed(rows: DataFrame, blocks: DataFrame, fills: DataFrame, seed: int, size: Column) -> DataFrame:
    """rows (source, block, mark and others) with source_size, target and places; the rows stay where they are.

    Both tables, a row per source and block, and one per source and size that fills up a rest, are broadcast while they have at most
    200,000 rows each; beyond that the rows meet them in joins. `size`, an expression over rows, is evaluated only where
    a row may be in a fill.
    """
    found = _same(rows, _small(blocks), ["source", "block"])
    found = found.withColumn("_size", F.when((F.col("mark") > F.col("up_to")) & (F.col("mark") <= F.col("fill_most")), size))
    found = _same(found, _small(fills.withColumnRenamed("size", "_size")), ["source", "_size"], "left")
    up_to = F.col("mark") <= F.col("up_to")
    in_last = up_to & ~F.col("mark").eqNullSafe(F.col("mark_out"))
    whole = F.slice("shards_of", F.lit(1), (F.col("rounds") + in_last.cast("long")).cast("int"))
    filled = F.when(~up_to & (F.col("mark") <= F.col("fill_up_to")), F.array("fill_shard")).when(~up_to & (F.col("mark") == F.col("mark_in")), F.array("swap_shard")).otherwise(F.array().cast("array<int>"))
    own = F.concat(F.coalesce(whole, F.array().cast("array<int>")), filled)
    places = F.transform(own, lambda shard, k: F.struct(shard.alias("shard"), F.xxhash64(F.lit(seed + 3), k, F.col("mark")).alias("position")))
    return found.withColumn("places", places).drop("shards_of", "up_to", "rounds", "fill_most", "fill_up_to", "fill_shard", "_size", "mark_out", "mark_in", "swap_shard")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", blocks: int = 256, shards: int = 8, seed: int = 7) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken, and `places`, where its copies go.

    size counts words (words_in). Sources, null among them as one, get targets by source_targets(). A source with
    target / size = k + f gives all its rows k times and a share f of its words once more, so taken = size * size(places)
    and no row is taken more than 3 times. places holds one (shard, position key) per copy: shuffle a shard by sorting on it.
    Rows repeated with id and text are taken alike; ids may be null. An empty table gives an empty table; other columns
    are ignored. Reruns agree. The number of sources is bounded: their targets meet in one task and a node of the tree is
    one row with all of them, folded in time quadratic in their number. Meant for named sources, not domains or URLs.

    A source's rows are dealt over `blocks` by a hash and the blocks permuted; k rounds over all blocks and then blocks in
    permuted order up to the share f are its draws, an exact quota of blocks that the splitting tree deals to the
    shards. The block that the share ends in is taken in part, rows in permuted order as long as they fit; what is still
    missing is filled up by rows that fit from the blocks left out, as one more draw, and at last a row of the share is exchanged
    for a larger one that was left out, if that brings the source nearer to its target. A row's copies follow from its block, its
    size and a hash alone, through two small tables, so no text moves and a hot source is `blocks` groups.
    """
    rows = cut(docs.select(F.col(id_col).alias("_id"), *_rows(docs, id_col, text_col, source_col, blocks, seed)))
    out = _placed(rows, *_draws(rows, shards, seed), seed, F.col("size"))
    return out.select(F.col("_id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.size("places")).alias("taken"), "places")


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", blocks: int = 256, shards: int = 8, seed: int = 7) -> DataFrame:
    """The rows of the mix, each as often as the mix takes it, in the order of shard and position, all columns unchanged.

    Every row is taken by its own places, whatever ids it shares; see mix() for odd rows. Texts move once, into their shards.
    """
    small = cut(docs.select(*_rows(docs, id_col, text_col, source_col, blocks, seed)))
    tables = _draws(small, shards, seed)
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), *(c for c, name in zip(_rows(docs, id_col, text_col, source_col, blocks, seed), ("source", "size", "block", "mark")) if name != "size"))
    copies = _placed(whole, *tables, seed, words_in(F.col(f"_doc.`{text_col}`"))).select("_doc", F.explode("places").alias("place"))
    # a position is a hash, so equal ranges of it are equal parts of a shard, and no pass over the texts has to find them
    parts = max(1, -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards))
    part = F.least(F.floor((F.col("place.position") / F.lit(2.0**64) + 0.5) * parts), F.lit(parts - 1))
    dealt = copies.repartitionById(parts * shards, (F.col("place.shard") * parts + part).cast("int"))
    return dealt.sortWithinPartitions("place.shard", "place.position").select("_doc.*")
