"""All pairs of many buckets in bounded tiles, each pair judged once, without emitting pairs.

A bucket is dealt over blocks of about `BLOCK` members; a tile holds one block, or two blocks to be
compared with each other. So a bucket of any size is compared exactly, over as many tasks as it needs.
A pair that shares several buckets is judged only in the first of them (the smallest bucket number), so
link counts add up without a list of pairs; what leaves a tile is one row per linked member.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverspark.llm.texts import give_back

BLOCK, WEIGHT = 512, 1 << 20
TILE = ["bucket", "lo", "hi"]


def tiled(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """(bucket, lo, hi, id) from (bucket, id, members): each member once per tile of its bucket, in blocks of about `block`
    members and, where there is a column weight (of the whole bucket), of about WEIGHT."""
    blocks = F.ceil(F.col("members") / F.lit(block)).cast("int")
    if "weight" in members.columns:
        blocks = F.greatest(blocks, F.least("members", F.ceil(F.col("weight") / F.lit(WEIGHT))).cast("int"))
    own = members.select("bucket", "id", blocks.alias("_n"), F.pmod(F.xxhash64("id", "bucket"), blocks).cast("int").alias("_own"))
    each = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return each.select("bucket", F.least("_own", "_other").alias("lo"), F.greatest("_own", "_other").alias("hi"), "id", F.col("_own").alias("own"))


def shared(members: DataFrame, weight: str | None = None) -> DataFrame:
    """(bucket, id, members) of the buckets with at least two members, from (bucket, id), and the sum of `weight`, if named."""
    more = [F.sum(weight).alias("weight")] if weight else []
    sizes = members.groupBy("bucket").agg(F.count("*").alias("members"), *more).where("members > 1")
    return members.join(sizes, "bucket")


def by_tile(df: DataFrame, judge: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Call `judge` on frames that hold whole tiles, sorted by tile."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            last = batch.iloc[-1]
            same = (batch["bucket"].values == last["bucket"]) & (batch["lo"].values == last["lo"]) & (batch["hi"].values == last["hi"])
            if same.all():
                continue
            n = len(batch) - int(same.sum())
            whole = pd.concat([*held[:-1], batch.iloc[:n]], ignore_index=True)
            held = [batch.iloc[n:]]
            yield judge(whole)
        if held:
            yield judge(pd.concat(held, ignore_index=True))
        held.clear()
        give_back()

    return df.repartition(*TILE).sortWithinPartitions(*TILE).mapInPandas(run, schema)


def tile_edges(pdf: pd.DataFrame) -> np.ndarray:
    """Where the tiles of a sorted frame begin, and its end."""
    bucket, lo, hi = (pdf[c].values for c in TILE)
    return np.r_[0, np.flatnonzero((bucket[1:] != bucket[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1, len(bucket)]


def tile_pairs(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (i, j) to compare, in runs: i and j in one tile, across its two blocks if it has two, with unequal ids."""
    bucket, lo, hi, own, ids = (pdf[c].values for c in ("bucket", "lo", "hi", "own", "id"))
    changed = np.r_[True, (bucket[1:] != bucket[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
    end = np.repeat(np.r_[np.flatnonzero(changed)[1:], len(bucket)], np.diff(np.r_[np.flatnonzero(changed), len(bucket)]))
    rows = np.arange(len(bucket))
    d = 1
    while len(rows := rows[rows + d < end[rows]]):
        i, j = rows, rows + d
        ok = ((lo[i] == hi[i]) | (own[i] != own[j])) & (ids[i] != ids[j])
        i, j = i[ok], j[ok]
        for a in range(0, len(i), 8192):
            yield i[a : a + 8192], j[a : a + 8192]
        d += 1


def seen_before(table: np.ndarray, bucket: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether a bucket before this one has both rows; table: each row's buckets, padded."""
    here, right, found = bucket[i], table[j], np.zeros(len(i), bool)
    for k in range(table.shape[1]):
        key = table[i, k]
        todo = np.flatnonzero((key < here) & ~found)
        if len(todo):
            found[todo] = (right[todo] == key[todo, None]).any(1)
    return found


def padded(keys: list[np.ndarray]) -> np.ndarray:
    """One row of buckets each, filled up with the largest number, which is before no bucket."""
    table = np.full((len(keys), max(map(len, keys))), np.iinfo(np.int64).max)
    for k, own in enumerate(keys):
        table[k, : len(own)] = own
    return table


def links_of(pdf: pd.DataFrame, i: np.ndarray, j: np.ndarray) -> pd.DataFrame:
    """(id, n_links, root) per linked member: weighted number of links, and the smallest id that these links reach."""
    n = len(pdf)
    copies, ids = pdf["copies"].values.astype(np.int64), pdf["id"].values.astype(np.int64)
    links = np.zeros(n, np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    root = ids.copy()
    while True:  # labels only fall, and only within a tile's links
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (root == before).all():
            break
    linked = np.zeros(n, bool)
    linked[i] = linked[j] = True
    return pd.DataFrame({"id": ids[linked], "n_links": links[linked], "root": root[linked]})


LINKS = "id long, n_links long, root long"
