"""N-gram Jaccard self-join of texts by chosen paths."""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from coverspark.llm.graph import components
from coverspark.llm.rows import by_own_key, free_name, keyed, without
from coverspark.llm.shingles import mix, texts_shingles
from coverspark.llm.texts import map_texts
from coverspark.llm.tiles import LINKS, TILE, by_tile, links_of, padded, seen_before, shared, tile_pairs, tiled
from coverspark.session import cut, ship

COORDINATES = 64
#: A set goes to this many children where a bucket splits.
_CHILDREN = 2
_SLACK = 0.3
_DENSE = 48
_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The sampled tokens of a set: under each of 64 orders its first token, as a 32-bit number."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 4096):
        h = shingles[a : a + 4096] * _SEEDS[:, None]
        np.minimum(low, (h ^ (h >> np.uint64(29))).min(1), out=low)
    return (mix(low) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def runs_for(threshold: float, target_recall: float, splits: int) -> int:
    """Runs that find a pair at the threshold with this probability, even if its buckets split `splits` times."""
    once = threshold * (1 - (1 - threshold) ** _CHILDREN) ** splits
    return min(COORDINATES, max(1, math.ceil(math.log(1 - target_recall) / math.log(max(1e-9, 1 - once)))))


def _digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _sketches(n: int):
    def of(texts: list[str | None]) -> dict[str, list]:
        sets = texts_shingles(texts, n)
        return {"digest": [_digest(s) for s in sets], "n": [len(s) for s in sets], "sketch": [sketch(s) if len(s) else None for s in sets]}

    return lambda: of


def _sets(n: int):
    def of(texts: list[str | None]) -> dict[str, list]:
        sets = texts_shingles(texts, n)
        return {"digest": [_digest(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]}

    return lambda: of


def _leaves(nodes: DataFrame, runs: int, limit: int, splits: int) -> DataFrame:
    """(bucket, id, members, weight): split on sampled tokens until buckets are small, or dense, or `splits` is reached.

    A large bucket is dense if under every token order that it samples at least half of its members agree: splitting
    would only repeat it, so it is compared as it is.
    """
    entries = nodes.select("id", "n", F.posexplode(F.slice("sketch", 1, runs)).alias("run", "token")).select("id", "n", F.xxhash64("run", "token").alias("bucket")).distinct()
    leaves = []
    for level in range(splits + 1):
        sized = cut(shared(entries, "n"))
        large = sized.where(F.col("members") > limit)
        if level == splits or large.isEmpty():
            leaves.append(sized)
            break
        # each node samples its own tokens: the choice hangs on the path so far
        first = F.pmod(F.xxhash64(F.lit(level), "bucket"), F.lit(COORDINATES)).cast("int")
        step = (1 + F.pmod(F.xxhash64("bucket", F.lit(level)), F.lit(COORDINATES // _CHILDREN - 1))).cast("int")
        chosen = large.withColumn("coordinate", F.explode(F.array(*(F.pmod(first + F.lit(k) * step, F.lit(COORDINATES)) for k in range(_CHILDREN)))))
        children = cut(chosen.join(nodes.select("id", "sketch"), "id").select("id", "n", "bucket", "members", "coordinate", F.xxhash64("bucket", "coordinate", F.element_at("sketch", F.col("coordinate") + 1)).alias("child")))
        agreeing = children.groupBy("bucket", "members", "coordinate", "child").agg(F.count("*").alias("agree")).groupBy("bucket", "members", "coordinate").agg(F.max("agree").alias("agree"))
        dense = agreeing.groupBy("bucket", "members").agg(F.min("agree").alias("agree")).where("2 * agree >= members").select("bucket")
        leaves += [sized.where(F.col("members") <= limit), large.join(dense, "bucket", "left_semi")]
        entries = children.join(dense, "bucket", "left_anti").select("id", "n", F.col("child").alias("bucket")).distinct()
    return reduce(DataFrame.unionByName, leaves)


def _likely(threshold: float):
    """Members of a tile with a partner whose sampled tokens agree well enough, judged in their first bucket."""

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        s, keys, bucket = np.stack(pdf["sketch"].values), padded(list(pdf["keys"])), pdf["bucket"].values
        hit = np.zeros(len(pdf), bool)
        for i, j in tile_pairs(pdf):
            near = (s[i] == s[j]).sum(1) >= (threshold - _SLACK) * COORDINATES
            i, j = i[near], j[near]
            new = ~seen_before(keys, bucket, i, j)
            hit[i[new]] = hit[j[new]] = True
        return pdf.loc[hit, [*TILE, "own", "id"]]

    return judge


def _verified(threshold: float):
    """Exact similarity of the likely pairs of each tile."""

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        s, keys, bucket = np.stack(pdf["sketch"].values), padded(list(pdf["keys"])), pdf["bucket"].values
        sets = list(pdf["shingles"])
        size = np.array([len(x) for x in sets])
        at, to = [np.empty(0, int)], [np.empty(0, int)]
        for i, j in tile_pairs(pdf):
            near = (s[i] == s[j]).sum(1) >= (threshold - _SLACK) * COORDINATES
            near &= np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])
            i, j = i[near], j[near]
            new = ~seen_before(keys, bucket, i, j)
            at.append(i[new])
            to.append(j[new])
        i, j = np.concatenate(at), np.concatenate(to)
        both = _overlaps(sets, np.cumsum(np.r_[False, (bucket[1:] != bucket[:-1]) | (pdf["lo"].values[1:] != pdf["lo"].values[:-1]) | (pdf["hi"].values[1:] != pdf["hi"].values[:-1])]), i, j)
        close = both >= threshold * (size[i] + size[j] - both)
        return links_of(pdf, i[close], j[close])

    return judge


def _overlaps(sets: list[np.ndarray], tile: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of shared tokens of each pair; i and j are in one tile."""
    out = np.zeros(len(i), np.int64)
    order = np.argsort(tile[i], kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(tile[i][order])) + 1):
        if len(part) < _DENSE:
            for p in part:
                a, b = sets[i[p]], sets[j[p]]
                out[p] = len(a) + len(b) - len(np.union1d(a, b))
            continue
        rows, back = np.unique(np.r_[i[part], j[part]], return_inverse=True)
        a, b = back[: len(part)], back[len(part) :]
        tokens, col, times = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
        often = times >= 2
        number = np.cumsum(often) - 1
        use = often[col]
        row, col = row[use], number[col[use]]
        by = np.argsort(col, kind="stable")
        row, col = row[by], col[by]
        together = np.zeros((len(rows), len(rows)), np.float64)
        for start in range(0, int(often.sum()), 4096):
            lo, hi = np.searchsorted(col, [start, start + 4096])
            m = np.zeros((len(rows), min(4096, int(often.sum()) - start)), np.float32)
            m[row[lo:hi], col[lo:hi] - start] = 1
            together += m @ m.T
        out[part] = together[a, b].astype(np.int64)
    return out


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, target_recall: float = 0.99999, limit: int = 256, splits: int = 2) -> DataFrame:
    """One row per input row: id, component_id, n_links, kept.

    Two documents are linked when the Jaccard similarity of their sets of `n`-word shingles (64-bit hashes; words
    are runs of letters, digits and non-ASCII characters, lower-cased) is `threshold` or more. A text of fewer than
    `n` words has one shingle of all its words; null, empty and wordless texts link with nothing, nor do rows
    without an id, whose component is null. Ids may be of any type that has an order. Repeated rows count as documents of their own. component_id is the
    smallest id reachable over links; kept marks it. Other columns are ignored; an empty table gives an empty one.

    Equal sets are one class first. Each run puts a class into the bucket of one sampled token; buckets over `limit`
    split again on tokens that their path samples, `splits` times at most; a bucket that is dense, so that no split
    would part it, or still large in the end is compared whole, in tiles, whose blocks are bounded in members and in shingles.
    runs_for() gives the number of runs for the target recall; a pair at the threshold is missed with probability 1 - target_recall at most, a closer one less. Likely pairs are verified on their whole sets.
    """
    spark = docs.sparkSession
    ship(spark)
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        return by_own_key(docs, id_col, text_col, lambda rows, key: jaccard_join(rows, key, text_col, n, threshold, target_recall, limit, splits))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    sketched = cut(map_texts(texts.where("_id is not null"), "_text", _sketches(n), {"digest": pa.binary(), "n": pa.int64(), "sketch": pa.list_(pa.int32())}))
    # classes of equal sets; written, so that a hot class is a plain skewed join at the end
    named = sketched.where("digest is not null")
    classes = cut(named.groupBy("digest").agg(F.min("_id").alias("id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    leaves = cut(_leaves(classes, runs_for(threshold, target_recall, splits), limit, splits))
    # a class has a bounded number of leaves: runs x children
    nodes = cut(leaves.groupBy("id").agg(F.array_sort(F.collect_set("bucket")).alias("keys")).join(classes, "id"))
    likely = cut(by_tile(tiled(leaves).join(nodes, "id").select(*TILE, "own", "id", "keys", "sketch"), _likely(threshold), "bucket long, lo int, hi int, own int, id long"))
    wanted = likely.select("id").distinct()
    sets = map_texts(texts.join(wanted, F.col("_id") == F.col("id"), "left_semi").withColumnRenamed("_id", "id"), "_text", _sets(n), {"digest": pa.binary(), "shingles": pa.list_(pa.int64())})
    full = likely.join(nodes.join(sets.dropDuplicates(["id", "digest"]), ["id", "digest"]), "id")
    found = cut(by_tile(full.select(*TILE, "own", "id", "copies", "keys", "sketch", "shingles"), _verified(threshold), LINKS))
    n_links = found.groupBy("id").agg(F.sum("n_links").alias("_links"))
    part = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    solved = cut(classes.select("digest", "id", "copies").join(n_links, "id", "left").join(part, "id", "left").select("digest", F.coalesce("component", "id").alias("_component"), (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_links")))
    linked = sketched.select("_id", "digest").join(solved, "digest", "left")
    linked = linked.unionByName(texts.where("_id is null").select("_id", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("_component"), F.lit(None).cast("long").alias("_links")))
    component = F.coalesce("_component", "_id")
    return linked.select(F.col("_id").alias(id_col), component.alias("component_id"), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), F.col("_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` that stay, one of each group, all columns unchanged: the one with the smallest id.

    Rows are joined by a key of their own, so rows that share an id or have none are documents of their own; of a
    group, rows without an id stay only where none has one. Wordless texts are in no group and stay.
    """
    key = free_name(docs, "_row_key")
    rows = keyed(docs, key)
    parts = jaccard_join(rows.select(key, text_col), key, text_col, **options).where("n_links > 0").select(key, "component_id")
    parts = cut(rows.select(key, F.col(id_col).alias("_id")).join(cut(parts), key))
    first = cut(parts.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", key))[key].alias("_first")))
    gone = cut(parts.join(first, "component_id").where(F.col(key) != F.col("_first")).select(key))
    return without(rows, gone, key)
