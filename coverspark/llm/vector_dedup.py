"""Near-duplicate embeddings through a pivot-permutation index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from coverspark.llm.graph import components
from coverspark.llm.rows import by_own_key
from coverspark.llm.tiles import LINKS, TILE, by_tile, links_of, padded, seen_before, shared, tile_edges, tiled
from coverspark.session import cut, ship


def unit_rows(vectors: list[np.ndarray]) -> np.ndarray:
    """The vectors in double precision, of length 1."""
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x /= np.abs(x).max(1, keepdims=True)  # keeps squares of very large and very small numbers finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


#: Most numbers (components) that the driver takes as a sample, and most pivots.
_SAMPLE, _MOST_PIVOTS = 1 << 23, 1 << 16
#: Lists longer than this are compared block against block.
_BLOCK = 2048
_JUDGED = 2000


@dataclass(frozen=True)
class PivotIndex:
    """Pivots from the rarest to the most frequent, how many nearest ones, in order, describe a vector, how many two must share,
    and by how many places these may differ in their orders."""

    pivots: np.ndarray
    nearest: int
    common: int
    shift: int


def thinned(x: np.ndarray, most: int, close: float) -> np.ndarray:
    """Up to `most` of the unit rows of x, in order, without those whose cosine to a row already taken is above `close`."""
    if close >= 1:
        return x[:most]
    taken = x[:0]
    for a in range(0, len(x), 1024):
        part = x[a : a + 1024]
        if len(taken):
            part = part[(part @ taken.T).max(1) <= close]
        free, alike, own = np.ones(len(part), bool), part @ part.T > close, []
        while free.any():
            own.append(int(free.argmax()))
            free &= ~alike[own[-1]]
            free[own[-1]] = False
        taken = np.concatenate([taken, part[own]])
        if len(taken) >= most:
            break
    return taken[:most]


def permutations(x: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of each row's `nearest` nearest pivots, nearest first."""
    nearest, out = min(nearest, len(pivots)), []
    step = max(1, (1 << 22) // max(1, len(pivots)))
    for a in range(0, len(x), step):
        near = x[a : a + step] @ pivots.T
        first = np.argpartition(-near, nearest - 1, axis=1)[:, :nearest]
        order = np.argsort(-np.take_along_axis(near, first, 1), axis=1, kind="stable")
        out.append(np.take_along_axis(first, order, 1))
    return np.concatenate(out) if out else np.empty((0, nearest), np.int64)


def listed_under(near: np.ndarray, common: int) -> np.ndarray:
    """The pivots that each row is listed under: all but the `common` - 1 most frequent of its nearest ones.

    Two rows that share `common` pivots share one of these: of the shared ones the rarest has `common` - 1 others after it.
    """
    return np.sort(near, axis=1)[:, : near.shape[1] - common + 1]


def shared_counts(x: np.ndarray, y: np.ndarray, shift: int) -> np.ndarray:
    """How many pivots each row of x shares with each row of y at places that differ by `shift` at most.

    The rows of y are inverted: per pivot, the place that it has in each of them. The lists of x's pivots are added up.
    """
    pivots, at = np.unique(y, return_inverse=True)
    places = np.full((len(pivots) + 1, len(y)), 127, np.int8)  # the last list is empty: pivots that no row of y has
    places[at.reshape(y.shape), np.arange(len(y))[:, None]] = np.arange(y.shape[1], dtype=np.int8)
    found = np.searchsorted(pivots, x)
    found = np.where((found < len(pivots)) & (pivots[np.minimum(found, len(pivots) - 1)] == x), found, len(pivots)) if len(pivots) else np.zeros_like(x)
    out = np.zeros((len(x), len(y)), np.int8)
    if shift >= max(x.shape[1], y.shape[1]) - 1:  # any places will do
        listed = (places != 127).view(np.int8)
        for place in range(x.shape[1]):
            out += listed[found[:, place]]
        return out
    for place in range(x.shape[1]):
        lists = places[found[:, place]]
        out += (lists >= place - shift) & (lists <= min(place + shift, 126))
    return out


def _pair_counts(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    """The same for the pairs (a[i], b[i])."""
    k = np.arange(a.shape[1])
    return ((a[:, :, None] == b[:, None, :]) & (np.abs(k[:, None] - k) <= shift)).any(2).sum(1)


def _trial_pairs(x: np.ndarray, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs to measure recall on: at a cosine of exactly `threshold` towards other rows, and the rows' own links."""
    rng = np.random.default_rng(11)
    a = x[-_JUDGED:]
    other = a[rng.permutation(len(a))]
    away = other - (other * a).sum(1, keepdims=True) * a
    length = np.sqrt((away * away).sum(1, keepdims=True))
    some = length[:, 0] > 1e-6
    a, away = a[some], away[some] / length[some]
    out = [(a, threshold * a + np.sqrt(max(0.0, 1 - threshold**2)) * away)]
    own = x[-2 * _JUDGED :]
    i, j = np.nonzero(np.triu(own @ own.T >= threshold, 1))
    if len(i):
        pick = rng.permutation(len(i))[:_JUDGED]
        out.append((own[i[pick]], own[j[pick]]))
    return [p for p in out if len(p[0])]


def plan_index(x: np.ndarray, n_pivots: int, threshold: float, target: float) -> PivotIndex | None:
    """The cheapest index by which `target` of the trial pairs meet; None if there is none, so that all must be compared.

    x are unit rows in random order. Pivots are thinned to several degrees, as a cluster that holds many pivots would tell
    its members apart by noise. The cost of an index is the expected number of comparisons in its lists.
    """
    trials, judged = _trial_pairs(x, threshold), x[-_JUDGED:]
    best, cost, before = None, float("inf"), -1
    for close in (1.0, 0.9, 0.8, 0.65, 0.5):
        pivots = thinned(x[: max(1, 3 * len(x) // 4)], n_pivots, close)
        if len(pivots) == before or len(pivots) < 16:
            continue
        before = len(pivots)
        k_most = min(64, len(pivots) // 4)
        own = permutations(judged, pivots, k_most)
        both = [(permutations(a, pivots, k_most), permutations(b, pivots, k_most)) for a, b in trials]
        for k in (4, 8, 16, 32, 64):
            if k > k_most:
                break
            first = [(a[:, :k], b[:, :k]) for a, b in both]
            met = [_pair_counts(a, b, k) for a, b in first]
            common = max((c for c in range(1, k // 2 + 1) if all((m >= c).mean() >= target for m in met)), default=0)
            if not common:
                continue
            order = np.argsort(np.bincount(own[:, :k].ravel(), minlength=len(pivots)), kind="stable")
            rank = np.empty(len(pivots), np.int64)
            rank[order] = np.arange(len(pivots))
            for c in {1, common}:
                under = listed_under(rank[own[:, :k]], c)
                n = np.bincount(under.ravel()).astype(float)
                meets = (n * (n - 1)).sum() / max(1, len(judged) * (len(judged) - 1))
                # a row's comparisons as a share of all rows, and what a listing costs besides
                own_cost = meets + under.shape[1] * 1e-3
                if own_cost < cost:
                    # the least shift that still brings the trial pairs together
                    shift = next((s for s in (1, 2, 4, 8, 16, 32) if s < k and all((_pair_counts(a, b, s) >= c).mean() >= target for a, b in first)), k)
                    best, cost = PivotIndex(pivots[order], k, c, shift), own_cost
    return best if cost < 1 else None


def vector_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, pivots_per_root: float = 8.0, target_recall: float = 0.998) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Two vectors are linked when their cosine, in double precision, is `threshold` or more. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, nor do rows without an id or vectors of
    different lengths. Rows alike in id and vector count as two vectors. component_id is the smallest id reachable
    over links, kept is id = component_id. Ids may be of any type that has an order. Other columns are ignored; an empty table gives an empty table.

    Equal vectors are one class first, so a hot vector is one row. Up to `pivots_per_root` * sqrt(classes) (65,536 at most)
    of a bounded sample (at most 2**23 components, the first classes by a hash of the vector) are pivots. Every class is
    described by its nearest pivots, in order, and stands, with that order, in the inverted lists of all but the most frequent of
    them; so two that share `common` pivots meet in a list. There the pivots that two classes share at places at most
    `shift` apart are counted, and only pairs with `common` or more are verified by their cosine. plan_index
    chooses the pivots, how many describe a vector, `common` and `shift` from the sample, so that `target_recall` of pairs at the
    threshold, and of the sample's own links, are verified, at the least cost; the target is the same for tables of any size. Lists
    of any length are compared whole, in tiles; each found pair counts in the first list that both are in. With pivots growing as
    the square root, a list does, too.

    Where no index reaches the target (vectors that are all close, or fewer than 128 of a length in the sample), all are compared
    with all, in tiles: no link is lost, but the work is a matrix product that grows with the square of their number.
    """
    spark = vectors.sparkSession
    ship(spark)
    if not isinstance(vectors.schema[id_col].dataType, IntegralType):
        return by_own_key(vectors, id_col, vector_col, lambda rows, key: vector_dedup(rows, key, vector_col, threshold, pivots_per_root, target_recall))
    raw = F.col(vector_col).cast("array<double>")
    usable = F.coalesce((F.size(raw) > 0) & F.forall(raw, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(raw, lambda v: v != 0) & F.col(id_col).isNotNull(), F.lit(False))
    rows = cut(vectors.select(F.col(id_col).cast("long").alias("_id"), F.when(usable, raw).alias("_v")))
    # classes of equal vectors; written, so that a hot vector is a plain skewed join at the end
    classes = cut(rows.where("_v is not null").groupBy("_v").agg(F.min("_id").alias("id"), F.count("*").alias("copies")))
    n, longest = classes.agg(F.count("*"), F.max(F.size("_v"))).first()
    wanted = min(_MOST_PIVOTS, max(64, int(pivots_per_root * n**0.5)))
    picked = classes.orderBy(F.xxhash64("_v"), "id").limit(max(1, min(4 * wanted, _SAMPLE // (longest or 1)))).select("_v").toArrow().column(0)
    by_length: dict[int, list] = {}
    for chunk in picked.chunks:
        for own in (chunk[k].values.to_numpy() for k in range(len(chunk))):
            by_length.setdefault(len(own), []).append(own)
    plans = {k: plan_index(unit_rows(v), wanted, threshold, target_recall) for k, v in by_length.items() if len(v) >= 128}

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for length, part in b.groupby(b["vector"].map(len)):
                x, own = unit_rows(list(part["vector"])), plans.get(length)
                # vectors of a length without an index are compared with one another, in tiles
                near = np.zeros((len(x), 1), np.int64) if own is None else permutations(x, own.pivots, own.nearest)
                under = near if own is None else 1 + listed_under(near, own.common)
                yield part.assign(vector=list(x), keys=list(under * 65536 + min(length, 65535)), near=list(near))

    listed = cut(classes.select("id", "copies", F.col("_v").alias("vector")).mapInPandas(index, "id long, copies long, vector array<double>, keys array<long>, near array<int>"))
    members = shared(listed.select("id", F.explode("keys").alias("bucket")))
    tiles = tiled(members, _BLOCK).join(listed, "id")

    rules = {k: (p.common, p.shift) for k, p in plans.items() if p}

    def close_pairs(x, y, x_near, y_near, rule: tuple[int, int] | None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows that share enough pivots, if they are indexed, and are linked. Candidates that are most of a tile are verified
        by one matrix product, and near the threshold all by their own sum."""
        enough = np.ones((len(x), len(y)), bool) if rule is None else shared_counts(x_near, y_near, rule[1]) >= rule[0]
        if enough.size and enough.mean() > 0.02:
            cosine = x @ y.T
            i, j = np.nonzero(enough & (cosine >= threshold - 1e-9))
        else:
            i, j = np.nonzero(enough)
        sure = np.zeros(len(i), bool)
        for a in range(0, len(i), 1 << 15):
            b = a + (1 << 15)
            sure[a:b] = (x[i[a:b]] * y[j[a:b]]).sum(1) >= threshold
        return i[sure], j[sure]

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, bucket, own, low, high = padded(list(pdf["keys"])), *(pdf[c].values for c in ("bucket", "own", "lo", "hi"))
        lengths = pdf["vector"].map(len).values
        at, to = [np.empty(0, int)], [np.empty(0, int)]
        edges = tile_edges(pdf)
        for a, b in zip(edges, edges[1:]):
            for length in np.unique(lengths[a:b]):
                here = a + np.flatnonzero(lengths[a:b] == length)
                left = here if low[a] == high[a] else here[own[here] == low[a]]
                right = here if low[a] == high[a] else here[own[here] == high[a]]
                x, y = (np.stack(pdf["vector"].values[side]) if len(side) else np.empty((0, length)) for side in (left, right))
                i, j = close_pairs(x, y, *(np.stack(pdf["near"].values[side]) if len(side) else np.empty((0, 1), int) for side in (left, right)), rules.get(length))
                if low[a] == high[a]:
                    i, j = i[i < j], j[i < j]
                i, j = left[i], right[j]
                new = ~seen_before(keys, bucket, i, j)
                at.append(i[new])
                to.append(j[new])
        return links_of(pdf, np.concatenate(at), np.concatenate(to))

    found = cut(by_tile(tiles.select(*TILE, "own", "id", "copies", "vector", "keys", "near"), judge, LINKS))
    n_links = found.groupBy("id").agg(F.sum("n_links").alias("_links"))
    part = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    solved = cut(classes.join(n_links, "id", "left").join(part, "id", "left").select("_v", F.coalesce("component", "id").alias("_component"), (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_links")))
    out = rows.join(solved, "_v", "left")
    component = F.coalesce("_component", "_id")
    return out.select(F.col("_id").alias(id_col), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"))
