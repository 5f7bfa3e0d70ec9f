"""Shards of near equal bytes by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverspark.llm.ranks import spread_rank
from coverspark.session import cut


@dataclass
class _Node:
    room: tuple[float, int]
    left: _Node | None = None
    right: _Node | None = None
    height: int = 1


class Rooms:
    """(room, bin) pairs in a balanced (AVL) tree: insert, and take out the least that is not below a size."""

    def __init__(self):
        self.top: _Node | None = None

    def insert(self, room: tuple[float, int]) -> None:
        self.top = self._insert(self.top, room)

    def take(self, size: float) -> tuple[float, int] | None:
        """The tightest room of at least `size`, taken out; None if there is none."""
        at, found = self.top, None
        while at:
            at, found = (at.left, at.room) if at.room >= (size, -1) else (at.right, found)
        if found is not None:
            self.top = self._remove(self.top, found)
        return found

    def _insert(self, at: _Node | None, room) -> _Node:
        if at is None:
            return _Node(room)
        if room < at.room:
            at.left = self._insert(at.left, room)
        else:
            at.right = self._insert(at.right, room)
        return self._even(at)

    def _remove(self, at: _Node, room) -> _Node | None:
        if room < at.room:
            at.left = self._remove(at.left, room)
        elif room > at.room:
            at.right = self._remove(at.right, room)
        elif at.left is None or at.right is None:
            return at.left or at.right
        else:
            low = at.right
            while low.left:
                low = low.left
            at.room, at.right = low.room, self._remove(at.right, low.room)
        return self._even(at)

    @staticmethod
    def _sized(at: _Node) -> _Node:
        at.height = 1 + max(at.left.height if at.left else 0, at.right.height if at.right else 0)
        return at

    def _even(self, at: _Node) -> _Node:
        lean = lambda n: (n.left.height if n.left else 0) - (n.right.height if n.right else 0)
        self._sized(at)
        if lean(at) > 1:
            if lean(at.left) < 0:
                at.left = self._turn_left(at.left)
            return self._turn_right(at)
        if lean(at) < -1:
            if lean(at.right) > 0:
                at.right = self._turn_right(at.right)
            return self._turn_left(at)
        return at

    def _turn_right(self, at: _Node) -> _Node:
        up = at.left
        at.left, up.right = up.right, at
        self._sized(at)
        return self._sized(up)

    def _turn_left(self, at: _Node) -> _Node:
        up = at.right
        at.right, up.left = up.left, at
        self._sized(at)
        return self._sized(up)


def best_fit_runs(sizes: list[tuple[float, int]], capacity: float) -> list[tuple[int, int, int]]:
    """(place in sizes, bin, number of items) by best-fit decreasing of (size, number) pairs, largest size first.

    Each item goes into the fitting bin with the least room, else a new one. Items of one size fill such a bin one after
    the other while it fits, so they are placed in runs. An item above the capacity has a bin of its own.
    """
    rooms, out, bins = Rooms(), [], 0
    for k, (size, left) in enumerate(sizes):
        while left:
            found = rooms.take(size)
            if found is None:
                found, bins = (capacity, bins), bins + 1
            room, b = found
            n = max(1, min(left, int(room // size) if size else left))
            out.append((k, b, n))
            left -= n
            rooms.insert((room - n * size, b))
    return out


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item, by best_fit_runs."""
    out = [0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda k: (-sizes[k], k))
    for k, b, _ in best_fit_runs([(sizes[k], 1) for k in order], capacity):
        out[order[k]] = b
    return out


def runs_into_bins(sizes: list[tuple[float, int]], bins: int) -> list[tuple[int, int, int]]:
    """best_fit_runs with the smallest capacity that needs no more than `bins` bins, to a part in 1,000,000."""
    if not sizes:
        return []
    even = sum(s * n for s, n in sizes) / bins
    # with room for one more of the largest, every bin could hold its even part before another is opened
    low, high = max(sizes[0][0], even), even + sizes[0][0]
    while high - low > max(0.5, high / 1_000_000):
        middle = (low + high) / 2
        low, high = (low, middle) if max(b for _, b, _ in best_fit_runs(sizes, middle)) < bins else (middle, high)
    return best_fit_runs(sizes, high)


def into_bins(sizes: list[int], bins: int) -> list[int]:
    """Bin of each item, by runs_into_bins."""
    out = [0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda k: (-sizes[k], k))
    for k, b, _ in runs_into_bins([(sizes[k], 1) for k in order], bins):
        out[order[k]] = b
    return out


def shard_by_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8, parcels: int = 4096) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    size is UTF-8 bytes of the text (null: none) plus 1, text_crc32 its unsigned CRC-32 (null: 0). The law is `bytes`:
    shards get near equal sums of sizes while equal texts (null counts as empty) stay together; a group larger than
    a shard's part has a shard for itself. slot is gapless from 0 in each shard, grown_shard null. Rows may repeat and
    ids be null; other columns are ignored; an empty table gives an empty table.

    Best-fit decreasing packs groups of equal texts, the indivisible items. The driver sees how many groups there are of
    each size, and their mean: a size up to 2 * `parcels` bytes by itself, larger ones in `parcels` classes per
    doubling (a class of one group has its own size), which bounds its table by 60 * `parcels` rows however many groups
    there are. It places runs of groups of one class, and every group finds its run by its rank in its class. Texts do not
    move: groups are found on SHA-256.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    rows = cut(docs.select(F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), digest.alias("digest")))
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    low_bits = F.expr(f"cast(greatest(0, floor(log2(bytes)) - {parcels.bit_length() - 1}) as int)")
    groups = cut(groups.withColumn("low_bits", low_bits).withColumn("class", F.expr("shiftleft(shiftright(bytes, low_bits), low_bits)")).drop("low_bits"))
    classes = groups.groupBy("class").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).collect()
    classes = sorted(((r["bytes"] / r["n"], r["n"], r["class"]) for r in classes), reverse=True)
    used: dict[int, int] = {}
    ranges = []
    for k, b, n in runs_into_bins([(size, n) for size, n, _ in classes], shards):
        at = used.get(k, 0)
        ranges.append((classes[k][2], at, at + n, b))
        used[k] = at + n
    places = docs.sparkSession.createDataFrame(ranges, "class long, rank_from long, rank_to long, shard int")
    ranked = spread_rank(groups, ["class"], [F.col("digest")], "_rank")
    placed = cut(ranked.join(F.broadcast(places), "class").where("_rank >= rank_from and _rank < rank_to").select("digest", "shard"))
    own = cut(rows.join(placed, "digest").select("_id", "size", "text_crc32", "shard"))
    slots = spread_rank(own, ["shard"], [F.col("_id"), F.col("text_crc32"), F.col("size")], "slot")
    return slots.select(F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
