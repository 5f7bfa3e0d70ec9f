"""Packing token sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverspark.llm.ranks import spread_rank
from coverspark.llm.texts import give_back
from coverspark.llm.tokens import Encoder, groups
from coverspark.session import cut, ship


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """A multiset of at most `counts` lengths that holds the largest length and sums as near to `capacity` as any such.

    Subset sums are bits of an integer: bit s is set if s can be reached. One bitset is kept per length, largest
    first, and the way back from the best sum tells how often each length is taken.
    """
    lengths = sorted(counts, reverse=True)
    first = lengths[0]
    room = capacity - first
    mask, reach, before = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        before.append(reach)
        left, times = counts[length] - (length == first), 1
        left = min(left, room // length)
        while left > 0:  # 1, 2, 4, ... copies at once: every number up to the count can be made
            step = min(times, left)
            reach |= (reach << (length * step)) & mask
            left -= step
            times *= 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {first: 1}
    for length, old in zip(reversed(lengths[: len(before)]), reversed(before)):
        used = 0
        while not old >> total & 1:  # the fewest copies of this length that leave a sum the longer ones reach
            total -= length
            used += 1
        if used:
            taken[length] = taken.get(length, 0) + used
    return taken


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, multiset) until no length is left. Each multiset is used as often as the counts allow.

    Each entry uses up a length, or leaves fewer of it than the multiset takes, so the plan has a few entries per
    different length (at most capacity - 1) however many pieces there are.
    """
    left, out = {k: v for k, v in counts.items() if v}, []
    while left:
        chosen = fullest(left, capacity)
        times = min(left[k] // v for k, v in chosen.items())
        out.append((times, chosen))
        for k, v in chosen.items():
            left[k] -= times * v
            if not left[k]:
                del left[k]
    return out


def _pieces(name: str, capacity: int, end_id: int, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(name)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(part.schema.get_field_index("_text")).to_pylist()
                row, start, length, crc, tokens = [], [], [], [], []
                for a, b in groups(texts):
                    for k, ids in enumerate(own.encode(texts[a:b]), a):
                        ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                        for s in range(0, len(ids), capacity):
                            piece = ids[s : s + capacity]
                            row.append(k)
                            start.append(s)
                            length.append(len(piece))
                            crc.append(zlib.crc32(piece.tobytes()))
                            tokens.append(len(ids))
                rows = part.take(pa.array(row, pa.int64()))
                made = [pa.array(x, pa.int64()) for x in (start, length, crc, tokens)]
                yield pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index(c)) for c in keep] + made, names=[*keep, "start", "length", "ids_crc32", "doc_tokens"])
        del own
        give_back()

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 1, name: str = "byte_bpe_50k.json") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its whole text (null: empty) with `end_id` after them; it is cut into pieces of
    `capacity` ids and a rest, each id in one piece. Whole pieces are sequences of their own; rests share sequences by
    minimum bin slack. Sequence ids are gapless from 0, offsets gapless from 0 in each. Rows may repeat (each is packed)
    and ids may be null; other columns are ignored; an empty table gives an empty table.

    Texts are encoded once; only (id, numbers) rows move. The driver sees the number of rests of each length
    (capacity - 1 numbers at most) and plans multisets of lengths with it; every rest then finds its place by its rank
    among rests of its length, through a table of at most a few rows per length and multiset.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    schema = texts.select(id_col).schema
    for c in ("start", "length", "ids_crc32", "doc_tokens"):
        schema = schema.add(c, "long")
    pieces = cut(texts.mapInArrow(_pieces(name, capacity, end_id, [id_col]), schema))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    whole = counts.pop(capacity, 0)
    # ranges of ranks: rests of a length with rank in [rank_from, rank_to) are in copies of one multiset
    used: dict[int, int] = {}
    ranges, sequence = [(capacity, 0, whole, 1, 0, 0)], whole
    for times, chosen in plan(counts, capacity):
        offset = 0
        for length, each in sorted(chosen.items(), reverse=True):
            at = used.get(length, 0)
            ranges.append((length, at, at + times * each, each, sequence, offset))
            used[length] = at + times * each
            offset += length * each
        sequence += times
    places = spark.createDataFrame(ranges, "length long, rank_from long, rank_to long, each long, first_sequence long, first_offset long")
    order = [F.col(id_col), F.col("start"), F.col("ids_crc32")]
    ranked = spread_rank(pieces, ["length"], order, "_rank")
    placed = ranked.join(F.broadcast(places), "length").where("_rank >= rank_from and _rank < rank_to")
    q = F.expr("(_rank - rank_from) div each")
    return placed.select(
        id_col, "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + q).alias("sequence_id"),
        (F.col("first_offset") + (F.col("_rank") - F.col("rank_from") - q * F.col("each")) * F.col("length")).alias("offset"),
    )
