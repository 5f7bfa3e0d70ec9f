"""Hard negatives through Hilbert-ordered blocks of vectors with zone maps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from coverspark.llm.texts import give_back
from coverspark.session import cut, ship

#: Numbers in a block of vectors, and rows at most; blocks in a page of zone maps.
_NUMBERS, _ROWS, _PAGE = 1 << 17, 1024, 512
#: Rows that tell which dimensions the curve runs through, and their ranges.
_SAMPLE = 4096
_CURVE, _BITS = 32, 4
_LEAST, _MOST = -(1 << 62), 1 << 62
#: Scores up to here are exact in a double and leave room for a place in the block.
_EXACT = 1 << 52


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve through a cube, as rows of bytes, of points with whole coordinates below 2**bits.

    By the transposition of Skilling (2004): the axes are undone level by level, Gray-coded, and their bits interleaved.
    """
    x = x.astype(np.int64).T.copy()
    d, top = len(x), 1 << (bits - 1)
    level = top
    while level > 1:
        low = level - 1
        for i in range(d):
            turned = (x[i] & level) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            if i:
                x[i] ^= swap
        level >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip, level = np.zeros_like(x[0]), top
    while level > 1:
        flip ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= flip
    planes = [(x[i] >> b) & 1 for b in reversed(range(bits)) for i in range(d)]
    return np.packbits(np.array(planes, np.uint8).T, axis=1)


def _quantised(raw: Column, steps: int) -> Column:
    """floor(steps * x) of each component, in double precision."""
    return F.transform(raw, lambda v: F.floor(F.lit(float(steps)) * v).cast("double"))


def _narrow(x: np.ndarray) -> tuple[str, bytes]:
    """The numbers in the narrowest type that holds them all, and its name."""
    most = np.abs(x).max(initial=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
    return kind, x.astype(kind).tobytes()


_BLOCK = "block long, dim int, n int, label_lo long, label_hi long, lo binary, hi binary, ids binary, labels binary, kind string, vectors binary"
_FIELDS = [f.split()[0] for f in _BLOCK.split(", ")]


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows (_id, _label, _key, _v) in order of length, label and place on the curve, a block a row, with its zone map.

    Written as Parquet: the zone maps (label_lo, label_hi, lo, hi) are read without the vectors.
    """
    order = [F.size("_v"), F.col("_label"), F.col("_key"), F.col("_id")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = TaskContext.get().partitionId() << 32, []

        def block() -> pa.RecordBatch:
            x = np.array([v for _, _, v in held], np.float64).reshape(len(held), -1)
            ids, labels = (np.array([r[k] for r in held], "<i8") for k in (0, 1))
            at = np.argsort(ids, kind="stable")  # so that the first of equal scores has the smallest id
            lo, hi = (f(0).astype("<f8").tobytes() if x.size else b"" for f in (x.min, x.max))
            own = (made, x.shape[1], len(x), labels.min(), labels.max(), lo, hi, ids[at].tobytes(), labels[at].tobytes(), *_narrow(x[at]))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v if isinstance(v, (bytes, str)) else int(v)], k) for v, k in zip(own, kinds)], names=_FIELDS)

        for batch in batches:
            flat, ends = batch.column(2).flatten().to_numpy(), np.cumsum(batch.column(2).value_lengths().to_numpy())
            for i, label, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), np.r_[0, ends[:-1]], ends):
                if held and (len(held[-1][2]) != b - a or len(held) >= _size(b - a)):
                    yield block()
                    held, made = [], made + 1
                held.append((i, label, flat[a:b]))
        if held:
            yield block()
        give_back()

    return cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_label", "_v").mapInArrow(run, _BLOCK))


def _size(dim: int) -> int:
    """Rows of a block of vectors of this length."""
    return int(max(16, min(_ROWS, _NUMBERS // max(1, dim))))


def _matrix(row: dict, of: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, vectors) of a block in a row of a batch."""
    n = row[f"{of}n"]
    x = np.frombuffer(row[f"{of}vectors"], row[f"{of}kind"]).astype(np.float64).reshape(n, row["dim"])
    return np.frombuffer(row[f"{of}ids"], "<i8"), np.frombuffer(row[f"{of}labels"], "<i8"), x


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(j)[k].as_py() for j, name in enumerate(batch.schema.names)}


def _pages(blocks: DataFrame) -> DataFrame:
    """(page, dim, places, zones): the zone maps of up to 512 blocks a row, read without the blocks' vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = TaskContext.get().partitionId() << 32, []

        def page() -> pa.RecordBatch:
            places = np.array([(r["block"], r["label_lo"], r["label_hi"]) for r in held], "<i8").tobytes()
            zones = b"".join(r["lo"] for r in held) + b"".join(r["hi"] for r in held)
            return pa.RecordBatch.from_arrays([pa.array([made], pa.int64()), pa.array([held[0]["dim"]], pa.int32()), pa.array([places]), pa.array([zones])], names=["page", "dim", "places", "zones"])

        for row in _each(batches):
            if held and (held[-1]["dim"] != row["dim"] or len(held) >= max(16, min(_PAGE, 16 * _size(row["dim"])))):
                yield page()
                held, made = [], made + 1
            held.append(row)
        if held:
            yield page()

    return cut(blocks.select("block", "dim", "label_lo", "label_hi", "lo", "hi").mapInArrow(run, "page long, dim int, places binary, zones binary"))


_CHUNK = ["chunk", "dim", "n", "ids", "labels", "kind", "vectors", "asks"]


def _met(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """Each chunk of anchors with each page of zone maps of its length: a chunk is sent once per bucket of pages, and the
    pages of a bucket once per 64 chunks, so that work on a bucket is spread, too."""
    buckets, salts = max(1, pages.count()), max(1, chunks.count() // 64)
    left = chunks.withColumn("_salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int")).withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    right = pages.withColumn("_bucket", F.pmod(F.xxhash64("page"), F.lit(buckets)).cast("int")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, ["_bucket", "_salt", "dim"]).select(*_CHUNK, "places", "zones")


def _asked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place in the chunk, number, least score, largest score) of the windows asked for."""
    asks = row["asks"]
    return tuple(np.array([a[k] for a in asks], np.int64) for k in ("pos", "ask", "lo", "hi"))


def _reach(row: dict, same: bool) -> tuple[np.ndarray, ...]:
    """Of a chunk and a page: (place, lo, hi, block numbers, bounds below and above of each window's scores in each block,
    middle of the bounds, whether the block holds labels that the anchor looks for)."""
    _, labels, x = _matrix(row)
    pos, _, low, high = _asked(row)
    places = np.frombuffer(row["places"], "<i8").reshape(-1, 3)
    lo, hi = np.frombuffer(row["zones"], "<f8").reshape(2, len(places), row["dim"])
    up, down = np.maximum(x, 0), np.minimum(x, 0)
    most, least = up @ hi.T + down @ lo.T, up @ lo.T + down @ hi.T
    rough = np.maximum(np.abs(most), np.abs(least)) >= _EXACT  # bounds of such size are rounded: read the block
    most[rough], least[rough] = np.inf, -np.inf
    own = labels[:, None]
    holds = (places[:, 1] <= own) & (own <= places[:, 2]) if same else (places[:, 1] != own) | (places[:, 2] != own)
    middle = np.where(np.isfinite(most + least), most + least, 0.0)
    return pos, low, high, places[:, 0], least[pos], most[pos], middle[pos], holds[pos]


def _first_blocks(met: DataFrame, same: bool) -> DataFrame:
    """(chunk, block, picks) with, for each anchor, the block that its windows can reach whose middle is nearest to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            pos, low, high, block, least, most, middle, holds = _reach(row, same)
            open_ = holds & (least <= high[:, None]) & (most >= low[:, None])
            middle = np.where(open_, middle, -np.inf)
            best = middle.argmax(1)
            some = np.flatnonzero(open_[np.arange(len(pos)), best])
            made = (np.full(len(some), row["chunk"]), pos[some], middle[some, best[some]], block[best[some]])
            yield pa.RecordBatch.from_arrays([pa.array(m, t) for m, t in zip(made, (pa.int64(), pa.int32(), pa.float64(), pa.int64()))], names=["chunk", "pos", "middle", "block"])
        give_back()

    best = met.mapInArrow(run, "chunk long, pos int, middle double, block long").groupBy("chunk", "pos").agg(F.max_by("block", F.struct("middle", "block")).alias("block"))
    return best.groupBy("chunk", "block").agg(F.collect_list("pos").alias("picks"))


def _needed_blocks(met: DataFrame, same: bool) -> DataFrame:
    """(chunk, block, picks): every block whose bounds meet a window of the chunk, with the places of those anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            pos, low, high, block, least, most, _, holds = _reach(row, same)
            need = holds & (least <= high[:, None]) & (most >= low[:, None])
            of = [(int(b), np.unique(pos[need[:, k]]).astype(np.int32)) for k, b in enumerate(block)]
            of = [(b, p) for b, p in of if len(p)]
            made = ([row["chunk"]] * len(of), [b for b, _ in of], [p for _, p in of])
            yield pa.RecordBatch.from_arrays([pa.array(m, t) for m, t in zip(made, (pa.int64(), pa.int64(), pa.list_(pa.int32())))], names=["chunk", "block", "picks"])
        give_back()

    return met.mapInArrow(run, "chunk long, block long, picks array<int>")


def first_in_windows(x: np.ndarray, y: np.ndarray, allowed: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, column, score) of the first k rows of y, by falling product with row x[at[w]], ties by column, in low[w] to high[w]."""
    scores = x @ y.T
    if np.abs(x).sum(1).max(initial=0) * np.abs(y).max(initial=0) < _EXACT:
        codes, values, lo, hi = scores.astype(np.int64), None, np.clip(low, -_EXACT, _EXACT), np.clip(high, -_EXACT, _EXACT)
    else:
        values, codes = np.unique(scores, return_inverse=True)
        codes = codes.reshape(scores.shape).astype(np.int64)
        lo, hi = np.searchsorted(values, low.astype(float), "left"), np.searchsorted(values, high.astype(float), "right") - 1
    n = codes.shape[1]
    codes = np.where(allowed, codes, -_EXACT - 1)
    key = np.sort(codes * n + np.arange(n - 1, -1, -1), axis=1)  # rising; of equal scores the first column is last
    after = np.empty(len(at), np.int64)
    for w in range(len(at)):
        after[w] = np.searchsorted(key[at[w]], (hi[w] + 1) * n)
    place = after[:, None] - 1 - np.arange(k)
    got = key[at[:, None], np.maximum(place, 0)]
    code, column = got // n, n - 1 - got % n
    ok = (place >= 0) & (code >= lo[:, None]) & (code >= -_EXACT)
    w, j = np.nonzero(ok)
    code = code[w, j]
    return w, column[w, j], code if values is None else np.clip(values[code], -(2.0**63), 2.0**63 - 1024).astype(np.int64)


def _scored(picks: DataFrame, chunks: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """(chunk, pos, ask, score, id): the first k rows in each window over the picked blocks, k for each task that holds some."""
    other = blocks.select("block", F.col("n").alias("y_n"), *(F.col(c).alias(f"y_{c}") for c in ("ids", "labels", "kind", "vectors")))
    tiles = picks.join(chunks.select(*_CHUNK), "chunk").join(other, "block").drop("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def rows() -> pa.RecordBatch:
            made = [np.concatenate([p[c] for parts in held.values() for p in parts]) for c in range(5)]
            return pa.RecordBatch.from_arrays([pa.array(m, t) for m, t in zip(made, (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=["chunk", "pos", "ask", "score", "id"])

        for row in _each(batches):
            ids, labels, x = _matrix(row)
            y_ids, y_labels, y = _matrix(row, "y_")
            pos, ask, low, high = _asked(row)
            picked = np.unique(row["picks"])
            mine = np.flatnonzero(np.isin(pos, picked))
            allowed = ((labels[picked][:, None] == y_labels) if same else (labels[picked][:, None] != y_labels)) & (ids[picked][:, None] != y_ids)
            w, column, score = first_in_windows(x[picked], y, allowed, np.searchsorted(picked, pos[mine]), low[mine], high[mine], k)
            w = mine[w]
            held.setdefault(row["chunk"], []).append((np.full(len(w), row["chunk"]), pos[w], ask[w], score, y_ids[column]))
            if len(held[row["chunk"]]) >= 16:
                held[row["chunk"]] = [_best(held[row["chunk"]], k)]
            if sum(len(p[0]) for parts in held.values() for p in parts) > 1 << 20:
                yield rows()
                held.clear()
        if held:
            held.update({c: [_best(p, k)] for c, p in held.items()})
            yield rows()
        give_back()

    return tiles.mapInArrow(run, "chunk long, pos int, ask int, score long, id long")


def _best(parts: list[tuple], k: int) -> tuple:
    """The first k rows of each window over all parts."""
    chunk, pos, ask, score, ids = (np.concatenate([p[c] for p in parts]) for c in range(5))
    at = np.lexsort((ids, -score, ask, pos))
    pos, ask = pos[at], ask[at]
    new = np.r_[True, (pos[1:] != pos[:-1]) | (ask[1:] != ask[:-1])] if len(at) else np.empty(0, bool)
    first = np.flatnonzero(new)
    keep = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)])) < k
    at = at[keep]
    return chunk[at], pos[keep], ask[keep], score[at], ids[at]


def _first(scored: DataFrame, k: int) -> DataFrame:
    """The first k rows of each window, with their `rank` from 1."""
    by = Window.partitionBy("chunk", "pos", "ask").orderBy(F.desc("score"), "id")
    return cut(scored.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k))


def _with_asks(chunks: DataFrame, asks: DataFrame) -> DataFrame:
    """Chunks with the windows (chunk, pos, ask, lo, hi) of their anchors; those without any are left out."""
    return cut(chunks.drop("asks").join(asks.groupBy("chunk").agg(F.collect_list(F.struct("pos", "ask", "lo", "hi")).alias("asks")), "chunk"))


def search_windows(chunks: DataFrame, asks: DataFrame, blocks: DataFrame, pages: DataFrame, same: bool, k: int) -> DataFrame:
    """The first k rows (chunk, pos, ask, rank, score, id) in each window over all blocks, of the anchor's own label or of others.

    A first block per anchor raises the windows' lower ends to the k-th score found there; then every block whose bounds
    still meet a window is read, so the result is exact.
    """
    seeded = _with_asks(chunks, asks)
    early = _first(_scored(_first_blocks(_met(seeded, pages), same), seeded, blocks, same, k), k)
    floor = early.where(F.col("rank") == k).select("chunk", "pos", "ask", F.col("score").alias("_floor"))
    raised = asks.join(floor, ["chunk", "pos", "ask"], "left").withColumn("lo", F.greatest("lo", F.coalesce("_floor", "lo"))).drop("_floor")
    asked = _with_asks(chunks, raised)
    return _first(_scored(_needed_blocks(_met(asked, pages), same), asked, blocks, same, k), k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    n_positives: int = 5, n_negatives: int = 3, least: int = 50, most: int = 95, steps: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: up to `n_negatives` rows per anchor and positive.

    Each component x counts as floor(steps * x); a score is the inner product with the anchor. Rows for which `anchors` holds
    are anchors. An anchor's positives are its first `n_positives` other rows of its label, by falling score, ties by
    smaller id; for each, the negatives are the first rows of other labels with least * positive <= 100 * negative <= most *
    positive, in the same order. Scores are exact below 2**52; beyond that they are doubles, cut to what a long holds.

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part; so do empty vectors with
    others of length 0 only: vectors of different lengths do not meet. Rows that share the anchor's id are not its others.
    Repeated rows count as often as they come; ids are whole numbers, labels are compared by a 64-bit hash if they are
    not. Other columns are ignored; an empty table gives an empty table.

    All rows are blocks of up to 1,024 vectors in order of label and place on a Hilbert curve through the dimensions of
    widest range (of 4,096 rows by hash, which decide nothing but the order), written as Parquet with the least and largest
    value of every dimension. Bounds from these intervals say which blocks an anchor's windows can meet; only those are
    read. A hot label or vector is many blocks. Where vectors have no order that blocks could follow, most blocks are read: anchors
    against rows, by matrix products. Nothing but the sample reaches the driver.
    """
    spark = vectors.sparkSession
    ship(spark)
    raw = F.col(vector_col).cast("array<double>")
    fine = F.coalesce(F.forall(raw, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    label = F.col(label_col).cast("long") if isinstance(vectors.schema[label_col].dataType, IntegralType) else F.xxhash64(label_col)
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & fine
    rows = cut(vectors.where(usable).select(F.col(id_col).cast("long").alias("_id"), label.alias("_label"), F.coalesce(anchors, F.lit(False)).alias("_anchor"), _quantised(raw, steps).alias("_v")))
    curve: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    longest = rows.agg(F.max(F.size("_v"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    sample: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("_v"), "_id").limit(max(64, min(_SAMPLE, (1 << 22) // max(1, longest)))).select("_v").collect():
        sample.setdefault(len(r[0]), []).append(r[0])
    for dim, got in sample.items():
        x = np.array(got).reshape(len(got), dim)
        wide = np.sort(np.argsort(-x.std(0), kind="stable")[:_CURVE])
        curve[dim] = wide, x[:, wide].min(0, initial=0), x[:, wide].max(0, initial=1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, size = batch.column(3).flatten().to_numpy(), batch.column(3).value_lengths().to_numpy()
            starts = np.cumsum(size) - size
            keys = [b""] * len(size)
            for dim in np.unique(size):
                if dim in curve and dim:
                    at, (wide, low, high) = np.flatnonzero(size == dim), curve[dim]
                    x = flat[starts[at][:, None] + wide]
                    cell = np.clip((x - low) / (high - low) * (1 << _BITS), 0, (1 << _BITS) - 1).astype(np.int64)
                    for k, key in zip(at, hilbert_keys(cell, _BITS)):
                        keys[k] = key.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=["_id", "_label", "_anchor", "_v", "_key"])
        give_back()

    placed = cut(rows.mapInArrow(place, "_id long, _label long, _anchor boolean, _v array<double>, _key binary"))
    blocks, chunks = _blocks(placed), _blocks(placed.where("_anchor")).withColumnRenamed("block", "chunk")
    pages = _pages(blocks)
    every = chunks.select("chunk", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("pos")).select("chunk", "pos", F.lit(0).alias("ask"), F.lit(_LEAST).alias("lo"), F.lit(_MOST).alias("hi"))
    positives = search_windows(chunks, every, blocks, pages, True, n_positives)
    score = F.col("score").cast("decimal(38,0)")
    window = positives.where(score >= 0).select(
        "chunk", "pos", (F.col("rank") - 1).alias("ask"), F.ceil(score * least / 100).cast("long").alias("lo"), F.floor(score * most / 100).cast("long").alias("hi"),
    )
    negatives = search_windows(chunks, window.where("lo <= hi"), blocks, pages, False, n_negatives)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            ids = np.frombuffer(row["ids"], "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), row["chunk"])), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)], names=["chunk", "pos", "anchor_id"])

    names = chunks.select("chunk", "ids").mapInArrow(named, "chunk long, pos int, anchor_id long")
    positive = positives.select("chunk", "pos", (F.col("rank") - 1).alias("ask"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    both = negatives.join(positive, ["chunk", "pos", "ask"]).join(names, ["chunk", "pos"])
    return both.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
