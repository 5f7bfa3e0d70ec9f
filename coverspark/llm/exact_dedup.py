"""Exact deduplication by content-defined chunk recipes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverspark.llm.rows import free_name, keyed, without
from coverspark.llm.texts import give_back, map_texts
from coverspark.session import cut, ship

_WINDOW = 16
#: One pseudo-random number per byte value, from a rule.
_GEAR = np.frombuffer(b"".join(hashlib.blake2b(bytes([k]), digest_size=4).digest() for k in range(256)), "<u4").copy()


def boundaries(data: bytes, mean: int = 1024, least: int = 256, most: int = 8192) -> list[int]:
    """Ends of the chunks of `data`, which depend on nothing but the bytes of `data`.

    A chunk may end where a hash of the last 16 bytes is divisible by `mean` (a power of two), not before
    `least` bytes; a chunk without such a place ends after `most`. No bytes: no chunk.
    """
    if not data:
        return []
    if len(data) <= least:
        return [len(data)]
    h = _GEAR[np.frombuffer(data, np.uint8)]
    step = 1
    while step < _WINDOW:  # doubles the window: h[i] becomes the sum of gear[i - k] << k
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    shift = np.uint32(32 - int(mean).bit_length() + 1)
    ends, start = [], 0
    for at in [*(np.flatnonzero(h >> shift == 0) + 1).tolist(), len(data)]:
        while at - start > most:
            start += most
            ends.append(start)
        if at - start >= least:
            ends.append(at)
            start = at
    if start < len(data):
        ends.append(len(data))
    return ends


def _chunks(text: str | None, digest_bytes: int) -> tuple[bytes, list[bytes], list[bytes]]:
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower() changes A-Z only
    ends = boundaries(data)
    parts = [data[a:b] for a, b in zip([0, *ends], ends)]
    return data, parts, [hashlib.blake2b(p, digest_size=digest_bytes).digest() for p in parts]


def _recipes(digest_bytes: int):
    def of(texts: list[str | None]) -> dict[str, list]:
        made = [_chunks(t, digest_bytes) for t in texts]
        return {"text_sha256": [hashlib.sha256(data).hexdigest() for data, _, _ in made], "recipe": [b"".join(names) for _, _, names in made]}

    return lambda: of


_RECIPE = {"text_sha256": pa.string(), "recipe": pa.binary()}


def _pieces(digest_bytes: int):
    """(name, chunk) once per input batch for every different chunk in it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: set[tuple[bytes, bytes]] = set()
            for t in b["_text"]:
                _, parts, names = _chunks(t, digest_bytes)
                seen.update(zip(names, parts))
                if len(seen) >= 8192:
                    yield pd.DataFrame(list(seen), columns=["name", "chunk"])
                    seen = set()
            yield pd.DataFrame(list(seen), columns=["name", "chunk"])
        give_back()

    return run


def _places(digest_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t in zip(b["_row"], b["_text"]):
                _, parts, names = _chunks(t, digest_bytes)
                rows += [(k, pos, name, part) for pos, (name, part) in enumerate(zip(names, parts))]
            yield pd.DataFrame(rows, columns=["_row", "pos", "name", "chunk"])

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 16) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal texts the
    largest id stays. Rows without an id count in group_size and stay only where no row of their group has an
    id (keep_id is null then). Rows repeated with the surviving id are one document: all are kept. Other
    columns of `docs` are neither read nor returned, whatever their names; an empty table gives an empty table.

    Each text becomes the ordered list of its chunks' identifiers (the recipe). The distinct chunks are
    compared byte by byte once: an identifier is a digest, verified to stand for one chunk; chunks that share a
    digest are told apart by their rank, which joins the recipe. Only distinct chunks move, after a merge in
    each task; whole texts never do, and groups are formed on recipes.
    """
    recipes = _written_recipes(docs.select(F.col(id_col), F.col(text_col).alias("_text")), digest_bytes)
    # written, so that a hot recipe is a plain skewed join below
    groups = cut(recipes.groupBy("recipe").agg(F.max(id_col).alias("keep_id"), F.count("*").alias("group_size")))
    return recipes.join(groups, "recipe").select(id_col, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _written_recipes(texts: DataFrame, digest_bytes: int) -> DataFrame:
    """`texts` without _text but with recipe and text_sha256, as a written table."""
    ship(texts.sparkSession)
    names = texts.mapInPandas(_pieces(digest_bytes), "name binary, chunk binary").distinct().groupBy("name").count()
    doubtful = cut(names.where("count > 1").select("name"))
    if doubtful.isEmpty():
        recipes = map_texts(texts, "_text", _recipes(digest_bytes), _RECIPE)
    else:
        recipes = _verified(texts, doubtful, digest_bytes)
    return cut(recipes)


def _verified(texts: DataFrame, doubtful: DataFrame, digest_bytes: int) -> DataFrame:
    """Recipes in which chunks of one digest but different bytes have different identifiers."""
    rows = cut(texts.withColumn("_row", F.monotonically_increasing_id()))
    places = rows.select("_row", "_text").mapInPandas(_places(digest_bytes), "_row long, pos int, name binary, chunk binary").join(doubtful, "name", "left_semi")
    places = cut(places)
    ranks = places.select("name", "chunk").distinct().withColumn("variant", F.row_number().over(Window.partitionBy("name").orderBy("chunk")))
    told = places.join(ranks, ["name", "chunk"]).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("pos", "variant"))).alias("told"))
    plain = map_texts(rows, "_text", _recipes(digest_bytes), _RECIPE)
    return plain.join(told, "_row", "left").select(*(c for c in texts.columns if c != "_text"), "text_sha256", F.concat("recipe", F.encode(F.coalesce(F.to_json("told"), F.lit("")), "utf-8")).alias("recipe"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: bool = True) -> DataFrame:
    """The rows of `docs` that stay, all columns unchanged: of equal texts those with the largest id.

    With `repeats`, rows repeated with that id all stay, as do all rows of a text that none has an id for; without,
    one row of each text stays. Rows are dropped by a key of their own, so an id on several texts loses none of them.
    """
    key = free_name(docs, "_row_key")
    rows = keyed(docs, key)
    recipes = _written_recipes(rows.select(F.col(id_col).alias("_id"), F.col(key).alias("_key"), F.col(text_col).alias("_text")), 16)
    # a struct with a null id is before all others
    groups = cut(recipes.groupBy("recipe").agg(F.max(F.struct("_id", "_key")).alias("_first")))
    stays = F.col("_id").eqNullSafe(F.col("_first._id")) if repeats else F.col("_key") == F.col("_first._key")
    gone = cut(recipes.join(groups, "recipe").where(~stays).select(F.col("_key").alias(key)))
    return without(rows, gone, key)
