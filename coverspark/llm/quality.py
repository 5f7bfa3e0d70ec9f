"""Compression classifier: Zstandard dictionaries of good and bad text, and a calibrated score."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverspark.llm.rows import free_name
from coverspark.llm.texts import map_texts
from coverspark.session import cut, ship

_BLOCK = 2048
#: Added to a text's length, so that a few words do not decide for certain.
_DAMP = 128
_LEVEL = 3
_SAMPLE = 4096


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the logistic curve of the difference: score = 1 / (1 + exp(-(offset + slope * d)))."""

    good: bytes
    bad: bytes
    offset: float
    slope: float


class _Sizes:
    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = (zstandard.ZstdCompressor(dict_data=self._dictionary(d), write_content_size=False, write_checksum=False, write_dict_id=False) for d in (good, bad))

    @staticmethod
    def _dictionary(data: bytes):
        d = zstandard.ZstdCompressionDict(data)
        d.precompute_compress(level=_LEVEL)
        return d

    def difference(self, text: str | None) -> float:
        """(size by the bad dictionary - size by the good one) / (bytes of the text + 128), block by block over all of it."""
        data = (text or "").encode("utf-8", "replace")
        if not data:
            return 0.0
        total = 0
        for a in range(0, len(data), _BLOCK):
            block = data[a : a + _BLOCK]
            total += len(self.bad.compress(block)) - len(self.good.compress(block))
        return total / (len(data) + _DAMP)


def _fit_curve(d: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Logistic regression of y on d by Newton steps."""
    scale = float(np.abs(d).mean()) or 1.0
    x = np.stack([np.ones_like(d), d / scale], 1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(2), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1]) / scale


def learnable(doc_id: Column) -> Column:
    """Rows that may be learned from: CRC-32 of the id as text, modulo 3, is not 1."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) != 1


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = 1000, calibration: int = 1500, dictionary_bytes: int = 262144, sample_bytes: int = 1 << 25) -> QualityModel:
    """Fit on a bounded sample: `per_class` texts of each class for its dictionary, `calibration` others of each for the curve.

    The sample takes the learnable labelled rows that come first by a hash of the id, whole texts, of several texts of an
    id the least. A dictionary learns from texts in that order until they hold `sample_bytes`. Labels other than 0 and 1
    are ignored, of several labels of an id the smallest counts. The curve weighs the classes as they are among all
    learnable labels. Without texts of both classes every score is the share of label 1 (0.5 without labels).
    """
    own = labels.where(F.col(label_col).isin(0, 1) & learnable(F.col(id_col))).groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("_label"))
    shares = {r["_label"]: r["count"] for r in own.groupBy("_label").count().collect()}
    first = F.xxhash64(F.lit(9), "_id")
    wanted = per_class + calibration
    picked = own.where("_label = 1").orderBy(first, "_id").limit(wanted).unionByName(own.where("_label = 0").orderBy(first, "_id").limit(wanted))
    found = docs.where(F.length(text_col) > 0).select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
    # at most 2 * (per_class + calibration) rows from here on
    by_class = Window.partitionBy("_label").orderBy(first, "_id")
    size = F.octet_length("_text").cast("long")
    texts = cut(found.groupBy("_id", "_label").agg(F.min("_text").alias("_text")).withColumn("_rank", F.row_number().over(by_class)).withColumn("_before", F.sum(size).over(by_class) - size))
    n = {r["_label"]: r["count"] for r in texts.groupBy("_label").count().collect()}
    share = shares.get(1, 0) / max(1, sum(shares.values())) if shares else 0.5
    if min(n.get(0, 0), n.get(1, 0)) < 16:
        return QualityModel(b"", b"", math.log((share + 1e-6) / (1 - share + 1e-6)), 0.0)
    learns = F.col("_rank") <= F.when(F.col("_label") == 1, min(per_class, n[1] // 2)).otherwise(min(per_class, n[0] // 2))
    at: dict[int, list[bytes]] = {0: [], 1: []}
    for r in texts.where(learns & (F.col("_before") < sample_bytes)).orderBy("_rank").select("_label", "_text").toLocalIterator():
        data = r["_text"].encode("utf-8", "replace")
        at[r["_label"]] += [data[a : a + _SAMPLE] for a in range(0, len(data), _SAMPLE)]
    words = {k: _train(v, dictionary_bytes) for k, v in at.items()}
    pairs = map_texts(texts.where(~learns).select("_label", "_text"), "_text", _differences(words[1], words[0]), {"_d": pa.float64()}).collect()
    y, d = np.array([r["_label"] for r in pairs], float), np.array([r["_d"] for r in pairs])
    offset, slope = _fit_curve(d, y)
    # from the sample's shares to the labels' own
    seen = min(max(y.mean(), 1e-6), 1 - 1e-6)
    offset += math.log((share + 1e-6) / (1 - share + 1e-6)) - math.log(seen / (1 - seen))
    return QualityModel(words[1], words[0], offset, slope)


def _train(blocks: list[bytes], size: int) -> bytes:
    total = sum(map(len, blocks))
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 4)), blocks).as_bytes()
    except zstandard.ZstdError:  # too few or too even samples: the text itself serves as content
        return b"".join(blocks)[-size:]


def _differences(good: bytes, bad: bytes, name: str = "_d"):
    def make():
        sizes = _Sizes(good, bad)
        return lambda texts: {name: [sizes.difference(t) for t in texts]}

    return make


def _scored(docs: DataFrame, model: QualityModel, text_col: str) -> tuple[DataFrame, Column]:
    """`docs` with one more column, and the score as an expression over it; a map over whole texts."""
    ship(docs.sparkSession)
    d, text = free_name(docs, "_d"), free_name(docs, "_d_text")
    if model.good:
        rows = map_texts(docs.withColumn(text, F.col(text_col)), text, _differences(model.good, model.bad, d), {d: pa.float64()})
    else:
        rows = docs.withColumn(d, F.lit(0.0))
    return rows, 1 / (1 + F.exp(-(F.lit(model.offset) + F.lit(model.slope) * F.col(d))))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= 0.5, else 0).

    Reads whole texts and nothing else; null and empty texts get the score of a difference of 0. Other columns are
    ignored. A map: no shuffle. An empty table gives an empty table.
    """
    rows, score = _scored(docs.select(F.col(id_col), F.col(text_col).alias(f"{id_col}_text")), model, f"{id_col}_text")
    return rows.select(id_col, score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out (not learned from), score, predicted. Ids may be null (held_out false) or repeated."""
    model = fit_quality(docs, labels, id_col, text_col)
    scored = score_quality(docs.select(id_col, text_col), model, id_col, text_col)
    return scored.select(id_col, F.coalesce(~learnable(F.col(id_col)), F.lit(False)).alias("held_out"), "score", "predicted")


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` predicted good, all columns unchanged, whatever their names. One map over the texts; they do not move."""
    model = fit_quality(docs, labels, id_col, text_col)
    rows, score = _scored(docs, model, text_col)
    return rows.where(score >= 0.5).select(*(F.col(f"`{c}`") for c in docs.columns))
