"""Importance resampling towards a target's words, with hashed features of bytes."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverspark.llm.ranks import global_rank
from coverspark.llm.texts import give_back
from coverspark.session import cut, ship

#: Lower-cases A-Z and blanks what is no part of a word: digits, a-z and all bytes of characters beyond ASCII are.
_TABLE = bytes(k + 32 if 65 <= k <= 90 else k if 48 <= k <= 57 or 97 <= k <= 122 or k >= 128 else 32 for k in range(256))


def words_of(data: bytes) -> list[bytes]:
    """Words of a text in UTF-8."""
    return data.translate(_TABLE).split()


def feature_counts(words: list[bytes], longest: int) -> Counter[int]:
    """How often each crc32 comes up among the runs of 1 to `longest` words, joined by one space.

    The crc of a run is the seed for the run one word longer.
    """
    out: Counter[int] = Counter()
    if longest == 1:
        for word, n in Counter(words).items():
            out[zlib.crc32(word)] += n
        return out
    runs = [zlib.crc32(w) for w in words]
    out.update(runs)
    spaced = [b" " + w for w in words]
    for more in range(1, longest):
        runs = [zlib.crc32(w, seed) for w, seed in zip(spaced[more:], runs)]
        out.update(runs)
    return out


def _bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How often each bucket comes up in all texts (column _text, binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [0] * buckets
        for batch in batches:
            for text in batch.column(0):
                for crc, n in feature_counts(words_of(text.as_py() or b""), longest).items():
                    held[crc % buckets] += n
        some = [k for k, n in enumerate(held) if n]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([held[k] for k in some], pa.int64())], names=["bucket", "n"])
        give_back()

    out = np.zeros(buckets, dtype=object)
    for r in texts.select("_text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln) of each bucket's share in the target over its share in the source, each count raised by one."""
    s, t, n = int(source.sum()), int(target.sum()), len(source)
    return [math.floor(1000 * math.log((int(b) + 1) * (s + n) / ((int(a) + 1) * (t + n)))) for a, b in zip(source, target)]


def importance_resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    longest: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: int = 2024,
) -> DataFrame:
    """One row per input row: id, n_features, weight, score, rank (of those drawn, from 1; null for others), all but the id long.

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII of the whole text; features are the
    runs of 1 to `longest` words, repeats counted, in one of `buckets` by crc32. weight is the floored mean of its features'
    gains (see gains_of; 0 without features), score adds the noise of a Gumbel draw from sha256 of `seed:id`. Of the N rows
    with `least_words` words or more the floor(percent * N / 100) of the highest scores are drawn, ties to the smaller id;
    so reruns agree and the draw is without replacement, in proportion to the exponential of the weight.

    Null and empty texts have no features. A null id counts as an empty one in the draw and comes last in ties. Rows repeated
    with their id have one score and are drawn each for itself. Other columns are ignored; empty tables give empty tables,
    an empty target gives the same gain to like counts. Two maps over the texts, whose counts meet as one number per bucket;
    after that only numbers move, in one range shuffle.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    gains = gains_of(_bucket_counts(texts, longest, buckets), _bucket_counts(target.select(F.col(target_col).cast("binary").alias("_text")), longest, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = [], [], []
            for text in batch.column(1):
                own = words_of(text.as_py() or b"")
                if longest == 1:
                    n, total = len(own), sum([gains[zlib.crc32(w) % buckets] * k for w, k in Counter(own).items()])
                else:
                    counts = feature_counts(own, longest)
                    n, total = counts.total(), sum(gains[crc % buckets] * k for crc, k in counts.items())
                words.append(len(own))
                features.append(n)
                weights.append(total // n if n else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (words, features, weights))], names=["_id", "_words", "n_features", "weight"])
        give_back()

    schema = texts.select("_id").schema.add("_words", "long").add("n_features", "long").add("weight", "long")
    weighed = texts.mapInArrow(run, schema)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = cut(weighed.withColumn("score", (F.col("weight") + noise).cast("long")))
    taken = scored.where(F.col("_words") >= least_words).count() * percent // 100
    ranked = global_rank(scored.where(F.col("_words") >= least_words), [F.desc("score"), F.asc_nulls_last("_id")], "rank")
    drawn = F.when(F.col("rank") <= taken, F.col("rank"))
    both = ranked.withColumn("rank", drawn).unionByName(scored.where(F.col("_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
    return both.select(F.col("_id").alias(id_col), "n_features", "weight", "score", "rank")
