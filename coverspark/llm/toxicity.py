"""Toxicity grades by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverspark.llm.texts import map_texts
from coverspark.session import cut, ship

#: Bytes of words after lower-casing, a-z and everything beyond ASCII; all others become spaces.
_LETTERS = bytes(k if 97 <= k <= 122 or k >= 128 else 32 for k in range(256))


@dataclass(frozen=True)
class ToxicityModel:
    """P(grade > k) = 1 / (1 + exp(thresholds[k] - sum of weights[f] * log(1 + times of f))): one weight per feature for all grades."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]


#: Besides itself, a longer word counts as its first 3 to 7 letters.
_STARTS = (3, 4, 5, 6, 7)
_KNOWN = 500_000


def _counts(text: str | None) -> Counter:
    """Times of each word (in UTF-8) of the lower-cased text."""
    return Counter((text or "").lower().encode("utf-8", "replace").translate(_LETTERS).split())


def _forms(utf8: bytes) -> list[str]:
    """The features of a word: itself, and its starts with `^` after them."""
    word = utf8.decode("utf-8", "replace")
    return [word, *(word[:k] + "^" for k in _STARTS if len(word) > k)]


class _Vocabulary:
    """Numbers of the known features of a word, looked up once per different word of a task."""

    def __init__(self, place: dict[str, int]):
        self.place, self.seen = place, {}

    def __call__(self, words: Counter) -> dict[int, int]:
        """Times of each feature in a text."""
        if len(self.seen) > _KNOWN:
            self.seen = {}
        seen, out = self.seen, {}
        for w, n in words.items():
            own = seen.get(w)
            if own is None:
                own = seen[w] = [self.place[f] for f in _forms(w) if f in self.place]
            for f in own:
                out[f] = out.get(f, 0) + n
        return out


def fit_ordinal(x: np.ndarray, grade: np.ndarray, weight: np.ndarray, grades: int, ridge: float = 1e-4, steps: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """(weights, increasing thresholds) of the proportional-odds model, by gradient steps on the penalised likelihood."""
    w = np.zeros(x.shape[1])
    # the first threshold and the logs of the gaps keep the thresholds in order
    above = np.array([np.average(grade > k, weights=weight) for k in range(grades - 1)]).clip(1e-4, 1 - 1e-4)
    start = -np.log(above / (1 - above))
    t = np.r_[start[0], np.log(np.maximum(np.diff(start), 1e-2))]
    m, v = np.zeros(len(w) + len(t)), np.zeros(len(w) + len(t))
    weight = weight / weight.sum()
    for step in range(1, steps + 1):
        theta = np.cumsum(np.r_[t[0], np.exp(t[1:])])
        z = x @ w.astype(x.dtype)
        cdf = 1 / (1 + np.exp(-np.clip(np.r_[-np.inf, theta, np.inf][None, :] - z[:, None], -30, 30)))
        cdf[:, 0], cdf[:, -1] = 0, 1
        rows = np.arange(len(z))
        up, low = cdf[rows, grade + 1], cdf[rows, grade]
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p, low * (1 - low) / p
        g_w = x.T @ (weight * (d_up - d_low)).astype(x.dtype) + ridge * w
        g_theta = np.zeros(grades - 1)
        np.add.at(g_theta, grade[grade < grades - 1], -(weight * d_up)[grade < grades - 1])
        np.add.at(g_theta, grade[grade > 0] - 1, (weight * d_low)[grade > 0])
        g_t = np.r_[g_theta.sum(), [g_theta[k + 1 :].sum() * np.exp(t[k + 1]) for k in range(grades - 2)]]
        g = np.r_[g_w, g_t]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        change = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, t = w - change[: len(w)], t - change[len(w) :]
    return w, np.cumsum(np.r_[t[0], np.exp(t[1:])])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 3000, vocabulary: int = 3000, grades: int = 4) -> ToxicityModel:
    """Fit on a bounded sample: `per_class` labelled texts of each class, the first by a hash of the id.

    labels hold 0 and 1 only. Grade 0 is label 0; rows of label 1 are graded 1 to grades - 1 by equal shares of how dense
    their words are in features that the other half of the sample ties to label 1, so no text is graded by its own label.
    Features are the `vocabulary` words and starts of words whose shares of texts differ most between the classes (at least 5
    texts), as log(1 + times). Other labels are ignored, of several labels of an id the largest counts, of several texts
    the first in text order. Rows weigh as their class does among all labels. Severity above 1 has no label to be held against: it orders
    texts by how densely they use such features. Without texts of both classes nothing is toxic.
    """
    ship(docs.sparkSession)
    own = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    shares = {r["_label"]: r["count"] for r in own.groupBy("_label").count().collect()}
    first = F.xxhash64(F.lit(3), "_id")
    picked = own.where("_label = 1").orderBy(first, "_id").limit(per_class).unionByName(own.where("_label = 0").orderBy(first, "_id").limit(per_class))
    picked = picked.withColumn("_half", F.pmod(F.xxhash64(F.lit(4), "_id"), F.lit(2)).cast("int"))
    found = docs.where(F.length(text_col) > 0).select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
    texts = cut(found.groupBy("_id", "_label", "_half").agg(F.min("_text").alias("_text")))

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for a in range(0, len(b), 64):
                part = b.iloc[a : a + 64]
                forms = [list({f for w in _counts(t) for f in _forms(w)}) for t in part["_text"]]
                n = [len(f) for f in forms]
                yield pd.DataFrame({"word": [f for own in forms for f in own], "label": np.repeat(part["_label"].values, n), "half": np.repeat(part["_half"].values, n)})

    totals = {(r["_label"], r["_half"]): r["count"] for r in texts.groupBy("_label", "_half").count().collect()}
    size = lambda label, half: sum(n for (x, h), n in totals.items() if x == label and half in (h, None))
    if min(size(0, None), size(1, None)) < 5:
        return ToxicityModel({}, tuple([30.0] * (grades - 1)))
    times = lambda label, half: F.sum(((F.col("label") == label) & (F.col("half") == half)).cast("long"))
    by_word = texts.mapInPandas(words, "word string, label int, half int").groupBy("word").agg(times(0, 0).alias("n00"), times(0, 1).alias("n01"), times(1, 0).alias("n10"), times(1, 1).alias("n11"))

    def z(one, zero, half=None):
        """Difference of the classes' shares over its standard error under one common share."""
        ones, zeros = max(1, size(1, half)), max(1, size(0, half))
        p = (one + zero + 1) / (ones + zeros + 2)
        return (one / ones - zero / zeros) / F.sqrt(p * (1 - p) * (1 / ones + 1 / zeros))

    c = F.col
    scored = by_word.where("n00 + n01 + n10 + n11 >= 5").select("word", z(c("n10") + c("n11"), c("n00") + c("n01")).alias("z"), z(c("n10"), c("n00"), 0).alias("z0"), z(c("n11"), c("n01"), 1).alias("z1"))
    chosen = scored.orderBy(F.abs("z").desc(), "word").limit(vocabulary).collect()
    place = {r["word"]: k for k, r in enumerate(chosen)}
    marked = [{k for k, r in enumerate(chosen) if r[h] > 3} for h in ("z0", "z1")]

    def make():
        of_words = _Vocabulary(place)

        def features(texts: list[str | None]) -> dict[str, list]:
            out: dict[str, list] = {"at": [], "times": [], "dense": []}
            for text in texts:
                words_ = _counts(text)
                found = of_words(words_)
                out["at"].append(list(found))
                out["times"].append(list(found.values()))
                # by the marks of the first half, and of the second
                out["dense"].append([sum(n for f, n in found.items() if f in m) / max(1, words_.total()) for m in marked])
            return out

        return features

    rows = map_texts(texts, "_text", make, {"at": pa.list_(pa.int32()), "times": pa.list_(pa.int32()), "dense": pa.list_(pa.float64())}).collect()
    x, label = np.zeros((len(rows), len(place)), np.float32), np.array([r["_label"] for r in rows])
    for k, r in enumerate(rows):
        x[k, r["at"]] = np.log1p(r["times"])
    dense = np.array([r["dense"][1 - r["_half"]] for r in rows])
    steps = np.quantile(dense[label == 1], np.arange(1, grades - 1) / (grades - 1))
    grade = np.where(label == 1, 1 + np.searchsorted(steps, dense), 0)
    all_labels = sum(shares.values())
    weight = np.where(label == 1, shares[1] / all_labels / (label == 1).sum(), shares[0] / all_labels / (label == 0).sum())
    w, theta = fit_ordinal(x, grade, weight, grades)
    return ToxicityModel({word: float(w[k]) for word, k in place.items()}, tuple(theta.tolist()))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, severity (expected grade), grade (likeliest), toxic (1 if P(grade > 0) >= 0.5, else 0).

    Reads whole texts; null and empty texts have no features. Ids may be null or repeated; other columns are ignored;
    an empty table gives an empty table. A map: no shuffle.
    """
    ship(docs.sparkSession)
    weights, theta = list(model.weights.values()), np.array(model.thresholds)
    place = {f: k for k, f in enumerate(model.weights)}

    def of(of_words: _Vocabulary, texts: list[str | None]) -> dict[str, list]:
        z = np.zeros(len(texts))
        for k, text in enumerate(texts):
            z[k] = sum(weights[f] * math.log1p(n) for f, n in of_words(_counts(text)).items())
        above = 1 / (1 + np.exp(np.clip(theta[None, :] - z[:, None], -30, 30)))
        each = np.concatenate([np.ones((len(z), 1)), above], 1) - np.concatenate([above, np.zeros((len(z), 1))], 1)
        return {"severity": above.sum(1).tolist(), "grade": each.argmax(1).astype(np.int32).tolist(), "toxic": (above[:, 0] >= 0.5).astype(np.int32).tolist()}

    return map_texts(docs.select(F.col(id_col), F.col(text_col).alias("_text")), "_text", lambda: partial(of, _Vocabulary(place)), {"severity": pa.float64(), "grade": pa.int32(), "toxic": pa.int32()})


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """score_toxicity with a model fitted on the labelled rows of `docs`."""
    ship(docs.sparkSession)
    return score_toxicity(docs, fit_toxicity(docs, labels, id_col, text_col), id_col, text_col)
