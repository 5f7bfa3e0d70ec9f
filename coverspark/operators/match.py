"""Matching names: the habit cascade, leaf retention and blocked fuzzy matching."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverspark.functions.text import clean_name, first_word, genus_species, infer_rank, normalize_by_rank, split_author, words
from coverspark.session import ship


def comma_set(c: Column) -> Column:
    """Aggregate: distinct, trimmed, non-blank values, sorted, as comma text; null if there is none."""
    t = F.trim(c)
    return F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(t != "", t))), ","), F.lit(""))


def habit_cascade(species: DataFrame, checklist: DataFrame, name: str = "species") -> DataFrame:
    """Add `habit` to each species row: the first of four lookups that has one.

    By genus and species among accepted names, then among synonyms, then by genus among accepted names, then synonyms.
    checklist: name, accepted_name, habit. The checklist is read once and aggregated to one row per key, with the
    habit of its first pass, so no row is lost or doubled; blank habits are null. Two joins; Spark broadcasts the lookups if they are small.
    """
    accepted, synonym = F.col("accepted_name"), F.col("name")
    passes = [("species", genus_species, accepted), ("species", genus_species, synonym), ("genus", first_word, accepted), ("genus", first_word, synonym)]
    keys = F.array(*(F.struct(F.lit(of).alias("of"), F.lit(k).alias("pass"), key(source).alias("key")) for k, (of, key, source) in enumerate(passes)))
    each = checklist.select(F.explode(keys).alias("_p"), "habit").select("_p.*", "habit").where("key is not null").groupBy("of", "key", "pass").agg(comma_set(F.col("habit")).alias("h"))
    lookup = each.groupBy("of", "key").agg(F.min_by("h", F.when(F.col("h").isNotNull(), F.col("pass"))).alias("h"))
    own = lambda of: lookup.where(F.col("of") == of).select(F.col("key").alias(f"_k_{of}"), F.col("h").alias(f"_h_{of}"))
    out = species.withColumns({"_species": genus_species(F.col(name)), "_genus": first_word(F.col(name))})
    for of in ("species", "genus"):
        out = out.join(own(of), F.col(f"_{of}") == F.col(f"_k_{of}"), "left")
    return out.withColumn("habit", F.coalesce("_h_species", "_h_genus")).drop("_species", "_genus", "_k_species", "_k_genus", "_h_species", "_h_genus")


def leaf_retention(species: DataFrame, retention: DataFrame, name: str = "species") -> DataFrame:
    """Add `leaf_retention`: the sorted distinct words for the genus as comma text, '' if there is none.

    retention: retention_name, retention. A match on two words implies one on the genus, so the genus decides.
    """
    lookup = retention.select(first_word(F.col("retention_name")).alias("_g"), "retention").where("_g is not null").groupBy("_g").agg(comma_set(F.col("retention")).alias("_r"))
    joined = species.join(lookup, first_word(F.col(name)) == F.col("_g"), "left")
    return joined.withColumn("leaf_retention", F.coalesce("_r", F.lit(""))).drop("_g", "_r")


def edit_score(a: Column, b: Column) -> Column:
    """100 for equal texts, down by edits per character of the longer one."""
    return F.round(100.0 * (1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))), 6)


def fuzzy_candidates(names: DataFrame, candidates: DataFrame, block: str, score: Column | None = None, top: int = 5, least: float = 0.0) -> DataFrame:
    """(name, candidate, score, place): the best `top` candidates of each name in its block.

    names: name and block; candidates: candidate and block. Only pairs that share a block are scored. Ties go to the
    candidate first in text order.
    """
    pairs = names.join(candidates, block).withColumn("score", edit_score(F.col("name"), F.col("candidate")) if score is None else score).where(F.col("score") >= least)
    best = Window.partitionBy("name").orderBy(F.desc("score"), "candidate")
    return pairs.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top).select("name", "candidate", "score", "place")


# Ranks tried for a name of a rank, in order.
RANK_CASCADE = {
    "subspecies": ["subspecies", "variety", "species", "genus", "family"],
    "variety": ["variety", "subspecies", "species", "genus", "family"],
    "species": ["species", "subspecies", "variety", "genus", "family"],
    "genus": ["genus", "family"],
    "family": ["family"],
}


def ranked_names(df: DataFrame, name: str) -> DataFrame:
    """Add taxon (without its author), rank, key (normalised by the rank) and genus of a name."""
    out = df.withColumn("taxon", split_author(F.col(name))["taxon"]).withColumn("rank", infer_rank(F.col("taxon")))
    return out.withColumns({"key": normalize_by_rank(F.col("taxon"), F.col("rank")), "genus": F.try_element_at(words(clean_name(F.col("taxon"))), F.lit(1))})


def fuzzy_cascade(names: DataFrame, checklist: DataFrame, name: str = "name", least: float = 85.0, score: Column | None = None, top: int = 5) -> DataFrame:
    """(name, accepted_name, checklist_name, score, rank, rank_match, audit): the match of each name, nulls where there is none.

    checklist: checklist_name, accepted_name. Ranks are tried in the order of RANK_CASCADE for the name's rank; in a rank, names
    of the same genus are candidates. One with the same key counts 100, else the best of at least `least` does. Among equals
    a subspecies or variety prefers the candidate with its last word, then the first in text order. The first rank with a
    match wins. rank_match tells whether that is the name's own rank. audit has, for each rank that was tried, up to
    and with that of the match, the `top` best candidates (accepted_name, score, rank), whatever they score; it is empty for a match
    of the same key. `score` is an expression of key and candidate. Only names that share genus and rank are paired.
    """
    own = ranked_names(names.select(name).distinct(), name).withColumn("key", clean_name(F.col("taxon")))
    tried = F.lit(None).cast("array<string>")
    for rank, order in RANK_CASCADE.items():
        tried = F.when(F.col("rank") == rank, F.array(*map(F.lit, order))).otherwise(tried)
    asked = own.select(name, "taxon", "key", "genus", F.col("rank").alias("own_rank"), F.posexplode(tried).alias("step", "rank"))
    listed = ranked_names(checklist, "checklist_name").groupBy("genus", "rank", F.col("key").alias("candidate")).agg(F.min_by("accepted_name", "checklist_name").alias("accepted_name"), F.min("checklist_name").alias("checklist_name"))
    same = F.col("key") == F.col("candidate")
    pairs = asked.join(listed, ["genus", "rank"]).withColumn("score", edit_score(F.col("key"), F.col("candidate")) if score is None else score)
    pairs = pairs.withColumn("score", F.when(same, 100.0).otherwise(F.col("score")))
    last = F.try_element_at(words(F.col("taxon")), F.lit(-1)) == F.try_element_at(words(F.col("candidate")), F.lit(-1))
    first = F.struct("step", (~same).alias("other"), -F.col("score"), F.when(F.col("own_rank").isin("subspecies", "variety") & last, 0).otherwise(1), "candidate")
    good = F.col("score") >= least
    placed = pairs.withColumn("_place", F.row_number().over(Window.partitionBy(name, "step").orderBy(F.desc("score"), "candidate")))
    seen = F.collect_list(F.when(F.col("_place") <= top, F.struct("step", "_place", "accepted_name", "score", "rank")))
    match = F.min_by(F.when(good, F.struct("accepted_name", "checklist_name", "score", "rank", "step", same.alias("exact"), (F.col("rank") == F.col("own_rank")).alias("rank_match"))), F.when(good, first))
    best = placed.groupBy(name).agg(match.alias("_b"), F.array_sort(seen).alias("_seen"))
    told = F.filter("_seen", lambda s: (s["step"] <= F.coalesce("_b.step", s["step"])) & ~F.coalesce("_b.exact", F.lit(False)))
    audit = F.transform(told, lambda s: F.struct(s["accepted_name"].alias("accepted_name"), s["score"].alias("score"), s["rank"].alias("rank")))
    best = best.select(name, "_b.accepted_name", "_b.checklist_name", "_b.score", "_b.rank", "_b.rank_match", audit.alias("audit"))
    kind = "array<struct<accepted_name:string,score:double,rank:string>>"
    return own.select(name).join(best, name, "left").withColumns({"rank_match": F.coalesce("rank_match", F.lit(False)), "audit": F.coalesce(F.col("audit").cast(kind), F.array().cast(kind))})


def least_edits(a: str, b: str) -> int:
    """Fewest insertions and deletions that turn a into some window of b of a's length."""
    x = np.frombuffer(a.encode("utf-32-le"), np.uint32)
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(b.encode("utf-32-le"), np.uint32), len(x))
    # longest common subsequences of all windows at once, row by row
    before = np.zeros((len(windows), len(x) + 1), np.int32)
    for c in x:
        now = np.maximum(before[:, 1:], before[:, :-1] + (windows == c))
        before = np.concatenate([np.zeros((len(windows), 1), np.int32), np.maximum.accumulate(now, axis=1)], axis=1)
    return int(2 * (len(x) - before[:, -1].max()))


def _shared_with_starts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of x with y[:1], y[:2], ..."""
    out, before = np.zeros(len(y), np.int32), np.zeros(len(x) + 1, np.int32)
    for k, c in enumerate(y):
        before[1:] = np.maximum.accumulate(np.maximum(before[1:], before[:-1] + (x == c)))
        out[k] = before[-1]
    return out


def best_window(a: str, b: str) -> float:
    """0 to 100: the best similarity of the shorter text with a window of the longer, of its length or cut off at either end.

    Similarity is twice the longest common subsequence over both lengths. Texts of one length are tried both ways.
    """
    a, b = sorted((a, b), key=len)
    if not a:
        return 100.0 if not b else 0.0
    x, y = (np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b))
    best = 1 - least_edits(a, b) / (2 * len(a))
    width = np.arange(1, len(x))
    for p, q in ((x, y), (y, x))[: 2 if len(x) == len(y) else 1]:
        for r, t in ((p, q[: len(x) - 1]), (p[::-1], q[::-1][: len(x) - 1])):
            if len(t):
                best = max(best, float((2 * _shared_with_starts(r, t) / (len(x) + width)).max()))
    return 100.0 * best


def partial_score(a: Column, b: Column) -> Column:
    """best_window of two text columns, null if one is; an Arrow batch at a time. For candidates that share a block, not for all pairs."""

    @F.pandas_udf("double")
    def ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            yield pd.Series([None if p is None or q is None else best_window(p, q) for p, q in zip(left, right)], dtype="float64")

    return ratio(a, b)


def partial_ratio(pairs: DataFrame) -> DataFrame:
    """Add `score` to (name, candidate): see partial_score."""
    ship(pairs.sparkSession)
    return pairs.withColumn("score", partial_score(F.col("name"), F.col("candidate")))
