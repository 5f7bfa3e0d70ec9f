"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coverspark.llm.exact_dedup import drop_exact_duplicates
from coverspark.llm.jaccard_join import drop_near_duplicates
from coverspark.llm.mixing import take_mix
from coverspark.llm.packing import pack
from coverspark.llm.quality import keep_quality
from coverspark.session import cut, read, release, written

#: Rows of every stage are told apart by their place, never by id. Null and empty texts: scored as a difference of 0, one of
#: them stays in the exact stage (null counts as empty), all stay in the near stage (no shingles), weigh nothing in the mix
#: (so they are taken with their block), and are one token in the packing. Null ids are rows like others and never preferred; columns of
#: any name pass through; texts of any length are read whole; an empty table gives an empty table.


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts good."""
    return keep_quality(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_exact_duplicates(docs, repeats=False)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources' documents in the target weights: some repeated, some left out."""
    return take_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing sources", mixed), ("packing", packed)]

#: Dictionaries, chosen paths and token ids have no SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again; what a stage wrote for itself is then removed."""
    docs, since = read(spark, sf_dir, "documents"), written()
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
        release(since, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
