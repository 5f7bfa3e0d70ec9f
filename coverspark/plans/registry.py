"""Registered queries: a function of (spark, sf_dir) by name, and DuckDB SQL with the same rows where there is any."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from coverspark.session import dealt, read

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function under its name."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


_NAMED = re.compile(r"\b(FROM|JOIN)\s+(" + "|".join(TABLES) + r")\b", re.IGNORECASE)


#: Keys by which covers (COVER) find these tables.
_COVER_KEYS = {"part": "p_partkey", "orders": "o_orderkey"}


def table(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A fixture: SQL that Spark and DuckDB read alike, over the tables it names, under view names that no user has.

    Where covers are joined, part and orders are dealt by their keys over tasks of a known number of covers: the joins, and sums by
    visit after them, take over these parts, so what a task sorts and sums does not grow with the tables.
    """
    names = {m[1].lower() for m in _NAMED.findall(sql)}
    covers = read(spark, sf_dir, "lineitem").count() if {"lineitem", *_COVER_KEYS} <= names else 0
    for name in names:
        own = read(spark, sf_dir, name)
        if covers and name in _COVER_KEYS:
            own = dealt(own, [_COVER_KEYS[name]], covers)
        own.createOrReplaceTempView(f"coverspark_{name}")
    return spark.sql(_NAMED.sub(lambda m: f"{m[1]} coverspark_{m[2].lower()}", sql))


# Fixtures, bound to the driver's tables.
COVER = """
  SELECT l_orderkey AS visit_id, p_name AS species, p_type AS habit, o_orderpriority AS dataset, l_linenumber AS line,
         l_suppkey AS zone, CASE WHEN l_linenumber <> 7 THEN l_quantity END AS cover, p_partkey, p_size
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey"""
VISITS = """
  SELECT o_orderkey AS visit_id, o_orderpriority AS source, o_orderstatus AS method, o_orderdate AS ts, o_totalprice AS price, o_custkey AS plot
  FROM orders"""
POINTS = """
  SELECT c_custkey AS id, -170 + (c_custkey * 37 % 3000) / 100.0D AS x, 60 + (c_custkey * 53 % 1000) / 100.0D AS y FROM customer"""
PIXELS = """
  SELECT l_partkey AS x, l_suppkey AS y, l_orderkey % 16 AS cell_id, l_quantity AS value, l_discount AS share, l_orderkey AS ord, l_linenumber AS line
  FROM lineitem"""
SERIES = """
  SELECT user_id AS id, CAST(ts AS DATE) AS day, round(avg(value), 6) AS v FROM events WHERE event_type <> 'error' GROUP BY user_id, CAST(ts AS DATE)"""
BANDS = "SELECT vec_id AS id, label AS zone, " + ", ".join(f"0.01 + abs(CAST(embedding[{k}] AS DOUBLE)) AS {n}" for k, n in enumerate(("blue", "green", "red", "red_edge", "nir", "swir1", "swir2"))) + " FROM embeddings"


def duck(sql: str) -> str:
    """Fixture SQL for DuckDB: its lists count from 1, Spark's arrays from 0, and it has no double suffix."""
    for k in range(6, -1, -1):
        sql = sql.replace(f"embedding[{k}]", f"embedding[{k + 1}]")
    return sql.replace("100.0D", "CAST(100 AS DOUBLE)")


def ctes(**named: str) -> str:
    return "WITH " + ", ".join(f"{k} AS ({duck(v)})" for k, v in named.items()) + " "
