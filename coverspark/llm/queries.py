"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from coverspark.llm.chat import chat_format
from coverspark.llm.exact_dedup import exact_dedup
from coverspark.llm.hard_negatives import hard_negatives
from coverspark.llm.jaccard_join import jaccard_join
from coverspark.llm.mixing import mix
from coverspark.llm.packing import pack
from coverspark.llm.quality import quality_classifier
from coverspark.llm.resample import importance_resample
from coverspark.llm.sharding import shard_by_bytes
from coverspark.llm.token_files import token_files
from coverspark.llm.tokens import token_counts
from coverspark.llm.toxicity import toxicity
from coverspark.llm.vector_dedup import vector_dedup
from coverspark.session import read


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op2_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup(read(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(read(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format(read(spark, sf_dir, "conversations"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(read(spark, sf_dir, "documents"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_OPERATORS = (
    op1_exact_dedup, op2_vector_dedup, op3_toxicity, op4_jaccard_join, op5_packing, op6_token_counts, op7_mixing, op8_sharding, op9_quality, op10_chat_format,
    op11_hard_negatives, op12_token_files, op13_resample,
)
QUERIES = {f.__name__: f for f in _OPERATORS} | {"pipeline": corpus_pipeline.run}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op1_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256({_LOWER}) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY {_LOWER})""",
    "op2_vector_dedup": """
        WITH RECURSIVE
          good AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
          unit AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM good WHERE list_dot_product(v, v) > 0),
          links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM unit a, unit b
                    WHERE a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.9),
          reach(vec_id, low) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.vec_id)
        SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, r.low AS component_id, e.vec_id = r.low AS kept
        FROM embeddings e JOIN (SELECT vec_id, min(low) AS low FROM reach GROUP BY 1) r USING (vec_id)""",
    "op4_jaccard_join": r"""
        WITH RECURSIVE
          words AS (SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
          shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
          sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
          common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
          links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c)),
          reach(doc_id, low) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.doc_id)
        SELECT d.doc_id, r.low AS component_id, (SELECT count(*) FROM links WHERE a = d.doc_id) AS n_links, d.doc_id = r.low AS kept
        FROM documents d JOIN (SELECT doc_id, min(low) AS low FROM reach GROUP BY 1) r USING (doc_id)""",
    "op11_hard_negatives": """
        WITH
          rows AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
          scores AS (SELECT a.id AS anchor, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score FROM rows a JOIN rows b ON a.id <> b.id WHERE a.id % 50 = 0),
          positives AS (SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
        SELECT p.anchor AS anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id)::INT AS "rank",
               n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        QUALIFY row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) <= 3""",
    "op13_resample": rf"""
        WITH
          steps AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)),
          texts AS (SELECT true AS doc, doc_id AS id, {_LOWER} AS text FROM documents UNION ALL SELECT false, row_number() OVER (), {_LOWER} FROM benchmark),
          words AS (SELECT doc, id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
          codes AS (SELECT w, xor(list_reduce(list_transform(range(strlen(w)), lambda k: ('0x' || substr(hex(w), 2 * k + 1, 2))::BIGINT),
                           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
                    FROM (SELECT DISTINCT w FROM words), steps),
          held AS (SELECT doc, id, bucket, count(*) AS n FROM words JOIN codes USING (w) GROUP BY ALL),
          sums AS (SELECT bucket, coalesce(sum(n) FILTER (doc), 0) AS s, coalesce(sum(n) FILTER (NOT doc), 0) AS t FROM held GROUP BY 1),
          gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM sums) + 10000)::DOUBLE / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM sums) + 10000)::DOUBLE))) AS gain FROM sums),
          weights AS (SELECT id, sum(n)::BIGINT AS n, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM held JOIN gains USING (bucket) WHERE doc GROUP BY 1),
          scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                            coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
                     FROM documents LEFT JOIN weights ON id = doc_id),
          places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= 20)
        SELECT scored.*, CASE WHEN place <= (SELECT count(*) FROM places) * 10 // 100 THEN place END AS "rank" FROM scored LEFT JOIN places USING (doc_id)""",
} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
