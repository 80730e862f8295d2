"""Registered queries of the operators (one per operator) and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, cross_polytope, cube_mix, hard_negatives, id_shards, ngram_join, packing, page_diff, pivot_index, secret_grammar,
               toxicity, url_reputation, whitening)
from .common import table

#: Fixed by the task: rule -> verdict.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: The 50,257-entry byte-level vocabulary, as ranks: the ids equal those of byte_bpe_50k.json (tested), several times faster.
TOKENIZER = "byte_bpe_50k.tiktoken"


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: a page is bad when its row of ``labels`` (by id) has quality 0."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return url_reputation.judge(table(spark, sf_dir, "pages"), outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), k=5, percent=75).select("doc_id", "n_shingles", "component_id")


def op3_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op4_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = cube_mix.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3.0)
    return mixed.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), capacity=2048, end_id=0)


def op7_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') "
                    "AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.digests(chat_format.expand(rows))


#: Turns by place, their escaped lengths, and for every example the length of its turns up to the target.
OP8_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, length('<s>[INST]' || regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') || '[/INST]'
                       || regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') || '</s>') AS chars,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM c),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM t)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id"""


def op9_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op10_secret_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_grammar.find_secrets(table(spark, sf_dir, "documents"))
    n = [F.regexp_count("base", F.lit(f"{k}:")).cast("long").alias(f"n_{k}") for k in secret_grammar.KINDS[:3]]
    return found.select("doc_id", *n, F.sha2("base", 256).alias("base_sha256"), "spans")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(False)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    return hard_negatives.mine(rows.select("vec_id", whole.alias("vector"), label.alias("label")), F.col("vec_id") % 100 == 0)


#: Every anchor against every row: fine for the sizes of the SQL check.
OP11_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a, r b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""


def op12_id_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_shards.write_and_read_back(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), k=8, scale=1024.0, shift=100000)
    return out.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {f.__name__: f for f in (
    op1_url_reputation, op2_ngram_join, op3_pivot_index, op4_cube_mix, op5_toxicity, op6_best_fit_packing, op7_cross_polytope,
    op8_chat_format, op9_page_diff, op10_secret_grammar, op11_hard_negatives, op12_id_shards, op13_whitening)}
ORACLE: dict[str, str] = {"op8_chat_format": OP8_SQL, "op11_hard_negatives": OP11_SQL}
