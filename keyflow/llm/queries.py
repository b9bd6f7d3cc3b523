"""The registered queries of this subpackage, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm import centroids, conversations, jaccard, langid, packing, pieces, quality, rules, sharding, substring, token_counts, topk, toxicity
from keyflow.llm.common import crc_bucket, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


@query
def op2_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring.remove_repeated(docs, 35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op4_kd_tree_sharding(spark, sf_dir):
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), 8)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op5_ngram_jaccard_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return jaccard.similar(docs, 5, 80).select("doc_id", "n_shingles", "component_id")


@query
def op6_exact_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


ORACLE_SQL["op6_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


@query
def op7_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.classify(docs)
    return out.select(
        "doc_id", F.col("quality_score").alias("score"), "weak_label", F.col("quality_kept").cast("int").alias("predicted"),
        F.col("quality_kept").alias("kept"),
    )


@query
def op8_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    coded = pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)
    return coded.select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"), "n_differing"
    )


@query
def op9_quality_rules(spark, sf_dir):
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_language_id(spark, sf_dir):
    out = langid.identify(table(spark, sf_dir, "documents"))
    return out.select("doc_id", (crc_bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op11_centroid_clustering(spark, sf_dir):
    assignment, found = centroids.cluster(table(spark, sf_dir, "embeddings"), 40, 5, 256, 64, "2")
    return centroids.report(assignment, found)


def _clustering_sql(k: int, rounds: int) -> str:
    """The rounds written out, over whole tables: the nearest of all centroids per vector, then the floor of the mean."""
    square = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT * FROM (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS INT) AS c, v FROM v WHERE vec_id IS NOT NULL) WHERE c < {k})""",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS best
  FROM (SELECT v.row, v.vec_id, v.v, c.c, CAST({square} AS BIGINT) AS d FROM v CROSS JOIN c{r} AS c) GROUP BY row)""")
        if r < rounds:
            parts.append(f"""s{r} AS (
  SELECT c, pos, sum(x) AS s, count(*) AS n
  FROM (SELECT best.c AS c, unnest(v) AS x, unnest(range(len(v))) AS pos FROM a{r}) GROUP BY c, pos),
m{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS v FROM s{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} ON c{r}.c = m{r}.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, best.c AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} AS c ON best.c = c.c"""


ORACLE_SQL["op11_centroid_clustering"] = _clustering_sql(40, 5)


@query
def op12_token_counts(spark, sf_dir):
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op13_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damaged(rows), rows)


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
