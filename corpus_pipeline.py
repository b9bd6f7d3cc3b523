"""A training corpus in five stages: toxic and poor documents go, one of each group of near copies stays, repeated passages are cut out,
and what is left is packed into sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of ``documents``. Null texts pass
the first stages as empty ones do. Rows may repeat. Documents may have further columns with any names; they come out as they went in.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm import jaccard, packing, quality, substring, toxicity
from keyflow.llm.common import session, stage, table

TOXIC_FROM = 0.7
CAPACITY = 2048
PASSAGE_WORDS = 35


def apart(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with names of their own for all columns but doc_id and text, so that no operator's column can meet them, and the way back."""
    names = {c: c if c in ("doc_id", "text") else f"_own_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return renamed, lambda df: df.select(*[F.col(n).alias(c) for c, n in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    rows, back = apart(docs)
    scored = toxicity.score(rows, table(spark, sf_dir, "labels"))
    return back(scored.filter(F.col("toxicity") < TOXIC_FROM))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    rows, back = apart(docs)
    return back(quality.classify(rows).filter("quality_kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return jaccard.keep_one(docs, 5, 80)


def cut_repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    rows, back = apart(docs)
    out = back(substring.remove_repeated(rows, PASSAGE_WORDS))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_poor),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeated),
    ("best-fit packing", pack),
]

# SQL can say neither the classifiers nor the tokeniser.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
