"""Sinks: dead letters, idempotent writes, the text form of the metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.operators.metrics import exposition


def content_key(*columns: Column | str) -> Column:
    """Key made of the content: equal rows get equal keys. Null and empty differ, and so do ("a", "bc") and ("ab", "c")."""
    parts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.when(text.isNull(), "n").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat_ws("|", *parts), 256)


def insert_if_absent(new: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``new`` to append to ``target``: the first per key in ``order``, for keys the target does not have.

    Reduced to one row per key first, so that a key repeated very often does not weigh on the join.
    """
    rest = [c for c in new.columns if c not in keys]
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    fresh = first.join(target.select(*keys), list(keys), "left_anti")
    return fresh.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*new.columns)


def upsert_latest(new: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The target after writing ``new``: per key the row that comes last in ``order``, whichever side it is from."""
    both = target.unionByName(new)
    rest = [c for c in both.columns if c not in keys]
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*both.columns)


def overwrite_batch(df: DataFrame, path: str, batch_id: int, file_format: str = "parquet") -> None:
    """Write a micro-batch into its own ``batch_id`` folder; a replay replaces the folder, also when it has no rows any more.

    A batch without rows leaves an empty, readable folder. ``batch_id`` is read back from the folder's name.
    """
    df.write.format(file_format).mode("overwrite").save(batch_folder(path, batch_id))


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def write_dead_letters(dead: DataFrame, path: str, batch_id: int = 0, file_format: str = "parquet") -> None:
    """Persist failed records with their reason. A failure to write raises, which keeps the batch uncommitted."""
    overwrite_batch(dead, path, batch_id, file_format)


def read_batches(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.format(file_format).load(path)


def write_exposition(metrics: DataFrame, path: str, namespace: str = "keyflow") -> None:
    """The metrics document as one text file. It has a line per series, not per message, so one task can write it."""
    exposition(metrics, namespace).coalesce(1).write.mode("overwrite").text(path)
