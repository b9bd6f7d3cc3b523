"""Intermediate tables in the shared folder, and broadcasts whose size has been looked at.

A staged table cuts a long plan: what is used several times downstream is computed once, and a lost executor costs only the
tasks that read it again. Every table of a session lies in one folder ``stages-<application id>`` under the shared folder;
:func:`clean_up` deletes it when the session's results have been written, else it is left to the shared folder's own retention.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.session import shared_dir

# A side is broadcast up to this many bytes of staged Parquet ...
BROADCAST_BYTES = 16 << 20
# ... and this many rows, as a few repeated values may take next to nothing in a file.
BROADCAST_ROWS = 2_000_000


def stages_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stages-{spark.sparkContext.applicationId}"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def clean_up(spark: SparkSession) -> None:
    """Delete every table that this session has staged. Results that still read them must have been written before."""
    path, fs = _path(spark, stages_dir(spark))
    fs.delete(path, True)


def stage(df: DataFrame) -> DataFrame:
    """Compute ``df`` now, keep it as a table in the shared folder, and go on from there."""
    return _stage(df)[0]


def _stage(df: DataFrame) -> tuple[DataFrame, str]:
    path = f"{stages_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def is_small(staged: DataFrame, path: str, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a staged table is small enough to be sent to every executor, by the bytes of its files."""
    found, fs = _path(staged.sparkSession, path)
    return fs.getContentSummary(found).getLength() <= limit and staged.count() <= BROADCAST_ROWS


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` staged and measured: marked for broadcast when its files are small, else left to a shuffled join.

    Joining a table per partition or per rebalance without the mark would shuffle the whole log by a dozen keys before the
    size of the other side is known.
    """
    staged, path = _stage(df)
    return F.broadcast(staged) if is_small(staged, path, limit) else staged
