"""What the operators of this subpackage share.

Operators take any DataFrame and the names of the columns they read; other columns, whatever their names, are not looked at.
Texts that are null count as empty unless an operator says otherwise. Rows may repeat and identifiers may be null or equal:
joins inside the operators go by content (a 128-bit digest of the text), never by an identifier.
"""

from __future__ import annotations

import binascii
import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.operators.staging import small_side, stage
from keyflow.session import prepare

# Rows and bytes handed to Python at once. Texts and sets may be very long, so a batch is kept small; one row is always taken.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def session(spark: SparkSession) -> SparkSession:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def digest(text: str | Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))))


def release() -> None:
    """Hand memory that a task no longer needs back to the system: workers live on, and what they keep adds up over the stages of a session."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield out
        batch = out = None
        release()

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column out of one array per row."""
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    flat = np.concatenate(values) if len(values) else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


# The base of the rolling hashes, an odd 64-bit number.
BASE = 0x9E3779B97F4A7C15


def rolling(values: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2**64, of every run of ``width`` neighbouring values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, factor = values[:n].copy(), np.uint64(base)
    for i in range(1, width):
        out *= factor
        out += values[i : i + n]
    return out


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling, so that the order of the results says nothing about the values."""
    out = values ^ (values >> np.uint64(31))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def crc_bucket(column: str | Column, modulus: int) -> Column:
    """crc32 of a value's text, modulo ``modulus``; null counts as empty text."""
    value = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def crc32(data: bytes) -> int:
    return binascii.crc32(data)


__all__ = [
    "BASE", "BATCH_ROWS", "WORD_PATTERN", "crc32", "crc_bucket", "digest", "lists", "map_arrow", "mixed", "rolling", "session",
    "small_side", "stage", "table", "texts", "word_hashes",
]
