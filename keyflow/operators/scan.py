"""Scans along a key with a state of any kind.

``prefix.running`` carries sums and maxima, which Spark can aggregate. Here the state is opaque (bytes in Arrow) and put together by a
Python function that must be associative: ``merge(merge(a, b), c) == merge(a, merge(b, c))``. The blocks of a key are merged in two levels:
runs of ``fan`` neighbouring positions side by side, then one state per run. A task holds one state at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_FAN = 1 << 10
_OUT_ROWS = 1024


def _as_batches(rows: Iterator[tuple], fields: list[pa.Field]) -> Iterator[pa.RecordBatch]:
    schema, held = pa.schema(fields), []
    for row in rows:
        held.append(row)
        if len(held) == _OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _sorted_rows(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple]:
    """Every row as its key, whether a new key begins there, and its values."""
    current, batch = None, first
    while batch is not None:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            key = row[:n_keys]
            yield key, key != current, row[n_keys:]
            current = key
        batch = next(rest, None)


def _over_groups(walk: Callable, n_keys: int, *names: str):
    """An Arrow function that walks sorted rows; its output is the keys and binary or bigint columns of the input's own types."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        fields = [*first.schema][:n_keys] + [pa.field(n, pa.int64() if n == "_at" else pa.binary()) for n in names]
        yield from _as_batches(walk(_sorted_rows(first, batches, n_keys)), fields)

    return run


def _total(merge):
    def walk(rows):
        last, total = None, None
        for key, fresh, (_, state) in rows:
            if fresh and last is not None:
                yield (*last, total)
            last, total = key, state if fresh else merge(total, state)
        if last is not None:
            yield (*last, total)

    return walk


def _carry(merge):
    """What came before each row; rows that are no blocks (``_is_row`` 0) only bring a state in."""

    def walk(rows):
        total = None
        for key, fresh, (is_row, at, state) in rows:
            if fresh:
                total = None
            if is_row:
                yield (*key, at, total)
            if state is not None:
                total = state if total is None else merge(total, state)

    return walk


def exclusive_scan(
    blocks: DataFrame,
    keys: Sequence[str],
    position: str,
    state: str,
    merge: Callable[[bytes, bytes], bytes],
    reverse: bool = False,
    fan: int = DEFAULT_FAN,
) -> DataFrame:
    """``keys, position, carry``: for every block the merged states of all blocks before it in its key, null for the first one.

    ``position`` is a bigint, different for the blocks of a key; ``state`` is binary and not null. With ``reverse`` the blocks behind come
    first, so the carry of a block is ``merge(merge(last, ...), next)``. Null keys are keys too.
    """
    keys = list(keys)
    low, n = [*keys, "_group"], len(keys)
    kinds = {f.name: f for f in blocks.schema.fields} | {"_group": T.StructField("_group", T.LongType())}
    at = F.col(position).cast("bigint")
    rows = blocks.select(*keys, (-at if reverse else at).alias("_at"), F.col(state).alias("_state"))
    rows = rows.withColumn("_group", F.floor(F.col("_at") / fan).cast("bigint"))

    def walked(df: DataFrame, by: list[str], columns: list[str], walk, *names: str) -> DataFrame:
        ordered = df.repartition(*by).sortWithinPartitions(*by, *[c for c in columns if c != "_state"])
        extra = [T.StructField(c, T.LongType() if c == "_at" else T.BinaryType()) for c in names]
        return ordered.select(*by, *columns).mapInArrow(_over_groups(walk, len(by), *names), T.StructType([kinds[c] for c in by] + extra))

    runs = walked(rows, low, ["_at", "_state"], _total(merge), "_state")
    between = runs.select(*keys, F.lit(1).alias("_is_row"), F.col("_group").alias("_at"), "_state")
    entering = walked(between, keys, ["_is_row", "_at", "_state"], _carry(merge), "_at", "_carry").select(
        *keys, F.col("_at").alias("_group"), F.lit(0).alias("_is_row"), F.lit(None).cast("bigint").alias("_at"), F.col("_carry").alias("_state")
    )
    stacked = rows.select(*low, F.lit(1).alias("_is_row"), "_at", "_state").unionByName(entering)
    out = walked(stacked, low, ["_is_row", "_at", "_state"], _carry(merge), "_at", "_carry")
    return out.select(*keys, (-F.col("_at") if reverse else F.col("_at")).alias(position), F.col("_carry").alias("carry"))
