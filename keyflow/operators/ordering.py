"""Per-key ordering: ordered processing, sequence numbers, the ordering audit, key and shard reports."""

from __future__ import annotations

import pickle
from collections import namedtuple
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from keyflow.functions import sharding
from keyflow.operators.prefix import DEFAULT_BITS, HOT_ROWS, TIME_BITS, Running, hot_keys, running
from keyflow.operators.scan import exclusive_scan
from keyflow.operators.staging import small_side

KEY = ["topic", "key_str"]


def process_by_key(
    df: DataFrame, step: Callable[[Any, Any], tuple[Any, dict]], out_schema: T.StructType | str, initial: Any = None
) -> DataFrame:
    """Runs ``step(state, record) -> (state, output)`` over the records of each key in offset order.

    One shuffle by key, one sort, then a streaming pass: memory holds one batch and one key's state, however many records
    a key has. Different keys run in parallel. The steps of one key depend on each other, so they cannot be spread over
    tasks. Where two states can be put together, :func:`fold_by_key` does split a hot key, and what needs only counts, sums or the previous
    record of a key can use ``keyflow.operators.prefix.running``.
    """
    ordered = df.repartition(*KEY).sortWithinPartitions(*KEY, "partition", "offset")
    schema = T.StructType.fromDDL(out_schema) if isinstance(out_schema, str) else out_schema
    names = schema.names

    def batches(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, initial
        for pdf in source:
            out = []
            for row in pdf.itertuples(index=False):
                key = (row.topic, row.key_str)
                if key != current:
                    current, state = key, initial
                state, produced = step(state, row)
                out.append(produced)
            yield pd.DataFrame({name: [produced[name] for produced in out] for name in names})

    return ordered.mapInPandas(batches, schema)


# A block's position along its key: the partition above, the number of the block in it below.
_POSITION_BITS = 43


def fold_by_key(
    df: DataFrame,
    step: Callable[[Any, Any], Any],
    merge: Callable[[Any, Any], Any],
    emit: Callable[[Any, Any], dict],
    out_schema: T.StructType | str,
    zero: Any = None,
    bits: int = DEFAULT_BITS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Folds the records of each key in offset order, with a hot key spread over many tasks.

    ``step(state, record)`` takes a record in, ``emit(state, record)`` gives the output for it, with the record in the state. ``merge(earlier, later)``
    puts the states of two neighbouring stretches together. For the result to be that of one pass, ``zero`` must change nothing in a merge, ``merge`` must
    be associative, and ``step(merge(a, b), r)`` must equal ``merge(a, step(b, r))``; states are pickled.

    Keys with more than ``hot_rows`` records are cut into blocks of ``2**bits`` offsets. Each block is folded from ``zero``, a two-level scan of the
    blocks' states gives each block the state before it, and all blocks are walked once more from there. Other keys take one pass.
    """
    columns = df.columns
    schema = T.StructType.fromDDL(out_schema) if isinstance(out_schema, str) else out_schema
    arrow_schema = to_arrow_schema(schema)
    record = namedtuple("Record", columns, rename=True)
    first_state = pickle.dumps(zero)
    block = [*KEY, "_part", "_block"]

    hot = small_side(hot_keys(df, KEY, hot_rows))
    no_block = {c: F.lit(None).cast("bigint") for c in ("_part", "_block")}
    split = not hot.isEmpty()
    if split:
        same = [F.col(f"d.{k}").eqNullSafe(F.col(f"h.{k}")) for k in KEY]
        rows = df.alias("d").join(hot.alias("h"), same, "left").select(
            "d.*",
            F.when(F.col("h._hot"), F.col("d.partition").cast("bigint")).alias("_part"),
            F.when(F.col("h._hot"), F.shiftright("d.offset", bits)).alias("_block"),
        )
    else:
        rows = df.withColumns(no_block)

    def in_order(source: DataFrame, *first: str) -> DataFrame:
        return source.repartition(*block).sortWithinPartitions(*block, *first, "partition", "offset")

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, bytes | None, Any]]:
        """Every sorted row: its block, whether a new one begins, the state it brings, the record. The last columns are the block's and the state's."""
        current, n = None, len(columns)
        for batch in batches:
            for values in zip(*[c.to_pylist() for c in batch.columns]):
                key = values[n : n + len(block)]
                yield key, key != current, values[n + len(block)], record(*values[:n])
                current = key

    def packed(source: DataFrame) -> DataFrame:
        keys = [F.col(c).alias(f"_key{i}") for i, c in enumerate(block)]
        return source.select(*columns, *keys, "_state")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, state):
            fields = [pa.field(c, types[c]) for c in block] + [pa.field("_state", pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, pickle.dumps(state)), fields)], schema=pa.schema(fields))

        last, state = None, None
        for key, fresh, _, row in walked(batches):
            if fresh:
                if last is not None:
                    yield out(last, state)
                last, state = key, pickle.loads(first_state)
            state = step(state, row)
        if last is not None:
            yield out(last, state)

    def outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out = None, []
        for _, fresh, carried, row in walked(batches):
            if fresh:
                state = pickle.loads(first_state)
            if carried is not None:
                state = merge(state, pickle.loads(carried))
                continue
            state = step(state, row)
            out.append(emit(state, row))
            if len(out) == 4096:
                yield pa.RecordBatch.from_pylist(out, schema=arrow_schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow_schema)

    rows = rows.withColumns({"_state": F.lit(None).cast("binary"), "_is_row": F.lit(1)})
    if split:
        keyed = [rows.schema[c] for c in block]
        types = {f.name: f.type for f in to_arrow_schema(T.StructType(keyed))}
        hot_ones = in_order(rows.filter(F.col("_block").isNotNull()))
        states = packed(hot_ones).mapInArrow(totals, T.StructType([*keyed, T.StructField("_state", T.BinaryType())]))
        placed = states.withColumn("_at", F.shiftleft("_part", _POSITION_BITS).bitwiseOR(F.col("_block")))

        def merged(earlier: bytes, later: bytes) -> bytes:
            return pickle.dumps(merge(pickle.loads(earlier), pickle.loads(later)))

        carried = exclusive_scan(placed, KEY, "_at", "_state", merged).filter("carry IS NOT NULL")
        entering = carried.select(
            *KEY,
            F.shiftright("_at", _POSITION_BITS).alias("_part"),
            F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1).cast("bigint")).alias("_block"),
            F.col("carry").alias("_state"),
            F.lit(0).alias("_is_row"),
        )
        rows = rows.unionByName(entering, allowMissingColumns=True)
    return packed(in_order(rows, "_is_row")).mapInArrow(outputs, schema)


def key_sequence(df: DataFrame, bits: int = DEFAULT_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``key_seq``, the 1-based position of a record within its key, by partition, then offset.

    Normally a key lives on one partition. Hot keys are counted in blocks of offsets.
    """
    return running(
        df,
        KEY,
        ["partition", "offset"],
        ["partition", "offset"],
        [Running("key_seq", F.lit(1).cast("bigint"))],
        bits,
        split_only_hot=True,
        hot_rows=hot_rows,
    )


def ordering_violations(attempts: DataFrame, bits: int = TIME_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Attempts that break per-key order, compared with the previous attempt of the same key and partition by start time.

    ``inversion``: it has a lower offset than the previous one. ``overlap``: the previous one was not finished when it
    started. The previous attempt is the running maximum of the sort columns, so hot keys are split by time.
    """
    previous = F.struct("start_us", "offset", "attempt_no", "done_us")
    with_previous = running(
        attempts,
        ["topic", "partition", "key_str"],
        ["start_us", "offset", "attempt_no"],
        "start_us",
        [Running("_prev", previous, "max", inclusive=False)],
        bits,
        True,
        hot_rows,
    )
    inversion = F.col("offset") < F.col("_prev.offset")
    overlap = F.col("_prev").isNotNull() & (
        F.col("_prev.done_us").isNull() | (F.col("_prev.done_us") > F.col("start_us"))
    )
    return (
        with_previous.withColumns({"inversion": F.coalesce(inversion, F.lit(False)), "overlap": overlap})
        .filter(F.col("inversion") | F.col("overlap"))
        .select(
            "topic",
            "partition",
            "key_str",
            "offset",
            "attempt_no",
            "start_us",
            F.col("_prev.offset").alias("previous_offset"),
            F.col("_prev.done_us").alias("previous_done_us"),
            "inversion",
            "overlap",
        )
    )


def shard_report(df: DataFrame, shards: int = sharding.DEFAULT_SHARDS) -> DataFrame:
    """Records and distinct keys per shard. Keys are reduced to one row each, with a count, before they are hashed."""
    per_key = df.groupBy("key_str").agg(F.count("*").alias("_n"))
    return (
        per_key.withColumn("shard", sharding.key_shard("key_str", shards))
        .groupBy("shard")
        .agg(F.sum("_n").alias("records"), F.count("*").alias("keys"), F.max("_n").alias("largest_key"))
    )


def key_fanout(df: DataFrame) -> DataFrame:
    """Distinct keys per partition: how far one partition spreads."""
    return df.groupBy("topic", "partition").agg(
        F.count_distinct("key_str").alias("keys"), F.count("*").alias("records")
    )
