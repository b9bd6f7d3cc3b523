"""Streaming operators with keyed state (``transformWithStateInPandas``, RocksDB state store).

A micro-batch has no order, so each processor sorts the rows of a key within the batch, by an external merge in the state store where they are
many. Where the key is a partition of the log, and so few keys carry everything, rows are merged into ranges or
single events inside each task before they are shuffled to the state.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keyflow import schema as S
from keyflow.operators.ops import DEFAULT_BAIL_MS, DEFAULT_LOG_INTERVAL_MS, kept_instants
from keyflow.streaming.state import RUN_STATE, SortedRows, with_state
from keyflow.streaming.watermark import commit_watermark_stream, stalled_partitions_stream

__all__ = ["commit_watermark_stream", "process_by_key_stream", "stalled_partitions_stream", "sustained_failures_stream", "throttle_stream"]

# Rows of one key sorted in memory; beyond that they go through the state store.
HELD_ROWS = 1 << 17

# ---- per-key ordered processing ------------------------------------------------------------------------------------


class _KeyProcessor(StatefulProcessor):
    def __init__(self, step, initial, ttl_ms, held):
        self.step, self.initial, self.ttl_ms, self.held = step, initial, ttl_ms, held

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "data binary", self.ttl_ms)
        self.runs = handle.getMapState("runs", *RUN_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = pickle.loads(self.state.get()[0]) if self.state.exists() else self.initial
        for pdf in SortedRows(self.runs, ["partition", "offset"], self.held).frames(rows):
            out = []
            for row in pdf.itertuples(index=False):
                state, produced = self.step(state, row)
                out.append(produced)
            yield pd.DataFrame(out)
        self.state.update((pickle.dumps(state),))

    def close(self) -> None:
        pass


def process_by_key_stream(
    df: DataFrame,
    step: Callable[[Any, Any], tuple[Any, dict]],
    out_schema: T.StructType | str,
    initial: Any = None,
    ttl_ms: int | None = None,
    held_rows: int = HELD_ROWS,
) -> DataFrame:
    """``keyflow.operators.ordering.process_by_key`` on a stream: the state of a key is carried from batch to batch.

    Memory holds ``held_rows`` rows of a key, however many a batch brings.
    ``ttl_ms`` drops the state of keys not seen for that long (needs processing time), without it state grows with the
    number of keys.
    """
    time_mode = "ProcessingTime" if ttl_ms else "None"
    return with_state(df, ["topic", "key_str"], _KeyProcessor(step, initial, ttl_ms, held_rows), out_schema, time_mode)


# ---- poll failures, throttle -----------------------------------------------------------------------------


class _SustainedFailures(StatefulProcessor):
    """State: when the current run of failures began (0: none) and whether it was reported."""

    def __init__(self, bail_us: int):
        self.bail_us = bail_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("run", "since bigint, reported boolean")
        self.runs = handle.getMapState("runs", *RUN_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        since, reported = self.state.get() if self.state.exists() else (0, False)
        for pdf in SortedRows(self.runs, ["at_us", "seq"], HELD_ROWS).frames(rows):
            ok, at = pdf["ok"].to_numpy(dtype=bool), pdf["at_us"].to_numpy(dtype=np.int64)
            failed = np.flatnonzero(~ok)
            # Failures with as many successes before them are one run; run 0 goes on from the rows before.
            runs, first, run_of = np.unique(np.cumsum(ok)[failed], return_index=True, return_inverse=True)
            began, told = at[failed[first]], np.zeros(len(runs), bool)
            if since and len(runs) and runs[0] == 0:
                began[0], told[0] = since, reported
            lasted = np.flatnonzero((at[failed] - began[run_of] >= self.bail_us) & ~told[run_of])
            hit, at_hit = np.unique(run_of[lasted], return_index=True)
            told[hit] = True
            if len(hit):
                rows_hit = failed[lasted[at_hit]]
                yield pd.DataFrame(
                    {"topic": key[0], "partition": key[1], "first_us": began[hit], "reported_us": at[rows_hit], "err": pdf["err"].to_numpy()[rows_hit]}
                )
            if len(ok):
                since, reported = (0, False) if ok[-1] else (int(began[-1]), bool(told[-1]))
        self.state.update((int(since), bool(reported)))

    def close(self) -> None:
        pass


def sustained_failures_stream(fetch_log: DataFrame, bail_ms: int = DEFAULT_BAIL_MS) -> DataFrame:
    """One row per run of failures, at the fetch with which it has lasted ``bail_ms``."""
    schema = "topic string, partition int, first_us bigint, reported_us bigint, err string"
    return with_state(fetch_log, S.PARTITION, _SustainedFailures(bail_ms * 1000), schema)


class _Throttle(StatefulProcessor):
    """State: the instant kept last."""

    def __init__(self, keys, time, width):
        self.keys, self.time, self.width = keys, time, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("kept", "at bigint")
        self.runs = handle.getMapState("runs", *RUN_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.state.get()[0] if self.state.exists() else None
        before = last
        instants = (pd.DataFrame({"at": np.unique(pdf[self.time].to_numpy(dtype=np.int64))}) for pdf in rows)
        for pdf in SortedRows(self.runs, ["at"], HELD_ROWS).frames(instants):
            kept = kept_instants(pdf["at"].to_numpy(), last, self.width)
            if kept:
                last = kept[-1]
                yield pd.DataFrame([(*key, k) for k in kept], columns=[*self.keys, self.time])
        if last != before:
            self.state.update((last,))

    def close(self) -> None:
        pass


def throttle_stream(
    df: DataFrame, keys: list[str], interval_ms: int = DEFAULT_LOG_INTERVAL_MS, time: str = "at_us"
) -> DataFrame:
    """Instants kept by the log throttle; rows must not come out of time order across batches."""
    types = {f.name: f for f in df.schema.fields}
    schema = T.StructType([*[types[k] for k in keys], T.StructField(time, T.LongType())])
    return with_state(df.select(*keys, time), keys, _Throttle(keys, time, interval_ms * 1000), schema)
