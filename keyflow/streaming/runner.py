"""The run loop as a Structured Streaming query: process, dead-letter, write, then commit.

A micro-batch is committed to the checkpoint only after everything it produced is written, so nothing is committed past
unfinished work. A batch that fails is replayed as a whole; every output lands in the folder of its ``batch_id`` and a
replay overwrites that folder, so replays add no duplicates to the outputs.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from keyflow.operators.process import split_outcomes
from keyflow.sources.sinks import batch_folder, overwrite_batch, write_dead_letters

Sink = str | Callable[[DataFrame, int], None]


def _write(df: DataFrame, sink: Sink, batch_id: int) -> None:
    if callable(sink):
        sink(df, batch_id)
    else:
        overwrite_batch(df, sink, batch_id)


def run_stream(
    records: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    dead_letters: Sink,
    checkpoint: str,
    ok: Sink | None = None,
    packets: Callable[[DataFrame], DataFrame] | None = None,
    packets_to: Sink | None = None,
    staging: str | None = None,
    drain: bool = False,
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start processing a stream of records.

    ``process`` adds ``outcome``, ``error`` and ``app_traits`` (``keyflow.operators.process``). A dead-letter sink is
    required: a path, or a function of (frame, batch id). If it raises, the query stops and the batch is not committed.
    ``ok`` takes the successful records; ``packets`` turns all outcomes into metrics rows for ``packets_to``.

    ``staging``: write the outcomes there once and read them back. Use it when ``process`` runs code that may answer
    differently when a lost task is repeated; otherwise outcomes are only kept on the executors for the batch.
    ``drain``: work off what is there, commit, end. ``interval``: time between batches, the commit interval.
    The size of a batch is bounded at the source (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``).
    """
    if dead_letters is None:
        raise ValueError("a dead-letter sink is required")

    def handle(batch: DataFrame, batch_id: int) -> None:
        outcomes = process(batch)
        if staging is not None:
            overwrite_batch(outcomes, staging, batch_id)
            # Only this batch's folder, with the schema that is known.
            outcomes = batch.sparkSession.read.schema(outcomes.schema).parquet(batch_folder(staging, batch_id))
        else:
            outcomes = outcomes.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, dead = split_outcomes(outcomes)
            if callable(dead_letters):
                dead_letters(dead, batch_id)
            else:
                write_dead_letters(dead, dead_letters, batch_id)
            if ok is not None:
                _write(good, ok, batch_id)
            if packets is not None and packets_to is not None:
                _write(packets(outcomes), packets_to, batch_id)
        finally:
            if staging is None:
                outcomes.unpersist()

    writer = records.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if drain:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def stop_gracefully(query: StreamingQuery, drain_seconds: float = 20.0) -> bool:
    """Stop between two batches, waiting up to ``drain_seconds`` for the running one.

    True when the query was idle at the stop, so nothing is repeated on the next start. Otherwise the running batch is
    abandoned uncommitted and replayed then.
    """
    deadline = time.monotonic() + drain_seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < deadline:
        time.sleep(0.05)
    idle = not query.isActive or not query.status["isTriggerActive"]
    query.stop()
    return idle


def collect_updates(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append", drain: bool = True, once: bool = False
) -> StreamingQuery:
    """Write what a streaming DataFrame emits to ``path``, one folder per batch.

    With ``once`` a single batch takes all there is. Operators with processing-time timers need it to end: as long as a timer may
    fire, a drain goes on with empty batches.
    """
    writer = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: overwrite_batch(batch, path, batch_id))
    )
    if once:
        return writer.trigger(once=True).start()
    return (writer.trigger(availableNow=True) if drain else writer).start()


def read_stream_of(spark: SparkSession, path: str, schema, file_format: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Files as a stream; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
