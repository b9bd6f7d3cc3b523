"""Streaming forms that need no state of their own: built-in aggregates and event-time de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame

from keyflow import schema as S
from keyflow.operators import bandwidth, metrics


def message_metrics_stream(packets: DataFrame) -> DataFrame:
    """Running counters per label set (update or complete mode). State is one row per label set."""
    return metrics.message_counters(packets)


def message_gauges_stream(packets: DataFrame) -> DataFrame:
    return metrics.message_gauges(packets)


def drop_redeliveries_stream(df: DataFrame, delay: str, time: str = "event_ts") -> DataFrame:
    """The first row per record; copies arriving within ``delay`` of it (by ``time``) are dropped.

    State holds the coordinates of that span only. ``time`` must not be null.
    """
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(S.COORDINATES)


def dedupe_by_id_stream(df: DataFrame, id_cols: list[str], delay: str, time: str = "event_ts") -> DataFrame:
    """As :func:`drop_redeliveries_stream`, by an id from the payload."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(id_cols)


def bandwidth_stream(records: DataFrame, interval: str, delay: str, time: str = "event_ts") -> DataFrame:
    """Bandwidth per interval; an interval is emitted once no more of its records are expected."""
    return bandwidth.bandwidth_from_records(records.withWatermark(time, delay), interval, time)
