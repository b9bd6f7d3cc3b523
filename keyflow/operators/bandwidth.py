"""Bandwidth counters and broker topology from bandwidth packets, and bandwidth metered from the records themselves."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow import schema as S
from keyflow.functions.envelope import record_bytes

# Defaults and limits of the two intervals.
DEFAULT_STATS_INTERVAL_MS = 60_000
MIN_STATS_INTERVAL_MS = 1_000
MAX_STATS_INTERVAL_MS = 12 * 3_600_000
DEFAULT_FLUSH_INTERVAL_MS = 60_000
UNKNOWN_COMPRESSION = "unknown"

UNIT_US = {
    "week": 604_800_000_000, "day": 86_400_000_000, "hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000, "millisecond": 1_000,
    "microsecond": 1,
}

GROUP = S.TOPOLOGY_LABELS


def check_stats_interval(interval_ms: int) -> int:
    if not MIN_STATS_INTERVAL_MS <= interval_ms <= MAX_STATS_INTERVAL_MS:
        raise ValueError(f"stats interval must be from {MIN_STATS_INTERVAL_MS} to {MAX_STATS_INTERVAL_MS} ms, got {interval_ms}")
    return interval_ms


def interval_millis(interval: str) -> int:
    """Milliseconds of an interval of weeks to microseconds, as :func:`pyspark.sql.functions.window` takes it, for example ``1 minute 30 seconds``."""
    parts = interval.lower().removeprefix("interval ").split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not an interval: {interval!r}")
    micros = Fraction(0)
    for number, unit in zip(parts[::2], parts[1::2], strict=True):
        size = UNIT_US.get(unit.removesuffix("s"))
        if size is None:
            raise ValueError(f"not an interval of fixed length: {interval!r}")
        micros += Fraction(number) * size
    return int(micros // 1000)


def _per_partition(packets: DataFrame) -> DataFrame:
    return packets.select(*GROUP, F.explode("partitions").alias("p")).select(*GROUP, "p.*")


def _total(name: str) -> Column:
    """Sum of the positive per-interval deltas; null when there was none, as the series then does not exist."""
    return F.sum(F.when(F.col(name) > 0, F.col(name)))


def bandwidth_counters(packets: DataFrame) -> DataFrame:
    """Accumulated bytes and messages per partition. Partitions with no positive delta at all have no row."""
    names = {
        "received_bytes": "received_bytes",
        "transmitted_bytes": "transmitted_bytes",
        "received_message_count": "received_messages",
    }
    out = (
        _per_partition(packets)
        .groupBy(*GROUP, F.col("id").alias("partition"))
        .agg(*[_total(source).alias(target) for source, target in names.items()])
    )
    return out.filter(F.coalesce(*names.values()).isNotNull())


def bandwidth_compression(packets: DataFrame) -> DataFrame:
    """Compressed and uncompressed bytes per partition and algorithm; an empty name counts as unknown."""
    algorithm = F.coalesce(F.nullif(F.col("compression"), F.lit("")), F.lit(UNKNOWN_COMPRESSION))
    out = (
        _per_partition(packets)
        .groupBy(*GROUP, F.col("id").alias("partition"), algorithm.alias("compression"))
        .agg(_total("compressed_bytes").alias("compressed_bytes"), _total("uncompressed_bytes").alias("uncompressed_bytes"))
    )
    return out.filter(F.coalesce("compressed_bytes", "uncompressed_bytes").isNotNull())


def _topology(packets: DataFrame) -> DataFrame:
    """State at the last packet (by ``seq``), the interval in milliseconds."""
    collected = F.call_function("div", F.col("ts_unix_ns"), F.lit(1_000_000_000))
    with_time = F.when(F.col("ts_unix_ns") != 0, F.col("seq"))
    return packets.groupBy(*GROUP).agg(
        F.max_by(F.size("brokers").cast("bigint"), "seq").alias("broker_count"),
        F.max_by(F.size("partitions").cast("bigint"), "seq").alias("partition_count"),
        F.max_by("stats_interval_ms", "seq").alias("stats_interval_ms"),
        F.max_by(collected, with_time).alias("last_collection_timestamp_seconds"),
    )


def topology_gauges(packets: DataFrame) -> DataFrame:
    """State at the last packet (by ``seq``). The collection time is that of the last packet that carries one."""
    interval = (F.col("stats_interval_ms") / 1000.0).alias("stats_interval_seconds")
    return _topology(packets).select(*GROUP, "broker_count", "partition_count", interval, "last_collection_timestamp_seconds")


def broker_info(packets: DataFrame) -> DataFrame:
    """One row per broker label set ever seen, value 1; rows of an earlier topology stay."""
    brokers = packets.select(*GROUP, F.explode("brokers").alias("b"))
    return (
        brokers.select(
            *GROUP,
            F.col("b.id").alias("broker_id"),
            F.col("b.host").alias("broker_host"),
            F.col("b.port").alias("broker_port"),
            F.col("b.rack").alias("broker_rack"),
        )
        .distinct()
        .withColumn("value", F.lit(1))
    )


def _series(df: DataFrame, kind: str, values: dict[str, tuple[Column, int]], labels: list[str], extra: dict[str, Column]) -> DataFrame:
    """A wide table of figures as long series: one row per figure that is not null. ``extra`` are labels beyond the common ones."""
    more = F.array(*[F.struct(F.lit(n).alias("name"), c.cast("string").alias("value")) for n, c in extra.items()])
    cells = [F.struct(F.lit(n).alias("metric"), c.cast("bigint").alias("value"), F.lit(scale).alias("scale")) for n, (c, scale) in values.items()]
    more = more if extra else more.cast("array<struct<name:string,value:string>>")
    present = F.filter(F.array(*cells), lambda c: c["value"].isNotNull())
    common = [F.col(n) if n in labels else F.lit(None).cast("int").alias(n) for n in S.MESSAGE_LABELS]
    return df.select(*common, more.alias("extra"), F.inline(present)).select(
        F.lit("bandwidth").alias("subsystem"), "metric", F.lit(kind).alias("type"), *S.MESSAGE_LABELS, "extra",
        F.lit(None).cast("string").alias("le"), F.lit(0).alias("sort"), "value", "scale",
    )


def bandwidth_long(packets: DataFrame) -> DataFrame:
    """The ten bandwidth and topology families as series, in the columns of :func:`keyflow.operators.metrics.metrics_long`.

    Families differ in their labels: counters have a partition, those of compression the algorithm too, the topology has neither, and brokers are told
    by four labels of their own.
    """
    per_partition = [*GROUP, "partition"]
    counters = {f"{n}_total": (F.col(n), 0) for n in ("received_bytes", "transmitted_bytes", "received_messages")}
    packed = {f"{n}_total": (F.col(n), 0) for n in ("compressed_bytes", "uncompressed_bytes")}
    state = {
        "broker_count": (F.col("broker_count"), 0),
        "partition_count": (F.col("partition_count"), 0),
        "stats_interval_seconds": (F.col("stats_interval_ms") * 1_000_000, 9),
        "last_collection_timestamp_seconds": (F.col("last_collection_timestamp_seconds"), 0),
    }
    broker = {n: F.col(n) for n in ("broker_id", "broker_host", "broker_port", "broker_rack")}
    parts = [
        _series(bandwidth_counters(packets), "counter", counters, per_partition, {}),
        _series(bandwidth_compression(packets), "counter", packed, per_partition, {"compression": F.col("compression")}),
        _series(_topology(packets), "gauge", state, list(GROUP), {}),
        _series(broker_info(packets), "gauge", {"broker_info": (F.col("value"), 0)}, list(GROUP), broker),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def bandwidth_from_records(records: DataFrame, interval: str = "1 minute", time: str = "event_ts") -> DataFrame:
    """Bytes and messages received per partition in tumbling intervals; records without a timestamp are left out.

    Also works on a stream, with a watermark on ``time``. Wire compression is not visible from records. The interval must lie within the
    limits of the statistics interval.
    """
    check_stats_interval(interval_millis(interval))
    size = record_bytes("key", "value", "headers")
    return (
        records.filter(F.col(time).isNotNull())
        .groupBy(*S.PARTITION, F.window(time, interval).alias("w"))
        .agg(F.sum(size).alias("received_bytes"), F.count("*").alias("received_message_count"))
        .select(
            *S.PARTITION,
            F.unix_millis(F.col("w.start")).alias("interval_start_ms"),
            "received_bytes",
            "received_message_count",
            F.lit(0).cast("bigint").alias("compressed_bytes"),
            F.lit(0).cast("bigint").alias("uncompressed_bytes"),
            F.lit("").alias("compression"),
        )
    )
