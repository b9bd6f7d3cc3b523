"""Registered queries that run a streaming job over a given table and return what it wrote.

Each drains the table as a stream (``availableNow``) into a fresh folder under the shared directory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow import schema as S
from keyflow.plans import fixtures as fx
from keyflow.plans.catalog import query
from keyflow.session import shared_dir
from keyflow.streaming import runner, stateful, stateless


def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fx.table(spark, sf_dir, "events").schema
    # As a pattern the path may be one file or a folder of files; a stream takes no plain file path.
    return runner.read_stream_of(spark, f"{sf_dir}/events.parque[t]", schema)


def _drain(df: DataFrame, mode: str = "append") -> DataFrame:
    """Run the stream to its end and read back all it emitted, with ``batch_id``."""
    spark, base = df.sparkSession, _run_dir(df.sparkSession)
    runner.collect_updates(df, f"{base}/out", f"{base}/checkpoint", mode).awaitTermination()
    return spark.read.schema(df.schema.add("batch_id", T.LongType())).parquet(f"{base}/out")


def _last(df: DataFrame, keys: list[str]) -> DataFrame:
    """The last emitted row per key."""
    rest = [c for c in df.columns if c not in (*keys, "batch_id")]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def _run(spark: SparkSession, sf_dir: str) -> str:
    base = _run_dir(spark)
    records = fx.records_of(_events(spark, sf_dir))
    runner.run_stream(
        records, fx.processed, f"{base}/dead", f"{base}/checkpoint", ok=f"{base}/ok", drain=True
    ).awaitTermination()
    return base


@query
def run_stream_ok(spark, sf_dir):
    out = spark.read.parquet(f"{_run(spark, sf_dir)}/ok")
    return out.select(*S.COORDINATES, "app_traits")


@query
def run_stream_dead(spark, sf_dir):
    out = spark.read.parquet(f"{_run(spark, sf_dir)}/dead")
    return out.select(*S.COORDINATES, "reason")


@query
def message_metrics_stream(spark, sf_dir):
    packets = fx.packets_of(fx.attempts_of(fx.records_of(_events(spark, sf_dir))))
    return _last(_drain(stateless.message_metrics_stream(packets), "update"), S.MESSAGE_LABELS)


@query
def drop_redeliveries_stream(spark, sf_dir):
    records = fx.records_of(_events(spark, sf_dir)).withColumn("read_ts", F.timestamp_micros("read_us"))
    # Every thirteenth record arrives twice.
    twice = records.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("offset") % 13 == 0, 2).otherwise(1))))
    return _drain(stateless.drop_redeliveries_stream(twice, "1 hour", "read_ts")).select(*S.COORDINATES, "key_str")


@query
def process_by_key_stream(spark, sf_dir):
    def step(state, row):
        count, total = state
        count, total = count + 1, total + row.cents
        return (count, total), {
            "topic": row.topic, "key_str": row.key_str, "offset": row.offset, "seen": count, "running_cents": total
        }

    rows = fx.records_of(_events(spark, sf_dir)).select(*S.COORDINATES, "key_str", "cents")
    schema = "topic string, key_str string, offset bigint, seen bigint, running_cents bigint"
    return _drain(stateful.process_by_key_stream(rows, step, schema, (0, 0)), "update").drop("batch_id")


@query
def commit_watermark_stream(spark, sf_dir):
    attempts = fx.attempts_of(fx.records_of(_events(spark, sf_dir)))
    return _last(_drain(stateful.commit_watermark_stream(attempts), "update"), S.PARTITION)


@query
def stalled_partitions_stream(spark, sf_dir):
    """The log in two deliveries, one batch each. Some records of odd partitions are read in the first and finished in the second."""
    base = _run_dir(spark)
    attempts = fx.attempts(spark, sf_dir)
    half = F.call_function("div", F.lit(attempts.agg(F.max("offset")).first()[0] or 0), F.lit(2))
    late = (F.col("partition") % 2 == 1) & (F.col("offset") % 7 == 3)
    first = attempts.filter(F.col("offset") < half).withColumn("done_us", F.when(~late, F.col("done_us")))
    second = attempts.filter((F.col("offset") >= half) | late)
    for part in (first, second):
        part.write.mode("append").parquet(f"{base}/in")
        alarms = stateful.stalled_partitions_stream(runner.read_stream_of(spark, f"{base}/in", attempts.schema), 1)
        runner.collect_updates(alarms, f"{base}/out", f"{base}/checkpoint", "update", once=True).awaitTermination()
    return spark.read.schema(alarms.schema.add("batch_id", T.LongType())).parquet(f"{base}/out")


def _shifted(df: DataFrame) -> DataFrame:
    return df.withColumn("read_ts", F.timestamp_micros("read_us"))


@query
def dedupe_by_id_stream(spark, sf_dir):
    """The first record of every key and event type; the delay spans the table, so none is forgotten."""
    records = _shifted(fx.records_of(_events(spark, sf_dir)))
    ids = ["key_str", "event_type"]
    return _drain(stateless.dedupe_by_id_stream(records, ids, "60 days", "read_ts")).select(*ids)


@query
def bandwidth_stream(spark, sf_dir):
    metered = stateless.bandwidth_stream(fx.records_of(_events(spark, sf_dir)), "1 hour", "60 days")
    return _last(_drain(metered, "update"), [*S.PARTITION, "interval_start_ms"])


@query
def sustained_failures_stream(spark, sf_dir):
    log = fx.fetch_log_of(fx.records_of(_events(spark, sf_dir)))
    return _drain(stateful.sustained_failures_stream(log), "update").drop("batch_id")


@query
def throttle_stream(spark, sf_dir):
    logs = _events(spark, sf_dir).select(
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"),
        (F.col("event_id") % 5).cast("int").alias("level"),
        F.col("event_type").alias("logger"),
    )
    out = _drain(stateful.throttle_stream(logs, ["logger", "level"], 3_600_000), "update")
    return out.drop("batch_id")
