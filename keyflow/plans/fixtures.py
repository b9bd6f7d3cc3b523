"""The record log and the other inputs of the registered queries, derived from the given tables.

All are lazy projections or partial aggregates: no window, so they scale with the tables they read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow import schema as S
from keyflow.functions import traits
from keyflow.operators.ops import TUNABLES
from keyflow.operators.process import Reject, Tag, parse_json, process, with_framework_traits
from keyflow.sources.tables import records_from_table

PARTITIONS = 12
EPOCH_US = 1_704_067_200_000_000  # 2024-01-01, the first day of the events table
DAY_US = 86_400_000_000
STOP_US = EPOCH_US + 15 * DAY_US
END_US = EPOCH_US + 30 * DAY_US

VALIDATED, HIGH_VALUE, PURCHASE = 10, 11, 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def log_table(events: DataFrame) -> DataFrame:
    """The events table as it would look as a stored log, with the oddities a real log has.

    Twelve partitions by user, the event id as offset: offsets rise within a partition and have holes, as in a compacted
    topic. Some records have no key, a binary or an empty key, no value, an empty or malformed value.
    """
    return events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "'events' as topic",
        f"cast(user_id % {PARTITIONS} as int) as partition",
        "event_id as offset",
        """case when event_id % 29 = 0 then null when event_id % 31 = 0 then X'FFFE' when event_id % 37 = 0 then X''
             else cast(concat('u', user_id) as binary) end as key""",
        """case when event_id % 17 = 0 then null when event_id % 19 = 0 then X'' when event_id % 23 = 0 then cast('{bad' as binary)
             else cast(props as binary) end as value""",
        "case event_id % 10 when 0 then -1 when 1 then 1 when 2 then 99 else 0 end as timestampType",
        "cast(ts as timestamp) as timestamp",
        """array(named_struct('key', 'trace', 'value', if(event_id % 5 = 0, null, cast('t1' as binary))),
                 named_struct('key', 'trace', 'value', cast('t2' as binary)),
                 named_struct('key', 'kind', 'value', cast(event_type as binary))) as headers""",
        "unix_micros(cast(ts as timestamp)) as read_us",
        "cast(round(value * 100) as bigint) as cents",
    )


LOG_MAPPING = {
    n: n for n in ("topic", "partition", "offset", "key", "value", "timestamp", "timestampType", "headers")
}
EXTRA = ["event_type", "read_us", "cents"]


def records_of(events: DataFrame) -> DataFrame:
    """Works on the static events table and on a stream of it alike."""
    return records_from_table(log_table(events), LOG_MAPPING, keep=EXTRA)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(table(spark, sf_dir, "events"))


def rules() -> list[Reject]:
    _, parse_error = parse_json("value", "k int")
    return [
        Reject(F.col("value").isNull(), "record without a value"),
        Reject(None, parse_error),
        Reject(F.col("key_source") == "base64", F.concat(F.lit("binary key "), F.col("key_str"))),
    ]


def tags() -> list[Tag]:
    return [
        Tag(F.lit(True), VALIDATED),
        Tag(F.col("cents") > 5000, HIGH_VALUE),
        Tag(F.col("event_type") == "purchase", PURCHASE),
        Tag(F.col("event_type") == "view", 5),
    ]


def processed(records_df: DataFrame) -> DataFrame:
    return process(records_df, rules(), tags())


def attempts_of(records_df: DataFrame) -> DataFrame:
    """One attempt per record: queue wait up to 0.1 s, completion out of order, a few never finish."""
    out = processed(records_df)
    start = F.col("read_us") + (F.col("offset") % 1000) * 100
    done = start + F.col("cents") * 600_000
    pending = (F.col("event_type") == "error") & (F.col("offset") % 50 == 0)
    return out.select(
        *S.COORDINATES,
        F.lit(1).alias("attempt_no"),
        "key_str",
        "read_us",
        start.alias("start_us"),
        F.when(~pending, done).alias("done_us"),
        (F.col("cents") * 100).alias("proc_us"),
        "outcome",
        "error",
        "app_traits",
        (F.col("outcome") != "ok").alias("dead_lettered"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempts_of(records(spark, sf_dir))


REDELIVERY_DELAY_US = 3_600_000_000


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempts, every thirteenth record a second time an hour later."""
    base = attempts(spark, sf_dir).drop("attempt_no")
    twice = F.sequence(F.lit(1), F.when(F.col("offset") % 13 == 0, 2).otherwise(1))
    out = base.withColumn("attempt_no", F.explode(twice))
    shift = (F.col("attempt_no") - 1).cast("bigint") * REDELIVERY_DELAY_US
    return out.withColumns({c: F.col(c) + shift for c in ("read_us", "start_us", "done_us")})


def in_topics(df: DataFrame) -> DataFrame:
    """The log as two topics: every third partition is one of clicks."""
    return df.withColumn("topic", F.when(F.col("partition") % 3 == 2, "clicks").otherwise(F.col("topic")))


COMMIT_INTERVAL_US = 6 * 3_600_000_000


def dense_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempts as a log without holes: records spread round robin, offsets 0, 1, 2, ... in every partition."""
    i = F.col("offset")
    return attempts(spark, sf_dir).withColumns(
        {"partition": (i % PARTITIONS).cast("int"), "offset": F.call_function("div", i, F.lit(PARTITIONS))}
    )


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three assignments of about ten days per partition, with a minute between them; on some the first two overlap."""
    partitions = records(spark, sf_dir).select(*S.PARTITION).distinct()
    shift = F.col("partition").cast("bigint") * 3_600_000_000
    begin = F.lit(EPOCH_US) + F.col("epoch").cast("bigint") * 10 * DAY_US + shift
    late = F.when((F.col("partition") % 4 == 1) & (F.col("epoch") == 0), 3_600_000_000).otherwise(0)
    return partitions.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(2)))).select(
        *S.PARTITION, "epoch", begin.alias("assigned_us"), (begin + 10 * DAY_US - 60_000_000 + late).alias("revoked_us")
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch_log_of(records(spark, sf_dir))


def fetch_log_of(records_df: DataFrame) -> DataFrame:
    """One fetch per event; those of type error failed."""
    return records_df.select(
        *S.PARTITION,
        F.col("offset").alias("seq"),
        F.col("read_us").alias("at_us"),
        (F.col("event_type") != "error").alias("ok"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("timeout "), (F.col("offset") % 3).cast("string"))).alias("err"),
    )


def packets_of(deliveries_df: DataFrame) -> DataFrame:
    """Metrics packets of finished attempts, in nanoseconds."""
    i = F.col("offset")
    flagged = deliveries_df.filter("done_us is not null").withColumns(
        {"duplicate": F.col("attempt_no") > 1, "used_overflow": i % 41 == 0}
    )
    crash = F.when(i % 997 == 0, F.lit(1 << S.PROCESS_PANIC).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return with_framework_traits(flagged).select(
        "topic",
        F.concat(F.lit("group-"), (F.col("partition") % 2).cast("string")).alias("consumer_group"),
        F.lit('bill"ing').alias("service"),
        F.lit("").alias("team"),
        "partition",
        "offset",
        F.col("traits").bitwiseOR(crash).alias("traits"),
        (i % 50).cast("int").alias("queue_depth"),
        (F.col("proc_us") * 1000 - 10_000_000).alias("process_duration_ns"),
        F.when(F.col("dead_lettered"), (i % 97) * 1_000_000).otherwise(F.lit(0).cast("bigint")).alias("deadletter_duration_ns"),
        F.when(i % 11 == 0, F.lit(0).cast("bigint")).otherwise(F.col("read_us") * 1000).alias("read_time_ns"),
        (F.col("start_us") * 1000).alias("process_start_time_ns"),
        (F.col("done_us") * 1000).alias("watermark_advance_time_ns"),
    )


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_of(deliveries(spark, sf_dir))


PACKET_EVENTS = 100


def bandwidth_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One packet per hundred events, with a counter entry for each partition seen among them."""
    seq = F.call_function("div", F.col("offset"), F.lit(PACKET_EVENTS)).alias("seq")
    value_bytes = F.coalesce(F.octet_length("value"), F.lit(0)).cast("bigint")
    per_partition = records(spark, sf_dir).groupBy(seq, "topic", F.col("partition").alias("id")).agg(
        (F.sum(value_bytes) - 20).alias("received_bytes"),
        F.max("read_us").alias("_at"),
        F.count("*").alias("received_message_count"),
    )
    entry = F.struct(
        "id",
        "received_bytes",
        F.when(F.col("id") == 5, 0).otherwise(F.col("received_message_count") * 7).cast("bigint").alias("transmitted_bytes"),
        F.when(F.col("id") == 7, 0).otherwise(F.col("received_message_count")).cast("bigint").alias("received_message_count"),
        (F.col("received_message_count") * 3).alias("compressed_bytes"),
        F.when(F.col("id") % 4 == 0, 0).otherwise(F.col("received_message_count") * 9).cast("bigint").alias("uncompressed_bytes"),
        F.lit("b1").alias("leader"),
        F.element_at(F.array(F.lit("lz4"), F.lit(""), F.lit("zstd")), (F.col("id") % 3 + 1).cast("int")).alias("compression"),
    )
    # At most one entry per partition of the topic.
    grouped = per_partition.groupBy("seq", "topic").agg(
        F.array_sort(F.collect_list(entry)).alias("partitions"), F.max("_at").alias("_at")
    )

    def broker(number: str, host: Column) -> Column:
        return F.struct(
            F.lit(number).alias("id"), host.alias("host"), F.lit("9092").alias("port"), F.concat(F.lit("r"), F.lit(number)).alias("rack")
        )

    moved = F.concat(F.lit("h2-"), (F.col("seq") % 3).cast("string"))
    two = F.array(broker("1", F.lit("h1")), broker("2", moved))
    three = F.array(broker("1", F.lit("h1")), broker("2", moved), broker("3", F.lit("h3")))
    return grouped.select(
        "seq",
        F.when(F.col("seq") % 7 == 0, F.lit(0).cast("bigint")).otherwise(F.col("_at") * 1000).alias("ts_unix_ns"),
        (F.lit(5000) + F.col("seq") % 5 * 500).alias("stats_interval_ms"),
        F.lit("m-1").alias("metrics_id"),
        "topic",
        F.concat(F.lit("group-"), (F.col("seq") % 2).cast("string")).alias("consumer_group"),
        F.concat(F.lit("svc-"), (F.col("seq") % 3).cast("string")).alias("service"),
        F.lit("core").alias("team"),
        F.when(F.col("seq") % 4 == 0, three).otherwise(two).alias("brokers"),
        "partitions",
    )


SNAPSHOT_EVENTS = 50


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per fifty events; some malformed, some without a section or a field, some with unknown fields."""
    snap = F.call_function("div", F.col("offset"), F.lit(SNAPSHOT_EVENTS)).alias("snap_id")
    per_partition = records(spark, sf_dir).groupBy(snap, "partition").agg(
        F.max("offset").alias("hi"), F.min("offset").alias("lo"), F.count("*").alias("n")
    )
    text = F.transform(
        F.array_sort(F.collect_list(F.struct("partition", "hi", "lo", "n"))),
        lambda p: F.format_string(
            '{"partition":%d,"committedOffset":%d,"highestReadyOffset":%d,"maxOffsetSeen":%d,"gapBufferDepth":%d,"assigned":%s}',
            p["partition"],
            p["lo"],
            p["lo"],
            p["hi"],
            p["n"] - 1,
            F.when(p["partition"] % 2 == 0, "true").otherwise("false"),
        ),
    )
    grouped = per_partition.groupBy("snap_id").agg(F.concat_ws(",", text).alias("parts"), F.sum("n").alias("total"))
    total = F.col("total").cast("string")
    pick = F.col("snap_id") % 6
    doc = F.concat(
        F.when(pick == 3, '{"renamed":').otherwise('{"summary":'),
        F.lit('{"topicName":"events","assignedPartitionCount":12,'),
        F.when(pick == 4, F.lit('"extra":[1,2],"other":{"a":null},')).otherwise(""),
        F.lit('"totalProcessed":'),
        total,
        F.lit(',"lastRebalanceTime":"2024-01-01T00:00:00.000Z"},"throughput":{"windows":[{"fromTime":"a","toTime":"b","processedCount":'),
        total,
        F.lit(',"deadLetterCount":0},{"fromTime":"b","toTime":"c","processedCount":0,"deadLetterCount":1}],"totalProcessed":'),
        total,
        F.when(pick == 5, "").otherwise(',"totalDeadLettered":1'),
        F.lit(',"avgProcessDuration":"2.25ms","maxProcessDuration":"71ms","avgEndToEndDuration":"8ms",'),
        F.lit('"maxEndToEndDuration":"4m5s","minEndToEndDuration":"0s"},"preCommits":{"partitions":['),
        F.col("parts"),
        F.lit(']},"concurrency":{"guardActive":1,"guardCapacity":250,"overflowActive":0,"overflowCapacity":30,'),
        F.lit('"commitIngestActive":4,"commitIngestCapacity":900},"shards":[{"shard":0,"activeWorkers":3,"pooledWorkers":8}]}'),
    )
    return grouped.select("snap_id", F.when(pick == 2, F.lit("{not json")).otherwise(doc).alias("doc"))


SETTING_KEYS = [name for name, *_ in TUNABLES] + ["rebalance.timeout.ms", "drain_timeout", "no.such.key"]


def service_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings of a fleet from the customers: a service per five customers, a setting per customer, odd values included."""
    c = F.col("c_custkey")
    key = F.element_at(F.array(*[F.lit(k) for k in SETTING_KEYS]), (c % len(SETTING_KEYS) + 1).cast("int"))
    amount = F.floor(F.abs(F.col("c_acctbal"))).cast("bigint")
    kind = c % 7
    value = (
        F.when(kind == 0, F.concat((amount * 10).cast("string"), F.lit("ms")))
        .when(kind == 1, (amount * 10).cast("string"))
        .when(kind == 2, F.concat((amount % 90).cast("string"), F.lit("s")))
        .when(kind == 3, F.element_at(F.array(*[F.lit(str(1 << n)) for n in range(8)]), (amount % 8 + 1).cast("int")))
        .when(kind == 4, "0")
        .when(kind == 5, (amount % 400).cast("string"))
        .otherwise("fast")
    )
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("svc-"), F.call_function("div", c, F.lit(5)).cast("string")).alias("service"),
        key.alias("key"),
        value.alias("value"),
    )


def timeout_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drain or a rebalance timeout, or both, per service, from the orders."""
    o = F.col("o_orderkey")
    amount = F.floor("o_totalprice").cast("bigint")
    both = F.array(
        F.struct(F.lit("drainTimeout").alias("key"), F.concat((amount % 60).cast("string"), F.lit("s")).alias("value")),
        F.struct(F.lit("rebalance.timeout.ms").alias("key"), ((amount % 70 + 1) * 1000).cast("string").alias("value")),
    )
    some = F.when(o % 3 == 0, F.slice(both, 1, 1)).when(o % 3 == 1, F.slice(both, 2, 1)).otherwise(both)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("svc-"), o.cast("string")).alias("service"), F.inline(some)
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        micros("ts").alias("at_us"),
        (F.col("event_id") % 5).cast("int").alias("level"),
        F.col("event_type").alias("logger"),
        F.col("props").alias("message"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop reasons of a fleet, from the orders."""
    o = F.col("o_orderkey")
    number = (o % 12).cast("string")
    reason = (
        F.when(o % 6 == 0, F.lit("graceful shutdown"))
        .when(
            o % 6 == 1,
            F.concat(
                F.lit("pipeline-worker: circuit-breaker triggered processing partition "), number, F.lit(", offset "), o.cast("string")
            ),
        )
        .when(o % 6 == 2, F.concat(F.lit("partition events["), number, F.lit("] failing to fetch for 10m0s: timeout")))
        .when(o % 6 == 3, F.concat(F.lit("error -"), (o % 8 + 1).cast("string"), F.lit(": details")))
        .when(o % 6 == 4, F.lit("disk full"))
        .otherwise("")
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("svc-"), (F.col("o_custkey") % 20).cast("string")).alias("service"),
        micros("o_orderdate").alias("at_us"),
        reason.alias("reason"),
    )


def end_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next offset to be written on each partition."""
    return records(spark, sf_dir).groupBy(*S.PARTITION).agg((F.max("offset") + 1).alias("end_offset"))


TRAIT_NAMES = {VALIDATED: "validated", HIGH_VALUE: "high_value", PURCHASE: "purchase"}
FLAG_NAMES = list(traits.FRAMEWORK_FLAGS)
