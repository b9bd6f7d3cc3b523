"""Operational snapshot of a run: throughput windows, partition offsets, concurrency, shards, and the JSON document.

Everything is derived from the attempt, assignment and commit tables as of one instant, topic by topic. An attempt belongs to the time bucket
in which it finished.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow import schema as S
from keyflow.functions import sharding, text
from keyflow.operators import delivery
from keyflow.operators.metrics import DEFAULT_CONCURRENT_KEYS
from keyflow.operators.staging import stage

# The default sliding window is fifteen buckets of one second.
WINDOW_BUCKETS = 15
WINDOW_WIDTH_US = 1_000_000

# Fixed value: fields of the snapshot document, section by section.
SNAPSHOT_DDL = """
    summary struct<topicName:string, assignedPartitionCount:bigint, totalProcessed:bigint, lastRebalanceTime:string>,
    throughput struct<
        windows:array<struct<fromTime:string, toTime:string, processedCount:bigint, deadLetterCount:bigint>>,
        totalProcessed:bigint, totalDeadLettered:bigint, avgProcessDuration:string, maxProcessDuration:string,
        avgEndToEndDuration:string, maxEndToEndDuration:string, minEndToEndDuration:string>,
    preCommits struct<
        partitions:array<struct<partition:int, committedOffset:bigint, highestReadyOffset:bigint, maxOffsetSeen:bigint,
        gapBufferDepth:bigint, assigned:boolean>>>,
    concurrency struct<guardActive:bigint, guardCapacity:bigint, overflowActive:bigint, overflowCapacity:bigint,
        commitIngestActive:bigint, commitIngestCapacity:bigint>,
    shards array<struct<shard:bigint, activeWorkers:bigint, pooledWorkers:bigint>>
"""


@cache
def snapshot_schema() -> T.StructType:
    return T.StructType.fromDDL(SNAPSHOT_DDL)


def _failed() -> Column:
    return F.col("outcome") != "ok"


def as_of(attempts: DataFrame, at_us: int) -> DataFrame:
    """The attempt table as it looked at an instant: later reads are gone, later completions are open."""
    return attempts.filter(F.col("read_us") <= at_us).withColumn(
        "done_us", F.when(F.col("done_us") <= at_us, F.col("done_us"))
    )


def by_topic(*parts: DataFrame) -> DataFrame:
    """Tables with one row per topic side by side, without a join: stacked, then the one value of each column."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy("topic").agg(*[F.max(c).alias(c) for c in stacked.columns if c != "topic"])


def topics_of(*tables: DataFrame) -> DataFrame:
    """The topics found in any of the tables."""
    stacked = tables[0].select("topic")
    for table in tables[1:]:
        stacked = stacked.unionByName(table.select("topic"))
    return stacked.distinct()


def _spine(topics: DataFrame, n: int, name: str) -> DataFrame:
    """The numbers below ``n`` for each topic."""
    return topics.select("topic", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name))


def throughput_windows(
    attempts: DataFrame, as_of_us: int, buckets: int = WINDOW_BUCKETS, width_us: int = WINDOW_WIDTH_US, topics: DataFrame | None = None
) -> DataFrame:
    """Per topic, processed and dead-lettered counts of the ``buckets`` most recent buckets, oldest first; empty ones stay as 0."""
    begin = as_of_us - buckets * width_us
    inside = attempts.filter((F.col("done_us") >= begin) & (F.col("done_us") < as_of_us))
    counted = inside.groupBy(
        "topic", F.call_function("div", F.col("done_us") - begin, F.lit(width_us).cast("bigint")).cast("int").alias("bucket")
    ).agg(F.count("*").alias("_n"), F.count_if(_failed()).alias("_dead"))
    zero = F.lit(0).cast("bigint")
    spine = _spine(topics_of(attempts) if topics is None else topics, buckets, "bucket")
    # A few rows per topic: stacked and summed up instead of joined.
    stacked = spine.withColumns({"_n": zero, "_dead": zero}).unionByName(counted)
    start = F.lit(begin).cast("bigint") + F.col("bucket").cast("bigint") * width_us
    return stacked.groupBy("topic", "bucket").agg(F.sum("_n").alias("_n"), F.sum("_dead").alias("_dead")).select(
        "topic",
        "bucket",
        text.utc_millis_text_of_micros(start).alias("from_time"),
        text.utc_millis_text_of_micros(start + width_us).alias("to_time"),
        F.col("_n").alias("processed_count"),
        F.col("_dead").alias("dead_letter_count"),
    )


def window_latency(
    attempts: DataFrame, as_of_us: int, buckets: int = WINDOW_BUCKETS, width_us: int = WINDOW_WIDTH_US
) -> DataFrame:
    """Per topic, handler and end-to-end times in microseconds over the whole sliding window, by when they ended."""
    begin = as_of_us - buckets * width_us
    inside = (F.col("done_us") >= begin) & (F.col("done_us") < as_of_us)
    spent = F.when(inside, F.col("done_us") - F.col("start_us"))
    handler = attempts.groupBy("topic").agg(
        F.call_function("div", F.sum(spent), F.nullif(F.count(spent), F.lit(0))).alias("avg_process_us"), F.max(spent).alias("max_process_us")
    )
    advance = F.col("watermark_advance_us")
    e2e = F.col("end_to_end_us")
    whole = (
        delivery.watermark_advance(as_of(attempts, as_of_us))
        .filter((advance >= begin) & (advance < as_of_us))
        .groupBy("topic")
        .agg(
            F.call_function("div", F.sum(e2e), F.count(e2e)).alias("avg_end_to_end_us"),
            F.max(e2e).alias("max_end_to_end_us"),
            F.min(e2e).alias("min_end_to_end_us"),
        )
    )
    return by_topic(handler, whole)


def assigned_at(assignments: DataFrame, at_us: int) -> DataFrame:
    """The latest assignment of each partition at an instant and whether it is still in force."""
    latest = (
        assignments.filter(F.col("assigned_us") <= at_us)
        .groupBy(*S.PARTITION)
        .agg(F.max_by(F.struct("epoch", "assigned_us", "revoked_us"), "assigned_us").alias("_a"))
    )
    return latest.select(
        *S.PARTITION,
        F.col("_a.epoch").alias("epoch"),
        F.col("_a.assigned_us").alias("assigned_us"),
        F.coalesce(F.col("_a.revoked_us") > at_us, F.lit(True)).alias("assigned"),
    )


def summary(attempts: DataFrame, assignments: DataFrame, as_of_us: int) -> DataFrame:
    """Per topic: lifetime totals, partitions assigned now and the time of the last rebalance."""
    finished = (
        attempts.filter(F.col("done_us") <= as_of_us)
        .groupBy("topic")
        .agg(F.count("*").alias("total_processed"), F.count_if(_failed()).alias("total_dead_lettered"))
    )
    now = assigned_at(assignments, as_of_us).groupBy("topic").agg(
        F.count_if("assigned").alias("assigned_partition_count"), F.max("assigned_us").alias("_last")
    )
    stacked = finished.unionByName(now, allowMissingColumns=True)
    figures = ["assigned_partition_count", "total_processed", "total_dead_lettered"]
    totals = stacked.groupBy("topic").agg(
        *[F.coalesce(F.max(c), F.lit(0).cast("bigint")).alias(c) for c in figures], F.max("_last").alias("_last")
    )
    return totals.select(
        F.col("topic").alias("topic_name"),
        *figures,
        text.utc_millis_text_of_micros("_last").alias("last_rebalance_time"),
    )


def committed_at(commits: DataFrame, at_us: int) -> DataFrame:
    """The position last committed per partition at an instant; of commits at the same instant the higher one."""
    latest = F.max_by("committed_offset", F.struct("committed_us", "committed_offset"))
    return commits.filter(F.col("committed_us") <= at_us).groupBy(*S.PARTITION).agg(latest.alias("committed_offset"))


def partition_offsets(
    attempts: DataFrame, assignments: DataFrame, as_of_us: int, commits: DataFrame | None = None
) -> DataFrame:
    """Offsets per partition known from work, from assignment or from commits; -1 where there is no position yet.

    ``commits`` is a commit log (``topic, partition, committed_us, committed_offset``), as :func:`keyflow.operators.delivery.commit_log` gives it; what is
    ready has not been committed before the log says so. Without one no position counts as committed.
    """
    parts = [delivery.commit_watermark(as_of(attempts, as_of_us)), assigned_at(assignments, as_of_us).select(*S.PARTITION, "assigned")]
    none = F.lit(-1).cast("bigint")
    parts.append(committed_at(commits, as_of_us) if commits is not None else parts[0].select(*S.PARTITION, none.alias("committed_offset")))
    stacked = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return stacked.groupBy(*S.PARTITION).agg(
        F.coalesce(F.max("committed_offset"), none).alias("committed_offset"),
        F.coalesce(F.max("highest_ready_offset"), none).alias("highest_ready_offset"),
        F.coalesce(F.max("max_offset_seen"), none).alias("max_offset_seen"),
        F.coalesce(F.max("gap_buffer_depth"), F.lit(0).cast("bigint")).alias("gap_buffer_depth"),
        F.coalesce(F.max("assigned"), F.lit(False)).alias("assigned"),
    )


def _active_keys(attempts: DataFrame, at_us: int) -> DataFrame:
    running_now = (F.col("start_us") <= at_us) & (F.col("done_us").isNull() | (F.col("done_us") > at_us))
    return attempts.filter(running_now).select("topic", "key_str").distinct()


def concurrency(
    attempts: DataFrame, as_of_us: int, capacity: int = DEFAULT_CONCURRENT_KEYS, topics: DataFrame | None = None
) -> DataFrame:
    """Per topic, keys in flight at an instant against the limit. Channel figures of an engine have no counterpart: 0."""
    zero = F.lit(0).cast("bigint")
    found = _active_keys(attempts, as_of_us).groupBy("topic").agg(F.count("*").alias("_n"))
    spine = (topics_of(attempts) if topics is None else topics).select("topic", zero.alias("_n"))
    active = spine.unionByName(found).groupBy("topic").agg(F.sum("_n").alias("_n"))
    limit = F.lit(capacity).cast("bigint")
    return active.select(
        "topic",
        F.least(F.col("_n"), limit).alias("guard_active"),
        limit.alias("guard_capacity"),
        F.greatest(F.col("_n") - limit, zero).alias("overflow_active"),
        zero.alias("overflow_capacity"),
        zero.alias("commit_ingest_active"),
        zero.alias("commit_ingest_capacity"),
    )


def shards(
    attempts: DataFrame, as_of_us: int, count: int = sharding.DEFAULT_SHARDS, topics: DataFrame | None = None
) -> DataFrame:
    """Per topic, keys in flight per shard at an instant; shards without any stay with 0."""
    n = sharding.check_shards(count)
    zero = F.lit(0).cast("bigint")
    busy = (
        _active_keys(attempts, as_of_us)
        .groupBy("topic", sharding.key_shard("key_str", n).alias("shard"))
        .agg(F.count("*").alias("_n"))
    )
    spine = _spine(topics_of(attempts) if topics is None else topics, n, "shard").withColumn("_n", zero)
    return spine.unionByName(busy).groupBy("topic", "shard").agg(
        F.sum("_n").alias("active_workers"), F.max(zero).alias("pooled_workers")
    )


def snapshot_json(
    attempts: DataFrame,
    assignments: DataFrame,
    as_of_us: int,
    buckets: int = WINDOW_BUCKETS,
    width_us: int = WINDOW_WIDTH_US,
    capacity: int = DEFAULT_CONCURRENT_KEYS,
    shard_count: int = sharding.DEFAULT_SHARDS,
    commits: DataFrame | None = None,
) -> DataFrame:
    """One row per topic with its JSON document: ``topic, doc``. Lists hold the windows, partitions and shards of the topic only.

    A topic is in it when it has attempts or assignments, at the instant or later; what it has not done yet counts 0.
    """
    topics = stage(topics_of(attempts, assignments))

    def rows(df: DataFrame, name: str, fields: dict[str, Column]) -> DataFrame:
        item = F.struct(*[c.alias(n) for n, c in fields.items()])
        return df.groupBy("topic").agg(F.array_sort(F.collect_list(item)).alias(name))

    windows = rows(
        throughput_windows(attempts, as_of_us, buckets, width_us, topics),
        "windows",
        {
            "fromTime": F.col("from_time"),
            "toTime": F.col("to_time"),
            "processedCount": F.col("processed_count"),
            "deadLetterCount": F.col("dead_letter_count"),
        },
    )
    partitions = rows(
        partition_offsets(attempts, assignments, as_of_us, commits),
        "partitions",
        {
            "partition": F.col("partition"),
            "committedOffset": F.col("committed_offset"),
            "highestReadyOffset": F.col("highest_ready_offset"),
            "maxOffsetSeen": F.col("max_offset_seen"),
            "gapBufferDepth": F.col("gap_buffer_depth"),
            "assigned": F.col("assigned"),
        },
    )
    shard_rows = rows(
        shards(attempts, as_of_us, shard_count, topics),
        "shards",
        {
            "shard": F.col("shard").cast("bigint"),
            "activeWorkers": F.col("active_workers"),
            "pooledWorkers": F.col("pooled_workers"),
        },
    )
    joined = by_topic(
        summary(attempts, assignments, as_of_us).withColumnRenamed("topic_name", "topic"),
        windows,
        window_latency(attempts, as_of_us, buckets, width_us),
        partitions,
        concurrency(attempts, as_of_us, capacity, topics),
        shard_rows,
    )
    none = F.array().cast(snapshot_schema()["preCommits"].dataType["partitions"].dataType)

    def total(name: str) -> Column:
        return F.coalesce(name, F.lit(0).cast("bigint"))

    def duration(name: str) -> Column:
        return F.coalesce(text.format_duration(name), F.lit("0s"))

    document = F.struct(
        F.struct(
            F.col("topic").alias("topicName"),
            total("assigned_partition_count").alias("assignedPartitionCount"),
            total("total_processed").alias("totalProcessed"),
            F.coalesce("last_rebalance_time", F.lit("")).alias("lastRebalanceTime"),
        ).alias("summary"),
        F.struct(
            "windows",
            total("total_processed").alias("totalProcessed"),
            total("total_dead_lettered").alias("totalDeadLettered"),
            duration("avg_process_us").alias("avgProcessDuration"),
            duration("max_process_us").alias("maxProcessDuration"),
            duration("avg_end_to_end_us").alias("avgEndToEndDuration"),
            duration("max_end_to_end_us").alias("maxEndToEndDuration"),
            duration("min_end_to_end_us").alias("minEndToEndDuration"),
        ).alias("throughput"),
        F.struct(F.coalesce("partitions", none).alias("partitions")).alias("preCommits"),
        F.struct(
            F.col("guard_active").alias("guardActive"),
            F.col("guard_capacity").alias("guardCapacity"),
            F.col("overflow_active").alias("overflowActive"),
            F.col("overflow_capacity").alias("overflowCapacity"),
            F.col("commit_ingest_active").alias("commitIngestActive"),
            F.col("commit_ingest_capacity").alias("commitIngestCapacity"),
        ).alias("concurrency"),
        F.col("shards").alias("shards"),
    )
    return joined.select("topic", F.to_json(document).alias("doc"))


def _missing(value: Column, kind: T.DataType, path: str) -> Column:
    """Path of the first known field that is absent, else null."""
    absent = F.when(value.isNull(), F.lit(path))
    if isinstance(kind, T.StructType):
        inner = [_missing(value[f.name], f.dataType, f"{path}.{f.name}") for f in kind.fields]
        return F.coalesce(absent, *inner)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        element = kind.elementType

        def incomplete(item: Column) -> Column:
            hole = item.isNull()
            for field in element.fields:
                hole = hole | item[field.name].isNull()
            return hole

        return F.coalesce(absent, F.when(F.exists(value, incomplete), F.lit(f"{path}[]")))
    return absent


def parse_snapshots(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Adds ``snapshot`` (typed) and ``error``. Unknown fields are fine; a malformed document or a missing known field is not."""
    known = snapshot_schema().fields
    with_corrupt = T.StructType([*known, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(doc, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    out = df.withColumn("_p", parsed)
    p = F.col("_p")
    missing = F.coalesce(*[_missing(p[f.name], f.dataType, f.name) for f in known])
    error = F.when(p.isNull() | p["_corrupt_record"].isNotNull(), "malformed document").when(
        missing.isNotNull(), F.concat(F.lit("missing field: "), missing)
    )
    snapshot = F.struct(*[p[f.name].alias(f.name) for f in known])
    return out.withColumn("error", error).withColumn("snapshot", F.when(F.col("error").isNull(), snapshot)).drop("_p")


def snapshot_partitions(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """One row per partition of each good snapshot."""
    rows = parsed.filter("error is null").select(*keep, F.inline("snapshot.preCommits.partitions"))
    return rows.select(
        *keep,
        "partition",
        F.col("committedOffset").alias("committed_offset"),
        F.col("highestReadyOffset").alias("highest_ready_offset"),
        F.col("maxOffsetSeen").alias("max_offset_seen"),
        F.col("gapBufferDepth").alias("gap_buffer_depth"),
        "assigned",
    )


def snapshot_windows(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """One row per throughput bucket of each good snapshot."""
    rows = parsed.filter("error is null").select(*keep, F.inline("snapshot.throughput.windows"))
    return rows.select(
        *keep,
        F.col("fromTime").alias("from_time"),
        F.col("toTime").alias("to_time"),
        F.col("processedCount").alias("processed_count"),
        F.col("deadLetterCount").alias("dead_letter_count"),
    )
