"""Streams cut into several micro-batches must give what the batch operators give."""

import time

import pytest
from helpers import ATTEMPT_SCHEMA, attempt, frame, random_attempts
from pyspark.sql import functions as F

from keyflow.operators import bandwidth, delivery, metrics, ordering
from keyflow.operators import ops as O
from keyflow.operators import process as P
from keyflow.sources import sinks
from keyflow.streaming import runner, stateful, stateless, watermark


def as_files(df, path, order, files=4):
    """Write rows as consecutive files, oldest first, so that a stream reads them in that order."""
    rows = df.orderBy(*order).collect()
    step = -(-len(rows) // files)
    for i in range(files):
        part = df.sparkSession.createDataFrame(rows[i * step : (i + 1) * step], df.schema).coalesce(1)
        part.write.mode("append").parquet(path)
        time.sleep(1.1)  # file sources order files by modification time
    return path


def stream(spark, path, schema):
    return runner.read_stream_of(spark, path, schema, max_files=1)


def drained(df, tmp_path, name, mode="update"):
    out = str(tmp_path / name)
    query = runner.collect_updates(df, out, str(tmp_path / f"{name}-checkpoint"), mode)
    query.awaitTermination()
    return df.sparkSession.read.parquet(out)


def latest(df, keys):
    rest = [c for c in df.columns if c not in (*keys, "batch_id")]
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("r"))
    return sorted(tuple([*[r[k] for k in keys], *r.r]) for r in out.collect())


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """Attempts in read order, in four files."""
    rows = [r for r in random_attempts(71, n=200, copies=0, pending=0.02)]
    df = frame(spark, rows)
    return df.cache(), as_files(df, str(tmp_path_factory.mktemp("log") / "log"), ["read_us", "partition", "offset"])


def test_counters(spark, tmp_path, log):
    df, path = log

    def packets(attempts):
        return attempts.select(
            "topic", F.lit("g").alias("consumer_group"), F.lit("").alias("service"), F.lit("").alias("team"), "partition", "offset",
            F.when(F.col("done_us").isNull(), 1).otherwise(0).cast("bigint").alias("traits"),
            F.col("offset").cast("int").alias("queue_depth"), F.col("start_us").alias("process_start_time_ns"),
        )

    keys = ["topic", "consumer_group", "service", "team", "partition"]
    got = drained(stateless.message_metrics_stream(packets(stream(spark, path, ATTEMPT_SCHEMA))), tmp_path, "counters")
    assert got.select("batch_id").distinct().count() == 4
    assert latest(got, keys) == sorted(map(tuple, metrics.message_counters(packets(df)).collect()))
    gauges = drained(stateless.message_gauges_stream(packets(stream(spark, path, ATTEMPT_SCHEMA))), tmp_path, "gauges")
    assert latest(gauges, keys) == sorted(map(tuple, metrics.message_gauges(packets(df)).collect()))


def test_process_by_key(spark, tmp_path, log):
    df, path = log

    def step(state, row):
        return state + row.offset, {"topic": row.topic, "key_str": row.key_str, "partition": row.partition, "offset": row.offset, "total": state + row.offset}

    schema = "topic string, key_str string, partition int, offset bigint, total bigint"
    # A key lives on one partition, as in a log.
    def keyed(d):
        return d.withColumn("key_str", F.concat("key_str", F.lit("-"), F.col("partition").cast("string")))

    got = drained(stateful.process_by_key_stream(keyed(stream(spark, path, ATTEMPT_SCHEMA)), step, schema, 0), tmp_path, "keys")
    want = sorted(map(tuple, ordering.process_by_key(keyed(df), step, schema, 0).collect()))
    assert sorted(map(tuple, got.drop("batch_id").collect())) == want
    # With next to no memory the rows of a key go through the state store.
    tight = stateful.process_by_key_stream(keyed(stream(spark, path, ATTEMPT_SCHEMA)), step, schema, 0, held_rows=3)
    assert sorted(map(tuple, drained(tight, tmp_path, "tight").drop("batch_id").collect())) == want


def test_read_watermark(spark, tmp_path, log):
    df, path = log
    got = drained(stateful.commit_watermark_stream(stream(spark, path, ATTEMPT_SCHEMA)), tmp_path, "read")
    want = delivery.commit_watermark(df)
    assert latest(got, ["topic", "partition"]) == sorted(map(tuple, want.select("topic", "partition", "highest_ready_offset", "max_offset_seen", "gap_buffer_depth").collect()))


def test_read_watermark_with_late_completions(spark, tmp_path):
    """Reads first, completions later and in another order."""
    steps = [
        ([attempt(o, o) for o in (3, 5, 9)], (-1, 9, 0)),
        ([attempt(9, 9, done=20)], (-1, 9, 1)),
        ([attempt(3, 3, done=21), attempt(12, 12)], (3, 12, 1)),
        ([attempt(5, 5, done=22)], (9, 12, 0)),
    ]
    path = str(tmp_path / "in")
    for rows, _ in steps:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    got = drained(stateful.commit_watermark_stream(stream(spark, path, ATTEMPT_SCHEMA)), tmp_path, "late")
    rows = [(r.highest_ready_offset, r.max_offset_seen, r.gap_buffer_depth) for r in got.orderBy("batch_id").collect()]
    assert rows == [want for _, want in steps]


def test_integer_watermark(spark, tmp_path):
    done = [7, 0, 1, 3, 2, 9, 5, 8, 4, 11]
    rows = [attempt(o, i, done=i + 1) for i, o in enumerate(done)]
    path = as_files(frame(spark, rows), str(tmp_path / "in"), ["read_us"], 5)
    got = drained(stateful.commit_watermark_stream(stream(spark, path, ATTEMPT_SCHEMA), "integer"), tmp_path, "integer")
    rows = [(r.highest_ready_offset, r.gap_buffer_depth) for r in got.orderBy("batch_id").collect()]
    assert rows == [(0, 1), (1, 2), (3, 2), (3, 4), (5, 4)]


def test_merge_ranges():
    import numpy as np

    lo, hi = watermark.merge_ranges(np.array([5, 1, 2, 9, 3]), np.array([7, 1, 8, 9, 3]))
    assert list(zip(lo, hi, strict=True)) == [(1, 9)]
    lo, hi = watermark.merge_ranges(np.array([5, 1]), np.array([5, 2]))
    assert list(zip(lo, hi, strict=True)) == [(1, 2), (5, 5)]


def test_throttle(spark, tmp_path):
    df = spark.createDataFrame([(k, at * 300_000) for at in range(40) for k in ("a", "b")], "k string, at_us bigint")
    path = as_files(df, str(tmp_path / "in"), ["at_us"])
    got = drained(stateful.throttle_stream(stream(spark, path, df.schema), ["k"], 1000), tmp_path, "throttle")
    want = O.throttle(df, ["k"], 1000).select("k", "at_us")
    assert sorted(map(tuple, got.select("k", "at_us").collect())) == sorted(map(tuple, want.collect()))


def test_sustained_failures(spark, tmp_path):
    minute = 60_000_000
    rows = [("t", 0, i, i * 2 * minute, i in (0, 9, 10), f"e{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "topic string, partition int, seq bigint, at_us bigint, ok boolean, err string")
    path = as_files(df, str(tmp_path / "in"), ["seq"])
    got = drained(stateful.sustained_failures_stream(stream(spark, path, df.schema)), tmp_path, "failures").collect()
    want = O.sustained_failures(df)
    assert sorted(r.first_us for r in got) == sorted(r.first_us for r in want.collect())
    assert all(r.reported_us - r.first_us == 10 * minute for r in got)


def test_drop_redeliveries(spark, tmp_path):
    rows = random_attempts(81, n=150, copies=0.3)
    df = frame(spark, rows).withColumn("event_ts", F.timestamp_seconds("read_us"))
    path = as_files(df, str(tmp_path / "in"), ["read_us", "attempt_no"])
    got = drained(stateless.drop_redeliveries_stream(stream(spark, path, df.schema), "1 day"), tmp_path, "dedupe", "append")
    coordinates = {(r[1], r[2]) for r in rows}
    assert got.count() == len(coordinates) and got.select("partition", "offset").distinct().count() == len(coordinates)


def test_watchdog_looks_at_the_contiguous_position(spark, tmp_path):
    """Offset 10 is finished while 1 to 9 are open; on partition 1 everything is finished; on partition 2 the watermark moves on."""
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    steps = [
        [attempt(o) for o in range(1, 10)] + [attempt(10, done=5), attempt(1, done=5, partition=1)] + [attempt(o, partition=2) for o in (1, 2)],
        [attempt(11, done=6), attempt(1, done=7, partition=2)],
        [attempt(o, done=8) for o in range(1, 10)] + [attempt(3, done=9, partition=2)],
    ]
    alarms = []
    for rows in steps:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
        df = stateful.stalled_partitions_stream(stream(spark, path, ATTEMPT_SCHEMA), 1)
        runner.collect_updates(df, out, checkpoint, "update", once=True).awaitTermination()
        found = spark.read.schema(df.schema).parquet(out)
        alarms.append(sorted((r.partition, r.first_open, r.highest_ready_offset, r.behind, r.held) for r in found.collect()))
    assert alarms[0] == []
    assert alarms[1] == [(0, 1, -1, 12, 2)]
    assert alarms[2] == [(0, 1, -1, 12, 2), (2, 2, 1, 2, 1)]


def rules(df):
    return P.process(df, [P.Reject(F.col("done_us").isNull(), "unfinished")], [P.Tag(F.lit(True), 10)])


def records(df):
    return df.drop("outcome", "error", "app_traits")


def run(spark, path, base, dead=None, **kwargs):
    source = records(stream(spark, path, ATTEMPT_SCHEMA))
    return runner.run_stream(source, rules, dead or f"{base}/dead", f"{base}/checkpoint", ok=f"{base}/ok", drain=True, **kwargs)


def test_run_splits_everything(spark, tmp_path, log):
    df, path = log

    def packets(outcomes):
        return outcomes.select("partition", "offset", "outcome")

    run(spark, path, tmp_path, packets=packets, packets_to=f"{tmp_path}/packets").awaitTermination()
    ok, dead = spark.read.parquet(f"{tmp_path}/ok"), spark.read.parquet(f"{tmp_path}/dead")
    assert ok.count() + dead.count() == df.count() == spark.read.parquet(f"{tmp_path}/packets").count()
    assert dead.count() == df.filter("done_us is null").count() and dead.select("reason").distinct().first().reason == "unfinished"


def test_run_with_staging_and_python_handler(spark, tmp_path, log):
    df, path = log

    def handler(message):
        if message.done_us is None:
            raise P.HandlerError("unfinished")

    source = records(stream(spark, path, ATTEMPT_SCHEMA))
    runner.run_stream(
        source, lambda d: P.process_udf(d, handler, ["done_us"]), f"{tmp_path}/dead", f"{tmp_path}/checkpoint", ok=f"{tmp_path}/ok",
        staging=f"{tmp_path}/staging", drain=True,
    ).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/ok").count() == df.filter("done_us is not null").count()


def test_failed_dead_letter_stops_and_replays(spark, tmp_path, log):
    df, path = log

    def broken(dead, batch_id):
        if batch_id == 2:
            raise OSError("store is down")
        sinks.write_dead_letters(dead, f"{tmp_path}/dead", batch_id)

    query = run(spark, path, tmp_path, dead=broken)
    with pytest.raises(Exception, match="store is down"):
        query.awaitTermination()
    committed = spark.read.parquet(f"{tmp_path}/ok").select("batch_id").distinct().count()
    assert committed == 2, "the failed batch wrote nothing downstream of the dead letters"
    run(spark, path, tmp_path).awaitTermination()
    ok, dead = spark.read.parquet(f"{tmp_path}/ok"), spark.read.parquet(f"{tmp_path}/dead")
    assert ok.count() + dead.count() == df.count()
    assert ok.select("partition", "offset").distinct().count() == ok.count()


def test_batch_replayed_after_its_outputs_were_written(spark, tmp_path, log):
    """A crash between the writes and the commit: the replay overwrites the folder of the batch."""
    df, path = log
    seen = []

    def dies_after_writing(packets, batch_id):
        seen.append(batch_id)
        if batch_id == 1 and seen.count(1) == 1:
            raise OSError("lost")

    def start():
        return run(spark, path, tmp_path, packets=lambda o: o, packets_to=dies_after_writing)

    with pytest.raises(Exception, match="lost"):
        start().awaitTermination()
    start().awaitTermination()
    assert seen.count(1) == 2
    ok, dead = spark.read.parquet(f"{tmp_path}/ok"), spark.read.parquet(f"{tmp_path}/dead")
    assert ok.count() + dead.count() == df.count()


def test_graceful_stop_finishes_the_batch(spark, tmp_path, log):
    df, path = log
    source = records(runner.read_stream_of(spark, path, ATTEMPT_SCHEMA))
    query = runner.run_stream(
        source, rules, f"{tmp_path}/dead", f"{tmp_path}/checkpoint", ok=f"{tmp_path}/ok", interval="1 hour"
    )
    while not query.recentProgress and query.isActive:
        time.sleep(0.1)
    assert runner.stop_gracefully(query) and not query.isActive
    ok, dead = spark.read.parquet(f"{tmp_path}/ok"), spark.read.parquet(f"{tmp_path}/dead")
    assert ok.count() + dead.count() == df.count()


def test_dead_letters_are_required(spark, log):
    with pytest.raises(ValueError):
        runner.run_stream(stream(spark, log[1], ATTEMPT_SCHEMA), rules, None, "unused")


def test_dedupe_by_id(spark, tmp_path):
    rows = [(i, f"id{i % 7}", i * 1_000_000) for i in range(60)]
    df = spark.createDataFrame(rows, "seq bigint, id string, at_us bigint").withColumn("at", F.timestamp_micros("at_us")).drop("at_us")
    path = as_files(df, str(tmp_path / "in"), ["seq"])
    got = drained(stateless.dedupe_by_id_stream(stream(spark, path, df.schema), ["id"], "1 hour", "at"), tmp_path, "ids", "append").collect()
    assert sorted(r.id for r in got) == [f"id{i}" for i in range(7)]
    assert all(r.seq < 15 for r in got), "of the first file"


def test_bandwidth(spark, tmp_path):
    df = spark.range(240).selectExpr(
        "'t' as topic", "cast(id % 2 as int) as partition", "id as offset", "cast('k' as binary) as key", "cast(repeat('v', cast(id % 5 as int)) as binary) as value",
        "cast(array() as array<struct<key:string,value:binary>>) as headers", "timestamp_seconds(id) as event_ts",
    )
    path = as_files(df, str(tmp_path / "in"), ["offset"])
    got = drained(stateless.bandwidth_stream(stream(spark, path, df.schema), "1 minute", "10 seconds"), tmp_path, "bandwidth", "append").drop("batch_id")
    want = [tuple(r) for r in bandwidth.bandwidth_from_records(df, "1 minute").collect() if r.interval_start_ms < 180_000]
    assert sorted(map(tuple, got.collect())) == sorted(want), "all intervals but the last, which may still grow"
