import re

import pytest
from helpers import attempt, frame, random_attempts
from pyspark.sql import functions as F

from keyflow.operators import bandwidth as B
from keyflow.operators import metrics as M

PACKET = (
    "topic string, consumer_group string, service string, team string, partition int, offset bigint, traits bigint, queue_depth int, "
    "process_duration_ns bigint, deadletter_duration_ns bigint, read_time_ns bigint, process_start_time_ns bigint"
)


def packet(traits=0, offset=0, depth=0, process=0, dead=0, read=0, start=0, partition=0, service="", group="g"):
    return ("orders", group, service, "", partition, offset, traits, depth, process, dead, read, start)


def packets(spark, *rows):
    return spark.createDataFrame(list(rows), PACKET)


def test_each_condition_counts_on_its_own(spark):
    row = M.message_counters(packets(spark, *[packet(1 << b) for b in range(8)], packet(0b110111), packet(1 << 45))).first()
    assert row.processed == 10
    assert (row.errored, row.panicked, row.dead_lettered, row.duplicate, row.used_overflow) == (2, 2, 2, 2, 2)


def test_label_sets_are_separate(spark):
    out = M.message_counters(packets(spark, packet(), packet(partition=1), packet(service="a"), packet(group="h"), packet()))
    assert sorted(r.processed for r in out.collect()) == [1, 1, 1, 2]


def test_gauges_take_the_last_packet_zero_included(spark):
    row = M.message_gauges(packets(spark, packet(depth=7, offset=42, start=5), packet(depth=0, offset=0, start=6))).first()
    assert (row.queue_depth, row.current_offset) == (0, 0)
    tie = M.message_gauges(packets(spark, packet(depth=1, offset=1, start=5), packet(depth=2, offset=2, start=5))).first()
    assert (tie.queue_depth, tie.current_offset) == (2, 2)


def test_histogram_bounds():
    labels = [M.seconds_label(b) for b in M.bounds_ns(*M.PROCESS_BUCKETS)]
    assert (len(labels), labels[0], labels[8], labels[-1]) == (15, "0.001", "0.256", "16.384")
    waits = [M.seconds_label(b) for b in M.bounds_ns(*M.QUEUE_WAIT_BUCKETS)]
    assert (len(waits), waits[0], waits[-1]) == (18, "0.0001", "13.1072")


def test_histogram_is_cumulative_and_inclusive(spark):
    rows = [packet(process=n) for n in (1, 1_000_000, 1_000_001, 2_000_000, 16_384_000_000, 16_384_000_001)]
    out = {r.le: r for r in M.process_histogram(packets(spark, *rows)).collect()}
    assert len(out) == 16
    assert (out["0.001"].cumulative, out["0.002"].cumulative, out["16.384"].cumulative, out["+Inf"].cumulative) == (2, 4, 5, 6)
    assert out["+Inf"].sum_ns == sum(r[8] for r in rows)


def test_zero_and_negative_are_not_observed(spark):
    df = packets(spark, packet(), packet(process=-5, dead=-5, read=10, start=4))
    assert M.process_histogram(df).count() == M.dead_letter_histogram(df).count() == M.queue_wait_histogram(df).count() == 0


def test_queue_wait_needs_both_times(spark):
    df = packets(spark, packet(read=0, start=9), packet(read=9, start=0), packet(read=1_000_000, start=3_000_000))
    row = M.queue_wait_histogram(df).filter("le = '+Inf'").first()
    assert (row.observations, row.sum_ns) == (1, 2_000_000)


def lines(spark, *rows):
    return [r.line for r in M.exposition(M.metrics_long(packets(spark, *rows)), "app").collect()]


def test_exposition(spark):
    text = lines(spark, packet(depth=7, offset=42, process=2_000_000, dead=4_000_000, read=1_000_000, start=3_000_000, service='a"b\\c\nd'))
    labels = 'topic="orders",consumer_group="g",service="a\\"b\\\\c\\nd",team="",partition="0"'
    assert f"app_engine_processed_total{{{labels}}} 1" in text
    assert f"app_engine_queue_depth{{{labels}}} 7" in text
    assert f"app_engine_current_offset{{{labels}}} 42" in text
    assert f"app_engine_process_duration_seconds_sum{{{labels}}} 0.002" in text
    assert f"app_engine_dead_letter_duration_seconds_sum{{{labels}}} 0.004" in text
    assert f'app_engine_queue_wait_duration_seconds_bucket{{le="0.0016",{labels}}} 0' in text
    assert f'app_engine_queue_wait_duration_seconds_bucket{{le="0.0032",{labels}}} 1' in text
    assert not any("errored" in t for t in text), "a condition that never occurred has no series"
    assert text[-1] == "# EOF" and text[0].startswith("# TYPE app_engine_")
    family = None
    for t in text[:-1]:
        if t.startswith("# TYPE "):
            family = t.split()[2]
        else:
            assert re.sub("_(total|sum|count|bucket)$", "", t.split("{")[0]) == family, "samples follow their header"
    bounds = [t.split('le="')[1].split('"')[0] for t in text if "process_duration_seconds_bucket" in t]
    assert bounds == [M.seconds_label(b) for b in M.bounds_ns(*M.PROCESS_BUCKETS)] + ["+Inf"]


def test_exposition_without_observations(spark):
    text = lines(spark, packet())
    assert not any("duration" in t for t in text)


def test_whole_seconds_keep_a_decimal_point(spark):
    assert any(t.endswith("} 3.0") for t in lines(spark, packet(process=3_000_000_000)))


BANDWIDTH = (
    "seq bigint, ts_unix_ns bigint, stats_interval_ms bigint, topic string, consumer_group string, service string, team string, "
    "brokers array<struct<id:string,host:string,port:string,rack:string>>, partitions array<struct<id:int,received_bytes:bigint,"
    "transmitted_bytes:bigint,received_message_count:bigint,compressed_bytes:bigint,uncompressed_bytes:bigint,compression:string>>"
)


def bandwidth_rows(spark):
    """Two services; broker 2 of the first moves; a partition without any traffic; no collection time for the second."""
    first = [
        (1, 7_000_000_001, 5000, "orders", "g", "svc", "", [("1", "h1", "9", "r"), ("2", "h2", "9", "r")], [(0, 1000, 10, 3, 50, 90, "lz4"), (1, 0, 0, 0, 0, 0, "")]),
        (2, 9_500_000_000, 2500, "orders", "g", "svc", "", [("1", "h1", "9", "r"), ("2", 'h"3', "9", "r")], [(0, 1000, 0, 0, 8, 0, "")]),
    ]
    second = [(3, 0, 60_000, "orders", "g", "other", "team", [], [(0, 1, 0, 0, 0, 0, "")])]
    return spark.createDataFrame(first + second, BANDWIDTH)


def test_bandwidth_series_are_in_the_exposition(spark):
    long = M.metrics_long(packets(spark, packet(service="svc")), bandwidth_rows(spark))
    text = [r.line for r in M.exposition(long, "app").collect()]
    group = 'topic="orders",consumer_group="g",service="{}",team="{}"'
    one, other = group.format("svc", ""), group.format("other", "team")
    wanted = {
        f'app_bandwidth_received_bytes_total{{{one},partition="0"}} 2000',
        f'app_bandwidth_received_bytes_total{{{other},partition="0"}} 1',
        f'app_bandwidth_transmitted_bytes_total{{{one},partition="0"}} 10',
        f'app_bandwidth_received_messages_total{{{one},partition="0"}} 3',
        f'app_bandwidth_compressed_bytes_total{{{one},partition="0",compression="lz4"}} 50',
        f'app_bandwidth_compressed_bytes_total{{{one},partition="0",compression="unknown"}} 8',
        f'app_bandwidth_uncompressed_bytes_total{{{one},partition="0",compression="lz4"}} 90',
        f"app_bandwidth_broker_count{{{one}}} 2", f"app_bandwidth_broker_count{{{other}}} 0",
        f"app_bandwidth_partition_count{{{one}}} 1", f"app_bandwidth_partition_count{{{other}}} 1",
        f"app_bandwidth_stats_interval_seconds{{{one}}} 2.5", f"app_bandwidth_stats_interval_seconds{{{other}}} 60.0",
        f"app_bandwidth_last_collection_timestamp_seconds{{{one}}} 9",
        *(f'app_bandwidth_broker_info{{{one},broker_id="{i}",broker_host="{h}",broker_port="9",broker_rack="r"}} 1' for i, h in (("1", "h1"), ("2", "h2"), ("2", 'h\\"3'))),
    }
    assert {t for t in text if t.startswith("app_bandwidth_")} == wanted
    assert f'app_engine_processed_total{{{one},partition="0"}} 1' in text
    heads = [t.split()[2:] for t in text if t.startswith("# TYPE app_bandwidth_")]
    assert ["app_bandwidth_broker_count", "gauge"] in heads and ["app_bandwidth_received_bytes", "counter"] in heads and len(heads) == 10
    assert text[-1] == "# EOF" and len(text) == len(set(text))


def depth_at(rows, partition, at):
    return sum(r[1] == partition and r[5] <= at and (r[7] is None or r[7] > at) for r in rows)


@pytest.mark.parametrize("bits", [3, 20])
def test_queue_depth(spark, bits):
    rows = random_attempts(51, n=120)
    for r in M.queue_depth(frame(spark, rows), bits).collect():
        assert r.queue_depth == depth_at(rows, r.partition, r.at_us)


@pytest.mark.parametrize(("bits", "hot_rows"), [(3, 10), (20, 10**6)])
def test_keys_in_flight(spark, bits, hot_rows):
    rows = [r for r in random_attempts(61, n=120, keys=20) if r[7] is None or r[7] > r[6]]
    instants = sorted({r[6] for r in rows} | {r[7] for r in rows if r[7] is not None})

    def keys_at(at):
        return len({r[4] for r in rows if r[6] <= at and (r[7] is None or r[7] > at)})

    counts = [keys_at(at) for at in instants]
    limit = max(counts) - 2
    over = sum(b - a for a, b, n in zip(instants, instants[1:], counts, strict=False) if n > limit)
    got = M.inflight_keys(frame(spark, rows), limit, bits, hot_rows).first()
    assert (got.peak_keys, got.over_limit_us) == (max(counts), over)
    for r in M.keys_in_flight(frame(spark, rows), bits, hot_rows).collect():
        assert r.in_flight == keys_at(r.at_us)
    flagged = {(r.partition, r.offset, r.attempt_no) for r in M.flag_overflow(frame(spark, rows), limit).filter("used_overflow").collect()}
    assert flagged == {(r[1], r[2], r[3]) for r in rows if keys_at(r[6]) > limit}


def test_overlapping_attempts_of_a_key_count_once(spark):
    rows = [attempt(0, 0, 0, 10), attempt(1, 5, 5, 15), attempt(2, 7, 7, 8, key="other")]
    assert M.inflight_keys(frame(spark, rows), 1).first().peak_keys == 2


def test_failure_rates(spark):
    counters = M.message_counters(packets(spark, packet(0b101), packet(), packet(), packet(0b10000)))
    row = M.failure_rates(counters).first()
    assert (row.errored_per_million, row.dead_lettered_per_million, row.duplicate_per_million) == (250_000, 250_000, 250_000)


BW = (
    "seq bigint, ts_unix_ns bigint, stats_interval_ms bigint, topic string, consumer_group string, "
    "brokers array<struct<id:string,host:string,port:string,rack:string>>, "
    "partitions array<struct<id:int,received_bytes:bigint,transmitted_bytes:bigint,received_message_count:bigint,"
    "compressed_bytes:bigint,uncompressed_bytes:bigint,leader:string,compression:string>>"
)


def bw(spark, *rows):
    return spark.createDataFrame(list(rows), BW).withColumns({"service": F.lit("s"), "team": F.lit("")})


def entry(received=0, sent=0, messages=0, compressed=0, uncompressed=0, compression="", partition=0):
    return (partition, received, sent, messages, compressed, uncompressed, "1", compression)


def test_bandwidth_deltas_accumulate(spark):
    df = bw(spark, (0, 1, 5000, "t", "g", [], [entry(1000, messages=1)]), (1, 2, 5000, "t", "g", [], [entry(1000), entry(-7, partition=1)]))
    rows = {r.partition: r for r in B.bandwidth_counters(df).collect()}
    assert set(rows) == {0}
    assert (rows[0].received_bytes, rows[0].transmitted_bytes, rows[0].received_messages) == (2000, None, 1)


def test_services_of_a_group_stay_apart(spark):
    df = bw(spark, (0, 1, 5000, "t", "g", [("1", "h", "9092", "r")], [entry(1000, compressed=5)]))
    df = df.unionByName(df.withColumn("service", F.lit("other")))
    assert {r.service: r.received_bytes for r in B.bandwidth_counters(df).collect()} == {"s": 1000, "other": 1000}
    assert [f(df).count() for f in (B.bandwidth_compression, B.topology_gauges, B.broker_info)] == [2, 2, 2]


def test_compression(spark):
    df = bw(spark, (0, 1, 5000, "t", "g", [], [entry(compressed=128), entry(compressed=3, uncompressed=9, compression="lz4"), entry()]))
    got = {r.compression: (r.compressed_bytes, r.uncompressed_bytes) for r in B.bandwidth_compression(df).collect()}
    assert got == {"unknown": (128, None), "lz4": (3, 9)}


def test_topology(spark):
    b = [("1", "h1", "9092", "r"), ("2", "h2", "9092", "r")]
    moved = [("1", "h1", "9092", "r"), ("2", "h2-new", "9092", "r")]
    df = bw(spark, (0, 7_000_000_001, 5000, "t", "g", b, [entry()]), (1, 0, 5000, "t", "g", moved, []))
    row = B.topology_gauges(df).first()
    assert (row.broker_count, row.partition_count, row.stats_interval_seconds, row.last_collection_timestamp_seconds) == (2, 0, 5.0, 7)
    assert sorted(r.broker_host for r in B.broker_info(df).collect()) == ["h1", "h2", "h2-new"]
    never = bw(spark, (0, 0, 5000, "t", "g", b, []))
    assert B.topology_gauges(never).first().last_collection_timestamp_seconds is None


def test_stats_interval():
    assert B.check_stats_interval(60_000) == 60_000
    for bad in (999, 12 * 3_600_000 + 1):
        with pytest.raises(ValueError):
            B.check_stats_interval(bad)


def test_bandwidth_from_records(spark):
    df = spark.sql(
        """select 't' as topic, 0 as partition, cast('k' as binary) as key, cast(null as binary) as value,
        array(named_struct('key', 'é', 'value', cast('ab' as binary)), named_struct('key', 'x', 'value', cast(null as binary))) as headers,
        timestamp_millis(61000) as event_ts"""
    )
    df = df.unionByName(df.withColumn("event_ts", F.lit(None).cast("timestamp")))
    for bad in ("999 milliseconds", "13 hours", "1 month", "minute"):
        with pytest.raises(ValueError):
            B.bandwidth_from_records(df, bad)
    assert B.interval_millis("INTERVAL 1 minute 1.5 seconds") == 61_500
    row = B.bandwidth_from_records(df, "1 minute").collect()
    assert [(r.interval_start_ms, r.received_bytes, r.received_message_count) for r in row] == [(60000, 1 + 2 + 2 + 1, 1)]
