"""The registered queries: one per operator, over whole tables. Binary columns are shown as hex text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow import schema as S
from keyflow.functions import envelope as E
from keyflow.functions import sharding, text, traits
from keyflow.operators import bandwidth, delivery, metrics, ops, ordering, snapshot
from keyflow.operators import process as P
from keyflow.operators.staging import stage
from keyflow.plans import fixtures as fx
from keyflow.session import prepare
from keyflow.sources import sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


# ---- envelope, headers, traits, text -------------------------------------------------------------------------------


@query
def order_events(spark, sf_dir):
    orders = tables.order_events(fx.table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate")
    return orders.select("number", F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"))


@query
def envelope(spark, sf_dir):
    return fx.records(spark, sf_dir).select(
        "topic",
        "partition",
        "offset",
        F.hex("key").alias("key_hex"),
        F.hex("value").alias("value_hex"),
        F.col("ts_kind").cast("int").alias("ts_kind"),
        "ts_millis",
        "key_str",
        "key_source",
    )


@query
def decode_timestamp(spark, sf_dir):
    log = fx.log_table(fx.table(spark, sf_dir, "events"))
    ts = E.decode_timestamp("timestampType", F.unix_millis("timestamp"))
    return log.select(
        "offset", ts["ts_kind"].cast("int").alias("ts_kind"), ts["ts_millis"].alias("ts_millis"),
        F.unix_millis(ts["event_ts"]).alias("event_ms"),
    )


@query
def normalise_key(spark, sf_dir):
    log = fx.log_table(fx.table(spark, sf_dir, "events"))
    return log.select("offset", *[c.alias(n) for n, c in E.normalise_key("key", "partition").items()])


@query
def value_text(spark, sf_dir):
    # The key stands in as a value, as only keys are binary here.
    return fx.records(spark, sf_dir).select(
        "offset", E.value_text("value").alias("value_text"), E.value_text("key").alias("key_as_text")
    )


@query
def lossy_text(spark, sf_dir):
    return fx.records(spark, sf_dir).select("offset", text.lossy_text("key").alias("key_text"))


@query
def truncate_utf8(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.truncate_utf8("text").alias("head"), text.truncate_utf8("text", 7).alias("head7"))


@query
def payload_kind(spark, sf_dir):
    return fx.records(spark, sf_dir).groupBy(E.payload_kind("value").alias("kind")).agg(F.count("*").alias("n"))


@query
def header_count(spark, sf_dir):
    return fx.records(spark, sf_dir).select("offset", E.header_count("headers").alias("headers"))


@query
def header_at(spark, sf_dir):
    columns = []
    for i in (0, 2, 3):
        h = E.header_at("headers", i)
        columns += [h["key"].alias(f"key{i}"), F.hex(h["value"]).alias(f"value{i}")]
    return fx.records(spark, sf_dir).select("offset", *columns)


@query
def header_find(spark, sf_dir):
    trace, kind, none = (E.header_find("headers", k) for k in ("trace", "kind", "absent"))
    return fx.records(spark, sf_dir).select(
        "offset",
        trace.isNotNull().alias("has_trace"),
        F.hex(trace["value"]).alias("trace"),
        E.value_text(kind["value"]).alias("kind"),
        none.isNotNull().alias("has_absent"),
    )


@query
def explode_headers(spark, sf_dir):
    rows = E.explode_headers(fx.records(spark, sf_dir).select("offset", "headers"))
    return rows.select("offset", "header_pos", "header_key", F.hex("header_value").alias("header_value"))


@query
def trait_bits(spark, sf_dir):
    r = fx.records(spark, sf_dir)
    both = traits.trait_or(
        traits.trait_bits(10, 9, 62, 64), traits.trait_when(F.col("cents") > 5000, 45), traits.trait_when(F.col("cents") > 0, 5)
    )
    return r.select("offset", both.alias("traits"))


@query
def decode_traits(spark, sf_dir):
    rows = traits.decode_traits(fx.packets(spark, sf_dir))
    return rows.select("partition", "offset", "process_start_time_ns", *traits.FRAMEWORK_FLAGS, "app_bits")


@query
def explode_traits(spark, sf_dir):
    rows = traits.explode_traits(fx.packets(spark, sf_dir), fx.TRAIT_NAMES)
    return rows.select("offset", "process_start_time_ns", "bit", "trait")


@query
def trait_counts(spark, sf_dir):
    return traits.trait_counts(fx.packets(spark, sf_dir), fx.TRAIT_NAMES)


@query
def parse_json(spark, sf_dir):
    parsed, error = P.parse_json("value", "k int")
    return fx.records(spark, sf_dir).select("offset", parsed["k"].alias("k"), error.alias("parse_error"))


@query
def utc_millis_text(spark, sf_dir):
    return fx.records(spark, sf_dir).select("offset", text.utc_millis_text_of_micros("read_us").alias("read_at"))


@query
def format_duration(spark, sf_dir):
    rows = fx.attempts(spark, sf_dir)
    spent = F.col("done_us") - F.col("start_us")
    return rows.select(
        "offset", text.format_duration(spent).alias("spent"), text.format_duration("proc_us").alias("handler")
    )


@query
def parse_duration(spark, sf_dir):
    rows = fx.attempts(spark, sf_dir)
    spent = F.col("done_us") - F.col("start_us")
    shown = rows.select("offset", text.format_duration(spent).alias("shown"))
    return shown.select("offset", text.parse_duration("shown").alias("spent_us"))


@query
def key_shard(spark, sf_dir):
    return fx.records(spark, sf_dir).select(
        "offset", "key_str", sharding.fnv1a_32("key_str").alias("hash"), sharding.key_shard("key_str").alias("shard")
    )


# ---- processing ----------------------------------------------------------------------------------------------------


@query
def require_equal(spark, sf_dir):
    orders = tables.order_events(fx.table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate")
    # Every 100th record gets a foreign key, so that there is something to find.
    key = F.when(F.col("number") % 100 == 7, F.lit("foreign")).otherwise(F.decode("key", "UTF-8"))
    body, _ = P.parse_json("value", "orderId string")
    rows = orders.withColumns({"key_str": key, "order_id": body["orderId"]})
    checked = P.process(rows, [P.require_equal(F.col("key_str"), F.col("order_id"), "record key differs from order id")])
    return checked.select("number", "outcome", "error")


@query
def process_rules(spark, sf_dir):
    return fx.processed(fx.records(spark, sf_dir)).select(*S.COORDINATES, "outcome", "error", "app_traits")


@query
def process_udf(spark, sf_dir):
    def handler(message):
        if message.value is None:
            raise P.HandlerError("record without a value")
        if message.value == b"":
            raise P.HandlerError("empty payload")
        if message.value == b"{bad":
            raise ValueError("crash")
        return 1 << 10 | 1 << 3

    rows = fx.records(spark, sf_dir).select(*S.COORDINATES, "value")
    return P.process_udf(rows, handler, ["value"]).drop("value")


@query
def process_batches(spark, sf_dir):
    """Rejects are answered as a column; a few records make the whole handler raise."""

    def handler(batch):
        import pyarrow as pa
        import pyarrow.compute as pc

        value, cents = batch.column("value"), batch.column("cents")
        bad = pc.equal(value, b"{bad")
        if pc.any(pc.and_(bad, pc.equal(pc.bit_wise_and(batch.column("offset"), 15), 0))).as_py():
            raise ValueError("crash")
        empty = pc.equal(pc.binary_length(value), 0)
        missing = pc.is_null(value)
        errors = pc.case_when(pc.make_struct(missing, empty, bad), "record without a value", "empty payload", "malformed", pa.scalar(None, pa.string()))
        bits = pc.add(1 << 10 | 1 << 3, pc.multiply(pc.cast(pc.greater(cents, 5000), "int64"), 1 << 11))
        return bits, errors

    rows = fx.records(spark, sf_dir).select(*S.COORDINATES, "value", "cents")
    return P.process_batches(rows, handler, ["offset", "value", "cents"]).drop("value", "cents")


@query
def no_traits_on_failure(spark, sf_dir):
    rows = fx.processed(fx.records(spark, sf_dir))
    return rows.groupBy("outcome").agg(
        F.count("*").alias("n"), F.count_if(F.col("app_traits") != 0).alias("with_traits")
    )


@query
def framework_traits(spark, sf_dir):
    rows = fx.attempts(spark, sf_dir).withColumn("used_overflow", F.col("offset") % 41 == 0)
    return P.with_framework_traits(rows).select(*S.COORDINATES, "traits")


@query
def split_outcomes_ok(spark, sf_dir):
    ok, _ = P.split_outcomes(fx.processed(fx.records(spark, sf_dir)))
    return ok.select(*S.COORDINATES, "app_traits")


@query
def split_outcomes_dead(spark, sf_dir):
    _, dead = P.split_outcomes(fx.processed(fx.records(spark, sf_dir)))
    return dead.select(*S.COORDINATES, "reason")


@query
def dead_letter_report(spark, sf_dir):
    _, dead = P.split_outcomes(fx.processed(fx.records(spark, sf_dir)))
    return P.dead_letter_report(dead)


@query
def replay_candidates(spark, sf_dir):
    _, dead = P.split_outcomes(fx.processed(fx.records(spark, sf_dir)))
    resolved = fx.records(spark, sf_dir).filter(F.col("cents") > 2000)
    return P.replay_candidates(dead, resolved).select(*S.COORDINATES, "reason")


@query
def latest_by_key(spark, sf_dir):
    rows = fx.records(spark, sf_dir).select(*S.COORDINATES, "key_str", "value")
    return P.latest_by_key(rows).select("topic", "key_str", "partition", "offset", F.hex("value").alias("value_hex"))


# ---- idempotent sinks ----------------------------------------------------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_SHOWN = [*LINE_KEYS, "l_partkey", "l_suppkey", "l_extendedprice"]


def _lines(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *LINE_ORDER)


@query
def insert_if_absent(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    target, new = lines.filter("l_shipdate < '1998-01-01'"), lines.filter("l_shipdate >= '1998-01-01'")
    return sinks.insert_if_absent(new, target, LINE_KEYS, LINE_ORDER).select(*LINE_SHOWN)


@query
def upsert_latest(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    target, new = lines.filter("l_shipdate < '1998-01-01'"), lines.filter("l_shipdate >= '1998-01-01'")
    return sinks.upsert_latest(new, target, LINE_KEYS, LINE_ORDER).select(*LINE_SHOWN)


@query
def content_key(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", sinks.content_key("lang", "source", "text").alias("content_key"))


# ---- ordering ------------------------------------------------------------------------------------------------------


@query
def process_by_key(spark, sf_dir):
    def step(state, row):
        count, total = state
        count, total = count + 1, total + row.cents
        return (count, total), {
            "topic": row.topic, "key_str": row.key_str, "offset": row.offset, "seen": count, "running_cents": total
        }

    rows = fx.records(spark, sf_dir).select(*S.COORDINATES, "key_str", "cents")
    schema = "topic string, key_str string, offset bigint, seen bigint, running_cents bigint"
    return ordering.process_by_key(rows, step, schema, (0, 0))


@query
def fold_by_key(spark, sf_dir):
    """As process_by_key, with states that can be put together. Keys are split from 100 records on here, so that these tables have hot ones."""

    def step(state, row):
        return state[0] + 1, state[1] + row.cents

    def merge(earlier, later):
        return earlier[0] + later[0], earlier[1] + later[1]

    def emit(state, row):
        return {"topic": row.topic, "key_str": row.key_str, "offset": row.offset, "seen": state[0], "running_cents": state[1]}

    rows = fx.records(spark, sf_dir).select(*S.COORDINATES, "key_str", "cents")
    schema = "topic string, key_str string, offset bigint, seen bigint, running_cents bigint"
    return ordering.fold_by_key(rows, step, merge, emit, schema, (0, 0), bits=10, hot_rows=100)


@query
def key_sequence(spark, sf_dir):
    rows = fx.records(spark, sf_dir).select(*S.COORDINATES, "key_str")
    return ordering.key_sequence(rows)


@query
def ordering_violations(spark, sf_dir):
    return ordering.ordering_violations(fx.attempts(spark, sf_dir))


@query
def shard_report(spark, sf_dir):
    return ordering.shard_report(fx.records(spark, sf_dir))


@query
def key_fanout(spark, sf_dir):
    return ordering.key_fanout(fx.records(spark, sf_dir))


# ---- delivery ------------------------------------------------------------------------------------------------------


@query
def commit_watermark_read(spark, sf_dir):
    return delivery.commit_watermark(fx.deliveries(spark, sf_dir))


@query
def commit_watermark_integer(spark, sf_dir):
    return delivery.commit_watermark(fx.dense_attempts(spark, sf_dir), mode="integer")


@query
def commit_buffered(spark, sf_dir):
    return delivery.commit_buffered(fx.deliveries(spark, sf_dir))


@query
def watermark_advance(spark, sf_dir):
    # A record that never finishes holds the watermark for good: what lies behind it has no advance time.
    return delivery.watermark_advance(fx.deliveries(spark, sf_dir))


@query
def flag_duplicates(spark, sf_dir):
    return delivery.flag_duplicates(fx.deliveries(spark, sf_dir)).select(*S.COORDINATES, "attempt_no", "duplicate")


@query
def drop_redeliveries(spark, sf_dir):
    return delivery.drop_redeliveries(fx.deliveries(spark, sf_dir)).select(*S.COORDINATES, "attempt_no", "read_us", "key_str")


@query
def dedupe_by_id(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    orders = fx.table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    seen = lines.join(orders, "l_orderkey", "left_semi").select(*LINE_KEYS)
    return delivery.dedupe_by_id(lines, LINE_KEYS, LINE_ORDER, seen).select(*LINE_SHOWN)


def _committed(spark, sf_dir):
    marks = delivery.commit_watermark(fx.attempts(spark, sf_dir))
    return marks.select(*S.PARTITION, F.col("highest_ready_offset").alias("committed_offset"))


@query
def redelivery_set(spark, sf_dir):
    rows = fx.records(spark, sf_dir).select(*S.COORDINATES, "key_str")
    return delivery.redelivery_set(rows, _committed(spark, sf_dir))


@query
def redelivered_work(spark, sf_dir):
    return delivery.redelivered_work(fx.deliveries(spark, sf_dir), fx.STOP_US)


@query
def drain_report(spark, sf_dir):
    return delivery.drain_report(fx.attempts(spark, sf_dir), fx.STOP_US, 20_000_000_000)


@query
def flag_orphaned(spark, sf_dir):
    rows = delivery.flag_orphaned(fx.attempts(spark, sf_dir), fx.assignments(spark, sf_dir))
    return rows.select(*S.COORDINATES, "epoch", "orphaned")


@query
def first_after_rebalance(spark, sf_dir):
    rows = delivery.flag_first_after_rebalance(fx.attempts(spark, sf_dir), fx.assignments(spark, sf_dir))
    return rows.filter("first_after_rebalance").select(*S.COORDINATES, "epoch", "read_us")


@query
def lag_report(spark, sf_dir):
    marks = delivery.commit_watermark(fx.attempts(spark, sf_dir))
    return delivery.lag_report(marks, fx.end_offsets(spark, sf_dir))


@query
def run_verdict(spark, sf_dir):
    return delivery.run_verdict(fx.deliveries(spark, sf_dir), 1000)


@query
def duplicate_rate(spark, sf_dir):
    return delivery.duplicate_rate(fx.deliveries(spark, sf_dir))


# ---- metrics -------------------------------------------------------------------------------------------------------


@query
def message_counters(spark, sf_dir):
    return metrics.message_counters(fx.packets(spark, sf_dir))


@query
def message_gauges(spark, sf_dir):
    return metrics.message_gauges(fx.packets(spark, sf_dir))


@query
def process_histogram(spark, sf_dir):
    return metrics.process_histogram(fx.packets(spark, sf_dir))


@query
def dead_letter_histogram(spark, sf_dir):
    return metrics.dead_letter_histogram(fx.packets(spark, sf_dir))


@query
def queue_wait_histogram(spark, sf_dir):
    return metrics.queue_wait_histogram(fx.packets(spark, sf_dir))


@query
def queue_depth(spark, sf_dir):
    return metrics.queue_depth(fx.attempts(spark, sf_dir))


@query
def inflight_keys(spark, sf_dir):
    return metrics.inflight_keys(fx.attempts(spark, sf_dir), limit=20)


@query
def flag_overflow(spark, sf_dir):
    rows = metrics.flag_overflow(fx.attempts(spark, sf_dir), limit=15)
    return rows.select(*S.COORDINATES, "used_overflow")


@query
def metrics_long(spark, sf_dir):
    out = metrics.metrics_long(fx.packets(spark, sf_dir), fx.bandwidth_packets(spark, sf_dir))
    return out.withColumn("extra", metrics.label_text(()))


@query
def exposition(spark, sf_dir):
    return metrics.exposition(metrics.metrics_long(fx.packets(spark, sf_dir), fx.bandwidth_packets(spark, sf_dir)))


@query
def failure_rates(spark, sf_dir):
    return metrics.failure_rates(metrics.message_counters(fx.packets(spark, sf_dir)))


# ---- bandwidth -----------------------------------------------------------------------------------------------------


@query
def bandwidth_counters(spark, sf_dir):
    return bandwidth.bandwidth_counters(fx.bandwidth_packets(spark, sf_dir))


@query
def bandwidth_compression(spark, sf_dir):
    return bandwidth.bandwidth_compression(fx.bandwidth_packets(spark, sf_dir))


@query
def topology_gauges(spark, sf_dir):
    return bandwidth.topology_gauges(fx.bandwidth_packets(spark, sf_dir))


@query
def broker_info(spark, sf_dir):
    return bandwidth.broker_info(fx.bandwidth_packets(spark, sf_dir))


@query
def bandwidth_from_records(spark, sf_dir):
    return bandwidth.bandwidth_from_records(fx.records(spark, sf_dir), "1 hour")


# ---- snapshot ------------------------------------------------------------------------------------------------------

WINDOW = {"buckets": 15, "width_us": 2 * fx.DAY_US}


def _two_topics(spark, sf_dir):
    return fx.in_topics(fx.deliveries(spark, sf_dir)), fx.in_topics(fx.assignments(spark, sf_dir))


@query
def throughput_windows(spark, sf_dir):
    return snapshot.throughput_windows(_two_topics(spark, sf_dir)[0], fx.END_US, **WINDOW)


@query
def window_latency(spark, sf_dir):
    return snapshot.window_latency(_two_topics(spark, sf_dir)[0], fx.END_US, **WINDOW)


@query
def summary(spark, sf_dir):
    return snapshot.summary(*_two_topics(spark, sf_dir), fx.STOP_US)


@query
def commit_log(spark, sf_dir):
    return delivery.commit_log(_two_topics(spark, sf_dir)[0], fx.COMMIT_INTERVAL_US)


@query
def partition_offsets(spark, sf_dir):
    attempts, assignments = _two_topics(spark, sf_dir)
    # The log of commits ends half a day before the stop, as a table of it that is loaded twice a day.
    commits = delivery.commit_log(attempts, fx.COMMIT_INTERVAL_US).filter(F.col("committed_us") <= fx.STOP_US - fx.DAY_US // 2)
    return snapshot.partition_offsets(attempts, assignments, fx.STOP_US, commits)


@query
def concurrency(spark, sf_dir):
    return snapshot.concurrency(fx.in_topics(fx.attempts(spark, sf_dir)), fx.STOP_US, 5)


@query
def shards(spark, sf_dir):
    return snapshot.shards(fx.in_topics(fx.attempts(spark, sf_dir)), fx.STOP_US)


@query
def snapshot_json(spark, sf_dir):
    # Every section reads the attempts, so they are derived once.
    attempts, assignments = _two_topics(spark, sf_dir)
    attempts = stage(attempts.select(*S.COORDINATES, "key_str", "read_us", "start_us", "done_us", "outcome"))
    assignments = stage(assignments)
    commits = delivery.commit_log(attempts, fx.COMMIT_INTERVAL_US)
    return snapshot.snapshot_json(attempts, assignments, fx.STOP_US, **WINDOW, commits=commits)


@query
def parse_snapshots(spark, sf_dir):
    parsed = snapshot.parse_snapshots(fx.snapshots(spark, sf_dir))
    return parsed.select(
        "snap_id",
        "error",
        F.col("snapshot.summary.totalProcessed").alias("total_processed"),
        F.col("snapshot.throughput.maxEndToEndDuration").alias("max_end_to_end"),
        F.size("snapshot.preCommits.partitions").alias("partitions"),
    )


@query
def snapshot_partitions(spark, sf_dir):
    return snapshot.snapshot_partitions(snapshot.parse_snapshots(fx.snapshots(spark, sf_dir)), ["snap_id"])


@query
def snapshot_windows(spark, sf_dir):
    return snapshot.snapshot_windows(snapshot.parse_snapshots(fx.snapshots(spark, sf_dir)), ["snap_id"])


# ---- operations ----------------------------------------------------------------------------------------------------


@query
def sustained_failures(spark, sf_dir):
    return ops.sustained_failures(fx.fetch_log(spark, sf_dir)).drop("run_id")


@query
def throttle(spark, sf_dir):
    return ops.throttle(fx.log_lines(spark, sf_dir), ["logger", "level"], 3_600_000)


@query
def throttle_busy_key(spark, sf_dir):
    """As throttle, with stretches split from 100 rows on, so that these tables have busy ones."""
    return ops.throttle(fx.log_lines(spark, sf_dir), ["logger", "level"], 3_600_000, hot_rows=100)


@query
def throttle_tumbling(spark, sf_dir):
    return ops.throttle_tumbling(fx.log_lines(spark, sf_dir), ["logger", "level"], 3_600_000)


@query
def stalled_partitions(spark, sf_dir):
    marks = delivery.commit_watermark(fx.attempts(spark, sf_dir))
    lag = delivery.lag_report(marks, fx.end_offsets(spark, sf_dir))
    return ops.stalled_partitions(fx.attempts(spark, sf_dir), lag, fx.STOP_US, 600_000)


@query
def breaker_trips(spark, sf_dir):
    return ops.breaker_trips(fx.attempts(spark, sf_dir), 60)


@query
def assignment_timeline(spark, sf_dir):
    return ops.assignment_timeline(fx.assignments(spark, sf_dir))


@query
def assigned_at(spark, sf_dir):
    return snapshot.assigned_at(fx.assignments(spark, sf_dir), fx.EPOCH_US + 20 * fx.DAY_US + 5 * 3_600_000_000)


@query
def config_violations(spark, sf_dir):
    return ops.config_violations(fx.service_config(spark, sf_dir).unionByName(fx.timeout_config(spark, sf_dir)))


@query
def unknown_settings(spark, sf_dir):
    return ops.unknown_settings(fx.service_config(spark, sf_dir))


@query
def stop_reasons(spark, sf_dir):
    return ops.stop_reasons(fx.stops(spark, sf_dir))


@query
def severity_counts(spark, sf_dir):
    return ops.severity_counts(fx.log_lines(spark, sf_dir), at_least=1)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From stored log to metric counters: envelope, rules, dead letters, flags, counters."""
    return QUERIES["message_counters"](spark, sf_dir)
