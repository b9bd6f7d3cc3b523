"""Per-message metric series from packets, queue depth and keys in flight from an attempt log, and their text form.

Series are grouped by ``keyflow.schema.MESSAGE_LABELS``. Every aggregate here combines before the shuffle, so what moves is
bounded by the number of label sets, not by the number of messages. Durations stay integer nanoseconds; seconds are only
produced as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow import schema as S
from keyflow.functions import text, traits
from keyflow.operators.delivery import ordered_pair
from keyflow.operators.bandwidth import bandwidth_long
from keyflow.operators.prefix import HOT_ROWS, TIME_BITS, Running, running
from keyflow.operators.staging import stage

# Counter name and the trait bit it counts (none: every message).
COUNTERS = {
    "processed": None,
    "errored": S.PROCESS_ERROR,
    "panicked": S.PROCESS_PANIC,
    "dead_lettered": S.DEAD_LETTER,
    "duplicate": S.DUPLICATE,
    "used_overflow": S.USED_OVERFLOW,
}

# First bound in nanoseconds and number of bounds; each bound is twice the one before.
PROCESS_BUCKETS = (1_000_000, 15)
QUEUE_WAIT_BUCKETS = (100_000, 18)

DEFAULT_CONCURRENT_KEYS = 250

# Histogram name -> column of packets it observes.
HISTOGRAMS = {
    "process_duration_seconds": ("process_duration_ns", PROCESS_BUCKETS),
    "dead_letter_duration_seconds": ("deadletter_duration_ns", PROCESS_BUCKETS),
    "queue_wait_duration_seconds": ("queue_wait_ns", QUEUE_WAIT_BUCKETS),
}


def bounds_ns(start_ns: int, count: int) -> list[int]:
    return [start_ns << k for k in range(count)]


def seconds_label(ns: int) -> str:
    """Nanoseconds as plain decimal seconds, from integers: 0.001, 13.1072."""
    whole, fraction = divmod(ns, 1_000_000_000)
    tail = f"{fraction:09d}".rstrip("0")
    return f"{whole}.{tail}" if tail else f"{whole}.0"


def message_counters(packets: DataFrame) -> DataFrame:
    """Six counters per label set. Conditions are counted independently of each other."""
    aggs = [
        (F.count("*") if bit is None else F.count_if(traits.has_bit("traits", bit))).alias(name)
        for name, bit in COUNTERS.items()
    ]
    return packets.groupBy(*S.MESSAGE_LABELS).agg(*aggs)


def message_gauges(packets: DataFrame) -> DataFrame:
    """Queue depth and offset of the packet that came last (by process start, then offset), zero included."""
    arrival = ordered_pair("process_start_time_ns", "offset")
    return packets.groupBy(*S.MESSAGE_LABELS).agg(
        F.max_by(F.col("queue_depth").cast("bigint"), arrival).alias("queue_depth"),
        F.max_by("offset", arrival).alias("current_offset"),
    )


def queue_wait_ns(packets: DataFrame) -> DataFrame:
    """Adds ``queue_wait_ns``: process start minus read time when both are set, else null."""
    both = (F.col("read_time_ns") != 0) & (F.col("process_start_time_ns") != 0)
    return packets.withColumn("queue_wait_ns", F.when(both, F.col("process_start_time_ns") - F.col("read_time_ns")))


def duration_histogram(
    packets: DataFrame, column: str, start_ns: int, count: int, labels: Sequence[str] = tuple(S.MESSAGE_LABELS)
) -> DataFrame:
    """Cumulative histogram rows ``labels, bucket, le, cumulative, sum_ns, observations``; positive durations only.

    The cumulative counts are direct conditional counts, one aggregate and no window. A label set without an observation
    has no rows. ``bucket`` numbers the bounds; the last row is ``+Inf``.
    """
    observed = packets.filter(F.col(column) > 0)
    bounds = bounds_ns(start_ns, count)
    wide = observed.groupBy(*labels).agg(
        *[F.count_if(F.col(column) <= b).alias(f"_b{i}") for i, b in enumerate(bounds)],
        F.sum(column).alias("sum_ns"),
        F.count("*").alias("observations"),
    )
    cells = [
        F.struct(F.lit(i).alias("bucket"), F.lit(seconds_label(b)).alias("le"), F.col(f"_b{i}").alias("cumulative"))
        for i, b in enumerate(bounds)
    ]
    cells.append(
        F.struct(F.lit(count).alias("bucket"), F.lit("+Inf").alias("le"), F.col("observations").alias("cumulative"))
    )
    return wide.select(*labels, F.inline(F.array(*cells)), "sum_ns", "observations").select(
        *labels, "bucket", "le", "cumulative", "sum_ns", "observations"
    )


def process_histogram(packets: DataFrame) -> DataFrame:
    return duration_histogram(packets, "process_duration_ns", *PROCESS_BUCKETS)


def dead_letter_histogram(packets: DataFrame) -> DataFrame:
    return duration_histogram(packets, "deadletter_duration_ns", *PROCESS_BUCKETS)


def queue_wait_histogram(packets: DataFrame) -> DataFrame:
    return duration_histogram(queue_wait_ns(packets), "queue_wait_ns", *QUEUE_WAIT_BUCKETS)


def _changes(df: DataFrame, keys: Sequence[str], begin: str, end: str) -> DataFrame:
    """Net change per group and instant: +1 where an interval begins, -1 where it ends (open intervals never do)."""
    both = F.array(
        F.struct(F.col(begin).alias("at_us"), F.lit(1).cast("bigint").alias("_d")),
        F.struct(F.col(end).alias("at_us"), F.lit(-1).cast("bigint").alias("_d")),
    )
    return (
        df.select(*keys, F.inline(both))
        .filter(F.col("at_us").isNotNull())
        .groupBy(*keys, "at_us")
        .agg(F.sum("_d").alias("_d"))
    )


def queue_depth(attempts: DataFrame, bits: int = TIME_BITS) -> DataFrame:
    """Attempts read and not yet finished on each partition, at every instant at which that number may change."""
    changes = _changes(attempts, S.PARTITION, "read_us", "done_us")
    out = running(changes, S.PARTITION, ["at_us"], "at_us", [Running("queue_depth", F.col("_d"))], bits)
    return out.drop("_d")


def keys_in_flight(attempts: DataFrame, bits: int = TIME_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number of distinct keys with an attempt between start and completion, at every instant it changes.

    Overlapping attempts of a key count once: per key only the steps from zero and back to zero are kept. Columns
    ``at_us, change, in_flight, before, previous_us`` (the number up to this instant and the instant before).
    """
    per_key = _changes(attempts.filter("start_us is not null"), ["topic", "key_str"], "start_us", "done_us")
    depth = running(
        per_key,
        ["topic", "key_str"],
        ["at_us"],
        "at_us",
        [Running("_depth", F.col("_d"))],
        bits,
        split_only_hot=True,
        hot_rows=hot_rows // 2,
        hot_from=attempts,
    )
    before = F.col("_depth") - F.col("_d")
    step = F.when((before <= 0) & (F.col("_depth") > 0), 1).when((before > 0) & (F.col("_depth") <= 0), -1)
    steps = (
        depth.withColumn("change", step.cast("bigint"))
        .filter("change is not null")
        .groupBy("topic", "at_us")
        .agg(F.sum("change").alias("change"))
    )
    return running(
        stage(steps),
        ["topic"],
        ["at_us"],
        "at_us",
        [
            Running("in_flight", F.col("change")),
            Running("before", F.col("change"), inclusive=False),
            Running("previous_us", F.col("at_us"), "max", inclusive=False),
        ],
        bits,
    )


def inflight_keys(
    attempts: DataFrame, limit: int = DEFAULT_CONCURRENT_KEYS, bits: int = TIME_BITS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Peak of keys in flight, time spent above ``limit`` and how often it was crossed, per topic."""
    sweep = keys_in_flight(attempts, bits, hot_rows)
    over = F.when(F.col("before") > limit, F.col("at_us") - F.col("previous_us"))
    crossed = (F.col("in_flight") > limit) & (F.coalesce(F.col("before"), F.lit(0)) <= limit)
    return sweep.groupBy("topic").agg(
        F.max("in_flight").alias("peak_keys"),
        F.coalesce(F.sum(over), F.lit(0)).cast("bigint").alias("over_limit_us"),
        F.count_if(crossed).alias("times_over_limit"),
    )


def flag_overflow(attempts: DataFrame, limit: int = DEFAULT_CONCURRENT_KEYS) -> DataFrame:
    """Adds ``used_overflow``: at its start, more than ``limit`` keys were in flight (the attempt's own key included)."""
    level = F.struct(F.col("at_us").alias("at"), F.col("in_flight").alias("n"))
    marks = stage(keys_in_flight(attempts).select("topic", "at_us", level.alias("_s")))
    starts = attempts.filter("start_us is not null").select("topic", F.col("start_us").alias("at_us"))
    # As-of lookup: the latest number at or before each start is the running maximum of (instant, number).
    merged = starts.unionByName(marks, allowMissingColumns=True).groupBy("topic", "at_us").agg(F.max("_s").alias("_s"))
    reached = running(merged, ["topic"], ["at_us"], "at_us", [Running("_level", F.col("_s"), "max")], TIME_BITS)
    at = reached.select("topic", F.col("at_us").alias("start_us"), F.col("_level.n").alias("_n"))
    return attempts.join(at, ["topic", "start_us"], "left").select(
        *attempts.columns, F.coalesce(F.col("_n") > limit, F.lit(False)).alias("used_overflow")
    )


def failure_rates(counters: DataFrame) -> DataFrame:
    """Shares of errored, dead-lettered and duplicate messages, per million."""

    def per_million(name: str) -> Column:
        return F.call_function("div", F.col(name) * 1_000_000, F.col("processed")).alias(f"{name}_per_million")

    return counters.select(
        *S.MESSAGE_LABELS, "processed", *[per_million(n) for n in ("errored", "dead_lettered", "duplicate")]
    )


def metrics_long(packets: DataFrame, bandwidth_packets: DataFrame | None = None) -> DataFrame:
    """All series as ``subsystem, metric, type, labels..., extra, le, sort, value, scale``: the value is ``value / 10**scale``.

    The message series are those of the subsystem engine; with ``bandwidth_packets`` those of bandwidth are there too. A label that a family does not have is
    null, labels that only some families have are in ``extra``, in their order. One hash aggregate computes the message series, so the packets are read once. ``sort`` orders the buckets of a histogram. As
    usual a condition counter or histogram without an event has no series.
    """
    arrival = ordered_pair("process_start_time_ns", "offset")
    aggs, cells = [], []

    def cell(metric: str, kind: str, column: str, le: str = "", sort: int = 0, scale: int = 0, when: str = "true") -> None:
        bound = f"'{le}'" if le else "cast(null as string)"
        fields = f"'metric', '{metric}', 'type', '{kind}', 'le', {bound}, 'sort', {sort}, 'value', {column}, 'scale', {scale}"
        cells.append(f"if({when}, named_struct({fields}), null)")

    for name, bit in COUNTERS.items():
        counted = "count(*)" if bit is None else f"count_if(bit_get(traits, {bit}) = 1)"
        aggs.append(F.expr(f"{counted} as c_{name}"))
        cell(f"{name}_total", "counter", f"c_{name}", when=f"c_{name} > 0")
    for name, column in (("queue_depth", F.col("queue_depth").cast("bigint")), ("current_offset", F.col("offset"))):
        aggs.append(F.max_by(column, arrival).alias(f"g_{name}"))
        cell(name, "gauge", f"g_{name}")
    for h, (name, (column, (start, count))) in enumerate(HISTOGRAMS.items()):
        seen = f"h{h}_count > 0"
        aggs.append(F.expr(f"coalesce(sum(if({column} > 0, {column}, null)), 0) as h{h}_sum"))
        aggs.append(F.expr(f"count_if({column} > 0) as h{h}_count"))
        cell(f"{name}_sum", "histogram", f"h{h}_sum", scale=9, when=seen)
        cell(f"{name}_count", "histogram", f"h{h}_count", sort=1, when=seen)
        for i, bound in enumerate(bounds_ns(start, count)):
            aggs.append(F.expr(f"count_if({column} > 0 and {column} <= {bound}) as h{h}_{i}"))
            cell(f"{name}_bucket", "histogram", f"h{h}_{i}", seconds_label(bound), 2 + i, when=seen)
        cell(f"{name}_bucket", "histogram", f"h{h}_count", "+Inf", 2 + count, when=seen)
    wide = queue_wait_ns(packets).groupBy(*S.MESSAGE_LABELS).agg(*aggs)
    series = f"inline(filter(array({', '.join(cells)}), c -> c is not null))"
    no_extra = F.array().cast("array<struct<name:string,value:string>>").alias("extra")
    out = wide.selectExpr(*S.MESSAGE_LABELS, series).select(
        F.lit("engine").alias("subsystem"), "metric", "type", *S.MESSAGE_LABELS, no_extra, "le", "sort", "value", "scale"
    )
    return out if bandwidth_packets is None else out.unionByName(bandwidth_long(bandwidth_packets))


def escape_label(value: Column | str) -> Column:
    """Label text with backslash, quote and newline escaped."""
    v = F.col(value) if isinstance(value, str) else value
    return F.replace(
        F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")
    )


def label_text(labels: Sequence[str] = tuple(S.MESSAGE_LABELS)) -> Column:
    """The labels a series has, as ``name="value"`` pairs in order: those of its columns that are not null, then its extra ones."""

    def pair(name: Column, value: Column) -> Column:
        return F.concat(name, F.lit('="'), escape_label(value), F.lit('"'))

    pairs = [pair(F.lit(name), F.col(name).cast("string")) for name in labels]
    return F.concat_ws(",", *pairs, F.transform("extra", lambda x: pair(x["name"], x["value"])))


def exposition_lines(metrics: DataFrame, namespace: str = "keyflow", labels: Sequence[str] = tuple(S.MESSAGE_LABELS)) -> DataFrame:
    """Sample lines of the text form: ``subsystem, metric, type, labels..., label_text, sort, line``; the bucket bound comes first among the labels."""
    le = F.when(F.col("le").isNotNull(), F.concat(F.lit('le="'), F.col("le"), F.lit('"')))
    seconds = text.decimal_text(F.col("value"), 9)
    seconds = F.when(F.contains(seconds, F.lit(".")), seconds).otherwise(F.concat(seconds, F.lit(".0")))
    value = F.when(F.col("scale") == 0, F.col("value").cast("string")).otherwise(seconds)
    known = metrics.withColumn("label_text", label_text(labels))
    line = F.concat(
        F.lit(f"{namespace}_"), F.col("subsystem"), F.lit("_"), F.col("metric"), F.lit("{"), F.concat_ws(",", le, F.col("label_text")), F.lit("} "), value
    )
    return known.select("subsystem", "metric", "type", *labels, "label_text", "sort", line.alias("line"))


# What the samples of a family add to its name.
_SUFFIXES = {"counter": "_total$", "histogram": "_(sum|count|bucket)$"}


def exposition(metrics: DataFrame, namespace: str = "keyflow") -> DataFrame:
    """The whole text document as ordered ``line`` rows: type headers, samples, the end mark.

    Its size is the number of series, not of messages, which is why one global sort is fine here.
    """
    family = F.col("metric")
    for kind, suffix in _SUFFIXES.items():
        family = F.when(F.col("type") == kind, F.regexp_replace("metric", suffix, "")).otherwise(family)
    samples = exposition_lines(metrics, namespace).withColumn("family", family)
    heads = samples.select("subsystem", "family", "type").distinct().select(
        "subsystem",
        "family",
        F.lit(0).alias("_k"),
        F.concat(F.lit(f"# TYPE {namespace}_"), F.col("subsystem"), F.lit("_"), F.col("family"), F.lit(" "), F.col("type")).alias("line"),
    )
    end = metrics.sparkSession.range(1).select(F.lit(2).alias("_k"), F.lit("# EOF").alias("line"))
    rows = samples.withColumn("_k", F.lit(1)).drop("metric", "type")
    document = rows.unionByName(heads, allowMissingColumns=True).unionByName(end, allowMissingColumns=True)
    first = [F.col(c).asc_nulls_last() for c in ("subsystem", "family")]
    return document.orderBy(*first, "_k", *S.MESSAGE_LABELS, "label_text", "sort").select("line")
