"""Operations analytics: poll failures, log throttling, stalls, breakers, rebalances, settings, stop reasons, log severity."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow import schema as S
from keyflow.functions import text
from keyflow.operators.delivery import ordered_pair
from keyflow.operators.prefix import DEFAULT_BITS, HOT_ROWS, TIME_BITS, Running, running
from keyflow.operators.scan import exclusive_scan
from keyflow.operators.staging import small_side, stage

# Defaults and limits, in milliseconds.
DEFAULT_BAIL_MS = 600_000
MIN_BAIL_MS = 60_000
MAX_BAIL_MS = 3_600_000
DEFAULT_LOG_INTERVAL_MS = 1_000
DEFAULT_BREAKER_MS = 60_000
DEFAULT_REBALANCE_TIMEOUT_MS = 60_000
DEFAULT_DRAIN_TIMEOUT_MS = 20_000

# Tunable, kind, least and greatest allowed value (durations in milliseconds). Zero always means "default".
TUNABLES = [
    ("concurrentKeys", "int", 1, 5000),
    ("perKeyBufferLen", "int", 1, 64),
    ("pollTimeout", "duration", 20, 2_000),
    ("autoCommitInterval", "duration", 250, 15_000),
    ("drainTimeout", "duration", 2_000, 55_000),
    ("awaitAssignmentsTimeout", "duration", 5_000, 300_000),
    ("commitIngestChannelLen", "int", 1_000, 200_000),
    ("commitPartitionSliceLen", "int", 50, 2_000),
    ("queryTimeout", "duration", 1_000, 10_000),
    ("acquireWorkerTimeoutCircuitBreaker", "duration", 15_000, 900_000),
    ("workerShardsCount", "power_of_two", 2, 64),
    ("rebalancePausePollingTimeout", "duration", 10_000, 600_000),
    ("acquireCommitGuardTimeout", "duration", 100, 30_000),
]
REBALANCE_KEY = "rebalance.timeout.ms"
DRAIN_KEY = "drainTimeout"

# Stable start-up codes and the fallback text of each.
STARTUP_CODES = [
    (-1, "already initialised"),
    (-2, "invalid configuration JSON"),
    (-3, "missing required config"),
    (-4, "failed to create adapter or connect to broker"),
    (-5, "invalid adapter or engine option"),
    (-6, "metrics endpoint failed to bind"),
]

# Log levels.
SEVERITIES = {0: "debug", 1: "info", 2: "warn", 3: "error"}


def check_bail_ms(bail_ms: int) -> int:
    """0 disables; otherwise from one minute to one hour."""
    if bail_ms != 0 and not MIN_BAIL_MS <= bail_ms <= MAX_BAIL_MS:
        raise ValueError(f"bail window must be 0 or from {MIN_BAIL_MS} to {MAX_BAIL_MS} ms, got {bail_ms}")
    return bail_ms


def sustained_failures(fetch_log: DataFrame, bail_ms: int = DEFAULT_BAIL_MS, bits: int = TIME_BITS) -> DataFrame:
    """Runs of failed fetches on one partition, without a success between, lasting at least ``bail_ms``.

    Runs are told apart by the number of successes before them, a running sum that is computed in blocks of time.
    """
    if check_bail_ms(bail_ms) == 0:
        kinds = dict(fetch_log.dtypes)
        names = "".join(f"{c} {kinds[c]}, " for c in S.PARTITION)
        schema = f"{names}run_id bigint, first_us bigint, last_us bigint, failures bigint, err {kinds['err']}, reason string"
        return fetch_log.sparkSession.createDataFrame([], schema)
    ok = F.when(F.col("ok"), 1).otherwise(0).cast("bigint")
    numbered = running(fetch_log, S.PARTITION, ["at_us", "seq"], "at_us", [Running("_run", ok)], bits)
    runs = (
        numbered.filter(~F.col("ok"))
        .groupBy(*S.PARTITION, F.col("_run").alias("run_id"))
        .agg(
            F.min("at_us").alias("first_us"),
            F.max("at_us").alias("last_us"),
            F.count("*").alias("failures"),
            F.max_by("err", F.struct("at_us", "seq")).alias("err"),
        )
    )
    lasted = text.format_duration(F.lit(bail_ms * 1000).cast("bigint"))
    reason = F.concat(
        F.lit("partition "),
        F.col("topic"),
        F.lit("["),
        F.col("partition").cast("string"),
        F.lit("] failing to fetch for "),
        lasted,
        F.lit(": "),
        F.col("err"),
    )
    return runs.filter(F.col("last_us") - F.col("first_us") >= bail_ms * 1000).withColumn("reason", reason)


def _floor_div(column: Column, by: int) -> Column:
    """Whole-number division that rounds down, below zero too."""
    by = F.lit(by).cast("bigint")
    return F.call_function("div", column - F.pmod(column, by), by)


# Cells of a stretch that are walked in one task; each cell is as wide as the throttle's interval.
BLOCK_CELLS = 32


def kept_instants(instants: np.ndarray, last: int | None, width: int) -> list[int]:
    """Of sorted instants those a throttle keeps that has kept ``last`` before."""
    kept, at = [], 0 if last is None else int(np.searchsorted(instants, last + width))
    while at < len(instants):
        kept.append(int(instants[at]))
        at = int(np.searchsorted(instants, kept[-1] + width))
    return kept


class Steps:
    """What a block of instants makes of the instant kept last before it, as a step function.

    ``upto`` rises; an entry up to ``upto[i]`` (and above ``upto[i - 1]``) leaves the block with ``kept[i]`` as the last kept instant, an entry
    above all of them leaves it unchanged, as the throttle still holds back everything in the block.
    """

    def __init__(self, upto: np.ndarray, kept: np.ndarray):
        # Neighbouring steps that end alike are one.
        last = np.append(kept[1:] != kept[:-1], True) if len(kept) else np.zeros(0, bool)
        self.upto, self.kept = upto[last], kept[last]

    def after(self, entry: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.upto, entry)
        inside = at < len(self.upto)
        return np.where(inside, self.kept[np.minimum(at, max(len(self.kept) - 1, 0))], entry) if len(self.kept) else entry

    def then(self, other: Steps) -> Steps:
        beyond = other.upto > (self.upto[-1] if len(self.upto) else np.iinfo(np.int64).min)
        return Steps(np.concatenate((self.upto, other.upto[beyond])), np.concatenate((other.after(self.kept), other.kept[beyond])))

    def to_bytes(self) -> bytes:
        return np.concatenate((self.kept, self.upto)).astype(">i8").tobytes()

    @staticmethod
    def of_bytes(data: bytes) -> Steps:
        kept, upto = np.frombuffer(data, ">i8").astype(np.int64).reshape(2, -1)
        return Steps(upto, kept)


class StepsOfBlock:
    """Builds the :class:`Steps` of a block from its instants in order, chunk by chunk. It holds one number per different course."""

    def __init__(self, begin: int, width: int):
        self.begin, self.width, self.closed = begin, width, False
        self.upto, self.kept = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, instants: np.ndarray) -> None:
        if not self.closed:
            # The entry lies before the block, so the first instant kept lies in the first interval of the block or is the next one.
            n = int(np.searchsorted(instants, self.begin + self.width)) + 1
            self.closed = n <= len(instants)
            first = instants[:n]
            self.upto, self.kept = np.append(self.upto, first - self.width), np.append(self.kept, first)
        while True:
            at = np.searchsorted(instants, self.kept + self.width)
            moving = at < len(instants)
            if not moving.any():
                break
            self.kept[moving] = instants[at[moving]]
        steps = Steps(self.upto, self.kept)
        self.upto, self.kept = steps.upto, steps.kept.copy()

    def steps(self) -> Steps:
        return Steps(self.upto, self.kept)


def _groups(pdf: pd.DataFrame, group: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """Runs of equal keys in sorted rows: ``key, begin, end``. Nulls are equal to nulls."""
    before = pdf[group].shift()
    changed = ((pdf[group] != before) & ~(pdf[group].isna() & before.isna())).any(axis=1).to_numpy()
    changed[0] = True
    edges = [*np.flatnonzero(changed).tolist(), len(pdf)]
    keys = zip(*[pdf[c].iloc[edges[:-1]].tolist() for c in group])
    for key, begin, end in zip(keys, edges, edges[1:], strict=False):
        yield tuple(None if pd.isna(v) else v for v in key), begin, end


def throttle(
    df: DataFrame,
    keys: Sequence[str],
    interval_ms: int = DEFAULT_LOG_INTERVAL_MS,
    time: str = "at_us",
    bits: int = DEFAULT_BITS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Instants kept by a log throttle: the first per key, then each first one at least ``interval_ms`` after the last kept.

    Columns ``keys, time, suppressed``: how many rows until the next kept instant were dropped. Equal instants of a key are
    merged before anything moves. Time is cut into cells as wide as the interval; across an empty cell the throttle has
    always run out, so each stretch of neighbouring cells can be walked on its own, whatever its key. A stretch of more than ``hot_rows`` rows
    is cut into blocks of ``BLOCK_CELLS``: each block is turned into the step function from the instant kept last before it to the one kept last in it, a scan of these
    functions tells every block what was kept before, and all blocks are walked side by side. A function has at most as many steps
    as there are different instants in one interval.
    """
    keys = list(keys)
    width = interval_ms * 1000
    at = F.col(time).cast("bigint")
    placed_in = df.filter(at.isNotNull()).select(*keys, at.alias("_at"), _floor_div(at, width).alias("_cell"))
    cells = placed_in.groupBy(*keys, "_cell").agg(F.count("*").alias("_rows"))
    ranked = running(
        cells, keys, ["_cell"], "_cell", [Running("_rank", F.lit(1).cast("bigint"))], bits, True, hot_rows
    )
    stretches = small_side(ranked.select(*keys, "_cell", (F.col("_cell") - F.col("_rank")).alias("_stretch"), "_rows"))
    group = [*keys, "_stretch"]
    block = _floor_div(F.col("_cell"), BLOCK_CELLS)
    ends = stretches.groupBy(*group).agg(F.min(block).alias("_from"), F.max(block).alias("_to"), F.sum("_rows").alias("_n"))
    long = small_side(ends.filter((F.col("_from") < F.col("_to")) & (F.col("_n") > hot_rows)).drop("_n"))
    any_long = not long.isEmpty()

    def same(left: str, right: str, columns: list[str]) -> list[Column]:
        """Null keys are keys too."""
        return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]

    if any_long:
        found = stretches.alias("c").join(long.alias("l"), same("c", "l", group), "left")
        in_block = F.when(F.col("l._from").isNotNull(), _floor_div(F.col("c._cell"), BLOCK_CELLS))
        stretches = small_side(found.select("c.*", in_block.alias("_block")))
    else:
        stretches = stretches.withColumn("_block", F.lit(None).cast("bigint"))
    joined = placed_in.alias("p").join(stretches.alias("s"), same("p", "s", [*keys, "_cell"])).select("p.*", "s._stretch", "s._block")
    whole = [*group, "_block"]
    instants = joined.groupBy(*whole, "_at").agg(F.count("*").alias("_n"))
    key_types = {f.name: f for f in df.schema.fields}
    out_schema = T.StructType(
        [*[key_types[k] for k in keys], T.StructField(time, T.LongType()), T.StructField("suppressed", T.LongType())]
    )

    def walk(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, kept, dropped = None, 0, 0
        for pdf in source:
            rows = []
            at = pdf["_at"].to_numpy(dtype=np.int64)
            total = np.concatenate(([0], np.cumsum(pdf["_n"].to_numpy(dtype=np.int64))))
            for group_key, begin, end in _groups(pdf, whole):
                pos = begin
                if group_key == current:
                    pos = begin + int(np.searchsorted(at[begin:end], kept + width))
                    dropped += int(total[pos] - total[begin])
                while pos < end:
                    if current is not None:
                        rows.append((*current[: len(keys)], kept, dropped))
                    current, kept = group_key, int(at[pos])
                    after = pos + int(np.searchsorted(at[pos:end], kept + width))
                    dropped, pos = int(total[after] - total[pos]) - 1, after
            if rows:
                yield pd.DataFrame(rows, columns=[*keys, time, "suppressed"])
        if current is not None:
            yield pd.DataFrame([(*current[: len(keys)], kept, dropped)], columns=[*keys, time, "suppressed"])

    def walked(rows: DataFrame) -> DataFrame:
        columns = [*whole, "_at", "_n"]
        return rows.select(*columns).repartition(*whole).sortWithinPartitions(*whole, "_at").mapInPandas(walk, out_schema)

    if not any_long:
        return walked(instants)
    instants = stage(instants)
    in_blocks = instants.filter(F.col("_block").isNotNull())
    parts = in_blocks.select(*whole, "_at").repartition(*whole).sortWithinPartitions(*whole, "_at")

    def functions(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, building = None, None

        def done() -> tuple:
            return (*current, building.steps().to_bytes())

        for pdf in source:
            rows, at = [], pdf["_at"].to_numpy(dtype=np.int64)
            for group_key, begin, end in _groups(pdf, whole):
                if group_key != current:
                    if current is not None:
                        rows.append(done())
                    current, building = group_key, StepsOfBlock(int(group_key[-1]) * BLOCK_CELLS * width, width)
                building.add(at[begin:end])
            if rows:
                yield pd.DataFrame(rows, columns=[*whole, "_steps"])
        if current is not None:
            yield pd.DataFrame([done()], columns=[*whole, "_steps"])

    def composed(first: bytes, second: bytes) -> bytes:
        return Steps.of_bytes(first).then(Steps.of_bytes(second)).to_bytes()

    steps = parts.mapInPandas(functions, T.StructType([*[parts.schema[c] for c in whole], T.StructField("_steps", T.BinaryType())]))
    carried = exclusive_scan(steps, group, "_block", "_steps", composed).filter("carry IS NOT NULL")
    # Nothing was kept before the stretch, so the first step counts, the number that leads its bytes. It enters the block as a row of its own.
    entering = carried.select(*whole, F.conv(F.hex(F.substring("carry", 1, 8)), 16, -10).cast("bigint").alias("_at"), F.lit(1).cast("bigint").alias("_n"))
    kept = walked(instants.unionByName(entering))
    # An instant kept in one block may hold back rows of the next ones.
    return kept.groupBy(*keys, time).agg(F.sum("suppressed").alias("suppressed"))


def throttle_tumbling(
    df: DataFrame, keys: Sequence[str], interval_ms: int = DEFAULT_LOG_INTERVAL_MS, time: str = "at_us"
) -> DataFrame:
    """The cheap approximate form: the first instant of each fixed interval per key, and how many rows it stands for."""
    slot = F.call_function("div", F.col(time), F.lit(interval_ms * 1000).cast("bigint")).alias("slot")
    return df.groupBy(*keys, slot).agg(F.min(time).alias(time), F.count("*").alias("n"))


def stalled_partitions(attempts: DataFrame, lag: DataFrame, as_of_us: int, quiet_ms: int) -> DataFrame:
    """Partitions with lag and no completion during the last ``quiet_ms`` before an instant."""
    last = (
        attempts.filter(F.col("done_us") <= as_of_us).groupBy(*S.PARTITION).agg(F.max("done_us").alias("last_done_us"))
    )
    quiet = F.lit(as_of_us).cast("bigint") - F.col("last_done_us")
    joined = lag.filter(F.col("lag") > 0).join(last, S.PARTITION, "left")
    return joined.filter(F.col("last_done_us").isNull() | (quiet >= quiet_ms * 1000)).select(
        *S.PARTITION, "lag", "last_done_us", quiet.alias("quiet_us")
    )


def breaker_trips(attempts: DataFrame, limit_ms: int = DEFAULT_BREAKER_MS) -> DataFrame:
    """First attempt per partition that waited longer than the limit for a worker, and how many did."""
    wait = F.col("start_us") - F.col("read_us")
    slow = attempts.filter(wait > limit_ms * 1000).withColumn("_wait", wait)
    return slow.groupBy(*S.PARTITION).agg(
        F.min_by("offset", ordered_pair("start_us", "offset")).alias("first_offset"),
        F.min("start_us").alias("first_us"),
        F.max("_wait").alias("longest_wait_us"),
        F.count("*").alias("slow_dispatches"),
    )


def assignment_timeline(assignments: DataFrame, bits: int = TIME_BITS) -> DataFrame:
    """Number of assigned partitions per topic at every instant it changes."""
    changes = assignments.select(
        "topic",
        F.inline(
            F.array(
                F.struct(F.col("assigned_us").alias("at_us"), F.lit(1).cast("bigint").alias("_d")),
                F.struct(F.col("revoked_us").alias("at_us"), F.lit(-1).cast("bigint").alias("_d")),
            )
        ),
    )
    net = changes.filter("at_us is not null").groupBy("topic", "at_us").agg(F.sum("_d").alias("change"))
    return running(net, ["topic"], ["at_us"], "at_us", [Running("assigned_partitions", F.col("change"))], bits)


def tunable_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TUNABLES, "key string, kind string, least bigint, greatest bigint")


def _millis(value: Column, kind: Column) -> Column:
    """The setting as a number: durations in milliseconds, rounded up so that a small one does not become zero."""
    whole = F.when(value.rlike("^[+-]?[0-9]{1,18}$"), value.cast("bigint"))
    micros = text.parse_duration(value)
    millis = F.call_function("div", micros + 999, F.lit(1000).cast("bigint"))
    return F.when(kind == "duration", millis).otherwise(whole)


def config_violations(config: DataFrame) -> DataFrame:
    """Settings of a fleet (``service, key, value``) that are malformed, out of range, or contradict each other.

    The last value per service and key counts as the caller's: the table holds one. The rules are thirteen fixed rows, so
    they are broadcast. A drain timeout must stay below the rebalance timeout, each with its default when not set; a
    rebalance timeout that is no integer is reported and the default used.
    """
    rules = F.broadcast(tunable_rules(config.sparkSession))
    number = _millis(F.col("value"), F.col("kind"))
    checked = config.join(rules, "key").withColumn("_x", number)
    x = F.col("_x")
    problem = (
        F.when(x.isNull(), F.when(F.col("kind") == "duration", "not a duration").otherwise("not an integer"))
        .when(x == 0, F.lit(None).cast("string"))
        .when((x < F.col("least")) | (x > F.col("greatest")), "out of range")
        .when((F.col("kind") == "power_of_two") & (F.bit_count(x) != 1), "not a power of two")
    )
    single = checked.withColumn("problem", problem).filter("problem is not null").select("service", "key", "value", "problem")

    drain = F.max(F.when(F.col("key") == DRAIN_KEY, _millis(F.col("value"), F.lit("duration"))))
    rebalance = F.max(F.when(F.col("key") == REBALANCE_KEY, _millis(F.col("value"), F.lit("int"))))
    pairs = (
        config.filter(F.col("key").isin(DRAIN_KEY, REBALANCE_KEY))
        .groupBy("service")
        .agg(drain.alias("_drain"), rebalance.alias("_rebalance"))
    )
    drain_ms = F.coalesce(F.nullif(F.col("_drain"), F.lit(0).cast("bigint")), F.lit(DEFAULT_DRAIN_TIMEOUT_MS))
    rebalance_ms = F.coalesce(F.col("_rebalance"), F.lit(DEFAULT_REBALANCE_TIMEOUT_MS))
    crossed = pairs.filter(rebalance_ms <= drain_ms).select(
        "service",
        F.lit(REBALANCE_KEY).alias("key"),
        rebalance_ms.cast("string").alias("value"),
        F.concat(F.lit("must exceed the drain timeout of "), drain_ms.cast("string"), F.lit(" ms")).alias("problem"),
    )
    unreadable = config.filter((F.col("key") == REBALANCE_KEY) & _millis(F.col("value"), F.lit("int")).isNull())
    unreadable = unreadable.select("service", "key", "value", F.lit("not an integer").alias("problem"))
    return single.unionByName(unreadable).unionByName(crossed)


def unknown_settings(config: DataFrame) -> DataFrame:
    """Settings whose key no rule knows."""
    known = tunable_rules(config.sparkSession).select("key").union(
        config.sparkSession.createDataFrame([(REBALANCE_KEY,)], "key string")
    )
    return config.join(F.broadcast(known), "key", "left_anti").select("service", "key", "value")


def stop_class(reason: Column | str) -> Column:
    """Class of a stop reason."""
    r = F.col(reason) if isinstance(reason, str) else reason
    return (
        F.when(r == "graceful shutdown", "graceful")
        .when(r.rlike("circuit-breaker triggered processing partition"), "breaker")
        .when(r.rlike(r"^partition .*\[[0-9]+\] failing to fetch for "), "poll failure")
        .when(r.rlike("^error -[0-9]+: "), "start-up")
        .otherwise("own reason")
    )


def stop_reasons(stops: DataFrame) -> DataFrame:
    """Stops per service and class; start-up failures with their code and what it stands for."""
    codes = F.broadcast(stops.sparkSession.createDataFrame(STARTUP_CODES, "code int, meaning string"))
    code = F.regexp_extract("reason", "^error (-[0-9]+): ", 1)
    classed = stops.withColumns(
        {"class": stop_class("reason"), "code": F.when(code != "", code.cast("int"))}
    )
    counted = classed.groupBy("service", "class", "code").agg(F.count("*").alias("n"), F.max("at_us").alias("last_us"))
    return counted.join(codes, "code", "left").select("service", "class", "code", "meaning", "n", "last_us")


def severity(level: Column | str) -> Column:
    c = F.col(level) if isinstance(level, str) else level
    out = F.when(c == 0, SEVERITIES[0])
    for number in (1, 2, 3):
        out = out.when(c == number, SEVERITIES[number])
    return out.otherwise("unknown")


def severity_counts(logs: DataFrame, at_least: int = 0) -> DataFrame:
    """Log lines per severity, from a level upward."""
    return (
        logs.filter(F.col("level") >= at_least)
        .groupBy("level", severity("level").alias("severity"))
        .agg(F.count("*").alias("n"))
    )
