import random

import numpy as np
import pytest
from helpers import attempt, frame

from keyflow.operators import ops as O

FETCH = "topic string, partition int, seq bigint, at_us bigint, ok boolean, err string"
MINUTE = 60_000_000


def fetches(spark, *rows):
    return spark.createDataFrame([("t", p, i, at, ok, None if ok else f"e{i}") for i, (p, at, ok) in enumerate(rows)], FETCH)


@pytest.mark.parametrize("bits", [4, 20])
def test_sustained_failures(spark, bits):
    df = fetches(
        spark,
        (0, 0, False), (0, 9 * MINUTE, False), (0, 10 * MINUTE, False), (0, 11 * MINUTE, True), (0, 12 * MINUTE, False),
        (0, 20 * MINUTE, False), (0, 21 * MINUTE, True), (0, 22 * MINUTE, False), (0, 40 * MINUTE, False), (1, 0, False), (1, 50 * MINUTE, True),
    )
    rows = sorted((r.first_us, r.last_us, r.failures, r.err, r.reason) for r in O.sustained_failures(df, bits=bits).collect())
    assert rows == [
        (0, 10 * MINUTE, 3, "e2", "partition t[0] failing to fetch for 10m0s: e2"),
        (22 * MINUTE, 40 * MINUTE, 2, "e8", "partition t[0] failing to fetch for 10m0s: e8"),
    ]


def test_bail_window(spark):
    df = fetches(spark, (0, 0, False), (0, 100 * MINUTE, False))
    assert O.sustained_failures(df, 0).count() == 0, "0 disables"
    assert O.sustained_failures(df, 3_600_000).first().reason.endswith("for 1h0m0s: e1")
    for bad in (1, 59_999, 3_600_001, -1):
        with pytest.raises(ValueError):
            O.sustained_failures(df, bad)


def greedy(instants, width):
    kept = []
    for at in sorted(instants):
        if not kept or at - kept[-1] >= width:
            kept.append(at)
    return kept


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(("bits", "hot_rows"), [(20, 10**6), (2, 20)])
def test_throttle(spark, seed, bits, hot_rows):
    rng = random.Random(seed)
    rows = [(rng.choice("aab"), rng.randrange(0, 60_000_000) // rng.choice([1, 1000, 500_000]) * 7) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, at_us bigint")
    got = {}
    for r in O.throttle(df, ["k"], 1000, bits=bits, hot_rows=hot_rows).collect():
        got.setdefault(r.k, []).append((r.at_us, r.suppressed))
    for k, kept in got.items():
        instants = [at for key, at in rows if key == k]
        assert sorted(at for at, _ in kept) == greedy(instants, 1_000_000)
        assert sum(n + 1 for _, n in kept) == len(instants)


def test_throttle_many_equal_instants(spark):
    df = spark.range(5000).selectExpr("'k' as k", "cast(5 as bigint) as at_us")
    assert [tuple(r) for r in O.throttle(df, ["k"]).collect()] == [("k", 5, 4999)]


def test_stalled(spark):
    df = frame(spark, [attempt(0, done=10), attempt(0, done=900, partition=1), attempt(0, partition=2)])
    lag = spark.createDataFrame([("t", p, n) for p, n in ((0, 5), (1, 5), (2, 5), (3, 0))], "topic string, partition int, lag bigint")
    got = {r.partition: r.quiet_us for r in O.stalled_partitions(df, lag, 1_001_000, 1000).collect()}
    assert got == {0: 1_000_990, 1: 1_000_100, 2: None}


def test_breaker(spark):
    df = frame(spark, [attempt(0, 0, 60_000_000, 1), attempt(1, 0, 60_000_001, 1), attempt(2, 0, 70_000_000, 1)])
    row = O.breaker_trips(df).first()
    assert (row.first_offset, row.longest_wait_us, row.slow_dispatches) == (1, 70_000_000, 2)


def test_timeline(spark):
    df = spark.createDataFrame([("t", 0, 0, 5, 20), ("t", 1, 0, 5, None), ("t", 0, 1, 20, 30)],
                               "topic string, partition int, epoch int, assigned_us bigint, revoked_us bigint")
    assert sorted((r.at_us, r.assigned_partitions) for r in O.assignment_timeline(df, 2).collect()) == [(5, 2), (20, 2), (30, 1)]


def settings(spark, *rows):
    return spark.createDataFrame(list(rows), "service string, key string, value string")


@pytest.mark.parametrize(
    ("rebalance", "drain", "bad"),
    [(None, None, False), (None, "55s", False), ("45000", "40s", False), ("15000", None, True), ("20000", None, True),
     ("30000", "40s", True), ("20001", "0", False), ("60000", "20000ms", False)],
)
def test_drain_must_stay_below_rebalance(spark, rebalance, drain, bad):
    rows = [("s", k, v) for k, v in (("rebalance.timeout.ms", rebalance), ("drainTimeout", drain)) if v is not None]
    out = O.config_violations(settings(spark, *(rows or [("s", "pollTimeout", "100ms")]))).collect()
    assert [r.key for r in out] == (["rebalance.timeout.ms"] if bad else [])


@pytest.mark.parametrize(("value", "bad"), [("abc", True), ("30s", True), ("60000", False)])
def test_malformed_rebalance_timeout(spark, value, bad):
    out = O.config_violations(settings(spark, ("s", "rebalance.timeout.ms", value))).collect()
    assert [(r.key, r.problem) for r in out] == ([("rebalance.timeout.ms", "not an integer")] if bad else [])


def test_every_default_and_zero_is_accepted(spark):
    good = {
        "concurrentKeys": "250", "perKeyBufferLen": "16", "pollTimeout": "100ms", "autoCommitInterval": "5s", "drainTimeout": "20s",
        "awaitAssignmentsTimeout": "50s", "commitIngestChannelLen": "2000", "commitPartitionSliceLen": "400", "queryTimeout": "5s",
        "acquireWorkerTimeoutCircuitBreaker": "1m", "workerShardsCount": "16", "rebalancePausePollingTimeout": "30s",
        "acquireCommitGuardTimeout": "10s",
    }
    assert set(good) == {t[0] for t in O.TUNABLES}
    rows = [("a", k, v) for k, v in good.items()] + [("b", k, "0") for k in good]
    assert O.config_violations(settings(spark, *rows)).count() == 0
    assert O.unknown_settings(settings(spark, *rows, ("a", "noSuchKey", "1"))).first().key == "noSuchKey"


@pytest.mark.parametrize(
    ("key", "value", "problem"),
    [("concurrentKeys", "5001", "out of range"), ("concurrentKeys", "5000", None), ("concurrentKeys", "-1", "out of range"),
     ("concurrentKeys", "many", "not an integer"), ("pollTimeout", "100", "not a duration"), ("pollTimeout", "19ms", "out of range"),
     ("pollTimeout", "19.5ms", None), ("pollTimeout", "2s", None), ("workerShardsCount", "1", "out of range"),
     ("workerShardsCount", "48", "not a power of two"), ("workerShardsCount", "64", None)],
)
def test_single_settings(spark, key, value, problem):
    out = O.config_violations(settings(spark, ("s", key, value))).collect()
    assert [r.problem for r in out] == ([problem] if problem else [])


def test_stop_reasons(spark):
    reasons = {
        "graceful shutdown": ("graceful", None),
        "pipeline-worker: circuit-breaker triggered processing partition 3, offset 9": ("breaker", None),
        "partition orders[3] failing to fetch for 10m0s: EOF": ("poll failure", None),
        "error -4: cannot connect": ("start-up", -4),
        "error -9: new": ("start-up", -9),
        "disk full": ("own reason", None),
        "": ("own reason", None),
    }
    df = spark.createDataFrame([("s", i, r) for i, r in enumerate(reasons)], "service string, at_us bigint, reason string")
    out = O.stop_reasons(df).collect()
    assert {(r["class"], r.code) for r in out} == set(reasons.values())
    assert {r.code: r.meaning for r in out}[-9] is None
    assert sum(r.n for r in out) == len(reasons)


def test_severity(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 3, 9)], "level int")
    assert {r.severity: r.n for r in O.severity_counts(df).collect()} == {"debug": 1, "info": 1, "warn": 1, "error": 2, "unknown": 1}
    assert O.severity_counts(df, 3).count() == 2


def test_throttle_keeps_null_keys(spark):
    df = frame(spark, [("a", 0), (None, 0), (None, 10), (None, 5_000_000)], "k string, at_us bigint")
    got = sorted([tuple(r) for r in O.throttle(df, ["k"], 1000).collect()], key=repr)
    assert got == sorted([("a", 0, 0), (None, 0, 1), (None, 5_000_000, 0)], key=repr)


def plain_throttle(rows, width):
    """Kept instants and how many rows each held back, one row after the other."""
    out, last = {}, {}
    for key, at in sorted(rows, key=lambda r: (repr(r[0]), r[1])):
        if key not in last or at >= last[key] + width:
            last[key] = at
            out[key, at] = 0
        else:
            out[key, last[key]] += 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_throttle_in_blocks(spark, seed):
    """Long stretches of neighbouring cells, dense, sparse and with gaps, before 1970 and with a null key."""
    rng = random.Random(seed)
    rows = []
    for key, step, n in [("dense", 30, 3000), ("sparse", 900, 300), (None, 400, 300), ("short", 5000, 40), ("even", 0, 400)]:
        at = rng.randrange(-200_000, 5_000)
        for _ in range(n):
            at += rng.randrange(step) if step else 250
            if rng.random() < 0.01:
                at += 20_000
            rows += [(key, at)] * rng.choice([1, 1, 1, 2])
    df = spark.createDataFrame(rows, "k string, at_us bigint").repartition(4)
    for hot_rows in (0, 400, 10**6):  # all long stretches in blocks, only the busy ones, none
        got = {(r.k, r.at_us): r.suppressed for r in O.throttle(df, ["k"], 1, hot_rows=hot_rows).collect()}
        assert got == plain_throttle(rows, 1000)
    assert O.throttle(df.filter("false"), ["k"], 1).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_steps_of_blocks_compose(seed):
    rng = np.random.default_rng(seed)
    width = int(rng.choice([3, 50, 1000]))
    instants = np.unique(rng.integers(0, 8000, int(rng.choice([5, 200, 4000]))))
    cuts = np.arange(0, 8001, 1000)
    whole = None
    for begin, end in zip(cuts, cuts[1:]):
        part = instants[(instants >= begin) & (instants < end)]
        building = O.StepsOfBlock(int(begin), width)
        for chunk in np.array_split(part, 3):
            building.add(chunk)
        steps = O.Steps.of_bytes(building.steps().to_bytes())
        entries = np.unique(rng.integers(begin - 2 * width, begin, 40))
        want = [(O.kept_instants(part, int(e), width) or [int(e)])[-1] for e in entries]
        assert steps.after(entries).tolist() == want
        whole = steps if whole is None else whole.then(steps)
        before = np.unique(rng.integers(-2 * width, 0, 40))
        upto = instants[instants < end]
        assert whole.after(before).tolist() == [(O.kept_instants(upto, int(e), width) or [int(e)])[-1] for e in before]
