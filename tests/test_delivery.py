"""Delivery operators against plain Python on random logs, with small blocks so that several are in play."""

import pytest
from helpers import as_set, attempt, frame, random_attempts
from pyspark.sql import functions as F

from keyflow.operators import delivery as D

ASSIGNMENT_SCHEMA = "topic string, partition int, epoch int, assigned_us bigint, revoked_us bigint"


def collapse(rows):
    out = {}
    for r in rows:
        read, done = out.get((r[1], r[2]), (None, None))
        read = r[5] if read is None else min(read, r[5])
        done = r[7] if done is None else done if r[7] is None else min(done, r[7])
        out[r[1], r[2]] = (read, done)
    return out


def read_watermarks(rows):
    want = {}
    for p in {r[1] for r in rows}:
        log = sorted((o, done) for (q, o), (_, done) in collapse(rows).items() if q == p)
        stop = next((o for o, done in log if done is None), None)
        ready = [o for o, _ in log if stop is None or o < stop]
        ahead = [o for o, done in log if stop is not None and o > stop and done is not None]
        want[p] = (max(ready, default=-1), log[-1][0], len(ahead))
    return want


def integer_watermarks(rows, start):
    want = {}
    for p in {r[1] for r in rows}:
        log = {o: done for (q, o), (_, done) in collapse(rows).items() if q == p}
        first = min(log) if start is None else start
        ready = first
        while log.get(ready) is not None:
            ready += 1
        ahead = [o for o, done in log.items() if o > ready and done is not None]
        want[p] = (ready - 1 if ready > first else -1, max(log), len(ahead))
    return want


def marks(df):
    return {r.partition: (r.highest_ready_offset, r.max_offset_seen, r.gap_buffer_depth) for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("bits", [2, 20])
def test_read_watermark(spark, seed, bits):
    rows = random_attempts(seed, pending=0.02)
    assert marks(D.commit_watermark(frame(spark, rows), bits=bits)) == read_watermarks(rows)


def test_read_watermark_edges(spark):
    rows = [attempt(5, done=None), attempt(6, done=9)] + [attempt(o, done=1, partition=1) for o in (3, 8)]
    rows += [attempt(4, done=None, partition=2), attempt(4, done=7, partition=2, no=2)]
    assert marks(D.commit_watermark(frame(spark, rows))) == {0: (-1, 6, 1), 1: (8, 8, 0), 2: (4, 4, 0)}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize(("bits", "start", "holes"), [(2, None, 0.03), (3, None, 0), (2, 5, 0.02), (20, None, 0.02), (1, 0, 0)])
def test_integer_watermark(spark, seed, bits, start, holes):
    rows = random_attempts(seed + 20, pending=0.02, holes=holes)
    got = marks(D.commit_watermark(frame(spark, rows), "integer", start, bits))
    assert got == integer_watermarks(rows, start)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        D.commit_watermark(frame(spark, []), "other")


@pytest.mark.parametrize("bits", [2, 20])
def test_watermark_advance(spark, bits):
    rows = random_attempts(31, pending=0.01)
    got = {
        (r.partition, r.offset): (r.commit_buffered, r.watermark_advance_us, r.end_to_end_us)
        for r in D.watermark_advance(frame(spark, rows), bits).collect()
    }
    state, blocked, want = {}, {}, {}
    for (p, o), (read, done) in sorted(collapse(rows).items()):
        blocked[p] = blocked.get(p, False) or done is None
        state[p] = max(state.get(p, 0), done or 0)
        advance = None if blocked[p] else state[p]
        buffered = done is not None and (advance is None or advance > done)
        want[p, o] = (buffered, advance, None if advance is None else advance - read)
    assert got == want
    assert sum(v[0] for v in want.values()) == D.commit_buffered(frame(spark, rows), bits).count()


def test_duplicates(spark):
    rows = random_attempts(41, copies=0.3)
    df = frame(spark, rows)
    flagged = {(r.partition, r.offset, r.attempt_no): r.duplicate for r in D.flag_duplicates(df).collect()}
    first = {}
    for r in rows:
        key = (r[1], r[2])
        first[key] = min(first.get(key, (r[5], r[3])), (r[5], r[3]))
    assert flagged == {(r[1], r[2], r[3]): (r[5], r[3]) != first[r[1], r[2]] for r in rows}
    kept = {(r.partition, r.offset): (r.read_us, r.attempt_no) for r in D.drop_redeliveries(df).collect()}
    assert kept == first
    rate = {r.partition: r.duplicates for r in D.duplicate_rate(df).collect()}
    assert sum(rate.values()) == sum(flagged.values())


def test_equal_attempts_are_one_delivery(spark):
    rows = [attempt(1, read=5, no=1)] * 3 + [attempt(1, read=5, no=2)] * 2 + [attempt(2, read=5, no=1)] * 2
    df = frame(spark, rows)
    assert as_set(D.flag_duplicates(df), "offset", "attempt_no", "duplicate") == [(1, 1, False)] * 3 + [(1, 2, True)] * 2 + [(2, 1, False)] * 2
    rate = D.duplicate_rate(df).first()
    assert (rate.deliveries, rate.records, rate.duplicates, rate.duplicates_per_million) == (3, 2, 1, 333_333)


def test_one_record_copied_many_times(spark):
    rows = [attempt(1, read=n, done=n + 1, no=n) for n in range(1, 2001)] + [attempt(2, read=5, done=6)]
    df = frame(spark, rows)
    assert D.flag_duplicates(df).filter("duplicate").count() == 1999
    assert D.drop_redeliveries(df).count() == 2
    assert marks(D.commit_watermark(df)) == {0: (2, 2, 0)}


def test_dedupe_by_id(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), ("c", 1, "w")], "id string, at int, v string")
    seen = spark.createDataFrame([("c",)], "id string")
    assert sorted(map(tuple, D.dedupe_by_id(df, ["id"], ["at"], seen).collect())) == [("a", 1, "y"), ("b", 1, "z")]


def test_redelivery_set(spark):
    df = frame(spark, [attempt(o, partition=p) for p in (0, 1) for o in range(4)])
    committed = spark.createDataFrame([("t", 0, 2)], "topic string, partition int, committed_offset bigint")
    got = sorted((r.partition, r.offset) for r in D.redelivery_set(df, committed).collect())
    assert got == [(0, 3), (1, 0), (1, 1), (1, 2), (1, 3)]


def test_emergency_stop(spark):
    rows = [attempt(0, 1, done=5), attempt(1, 2, done=50), attempt(2, 3, done=6), attempt(3, 20, done=21)]
    got = sorted((r.offset, r.was_done) for r in D.redelivered_work(frame(spark, rows), 10).collect())
    assert got == [(1, False), (2, True)]


def test_drain(spark):
    rows = [attempt(0, 1, done=5), attempt(1, 2, done=12), attempt(2, 3, done=99), attempt(3, 4), attempt(4, 20, done=21)]
    got = {r.fate: r.n for r in D.drain_report(frame(spark, rows), 10, 5).collect()}
    assert got == {"finished": 1, "drained": 1, "abandoned": 2}


def test_rebalance_flags(spark):
    assignments = spark.createDataFrame(
        [("t", 0, 0, 0, 100), ("t", 0, 1, 150, 400), ("t", 0, 2, 500, None), ("t", 1, 0, 10, None)], ASSIGNMENT_SCHEMA
    )
    rows = [
        attempt(0, 5, done=50), attempt(1, 90, done=120), attempt(2, 99, done=None), attempt(3, 100, done=110), attempt(4, 120, done=130),
        attempt(5, 150, done=160), attempt(6, 399, done=400), attempt(7, 399, done=401), attempt(8, 450, done=451),
        attempt(9, 500, done=10**9), attempt(10, 10**9, done=None), attempt(11, 9, done=10, partition=1), attempt(12, 11, done=12, partition=1),
    ]
    df = frame(spark, rows)
    for width in (7, 64, D.DAY_US):
        placed = {r.offset: r.epoch for r in D.assignment_at(df, assignments, width).collect()}
        assert placed == {0: 0, 1: 0, 2: 0, 3: None, 4: None, 5: 1, 6: 1, 7: 1, 8: None, 9: 2, 10: 2, 11: None, 12: 0}
    orphaned = {r.offset for r in D.flag_orphaned(df, assignments).filter("orphaned").collect()}
    assert orphaned == {1, 2, 7}
    first = {r.offset for r in D.flag_first_after_rebalance(df, assignments).filter("first_after_rebalance").collect()}
    assert first == {0, 5, 9, 12}


def test_overlapping_assignments(spark):
    """The assignment that began last counts, and every attempt stays one row; redeliveries are not collapsed."""
    spans = [("t", 0, 0, 0, 100), ("t", 0, 1, 50, 200), ("t", 0, 2, 60, 70), ("t", 0, 3, 150, None), ("t", 1, 0, 0, None), ("t", 1, 1, 40, 60)]
    # Several open at once, one of them cut by a closed one; two that begin together.
    spans += [("t", 2, 0, 0, None), ("t", 2, 1, 100, None), ("t", 2, 2, 50, 60), ("t", 2, 3, 150, None), ("t", 2, 4, 150, None)]
    assignments = spark.createDataFrame(spans, ASSIGNMENT_SCHEMA)
    rows = [attempt(n, n, done=n + 1, partition=p) for n in range(0, 230, 5) for p in (0, 1, 2)] + [attempt(5, 5, done=6), attempt(5, 5, done=6)]

    def last(p, at):
        covering = [s for s in spans if s[1] == p and s[3] <= at and (s[4] is None or at < s[4])]
        return max(covering, key=lambda s: (s[3], s[2]))[2] if covering else None

    want = sorted((r[1], r[2], last(r[1], r[5])) for r in rows)
    for width in (7, D.DAY_US):
        got = sorted((r.partition, r.offset, r.epoch) for r in D.assignment_at(frame(spark, rows), assignments, width).collect())
        assert got == want


def test_lag(spark):
    marks_df = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, highest_ready_offset bigint")
    ends = spark.createDataFrame([("t", 0, 10), ("t", 1, 3)], "topic string, partition int, end_offset bigint")
    assert {r.partition: (r.committed_offset, r.lag) for r in D.lag_report(marks_df, ends).collect()} == {0: (7, 2), 1: (-1, 3)}


def test_run_verdict(spark):
    good = [attempt(o, done=1) for o in range(1000)]
    row = D.run_verdict(frame(spark, good), 1000).first()
    assert (row.processed, row.dead_lettered, row.success) == (1000, 0, True)
    assert not D.run_verdict(frame(spark, good[:-1]), 1000).first().success
    bad = [*good, attempt(1000, done=1, outcome="error")]
    row = D.run_verdict(frame(spark, bad), 1000).first()
    assert (row.reached_expected, row.no_dead_letters, row.success) == (True, False, False)


def test_ordered_pair(spark):
    big = (1 << 63) - 1
    df = spark.createDataFrame([(0, big), (1, 0), (big, big), (big, 0)], "a bigint, b bigint")
    out = df.orderBy(D.ordered_pair("a", "b")).collect()
    assert [tuple(r) for r in out] == [(0, big), (1, 0), (big, 0), (big, big)]
    plan = df.groupBy().agg(F.max_by("a", D.ordered_pair("a", "b")))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
