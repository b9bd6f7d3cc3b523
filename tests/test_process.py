import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keyflow import schema as S
from keyflow.operators import ordering
from keyflow.operators import process as P

SCHEMA = "topic string, partition int, offset bigint, key_str string, value binary"


def log(spark, *values):
    return spark.createDataFrame([("t", 0, i, f"k{i % 2}", v) for i, v in enumerate(values)], SCHEMA)


def test_first_rule_wins_and_failures_have_no_traits(spark):
    df = log(spark, None, b"", b"x", b"y")
    out = P.process(
        df,
        [P.Reject(F.col("value").isNull(), "tombstone"), P.Reject(F.coalesce(F.octet_length("value"), F.lit(0)) == 0, "empty")],
        [P.Tag(F.lit(True), 10), P.Tag(F.col("value") == b"y", 11), P.Tag(F.lit(True), 3)],
    )
    assert [(r.outcome, r.error, r.app_traits) for r in out.orderBy("offset").collect()] == [
        ("error", "tombstone", 0), ("error", "empty", 0), ("ok", None, 1024), ("ok", None, 3072)
    ]


def test_reason_is_cut_to_1024_bytes(spark):
    out = P.process(log(spark, b"x"), [P.Reject(F.lit(True), "é" * 2000)])
    assert out.first().error == "é" * 512


def test_null_condition_does_not_reject(spark):
    assert P.process(log(spark, b"x"), [P.Reject(F.lit(None).cast("boolean"), "no")]).first().outcome == "ok"


@pytest.mark.parametrize(
    ("value", "k", "error"),
    [
        (b'{"k": 1}', 1, None), (b'{"k": 1, "more": [1]}', 1, None), (b"{}", None, None), (None, None, "null payload"),
        (b"", None, "empty payload"), (b"\xff", None, "payload is not UTF-8"), (b"{bad", None, "invalid JSON"),
        (b'{"k": "text"}', None, "invalid JSON"),
    ],
)
def test_parse_json(spark, value, k, error):
    parsed, problem = P.parse_json("value", "k int")
    got = log(spark, value).select(parsed.alias("p"), problem.alias("e")).first()
    assert got.e == error and (got.p is None) == (error is not None)
    assert (got.p.k if got.p else None) == k


def test_handler_outcomes(spark):
    def handler(message):
        if message.value is None:
            raise P.HandlerError("no value")
        if message.value == b"boom":
            raise ZeroDivisionError
        return (1 << 63 | 1 << 10 | 0b111) if message.value == b"x" else None

    out = P.process_udf(log(spark, None, b"boom", b"x", b"y"), handler)
    rows = [(r.outcome, r.error, r.app_traits) for r in out.orderBy("offset").collect()]
    assert rows[:2] == [("error", "no value", 0), ("panic", S.PANIC_REASON, 0)]
    assert rows[2][2] & ((1 << 64) - 1) == 1 << 63 | 1 << 10
    assert rows[3] == ("ok", None, 0)
    traits = [r.traits for r in P.with_framework_traits(out.withColumn("dead_lettered", F.col("outcome") != "ok")).orderBy("offset").collect()]
    assert traits[0] == 0b101 and traits[1] == 0b101, "a crash sets the error flag, not the panic flag"


def test_split_is_complete(spark):
    out = P.process(log(spark, None, b"x"), [P.Reject(F.col("value").isNull(), "tombstone")])
    ok, dead = P.split_outcomes(out)
    assert (ok.count(), dead.count(), dead.first().reason) == (1, 1, "tombstone")


def test_require_equal_is_null_safe(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, None), ("a", None)], "x string, y string")
    out = P.process(df, [P.require_equal(F.col("x"), F.col("y"), "differs")])
    assert [r.outcome for r in out.collect()] == ["ok", "error", "ok", "error"]


def test_latest_by_key_drops_tombstones_only(spark):
    rows = [("t", 0, 1, "a", b"1"), ("t", 0, 2, "a", b""), ("t", 0, 1, "b", b"1"), ("t", 0, 9, "b", None), ("t", 0, 3, "c", b"c")]
    out = P.latest_by_key(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.key_str, r.offset, bytes(r.value)) for r in out.collect()) == [("a", 2, b""), ("c", 3, b"c")]


def test_replay_candidates(spark):
    dead = spark.createDataFrame([("t", 0, 1, "x"), ("t", 0, 2, "y")], "topic string, partition int, offset bigint, reason string")
    resolved = spark.createDataFrame([("t", 0, 2)], "topic string, partition int, offset bigint")
    assert [r.offset for r in P.replay_candidates(dead, resolved).collect()] == [1]


def test_process_by_key_sees_offset_order(spark):
    rows = [("t", p, o, f"k{(p * 31 + o) % 5}", None) for p in range(3) for o in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)

    def step(state, row):
        seen = [*state, (row.partition, row.offset)]
        return seen, {"key_str": row.key_str, "n": len(seen), "ordered": seen == sorted(seen)}

    out = ordering.process_by_key(df, step, "key_str string, n bigint, ordered boolean", []).collect()
    assert len(out) == 600 and all(r.ordered for r in out)
    assert sum(r.n == 1 for r in out) == 5


def test_batch_handler_is_bisected_to_the_records_at_fault(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def handler(batch):
        (calls / uuid.uuid4().hex).touch()
        values = batch.column("value").to_pylist()
        if b"boom" in values:
            raise ZeroDivisionError
        if b"no" in values:
            raise P.HandlerError("refused")
        return pa.array([0b111 | 1 << 12] * len(values)), pa.array(["empty" if v == b"" else None for v in values], pa.string())

    def one(message):
        if message.value == b"boom":
            raise ZeroDivisionError
        if message.value == b"no":
            raise P.HandlerError("refused")
        if message.value == b"":
            raise P.HandlerError("empty")
        return 0b111 | 1 << 12

    values = [b"x"] * 4000
    for i, v in ((0, b"boom"), (1, b""), (777, b"no"), (2048, b"boom"), (2049, b"boom"), (3999, b""), (5, None)):
        values[i] = v
    rows = log(spark, *values).repartition(2)
    got = sorted(tuple(r) for r in P.process_batches(rows, handler).select("offset", "outcome", "error", "app_traits").collect())
    n = len(list(calls.iterdir()))
    want = sorted(tuple(r) for r in P.process_udf(rows, one).select("offset", "outcome", "error", "app_traits").collect())
    assert got == want and [r[0] for r in got if r[1] == "panic"] == [0, 2048, 2049]
    assert n <= 400, "a tenth of the calls"


def test_batch_handler_without_an_answer_and_with_a_wrong_one(spark):
    rows = log(spark, b"a", None, b"")
    assert [(r.outcome, r.error, r.app_traits) for r in P.process_batches(rows, lambda batch: None, ["value"]).collect()] == [("ok", None, 0)] * 3
    short = P.process_batches(rows, lambda batch: (pa.array([], pa.int64()), None))
    assert [(r.outcome, r.app_traits) for r in short.collect()] == [("panic", 0)] * 3
    assert P.process_batches(rows.limit(0), lambda batch: None).collect() == []
