"""Block-wise running values against one plain window, on random logs with small blocks."""

import pytest
from helpers import frame, random_attempts
from pyspark.sql import functions as F

from keyflow.operators import ordering
from keyflow.operators.delivery import collapse_attempts
from keyflow.operators.prefix import Running, hot_keys, running, running_by_window



def values():
    return [
        Running("total", F.col("read_us")),
        Running("total_before", F.col("read_us"), inclusive=False),
        Running("highest", F.col("done_us"), "max"),
        Running("highest_before", F.col("done_us"), "max", inclusive=False),
        Running("previous", F.struct("offset", "done_us"), "max", inclusive=False),
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("bits", [1, 3, 20])
def test_running_per_partition(spark, seed, bits):
    rows = collapse_attempts(frame(spark, random_attempts(seed))).cache()
    keys = ["topic", "partition"]
    got = running(rows, keys, ["offset"], "offset", values(), bits)
    want = running_by_window(rows, keys, ["offset"], values())
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("hot_rows", [10, 10_000])
@pytest.mark.parametrize("bits", [2, 20])
def test_running_splits_hot_keys(spark, bits, hot_rows):
    rows = frame(spark, random_attempts(7, n=400)).cache()
    keys, order = ["topic", "key_str"], ["partition", "offset", "attempt_no"]
    got = running(rows, keys, order, ["partition", "offset"], values(), bits, True, hot_rows)
    want = running_by_window(rows, keys, order, values())
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_null_key_can_be_hot(spark):
    rows = frame(spark, random_attempts(8, n=300)).withColumn("key_str", F.when(F.col("key_str") != "hot", F.col("key_str"))).cache()
    keys, order = ["topic", "key_str"], ["partition", "offset", "attempt_no"]
    split = running(rows, keys, order, ["partition", "offset"], values(), 2, True, 50)
    want = running_by_window(rows, keys, order, values())
    assert sorted(map(str, split.collect())) == sorted(map(str, want.collect()))


def test_hot_keys(spark):
    rows = frame(spark, random_attempts(5, n=300))
    assert [r.key_str for r in hot_keys(rows, ["topic", "key_str"], 100).collect()] == ["hot"]
    assert hot_keys(rows, ["topic", "key_str"], 10**6).count() == 0


@pytest.mark.parametrize("hot_rows", [10, 10_000])
def test_key_sequence(spark, hot_rows):
    rows = collapse_attempts(frame(spark, random_attempts(11))).withColumn("key_str", F.concat(F.lit("k"), (F.col("offset") % 2).cast("string")))
    got = {(r.key_str, r.partition, r.offset): r.key_seq for r in ordering.key_sequence(rows, 2, hot_rows).collect()}
    for key in ("k0", "k1"):
        in_order = sorted(k for k in got if k[0] == key)
        assert [got[k] for k in in_order] == list(range(1, len(in_order) + 1))


@pytest.mark.parametrize(("bits", "hot_rows"), [(20, 10**6), (4, 10)])
def test_ordering_violations(spark, bits, hot_rows):
    rows = random_attempts(13, n=250)
    got = ordering.ordering_violations(frame(spark, rows), bits, hot_rows).collect()
    want = []
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[1], r[4]), []).append(r)
    for group in groups.values():
        group.sort(key=lambda r: (r[6], r[2], r[3]))
        for before, now in zip(group, group[1:], strict=False):
            inversion, overlap = now[2] < before[2], before[7] is None or before[7] > now[6]
            if inversion or overlap:
                want.append((now[1], now[4], now[2], now[3], inversion, overlap))
    assert sorted((r.partition, r.key_str, r.offset, r.attempt_no, r.inversion, r.overlap) for r in got) == sorted(want)
    assert want


def test_every_hot_key_is_listed(spark):
    rows = spark.range(30_000).selectExpr("id % 15000 AS k")
    assert hot_keys(rows, ["k"], 1).count() == 15_000
