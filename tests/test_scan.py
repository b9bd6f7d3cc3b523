"""The two-level scan next to a plain loop."""

import random

import pytest

from keyflow.operators.scan import exclusive_scan


def join(a: bytes, b: bytes) -> bytes:
    """Associative but not commutative."""
    return a + b


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("fan", [1, 3, 1024])
def test_carry_is_all_that_came_before(spark, reverse, fan):
    rng = random.Random(fan)
    rows = []
    for key in ["a", "b", None, "d"]:
        for at in rng.sample(range(-30, 60), rng.randrange(1, 40)):
            rows.append((key, 1 if key else None, at, f"[{at}]".encode()))
    df = spark.createDataFrame(rows, "k string, k2 int, at bigint, state binary").repartition(3)
    got = {(r["k"], r["at"]): r["carry"] for r in exclusive_scan(df, ["k", "k2"], "at", "state", join, reverse, fan).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        total = None
        for _, _, at, state in sorted((r for r in rows if r[0] == key), key=lambda r: -r[2] if reverse else r[2]):
            want[key, at] = total
            total = state if total is None else total + state
    assert {k: None if v is None else bytes(v) for k, v in got.items()} == want


def test_no_blocks(spark):
    empty = spark.createDataFrame([], "k string, at bigint, state binary")
    assert exclusive_scan(empty, ["k"], "at", "state", join).count() == 0
