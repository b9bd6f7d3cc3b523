"""Small inputs for the tests."""

from __future__ import annotations

import random

ATTEMPT_SCHEMA = (
    "topic string, partition int, offset bigint, attempt_no int, key_str string, read_us bigint, start_us bigint, "
    "done_us bigint, outcome string, error string, app_traits bigint"
)


def attempt(offset, read=0, start=None, done=None, partition=0, key="k", no=1, outcome="ok", topic="t"):
    return (topic, partition, offset, no, key, read, read if start is None else start, done, outcome, None, 0)


def random_attempts(seed, n=300, partitions=3, keys=6, hot_share=0.4, pending=0.05, holes=0.3, copies=0.1):
    """A log with holes, a hot key, unfinished records and redeliveries."""
    rng = random.Random(seed)
    rows, next_offset, clock = [], [rng.randrange(5) for _ in range(partitions)], 1000
    for _ in range(n):
        p = rng.randrange(partitions)
        next_offset[p] += 1 + (rng.randrange(4) if rng.random() < holes else 0)
        clock += rng.randrange(1, 20)
        key = "hot" if rng.random() < hot_share else f"k{rng.randrange(keys)}"
        start = clock + rng.randrange(30)
        done = None if rng.random() < pending else start + rng.randrange(200)
        rows.append(attempt(next_offset[p], clock, start, done, p, key))
        while rng.random() < copies:
            last = rows[-1]
            late = last[5] + rng.randrange(1, 500)
            rows.append(attempt(last[2], late, late, late + rng.randrange(50), p, key, last[3] + 1))
    return rows


def frame(spark, rows, schema=ATTEMPT_SCHEMA):
    return spark.createDataFrame(rows, schema)


def as_set(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
