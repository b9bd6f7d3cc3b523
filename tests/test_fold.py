"""The split fold next to one pass over each key."""

import pytest
from helpers import frame, random_attempts
from pyspark.sql import functions as F

from keyflow.operators import ordering


@pytest.mark.parametrize("seed,bits,hot_rows", [(1, 3, 5), (2, 1, 0), (3, 5, 40), (4, 20, 1 << 20)])
def test_fold_is_one_pass(spark, seed, bits, hot_rows):
    """The state is the sequence of offsets: merging is associative but not commutative. One key is null, fields may be null."""
    rows = [(*r[:4], None if r[4] == "k1" else r[4], *r[5:]) for r in random_attempts(seed, n=250, copies=0)]
    df = frame(spark, rows).repartition(3)
    schema = "topic string, key_str string, partition int, offset bigint, seen int, trail string, done_us bigint"

    def produced(state, row):
        trail = "-".join(map(str, state[-4:]))
        return {"topic": row.topic, "key_str": row.key_str, "partition": row.partition, "offset": row.offset, "seen": len(state), "trail": trail, "done_us": row.done_us}

    def step(state, row):
        return (*state, (row.partition, row.offset))

    def both(state, row):
        state = step(state, row)
        return state, produced(state, row)

    plain = df.withColumn("done_us", F.coalesce("done_us", F.lit(-1)))
    want = sorted(map(tuple, ordering.process_by_key(plain.fillna({"key_str": "~null"}), both, schema, ()).collect()))
    got = ordering.fold_by_key(df, step, lambda a, b: a + b, produced, schema, (), bits, hot_rows)
    found = got.fillna({"key_str": "~null"}).withColumn("done_us", F.coalesce("done_us", F.lit(-1)))
    assert sorted(map(tuple, found.collect())) == want


def test_a_hot_key_lies_in_many_tasks(spark):
    df = spark.range(20_000).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("hot").alias("key_str")
    )
    out = ordering.fold_by_key(
        df, lambda s, r: s + 1, lambda a, b: a + b, lambda s, r: {"offset": r.offset, "seen": s}, "offset bigint, seen bigint", 0, bits=10, hot_rows=100
    )
    placed = out.withColumn("task", F.spark_partition_id())
    assert placed.filter(F.col("seen") != F.col("offset") + 1).isEmpty()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert placed.select("task").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
