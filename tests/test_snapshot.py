import json

import pytest
from helpers import attempt, frame
from pyspark.sql import functions as F

from keyflow.operators import delivery
from keyflow.operators import snapshot as N

ASSIGNMENT_SCHEMA = "topic string, partition int, epoch int, assigned_us bigint, revoked_us bigint"
SECOND = 1_000_000


def work(spark):
    return frame(
        spark,
        [
            attempt(0, 1, 2, 1 * SECOND + 5),
            attempt(1, 3, 4, 2 * SECOND, outcome="error"),
            attempt(2, 5, 6, None, key="b"),
            attempt(3, 7, 8, 2 * SECOND + 1, key="c"),
            attempt(4, 9, 9, 99 * SECOND, key="d"),
        ],
    )


def assigned(spark):
    return spark.createDataFrame([("t", 0, 0, 0, None), ("t", 1, 0, 0, 10), ("t", 2, 0, 98 * SECOND, None)], ASSIGNMENT_SCHEMA)


def test_windows_keep_empty_buckets(spark):
    rows = N.throughput_windows(work(spark), 16 * SECOND).orderBy("bucket").collect()
    assert len(rows) == 15
    assert [(r.processed_count, r.dead_letter_count) for r in rows[:3]] == [(1, 0), (2, 1), (0, 0)]
    assert rows[0].from_time == "1970-01-01T00:00:01.000Z" and rows[0].to_time == rows[1].from_time


def test_latency(spark):
    row = N.window_latency(work(spark), 16 * SECOND).first()
    spent = [SECOND + 3, 2 * SECOND - 4, 2 * SECOND + 1 - 8]
    assert (row.avg_process_us, row.max_process_us) == (sum(spent) // 3, max(spent))
    ends = [SECOND + 5 - 1, 2 * SECOND - 3]
    assert (row.min_end_to_end_us, row.max_end_to_end_us) == (min(ends), max(ends))


def test_partition_offsets(spark):
    rows = {r.partition: r for r in N.partition_offsets(work(spark), assigned(spark), 16 * SECOND).collect()}
    assert (rows[0].highest_ready_offset, rows[0].max_offset_seen, rows[0].gap_buffer_depth, rows[0].assigned) == (1, 4, 1, True)
    assert (rows[1].committed_offset, rows[1].max_offset_seen, rows[1].assigned) == (-1, -1, False)
    assert 2 not in rows


COMMITS = "topic string, partition int, committed_us bigint, committed_offset bigint"


def test_committed_is_not_ready(spark):
    commits = spark.createDataFrame([("t", 0, 5, 0), ("t", 0, 17 * SECOND, 1), ("t", 7, 3, 40), ("t", 7, 3, 41), ("t", 8, 3, 9), ("t", 8, 4, 6)], COMMITS)
    rows = {r.partition: r for r in N.partition_offsets(work(spark), assigned(spark), 16 * SECOND, commits).collect()}
    assert (rows[0].committed_offset, rows[0].highest_ready_offset) == (0, 1)
    assert (rows[7].committed_offset, rows[7].highest_ready_offset, rows[7].assigned) == (41, -1, False)
    assert rows[8].committed_offset == 6, "a position may go back"
    assert rows[1].committed_offset == -1
    unknown = N.partition_offsets(work(spark), assigned(spark), 16 * SECOND)
    assert {r.committed_offset for r in unknown.collect()} == {-1}


def test_commit_log(spark):
    """Ticks every 10 s: 0 and 1 are ready at the first one, nothing moves at the second, 3 is held back by 2."""
    done = {0: 3, 1: 10, 2: 25, 3: 11, 4: None, 5: 26}
    df = frame(spark, [attempt(o, 1, 1, None if at is None else at * SECOND) for o, at in done.items()])
    rows = sorted(tuple(r) for r in delivery.commit_log(df, 10 * SECOND).collect())
    assert rows == [("t", 0, 10 * SECOND, 1), ("t", 0, 30 * SECOND, 3)]


def test_topics_stay_apart(spark):
    one, other = work(spark), work(spark).filter("offset < 2").withColumn("topic", F.lit("u"))
    idle = spark.createDataFrame([("v", 5, 0, 3, None)], ASSIGNMENT_SCHEMA)
    attempts, assignments = one.unionByName(other), assigned(spark).unionByName(idle)
    commits = spark.createDataFrame([("t", 0, 5, 0), ("u", 0, 6, 1)], COMMITS)
    docs = {r.topic: json.loads(r.doc) for r in N.snapshot_json(attempts, assignments, 16 * SECOND, commits=commits).collect()}
    assert set(docs) == {"t", "u", "v"}
    assert [docs[t]["throughput"]["totalProcessed"] for t in "tuv"] == [3, 2, 0]
    assert [sum(w["processedCount"] for w in docs[t]["throughput"]["windows"]) for t in "tuv"] == [3, 2, 0]
    assert [len(docs[t]["throughput"]["windows"]) for t in "tuv"] == [15] * 3
    assert [[p["partition"] for p in docs[t]["preCommits"]["partitions"]] for t in "tuv"] == [[0, 1], [0], [5]]
    assert [docs[t]["preCommits"]["partitions"][0]["committedOffset"] for t in "tuv"] == [0, 1, -1]
    assert [docs[t]["concurrency"]["guardActive"] for t in "tuv"] == [2, 0, 0]
    assert [sum(s["activeWorkers"] for s in docs[t]["shards"]) for t in "tuv"] == [2, 0, 0]
    assert docs["u"]["throughput"]["maxEndToEndDuration"] != "0s" == docs["v"]["throughput"]["maxEndToEndDuration"]
    parsed = N.parse_snapshots(spark.createDataFrame([(json.dumps(d),) for d in docs.values()], "doc string"))
    assert parsed.filter("error is not null").isEmpty()


def test_concurrency_and_shards(spark):
    row = N.concurrency(work(spark), 16 * SECOND, 1).first()
    assert (row.guard_active, row.guard_capacity, row.overflow_active) == (1, 1, 1)
    rows = N.shards(work(spark), 16 * SECOND, 4).collect()
    assert len(rows) == 4 and sum(r.active_workers for r in rows) == 2


def test_document_round_trip(spark):
    out = N.snapshot_json(work(spark), assigned(spark), 16 * SECOND)
    doc = json.loads(out.first().doc)
    assert list(doc) == ["summary", "throughput", "preCommits", "concurrency", "shards"]
    assert doc["summary"] == {
        "topicName": "t", "assignedPartitionCount": 1, "totalProcessed": 3, "lastRebalanceTime": "1970-01-01T00:00:00.000Z"
    }
    assert len(doc["throughput"]["windows"]) == 15 and doc["throughput"]["totalDeadLettered"] == 1
    assert doc["throughput"]["maxProcessDuration"] == "1.999996s"
    assert [p["partition"] for p in doc["preCommits"]["partitions"]] == [0, 1]
    assert doc["preCommits"]["partitions"][1]["committedOffset"] == -1
    assert [s["shard"] for s in doc["shards"]] == list(range(16))
    parsed = N.parse_snapshots(out)
    assert parsed.first().error is None
    assert N.snapshot_partitions(parsed, []).count() == 2 and N.snapshot_windows(parsed, []).count() == 15


@pytest.fixture(scope="module")
def document(spark):
    return json.loads(N.snapshot_json(work(spark), assigned(spark), 16 * SECOND).first().doc)


def errors(spark, *docs):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, doc string")
    return [r.error for r in N.parse_snapshots(df).orderBy("i").collect()]


def test_unknown_fields_are_fine_at_every_level(spark, document):
    extra = json.loads(json.dumps(document))
    extra["future"] = {"a": 1}
    extra["summary"]["future"] = "x"
    extra["preCommits"]["partitions"][0]["future"] = [1, 2]
    extra["shards"][0]["future"] = True
    assert errors(spark, json.dumps(extra)) == [None]


def test_missing_parts_are_errors(spark, document):
    docs, want = [], []
    for section in document:
        docs.append(json.dumps({k: v for k, v in document.items() if k != section}))
        want.append(f"missing field: {section}")
    field = json.loads(json.dumps(document))
    del field["concurrency"]["guardActive"]
    element = json.loads(json.dumps(document))
    del element["shards"][3]["activeWorkers"]
    docs += [json.dumps(field), json.dumps(element)]
    want += ["missing field: concurrency.guardActive", "missing field: shards[]"]
    assert errors(spark, *docs) == want


def test_malformed_documents(spark, document):
    wrong = json.loads(json.dumps(document))
    wrong["summary"]["totalProcessed"] = "many"
    got = errors(spark, "{not json", "", None, "[]", json.dumps(wrong))
    assert all(e == "malformed document" or e.startswith("missing field") for e in got), got
    assert got[0] == got[1] == got[2] == got[4] == "malformed document"


def test_assigned_at(spark):
    rows = {r.partition: r.assigned for r in N.assigned_at(assigned(spark), 10).collect()}
    assert rows == {0: True, 1: False}
    assert N.as_of(work(spark), 5).filter(F.col("done_us").isNotNull()).count() == 0
