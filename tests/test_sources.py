import json
import warnings

import pytest
from helpers import attempt, frame
from pyspark.sql import functions as F

from keyflow.operators import metrics
from keyflow.sources import kafka, sinks, tables


def options(*pairs):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return kafka.reader_options("orders", "b:9092", "svc", pairs)


def test_required_and_forced():
    out = options()
    assert out["subscribe"] == "orders" and out["kafka.bootstrap.servers"] == "b:9092"
    assert out["kafka.isolation.level"] == "read_committed" and out["includeHeaders"] == "true"
    for missing in (("", "b", "g"), ("t", "", "g"), ("t", "b", "")):
        with pytest.raises(kafka.OptionError):
            kafka.reader_options(*missing)


@pytest.mark.parametrize("key", ["bootstrap.servers", "group.id"])
def test_reserved_options_are_refused(key):
    with pytest.raises(kafka.OptionError, match="reserved"):
        options((key, "x"))
    with pytest.raises(kafka.OptionError, match="reserved"):
        kafka.writer_options("t", "b", {key: "x"})


@pytest.mark.parametrize(
    ("key", "value"),
    [("no.such.key", "x"), ("isolation.level", "read_uncommitted"), ("isolation.level", "sideways"), ("group.instance.id", " "),
     ("client.rack", " "), ("partition.assignment.strategy", "zigzag"), ("partition.assignment.strategy", "range,"),
     ("partition.assignment.strategy", ""), ("auto.offset.reset", "none"), ("keyflow.max.concurrent.fetches", "0"),
     ("rebalance.timeout.ms", "soon")],
)
def test_bad_options_are_refused(key, value):
    with pytest.raises(kafka.OptionError):
        options((key, value))


def test_translation():
    out = options(
        ("auto.offset.reset", "earliest"), ("fetch.wait.max.ms", "500"), ("client.id", "a"), ("client.id", "b"), ("isolation.level", "read_committed"),
        ("sasl.mechanisms", "PLAIN"), ("security.protocol", "sasl_ssl"), ("keyflow.request.retries", "7"),
        ("partition.assignment.strategy", "Cooperative-Sticky, sticky, roundrobin, range"),
    )
    assert out["startingOffsets"] == "earliest" and out["kafka.fetch.max.wait.ms"] == "500"
    assert out["kafka.client.id"] == "b", "last write wins"
    assert out["kafka.sasl.mechanism"] == "PLAIN" and out["kafka.security.protocol"] == "sasl_ssl"
    assert out["fetchOffset.numRetries"] == "7"
    assert not any("assignment" in k for k in out)


def test_options_without_effect_warn():
    with pytest.warns(UserWarning, match="no effect"):
        kafka.reader_options("t", "b", "g", {"group.instance.id": "x"})


def test_starting_offsets():
    assert kafka.starting_offsets("earliest") == "earliest"
    out = json.loads(kafka.starting_offsets("earliest", "t", {1: 41, 0: -1}))
    assert out == {"t": {"0": -2, "1": 42}}
    with pytest.raises(kafka.OptionError):
        kafka.starting_offsets("none")


def test_writer_options():
    out = kafka.writer_options("t", "b", {"linger.ms": "5"})
    assert out["kafka.acks"] == "all" and out["kafka.linger.ms"] == "5"
    with pytest.raises(kafka.OptionError):
        kafka.writer_options("t", "b", {"acks": "1"})


def test_writer_security_is_that_of_the_reader():
    given = {
        "security.protocol": "SASL_SSL", "sasl.mechanisms": "SCRAM-SHA-256", "sasl.username": "u", "sasl.password": 'p"w', "ssl.ca.location": "/ca.pem",
        "ssl.certificate.location": "/both.pem", "ssl.key.location": "/both.pem",
    }
    out = kafka.writer_options("t", "b", {**given, "linger.ms": "5"})
    read = kafka.reader_options("t", "b", "g", given)
    translated = {k: v for k, v in read.items() if k.startswith(("kafka.sasl", "kafka.ssl", "kafka.security"))}
    assert {k: v for k, v in out.items() if k in translated} == translated and len(translated) >= 6
    assert not {f"kafka.{k}" for k in ("sasl.username", "sasl.password", "ssl.ca.location", "sasl.mechanisms")} & out.keys()
    assert out["kafka.linger.ms"] == "5"
    with pytest.raises(kafka.OptionError, match="no counterpart"):
        kafka.writer_options("t", "b", {"ssl.engine.location": "/x"})
    with pytest.raises(kafka.OptionError, match="belong together"):
        kafka.writer_options("t", "b", {"sasl.username": "u"})


def test_order_events(spark):
    df = spark.range(1000).withColumn("at", F.timestamp_seconds(F.lit(0)))
    rows = tables.order_events(df, "id", "at").orderBy("number").collect()
    bodies = [json.loads(bytes(r.value)) for r in rows]
    assert len({b["orderId"] for b in bodies}) == 1000
    assert all(bytes(r.key).decode() == b["orderId"] for r, b in zip(rows, bodies, strict=True))
    assert {b["quantity"] for b in bodies} == {1, 2, 3, 4, 5} and bodies[0]["unitPriceCents"] == 999 and bodies[49]["unitPriceCents"] == 1489
    assert {b["customerId"] for b in bodies} == set(tables.CUSTOMERS) and {b["sku"] for b in bodies} == set(tables.SKUS)
    assert list(bodies[0]) == ["orderId", "customerId", "sku", "quantity", "unitPriceCents", "currency", "placedAt"]
    assert bodies[0]["placedAt"] == "1970-01-01T00:00:00Z" and bodies[0]["currency"] == "GBP"


def test_content_key_tells_rows_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "abc"), ("", "abc"), ("abc", None), ("abc", ""), ("n", "x"), (None, "x"), ("é", "x")]
    df = spark.createDataFrame(rows, "x string, y string")
    keys = [r.k for r in df.select(sinks.content_key("x", "y").alias("k")).collect()]
    assert len(set(keys)) == len(rows)


def test_insert_if_absent_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1, "old")], "id string, at int, v string")
    new = spark.createDataFrame([("a", 2, "new"), ("b", 3, "late"), ("b", 2, "first")], "id string, at int, v string")
    added = sinks.insert_if_absent(new, target, ["id"], ["at"])
    assert [tuple(r) for r in added.collect()] == [("b", 2, "first")]
    assert sinks.insert_if_absent(new, target.unionByName(added), ["id"], ["at"]).count() == 0


def test_upsert_latest_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("c", 9, "keep")], "id string, at int, v string")
    new = spark.createDataFrame([("a", 2, "new"), ("c", 3, "stale"), ("b", 1, "b")], "id string, at int, v string")
    once = sinks.upsert_latest(new, target, ["id"], ["at"])
    want = [("a", 2, "new"), ("b", 1, "b"), ("c", 9, "keep")]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, sinks.upsert_latest(new, once, ["id"], ["at"]).collect())) == want


def test_dead_letter_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "dead")
    df = frame(spark, [attempt(1), attempt(2)]).select("topic", "partition", "offset", F.lit("why").alias("reason"))
    sinks.write_dead_letters(df, path, 0)
    sinks.write_dead_letters(df.filter("offset = 2"), path, 1)
    sinks.write_dead_letters(df, path, 0)
    out = sinks.read_batches(spark, path)
    assert sorted((r.batch_id, r.offset) for r in out.collect()) == [(0, 1), (0, 2), (1, 2)]


def test_write_exposition(spark, tmp_path):
    packet = ("t", "g", "", "", 0, 42, 0, 7, 2_000_000, 0, 0, 0)
    schema = (
        "topic string, consumer_group string, service string, team string, partition int, offset bigint, traits bigint, queue_depth int, "
        "process_duration_ns bigint, deadletter_duration_ns bigint, read_time_ns bigint, process_start_time_ns bigint"
    )
    path = tmp_path / "metrics"
    sinks.write_exposition(metrics.metrics_long(spark.createDataFrame([packet], schema)), str(path))
    parts = list(path.glob("part-*"))
    assert len(parts) == 1
    text = parts[0].read_text().splitlines()
    assert text[-1] == "# EOF" and any(t.endswith("} 42") for t in text)


def test_file_stream_and_batch_have_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.range(10).selectExpr("'t' as topic", "0 as p", "id as o").write.parquet(path)
    mapping = {"topic": "topic", "partition": "p", "offset": "o"}
    batch = tables.records_from_table(tables.read_table(spark, path), mapping)
    stream = tables.records_from_table(tables.read_table(spark, path, streaming=True), mapping)
    assert stream.isStreaming and stream.schema == batch.schema and batch.count() == 10


def test_security_options_are_translated():
    out = kafka.security_options({"security.protocol": "SASL_SSL", "sasl.mechanisms": "SCRAM-SHA-512", "sasl.username": 'a"b', "sasl.password": "c\\d", "ssl.ca.location": "/ca.pem"})
    module = "org.apache.kafka.common.security.scram.ScramLoginModule"
    assert out == {
        "kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "SCRAM-SHA-512", "kafka.ssl.truststore.type": "PEM",
        "kafka.ssl.truststore.location": "/ca.pem", "kafka.sasl.jaas.config": module + ' required username="a\\"b" password="c\\\\d";',
    }


@pytest.mark.parametrize("given", [
    {"sasl.username": "u"}, {"sasl.username": "u", "sasl.password": "p"}, {"ssl.certificate.location": "a", "ssl.key.location": "b"},
    {"enable.ssl.certificate.verification": "false"}, {"ssl.crl.location": "x"},
])
def test_security_options_without_counterpart_are_refused(given):
    with pytest.raises(kafka.OptionError):
        kafka.security_options(given)


def test_committed_offsets_reach_the_reader():
    settings = kafka.reader_settings("t", "b", "g", committed={0: 9, 1: -1})
    assert json.loads(settings["startingOffsets"]) == {"t": {"0": 10, "1": -1}}


def test_replay_without_rows_leaves_none(spark, tmp_path):
    one = spark.createDataFrame([(1, "x")], "k int, reason string")
    sinks.write_dead_letters(one, str(tmp_path / "d"), 7)
    sinks.write_dead_letters(one.limit(0), str(tmp_path / "d"), 7)
    sinks.write_dead_letters(one, str(tmp_path / "d"), 8)
    assert [r.batch_id for r in sinks.read_batches(spark, str(tmp_path / "d")).collect()] == [8]
