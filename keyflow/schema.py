"""Column layout of the record envelope and of the other tables operators exchange.

``records``      topic, partition, offset, key, value, ts_kind, ts_millis, event_ts, headers, key_str, key_source
``attempts``     topic, partition, offset, attempt_no, key_str, read_us, start_us, done_us, outcome, error, app_traits
                 (``done_us`` is null while the attempt is unfinished)
``assignments``  topic, partition, epoch, assigned_us, revoked_us (null while still assigned)
``packets``      one row of per-message metrics: labels, partition, offset, traits, queue_depth, five nanosecond fields
"""

from __future__ import annotations

from pyspark.sql import types as T

HEADER = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("ts_kind", T.ByteType()),
        T.StructField("ts_millis", T.LongType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("headers", T.ArrayType(HEADER)),
        T.StructField("key_str", T.StringType()),
        T.StructField("key_source", T.StringType()),
    ]
)

# What a coordinate of one record is: unique within a log, repeated only by a redelivery.
COORDINATES = ["topic", "partition", "offset"]
PARTITION = ["topic", "partition"]

# An unfinished attempt compares as later than every finished one.
NEVER_US = (1 << 63) - 1

# Positions of the framework flags in the 64-bit trait field.
PROCESS_ERROR = 0
PROCESS_PANIC = 1
DEAD_LETTER = 2
COMMIT_BUFFERED = 3
DUPLICATE = 4
USED_OVERFLOW = 5
ORPHANED = 6
FIRST_AFTER_REBALANCE = 7
FIRST_APPLICATION_BIT = 10
LAST_APPLICATION_BIT = 63

# Fixed value: the reason recorded when handler code crashes instead of returning an error.
PANIC_REASON = "panic in process callback"

# Labels carried by every per-message metric series.
MESSAGE_LABELS = ["topic", "consumer_group", "service", "team", "partition"]
TOPOLOGY_LABELS = ["topic", "consumer_group", "service", "team"]
