"""Column functions over the parts of a record: timestamp, key, value and headers.

Null and empty bytes are different things throughout: a null value is a tombstone, an empty one is a payload of length 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp_kind(type_col: Column | str) -> Column:
    """0 not available, 1 set by the producer, 2 set by the broker, from the wire's -1 / 0 / 1 (anything else is 0)."""
    t = _col(type_col)
    return F.when(t == 0, 1).when(t == 1, 2).otherwise(0).cast("tinyint")


def decode_timestamp(type_col: Column | str, millis_col: Column | str) -> Column:
    """``struct(ts_kind, ts_millis, event_ts)``; millis and instant are null when no timestamp is available."""
    kind = timestamp_kind(type_col)
    millis = F.when(kind != 0, _col(millis_col).cast("bigint"))
    return F.struct(kind.alias("ts_kind"), millis.alias("ts_millis"), F.timestamp_millis(millis).alias("event_ts"))


def is_utf8(binary: Column | str) -> Column:
    return F.is_valid_utf8(_col(binary).cast("string"))


def key_text(key: Column | str, partition: Column | str) -> Column:
    """The key as text: as is when UTF-8, base64 when binary, the partition number when the record has no key."""
    k = _col(key)
    return (
        F.when(k.isNull(), _col(partition).cast("string"))
        .when(is_utf8(k), k.cast("string"))
        .otherwise(F.base64(k))
    )


def key_source(key: Column | str) -> Column:
    """How :func:`key_text` got its text, so a keyless record on partition 3 stays apart from a literal key ``"3"``."""
    k = _col(key)
    return F.when(k.isNull(), "partition").when(is_utf8(k), "raw").otherwise("base64")


def normalise_key(key: Column | str, partition: Column | str) -> dict[str, Column]:
    return {"key_str": key_text(key, partition), "key_source": key_source(key)}


def value_text(value: Column | str) -> Column:
    """The value as text, null when it is null or not UTF-8."""
    return F.try_validate_utf8(_col(value).cast("string"))


def payload_kind(value: Column | str) -> Column:
    v = _col(value)
    return F.when(v.isNull(), "tombstone").when(F.octet_length(v) == 0, "empty").otherwise("present")


def header_count(headers: Column | str) -> Column:
    return F.coalesce(F.size(F.coalesce(_col(headers), F.array())), F.lit(0)).cast("int")


def header_at(headers: Column | str, index: int) -> Column:
    """Header at a wire position, null when out of range."""
    return F.get(_col(headers), F.lit(index))


def header_find(headers: Column | str, key: str) -> Column:
    """First header with the key as a struct; null when there is none, a struct with a null value when it has none."""
    return F.get(F.filter(_col(headers), lambda h: h["key"] == key), F.lit(0))


def clean_header_keys(headers: Column | str) -> Column:
    """Header keys that are not UTF-8 become the empty string; order, duplicates and values stay."""
    return F.transform(
        _col(headers),
        lambda h: F.struct(
            F.when(F.is_valid_utf8(h["key"].cast("string")), h["key"].cast("string")).otherwise("").alias("key"),
            h["value"].alias("value"),
        ),
    )


def explode_headers(df: DataFrame, headers: str = "headers") -> DataFrame:
    """One row per header in wire order with ``header_pos``, ``header_key`` and ``header_value``.

    A record without headers keeps one row with nulls.
    """
    others = [c for c in df.columns if c != headers]
    return df.select(*others, F.posexplode_outer(headers).alias("header_pos", "_h")).select(
        *others,
        "header_pos",
        F.col("_h.key").alias("header_key"),
        F.col("_h.value").alias("header_value"),
    )


def envelope(kafka_df: DataFrame, clean_headers: bool = True) -> DataFrame:
    """Rows of Spark's Kafka source (or a table of that shape) as typed envelopes, see ``keyflow.schema.ENVELOPE``.

    Expects ``key, value, topic, partition, offset, timestamp, timestampType`` and optionally ``headers``. Columns beyond
    these pass through unchanged. A narrow projection: no shuffle, and unused columns are pruned at the source.
    """
    known = {"key", "value", "topic", "partition", "offset", "timestamp", "timestampType", "headers"}
    rest = [c for c in kafka_df.columns if c not in known]
    if "headers" in kafka_df.columns:
        headers = clean_header_keys("headers") if clean_headers else F.col("headers")
    else:
        headers = F.lit(None).cast("array<struct<key:string,value:binary>>")
    ts = decode_timestamp("timestampType", F.unix_millis(F.col("timestamp").cast("timestamp")))
    return kafka_df.select(
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        "key",
        "value",
        ts["ts_kind"].alias("ts_kind"),
        ts["ts_millis"].alias("ts_millis"),
        ts["event_ts"].alias("event_ts"),
        headers.alias("headers"),
        key_text("key", "partition").alias("key_str"),
        key_source("key").alias("key_source"),
        *rest,
    )


def record_bytes(key: Column | str, value: Column | str, headers: Column | str) -> Column:
    """Size of a record: key, value and header bytes."""
    zero = F.lit(0).cast("bigint")
    header_bytes = F.aggregate(
        _col(headers),
        zero,
        lambda acc, h: acc
        + F.coalesce(F.octet_length(h["key"]), F.lit(0))
        + F.coalesce(F.octet_length(h["value"]), F.lit(0)),
    )
    return (
        F.coalesce(F.octet_length(_col(key)), F.lit(0)).cast("bigint")
        + F.coalesce(F.octet_length(_col(value)), F.lit(0))
        + F.coalesce(header_bytes, zero)
    )
