"""Kafka as source and sink through Spark's connector (its package must be on the class path of the session).

Options use the standard Kafka client names. Names that belong to this package's own behaviour start with ``keyflow.``.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions.envelope import envelope

# Options with a dedicated argument may not be given again.
RESERVED = {"bootstrap.servers": "brokers", "group.id": "group"}

# Client options handed to the connector under the same name with the ``kafka.`` prefix.
PASSED_THROUGH = [
    "allow.auto.create.topics",
    "check.crcs",
    "client.id",
    "client.rack",
    "connections.max.idle.ms",
    "enable.metrics.push",
    "fetch.max.bytes",
    "fetch.max.wait.ms",
    "fetch.min.bytes",
    "heartbeat.interval.ms",
    "max.partition.fetch.bytes",
    "metadata.max.age.ms",
    "session.timeout.ms",
    "socket.connection.setup.timeout.ms",
]
# Accepted and checked, but Spark assigns partitions itself.
WITHOUT_EFFECT = ["rebalance.timeout.ms", "partition.assignment.strategy", "group.instance.id"]
ASSIGNMENT_STRATEGIES = ["cooperative-sticky", "sticky", "roundrobin", "range"]
SECURITY_PREFIXES = ("security.", "sasl.", "ssl.")

# Own options and the reader option each becomes.
OWN_OPTIONS = {
    "keyflow.request.retries": "fetchOffset.numRetries",
    "keyflow.retry.timeout.ms": "kafka.default.api.timeout.ms",
    "keyflow.max.concurrent.fetches": "minPartitions",
}


# Names of the Kafka client.
LOGIN_MODULES = {
    "PLAIN": "org.apache.kafka.common.security.plain.PlainLoginModule",
    "SCRAM-SHA-256": "org.apache.kafka.common.security.scram.ScramLoginModule",
    "SCRAM-SHA-512": "org.apache.kafka.common.security.scram.ScramLoginModule",
}
SECURITY_SWITCHES = {"enable.ssl.certificate.verification"}
SECURITY_SAME = {
    "security.protocol", "sasl.jaas.config", "sasl.kerberos.service.name", "sasl.client.callback.handler.class", "ssl.key.password",
    "ssl.endpoint.identification.algorithm", "ssl.cipher.suites", "ssl.enabled.protocols", "ssl.protocol", "ssl.provider",
}
SECURITY_SAME_PREFIXES = ("ssl.keystore.", "ssl.truststore.", "sasl.login.", "sasl.oauthbearer.")


class OptionError(ValueError):
    """A client option that cannot be used."""


def merge_options(pairs: Mapping[str, str] | Iterable[tuple[str, str]]) -> dict[str, str]:
    """Options as a dict; of repeated keys the last one wins."""
    return dict(pairs.items() if isinstance(pairs, Mapping) else pairs)


def _whole_number(key: str, value: str) -> str:
    if not value.isdigit() or int(value) < 1:
        raise OptionError(f"{key} must be a positive integer, got {value!r}")
    return value


def _check_strategies(value: str) -> None:
    for name in value.split(","):
        if name.strip().lower() not in ASSIGNMENT_STRATEGIES:
            raise OptionError(f"unknown strategy {name.strip()!r} (supported: {', '.join(ASSIGNMENT_STRATEGIES)})")


def starting_offsets(reset: str = "latest", topic: str | None = None, committed: Mapping[int, int] | None = None) -> str:
    """Value of ``startingOffsets``: the reset policy, or JSON with the next offset of each committed partition.

    ``committed`` holds the last committed offset per partition of one topic. In a streaming query the checkpoint takes
    over after the first start.
    """
    if reset not in ("earliest", "latest"):
        raise OptionError(f"auto.offset.reset must be earliest or latest, got {reset!r}")
    if not committed:
        return reset
    if not topic:
        raise OptionError("committed offsets need the topic they belong to")
    edge = -2 if reset == "earliest" else -1
    return json.dumps({topic: {str(p): (o + 1 if o >= 0 else edge) for p, o in sorted(committed.items())}})


def reader_options(
    topic: str, brokers: str, group: str, options: Mapping[str, str] | Iterable[tuple[str, str]] = ()
) -> dict[str, str]:
    """Options of the Kafka reader for one topic. Reading is always limited to committed transactions."""
    if not topic or not brokers or not group:
        raise OptionError("topic, brokers and group must all be set")
    given = merge_options(options)
    security: dict[str, str] = {}
    out = {
        "subscribe": topic,
        "kafka.bootstrap.servers": brokers,
        "groupIdPrefix": group,
        "includeHeaders": "true",
        "kafka.isolation.level": "read_committed",
        "startingOffsets": "latest",
    }
    if "fetch.wait.max.ms" in given:
        given.setdefault("fetch.max.wait.ms", given["fetch.wait.max.ms"])
        del given["fetch.wait.max.ms"]
    for key, value in given.items():
        if key in RESERVED:
            raise OptionError(f"option {key!r} is reserved: use the argument {RESERVED[key]!r}")
        if key == "auto.offset.reset":
            out["startingOffsets"] = starting_offsets(value)
        elif key == "isolation.level":
            if value != "read_committed":
                raise OptionError(f"isolation.level={value} is rejected: aborted records must not be processed")
        elif key in WITHOUT_EFFECT:
            if not value.strip():
                raise OptionError(f"{key} must not be blank")
            if key == "partition.assignment.strategy":
                _check_strategies(value)
            if key == "rebalance.timeout.ms":
                _whole_number(key, value)
            warnings.warn(f"{key} has no effect: Spark assigns partitions itself", stacklevel=2)
        elif key in OWN_OPTIONS:
            out[OWN_OPTIONS[key]] = _whole_number(key, value)
        elif key in PASSED_THROUGH:
            if not value.strip():
                raise OptionError(f"{key} must not be blank")
            out[f"kafka.{key}"] = value
        elif key.startswith(SECURITY_PREFIXES) or key in SECURITY_SWITCHES:
            security[key] = value
        else:
            supported = sorted([*PASSED_THROUGH, *WITHOUT_EFFECT, *OWN_OPTIONS, "auto.offset.reset", "isolation.level"])
            raise OptionError(f"{key!r} is no option of this source; known are {', '.join(supported)} and the security options")
    return out | security_options(security)


def quoted(value: str) -> str:
    """A value inside a JAAS line."""
    return '"' + value.replace("\\", "\\\\").replace('"', '\\"') + '"'


def security_options(given: Mapping[str, str]) -> dict[str, str]:
    """Login and encryption settings in the names that the JVM client knows. What it has no counterpart for is refused by name."""
    rest = dict(given)
    out = {}
    mechanism = rest.pop("sasl.mechanisms", None) or rest.pop("sasl.mechanism", None)
    rest.pop("sasl.mechanism", None)
    if mechanism:
        out["kafka.sasl.mechanism"] = mechanism
    user, password = rest.pop("sasl.username", None), rest.pop("sasl.password", None)
    if (user is None) != (password is None):
        raise OptionError("sasl.username and sasl.password belong together")
    if user is not None:
        module = LOGIN_MODULES.get((mechanism or "").upper())
        if module is None:
            raise OptionError(f"sasl.username needs one of the mechanisms {', '.join(LOGIN_MODULES)}")
        out["kafka.sasl.jaas.config"] = f"{module} required username={quoted(user)} password={quoted(password)};"
    if "ssl.ca.location" in rest:
        out |= {"kafka.ssl.truststore.type": "PEM", "kafka.ssl.truststore.location": rest.pop("ssl.ca.location")}
    certificate, key = rest.pop("ssl.certificate.location", None), rest.pop("ssl.key.location", None)
    if certificate or key:
        if certificate != key:
            raise OptionError("ssl.certificate.location and ssl.key.location must name one PEM file that holds both")
        out |= {"kafka.ssl.keystore.type": "PEM", "kafka.ssl.keystore.location": certificate}
    if rest.pop("enable.ssl.certificate.verification", "true").lower() != "true":
        raise OptionError("enable.ssl.certificate.verification cannot be switched off")
    if rest.get("ssl.endpoint.identification.algorithm") == "none":
        rest["ssl.endpoint.identification.algorithm"] = ""
    for name, value in rest.items():
        if name not in SECURITY_SAME and not name.startswith(SECURITY_SAME_PREFIXES):
            raise OptionError(f"{name} has no counterpart in the JVM client")
        out[f"kafka.{name}"] = value
    return out


def read_records(
    spark: SparkSession,
    topic: str,
    brokers: str,
    group: str,
    options: Mapping[str, str] | Iterable[tuple[str, str]] = (),
    streaming: bool = True,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
    committed: Mapping[int, int] | None = None,
) -> DataFrame:
    """Records of one topic as envelopes.

    ``committed`` holds the last committed offset per partition; reading starts behind it.
    ``max_per_trigger`` bounds a micro-batch; ``min_partitions`` splits few Kafka partitions over more tasks.
    """
    settings = reader_settings(topic, brokers, group, options, streaming, max_per_trigger, min_partitions, committed)
    reader = spark.readStream if streaming else spark.read
    return envelope(reader.format("kafka").options(**settings).load())


def reader_settings(topic, brokers, group, options=(), streaming=True, max_per_trigger=None, min_partitions=None, committed=None) -> dict[str, str]:
    """All options of :func:`read_records` as the reader gets them."""
    settings = reader_options(topic, brokers, group, options)
    if max_per_trigger is not None:
        settings["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        settings["minPartitions"] = str(min_partitions)
    if not streaming and settings["startingOffsets"] == "latest":
        settings["startingOffsets"] = "earliest"
    if committed:
        settings["startingOffsets"] = starting_offsets(settings["startingOffsets"], topic, committed)
    return settings


def writer_options(
    topic: str, brokers: str, options: Mapping[str, str] | Iterable[tuple[str, str]] = ()
) -> dict[str, str]:
    """Options of the Kafka writer; every record is acknowledged by all in-sync replicas. Login and encryption settings are those of the reader."""
    out = {"topic": topic, "kafka.bootstrap.servers": brokers, "kafka.acks": "all"}
    security: dict[str, str] = {}
    for key, value in merge_options(options).items():
        if key in RESERVED:
            raise OptionError(f"option {key!r} is reserved: use the argument {RESERVED[key]!r}")
        if key == "acks" and value not in ("all", "-1"):
            raise OptionError("acks must be all")
        if key.startswith(SECURITY_PREFIXES) or key in SECURITY_SWITCHES:
            security[key] = value
        else:
            out[f"kafka.{key}"] = value
    return out | security_options(security)


def write_records(
    df: DataFrame, topic: str, brokers: str, options: Mapping[str, str] | Iterable[tuple[str, str]] = ()
) -> None:
    """Publish ``key``, ``value`` and, when present, ``headers``; returns when everything is acknowledged."""
    columns = [c for c in ("key", "value", "headers") if c in df.columns]
    out = df.select(*columns)
    if "headers" not in columns:
        out = out.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    out.write.format("kafka").options(**writer_options(topic, brokers, options), includeHeaders="true").save()
