"""Per-record processing: rules or a Python handler, failures routed to dead letters, nothing dropped."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any, NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow import schema as S
from keyflow.functions import envelope as E
from keyflow.functions import text, traits


@dataclass(frozen=True)
class Reject:
    """Fail records for which ``condition`` is true, with ``message`` (text or a string column) as the reason.

    Without a condition a record fails where the message column is not null.
    """

    condition: Column | None
    message: str | Column

    def reason(self) -> Column:
        if isinstance(self.message, str):
            return F.when(self.condition, text.cut_text(self.message))
        return self.message if self.condition is None else F.when(self.condition, self.message)


@dataclass(frozen=True)
class Tag:
    """Set application bit ``bit`` on successful records for which ``condition`` is true."""

    condition: Column
    bit: int


def require_equal(left: Column, right: Column, message: str | Column) -> Reject:
    """Reject records whose two columns differ (null equals null)."""
    return Reject(~left.eqNullSafe(right), message)


def parse_json(value: Column | str, schema: T.StructType | str) -> tuple[Column, Column]:
    """``(parsed, parse_error)`` of a JSON payload; unknown fields are ignored, ``parse_error`` is null when it parsed."""
    v = F.col(value) if isinstance(value, str) else value
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_corrupt = T.StructType([*fields.fields, T.StructField("_corrupt_record", T.StringType())])
    body = E.value_text(v)
    parsed = F.from_json(body, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    # Through a one-element array the document is parsed once for both tests.
    unreadable = F.get(F.transform(F.array(parsed), lambda p: p.isNull() | p["_corrupt_record"].isNotNull()), F.lit(0))
    error = (
        F.when(v.isNull(), "null payload")
        .when(F.octet_length(v) == 0, "empty payload")
        .when(body.isNull(), "payload is not UTF-8")
        .when(unreadable, "invalid JSON")
    )
    clean = F.struct(*[parsed[f.name].alias(f.name) for f in fields.fields])
    return F.when(error.isNull(), clean), error


def process(df: DataFrame, rules: Sequence[Reject] = (), tags: Sequence[Tag] = ()) -> DataFrame:
    """Adds ``outcome`` (ok / error), ``error`` and ``app_traits``. The first rule that holds gives the reason.

    Plain column expressions: they stay in generated code and filters still reach the scan. A failed record has no traits.
    """
    error = F.coalesce(*[r.reason() for r in rules]) if rules else F.lit(None).cast("string")
    tagged = traits.trait_or(*[traits.trait_when(F.coalesce(t.condition, F.lit(False)), t.bit) for t in tags])
    out = df.withColumn("error", error)
    if any(isinstance(r.message, Column) for r in rules):
        out = out.withColumn("error", text.truncate_utf8("error"))
    return out.withColumns(
        {
            "outcome": F.when(F.col("error").isNull(), "ok").otherwise("error"),
            "app_traits": F.when(F.col("error").isNull(), tagged).otherwise(F.lit(0).cast("bigint")),
        }
    )


class HandlerError(Exception):
    """Raised by a handler to fail a record with a reason. Any other exception counts as a crash."""


def run_handler(handler: Callable[[Any], int | None], message: Any) -> tuple[str, str | None, int]:
    """``(outcome, error, app_traits)`` of one call. A crash is contained and gets the fixed reason."""
    try:
        bits = handler(message) or 0
    except HandlerError as exc:
        return "error", str(exc), 0
    except Exception:  # noqa: BLE001 - a crash costs one record, never the job
        return "panic", S.PANIC_REASON, 0
    bits &= ~((1 << S.FIRST_APPLICATION_BIT) - 1) & ((1 << 64) - 1)
    return "ok", None, bits - (1 << 64) if bits >> 63 else bits


def process_udf(df: DataFrame, handler: Callable[[Any], int | None], columns: Sequence[str] | None = None) -> DataFrame:
    """As :func:`process`, with a Python function called once per record.

    ``handler`` gets a named tuple of ``columns`` (all by default) and returns application bits or None. Batches come and
    go as Arrow; only ``columns`` are turned into Python objects. No shuffle: a record needs nothing but itself.
    """
    names = list(columns or df.columns)
    fields = [f for f in df.schema.fields if f.name not in ("outcome", "error", "app_traits")]
    out_schema = T.StructType(
        [
            *fields,
            T.StructField("outcome", T.StringType()),
            T.StructField("error", T.StringType()),
            T.StructField("app_traits", T.LongType()),
        ]
    )
    kept = [f.name for f in fields]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        message = NamedTuple("Message", [(n, Any) for n in names])
        for batch in source:
            inputs = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
            results = [run_handler(handler, message(*row)) for row in zip(*inputs, strict=True)]
            added = [
                pa.array([r[0] for r in results], pa.string()),
                pa.array([r[1] for r in results], pa.string()),
                pa.array([r[2] for r in results], pa.int64()),
            ]
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in kept] + added
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "outcome", "error", "app_traits"])

    out = df.mapInArrow(batches, out_schema)
    return out.withColumn("error", text.truncate_utf8("error"))


BatchAnswer = tuple[pa.Array | None, pa.Array | None]


def handle_batch(handler: Callable[[pa.RecordBatch], BatchAnswer | None], batch: pa.RecordBatch) -> list[tuple[pa.Array, pa.Array, pa.Array]]:
    """``(outcome, error, app_traits)`` of the records of a batch, in pieces in their order.

    A batch whose handler raises is halved until the records that make it fail stand alone; the rest succeeds in larger pieces. The halves wait
    on a stack, so memory holds slices of one batch only.
    """
    done, waiting = [], [batch]
    clear = ~((1 << S.FIRST_APPLICATION_BIT) - 1)
    while waiting:
        part = waiting.pop()
        n = part.num_rows
        try:
            bits, errors = handler(part) or (None, None)
            bits = pa.nulls(n, pa.int64()) if bits is None else bits.cast(pa.int64())
            errors = pa.nulls(n, pa.string()) if errors is None else errors.cast(pa.string())
            if len(bits) != n or len(errors) != n:
                raise ValueError("a batch handler answers for every record")
        except Exception as exc:  # noqa: BLE001 - a crash costs the records that cause it, never the job
            if n > 1:
                waiting += [part.slice(n // 2), part.slice(0, n // 2)]
                continue
            outcome, reason = ("error", str(exc)) if isinstance(exc, HandlerError) else ("panic", S.PANIC_REASON)
            done.append((pa.array([outcome]), pa.array([reason], pa.string()), pa.array([0], pa.int64())))
            continue
        ok = pc.is_null(errors)
        bits = pc.bit_wise_and(pc.fill_null(bits, 0), pa.scalar(clear, pa.int64()))
        done.append((pc.if_else(ok, "ok", "error"), errors, pc.if_else(ok, bits, pa.scalar(0, pa.int64()))))
    return done


def process_batches(
    df: DataFrame, handler: Callable[[pa.RecordBatch], BatchAnswer | None], columns: Sequence[str] | None = None
) -> DataFrame:
    """As :func:`process_udf`, with a vectorised function called once per Arrow batch of ``columns`` (all by default).

    It returns None or ``(bits, errors)``, each an Arrow array with one entry per record or None: application bits, and the reason of the records
    that fail, null for the others. When it raises, the batch is bisected down to the records at fault, so a crash is still contained per record; k of them
    among n cost about 2 k log2(n / k) further calls. The handler therefore must not keep anything from call to call. A batch without records calls nothing.
    """
    names = list(columns or df.columns)
    fields = [f for f in df.schema.fields if f.name not in ("outcome", "error", "app_traits")]
    added = [T.StructField("outcome", T.StringType()), T.StructField("error", T.StringType()), T.StructField("app_traits", T.LongType())]
    kept = [f.name for f in fields]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if batch.num_rows:
                answers = zip(*handle_batch(handler, batch.select(names)), strict=True)
                arrays = [batch.column(batch.schema.get_field_index(n)) for n in kept] + [pa.concat_arrays(a) for a in answers]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "outcome", "error", "app_traits"])

    out = df.mapInArrow(batches, T.StructType([*fields, *added]))
    return out.withColumn("error", text.truncate_utf8("error"))


def with_framework_traits(df: DataFrame) -> DataFrame:
    """Adds ``traits``: the application bits plus the framework flags the row's columns stand for.

    ``outcome`` gives bit 0 and ``dead_lettered`` bit 2; the boolean columns ``commit_buffered``, ``duplicate``,
    ``used_overflow``, ``orphaned`` and ``first_after_rebalance`` give theirs when present. Bit 1 is kept for a crash
    inside the framework itself and is never set here.
    """
    flags = {
        S.DEAD_LETTER: "dead_lettered",
        S.COMMIT_BUFFERED: "commit_buffered",
        S.DUPLICATE: "duplicate",
        S.USED_OVERFLOW: "used_overflow",
        S.ORPHANED: "orphaned",
        S.FIRST_AFTER_REBALANCE: "first_after_rebalance",
    }
    terms = [F.when(F.col("outcome") != "ok", F.lit(1 << S.PROCESS_ERROR).cast("bigint")).otherwise(F.lit(0))]
    terms += [
        F.when(F.col(name), F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0))
        for bit, name in flags.items()
        if name in df.columns
    ]
    return df.withColumn("traits", traits.trait_or(F.coalesce(F.col("app_traits"), F.lit(0)), *terms))


def split_outcomes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(ok, dead)``. Every record is in exactly one; the caller persists the input if both are written."""
    failed = F.coalesce(F.col("outcome") != "ok", F.lit(True))
    return df.filter(~failed), df.filter(failed).withColumnRenamed("error", "reason")


def dead_letter_report(dead: DataFrame) -> DataFrame:
    """How often each reason occurred per partition, and where."""
    return dead.groupBy("topic", "partition", "reason").agg(
        F.count("*").alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


def replay_candidates(dead: DataFrame, resolved: DataFrame) -> DataFrame:
    """Dead letters whose record is not among ``resolved`` (by topic, partition, offset)."""
    return dead.join(resolved.select(*S.COORDINATES), S.COORDINATES, "left_anti")


def latest_by_key(df: DataFrame) -> DataFrame:
    """Compacted view: the latest record per key, without keys whose latest record is a tombstone.

    An aggregate with map-side combine, so a hot key costs one row per task. Records of one key are ordered by partition,
    then offset; normally a key lives on one partition.
    """
    latest = df.groupBy("topic", "key_str").agg(
        F.max_by(F.struct(*[c for c in df.columns if c not in ("topic", "key_str")]), F.struct("partition", "offset")).alias("_r")
    )
    rest = [F.col(f"_r.{c}").alias(c) for c in df.columns if c not in ("topic", "key_str")]
    return latest.filter(F.col("_r.value").isNotNull()).select("topic", "key_str", *rest)
