"""Delivery analysis of a run: commit watermark, buffering, duplicates, redelivery, drains, rebalances and lag.

``attempts`` may hold several attempts per record. A record counts as finished when any attempt is, at its first
completion. Offsets may have holes (compaction, transaction markers): "contiguous" means contiguous among the records
that were read, unless ``mode="integer"`` is asked for.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow import schema as S
from keyflow.operators.prefix import DEFAULT_BITS, Running, running
from keyflow.operators.staging import small_side, stage

DAY_US = 86_400_000_000


def collapse_attempts(attempts: DataFrame) -> DataFrame:
    """One row per record: ``read_us`` and ``start_us`` of the earliest attempt, ``done_us`` of the first completion.

    Partial aggregation keeps a record with very many copies from weighing on one task.
    """
    return attempts.groupBy(*S.COORDINATES).agg(
        F.min("read_us").alias("read_us"), F.min("start_us").alias("start_us"), F.min("done_us").alias("done_us")
    )


def _unfinished_free(records: DataFrame, bits: int) -> DataFrame:
    """Blocks of a read log: where the first unfinished record is, the highest offset, how many are finished."""
    done = F.col("done_us").isNotNull()
    return records.groupBy(*S.PARTITION, F.shiftright("offset", bits).alias("_block")).agg(
        F.min(F.when(~done, F.col("offset"))).alias("_stop"), F.max("offset").alias("_high"), F.count_if(done).alias("_done")
    )


def commit_watermark(
    attempts: DataFrame, mode: str = "read", start: int | None = None, bits: int = DEFAULT_BITS
) -> DataFrame:
    """Per partition ``highest_ready_offset``, ``max_offset_seen`` and ``gap_buffer_depth`` (-1 / 0 when there is none).

    ``read``: ready is the highest record read below the first unfinished one.
    ``integer``: ready is the end of the run of consecutive finished offsets from ``start`` (default: the lowest offset
    seen).

    Offsets are summed up in blocks first. Only the block of each partition in which the watermark stops is then looked at
    record by record, so the log is shuffled once, by record, and not again by its few partitions.
    """
    if mode not in ("read", "integer"):
        raise ValueError(f"mode must be 'read' or 'integer', got {mode!r}")
    if mode == "integer":
        return _integer_watermark(attempts, start, bits)
    blocks = stage(_unfinished_free(collapse_attempts(attempts), bits))
    stops = blocks.groupBy(*S.PARTITION).agg(F.min("_stop").alias("_stop")).withColumn(
        "_stop_block", F.shiftright("_stop", bits)
    )
    placed = blocks.drop("_stop").join(stops, S.PARTITION)
    before = F.col("_stop").isNull() | (F.col("_block") < F.col("_stop_block"))
    whole = placed.groupBy(*S.PARTITION).agg(
        F.max(F.when(before, F.col("_high"))).alias("_ready"),
        F.max("_high").alias("_seen"),
        F.sum(F.when(F.col("_block") > F.col("_stop_block"), F.col("_done"))).alias("_ahead"),
    )
    where = small_side(stops.filter("_stop is not null").withColumnRenamed("_stop_block", "_block"))
    near = attempts.withColumn("_block", F.shiftright("offset", bits)).join(where, [*S.PARTITION, "_block"])
    records = near.groupBy(*S.COORDINATES, "_stop").agg(F.min("done_us").alias("done_us"))
    detail = records.groupBy(*S.PARTITION).agg(
        F.max(F.when(F.col("offset") < F.col("_stop"), F.col("offset"))).alias("_ready"),
        F.count_if(F.col("done_us").isNotNull() & (F.col("offset") > F.col("_stop"))).alias("_ahead"),
    )
    return _watermark_rows(whole, detail)


def _watermark_rows(*parts: DataFrame) -> DataFrame:
    stacked = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return stacked.groupBy(*S.PARTITION).agg(
        F.coalesce(F.max("_ready"), F.lit(-1).cast("bigint")).alias("highest_ready_offset"),
        F.max("_seen").alias("max_offset_seen"),
        F.coalesce(F.sum("_ahead"), F.lit(0)).cast("bigint").alias("gap_buffer_depth"),
    )


def _integer_watermark(attempts: DataFrame, start: int | None, bits: int) -> DataFrame:
    done = F.col("done_us").isNotNull()
    records = collapse_attempts(attempts)
    from_start = F.col("offset") >= start if start is not None else F.lit(True)
    blocks = stage(
        records.groupBy(*S.PARTITION, F.shiftright("offset", bits).alias("_block")).agg(
            F.min("offset").alias("_low"),
            F.max("offset").alias("_high"),
            F.count_if(done & from_start).alias("_done"),
        )
    )
    first = F.lit(start).cast("bigint") if start is not None else F.min("_low")
    spans = blocks.groupBy(*S.PARTITION).agg(first.alias("_start"), F.max("_high").alias("_seen"))
    # The run ends in the first block that is not completely finished. Blocks are few, a missing one counts as unfinished.
    size = F.lit(1 << bits).cast("bigint")
    begin = F.shiftleft(F.col("_block"), bits)
    needed = size - F.greatest(F.col("_start") - begin, F.lit(0).cast("bigint"))
    usable = blocks.join(spans, S.PARTITION).filter(F.col("_block") >= F.shiftright("_start", bits))
    full = usable.filter(F.col("_done") == needed)
    # Full blocks in an unbroken row from the start block: the n-th full one must be the n-th block.
    ranked = running(full.select(*S.PARTITION, "_block", "_start"), S.PARTITION, ["_block"], "_block",
                     [Running("_n", F.lit(1).cast("bigint"))], bits)
    unbroken = ranked.filter(F.col("_block") - F.shiftright("_start", bits) == F.col("_n") - 1)
    reached = unbroken.groupBy(*S.PARTITION).agg((F.max("_block") + 1).alias("_next"))
    stops = stage(
        spans.join(reached, S.PARTITION, "left").select(
            *S.PARTITION, "_start", "_seen", F.coalesce("_next", F.shiftright("_start", bits)).alias("_block")
        )
    )
    first_of_block = F.greatest(F.col("_start"), F.shiftleft(F.col("_block"), bits))
    base = stops.select(
        *S.PARTITION,
        F.when(first_of_block > F.col("_start"), first_of_block - 1).alias("_ready"),
        "_seen",
    )
    ahead = usable.drop("_start", "_seen").join(stops.withColumnRenamed("_block", "_stop_block"), S.PARTITION)
    ahead = ahead.groupBy(*S.PARTITION).agg(
        F.sum(F.when(F.col("_block") > F.col("_stop_block"), F.col("_done"))).alias("_ahead")
    )
    where = small_side(stops.select(*S.PARTITION, "_block", first_of_block.alias("_from")))
    near = attempts.withColumn("_block", F.shiftright("offset", bits)).join(where, [*S.PARTITION, "_block"])
    finished = near.groupBy(*S.COORDINATES, "_from").agg(F.min("done_us").alias("done_us")).filter(
        done & (F.col("offset") >= F.col("_from"))
    )
    # At most one block per partition is left.
    rank = F.row_number().over(Window.partitionBy(*S.PARTITION).orderBy("offset"))
    in_run = F.col("offset") - F.col("_from") == F.col("_rank") - 1
    detail = finished.withColumn("_rank", rank).groupBy(*S.PARTITION).agg(
        F.max(F.when(in_run, F.col("offset"))).alias("_ready"), F.count_if(~in_run).alias("_ahead")
    )
    return _watermark_rows(base.unionByName(ahead, allowMissingColumns=True), detail)


def watermark_advance(attempts: DataFrame, bits: int = DEFAULT_BITS) -> DataFrame:
    """Per record ``commit_buffered``, ``watermark_advance_us`` and ``end_to_end_us``.

    The watermark passes a record once it and every earlier record of the partition are finished: the running maximum of
    completion times. A finished record is buffered when that is later than its own completion. While an earlier record
    is unfinished there is no advance time.
    """
    records = collapse_attempts(attempts)
    finish = F.coalesce(F.col("done_us"), F.lit(S.NEVER_US).cast("bigint"))
    out = running(records, S.PARTITION, ["offset"], "offset", [Running("_reached", finish, "max")], bits)
    advance = F.when(F.col("_reached") != S.NEVER_US, F.col("_reached"))
    return out.withColumns(
        {
            "commit_buffered": F.coalesce(F.col("_reached") > F.col("done_us"), F.lit(False)),
            "watermark_advance_us": advance,
            "end_to_end_us": advance - F.col("read_us"),
        }
    ).drop("_reached")


def commit_log(attempts: DataFrame, interval_us: int, bits: int = DEFAULT_BITS) -> DataFrame:
    """The commits of a consumer that commits what is ready every ``interval_us``: ``topic, partition, committed_us, committed_offset``.

    One row per partition and tick at which its position has moved since the tick before.
    """
    moved = watermark_advance(attempts, bits).filter(F.col("watermark_advance_us").isNotNull())
    interval = F.lit(interval_us).cast("bigint")
    late = F.pmod(-F.col("watermark_advance_us"), interval)
    return moved.groupBy(*S.PARTITION, (F.col("watermark_advance_us") + late).alias("committed_us")).agg(F.max("offset").alias("committed_offset"))


def commit_buffered(attempts: DataFrame, bits: int = DEFAULT_BITS) -> DataFrame:
    """Finished records held back because an earlier one was not finished yet."""
    return watermark_advance(attempts, bits).filter("commit_buffered").select(*S.COORDINATES, "done_us")


def ordered_pair(major: str, minor: str) -> Column:
    """One number that sorts like two non-negative bigints. Unlike a struct it fits the buffer of a hash aggregate."""
    shift = F.lit(Decimal(10) ** 19)
    return (F.col(major).cast("decimal(38,0)") * shift).cast("decimal(38,0)") + F.col(minor).cast("decimal(19,0)")


def _arrival() -> Column:
    return ordered_pair("read_us", "attempt_no")


def flag_duplicates(attempts: DataFrame) -> DataFrame:
    """Adds ``duplicate``: an earlier attempt read the same record.

    An attempt is told by its record, ``read_us`` and ``attempt_no``: rows equal in these are one attempt noted more than once, and
    alike first or duplicate.

    Only records with more than one attempt are joined back, so usually few rows, and a record copied very many times
    costs one aggregated row instead of one sorted group.
    """
    repeated = (
        attempts.groupBy(*S.COORDINATES)
        .agg(F.count("*").alias("_n"), F.min(_arrival()).alias("_first"))
        .filter("_n > 1")
        .drop("_n")
    )
    joined = attempts.join(repeated, S.COORDINATES, "left")
    return joined.withColumn("duplicate", F.col("_first").isNotNull() & (_arrival() > F.col("_first"))).select(
        *attempts.columns, "duplicate"
    )


def drop_redeliveries(attempts: DataFrame) -> DataFrame:
    """The first attempt of every record."""
    rest = [c for c in attempts.columns if c not in S.COORDINATES]
    first = attempts.groupBy(*S.COORDINATES).agg(F.min_by(F.struct(*rest), _arrival()).alias("_r"))
    return first.select(*S.COORDINATES, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*attempts.columns)


def dedupe_by_id(df: DataFrame, id_cols: list[str], order: list[str], seen: DataFrame | None = None) -> DataFrame:
    """First row per business id in ``order``, without ids already in ``seen``.

    ``order`` must tell rows of one id apart, else which of the equal ones stays is open.
    """
    rest = [c for c in df.columns if c not in id_cols]
    first = df.groupBy(*id_cols).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    if seen is not None:
        first = first.join(seen.select(*id_cols), id_cols, "left_anti")
    return first.select(*id_cols, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def redelivery_set(records: DataFrame, committed: DataFrame) -> DataFrame:
    """Records read again after a restart: those above their partition's ``committed_offset``, or all without one."""
    marks = small_side(committed.select(*S.PARTITION, "committed_offset"))
    joined = records.join(marks, S.PARTITION, "left")
    above = F.col("offset") > F.coalesce(F.col("committed_offset"), F.lit(-1))
    return joined.filter(above).select(*records.columns)


def redelivered_work(attempts: DataFrame, stop_us: int) -> DataFrame:
    """What an emergency stop at ``stop_us`` costs: records read by then and above the watermark of that moment.

    ``was_done`` marks work that was finished and will be done twice.
    """
    seen = attempts.filter(F.col("read_us") <= stop_us).withColumn(
        "done_us", F.when(F.col("done_us") <= stop_us, F.col("done_us"))
    )
    mark = commit_watermark(seen).select(*S.PARTITION, F.col("highest_ready_offset").alias("committed_offset"))
    again = redelivery_set(collapse_attempts(seen), mark)
    return again.select(*S.COORDINATES, "read_us", F.col("done_us").isNotNull().alias("was_done"))


def drain_report(attempts: DataFrame, stop_us: int, drain_us: int = 20_000_000) -> DataFrame:
    """Work read before a graceful stop: finished before it, finished while draining, or abandoned."""
    fate = (
        F.when(F.col("done_us") <= stop_us, "finished")
        .when(F.col("done_us") <= stop_us + drain_us, "drained")
        .otherwise("abandoned")
    )
    return (
        attempts.filter(F.col("read_us") <= stop_us)
        .groupBy(*S.PARTITION, fate.alias("fate"))
        .agg(F.count("*").alias("n"))
    )


def assignment_at(attempts: DataFrame, assignments: DataFrame, width_us: int = DAY_US) -> DataFrame:
    """Adds ``epoch``, ``assigned_us`` and ``revoked_us`` of the assignment during which an attempt was read, else nulls.

    Where assignments overlap, the one assigned last counts; an attempt stays one row. The range condition is turned into
    an equality on time slots: each slot of a partition lists the closed assignments that touch it (a rebalance each, so
    few), and an attempt meets only the list of its own slot, so a busy partition is spread over its slots. Of several open assignments
    one counts until the next one begins, so all but the last are cut there and listed like closed ones; the last has no end to list.
    """

    def slot(us: Column) -> Column:
        return F.call_function("div", us, F.lit(width_us).cast("bigint"))

    assignments = stage(assignments.select(*S.PARTITION, "epoch", "assigned_us", "revoked_us"))
    following = Window.partitionBy(*S.PARTITION).orderBy("assigned_us", "epoch")
    still_open = assignments.filter(F.col("revoked_us").isNull()).withColumn("_until", F.lead("assigned_us").over(following))
    ended = assignments.filter(F.col("revoked_us").isNotNull()).withColumn("_until", F.col("revoked_us"))
    listed = ended.unionByName(still_open.filter(F.col("_until").isNotNull())).filter(F.col("_until") > F.col("assigned_us"))
    span = F.struct("assigned_us", "epoch", "revoked_us", "_until")
    closed = listed.select(
        *S.PARTITION, span.alias("_c"), F.explode(F.sequence(slot(F.col("assigned_us")), slot(F.col("_until") - 1))).alias("_slot")
    )
    closed = closed.groupBy(*S.PARTITION, "_slot").agg(F.collect_list("_c").alias("_closed"))
    opened = still_open.filter(F.col("_until").isNull()).groupBy(*S.PARTITION).agg(F.max_by(span, ordered_pair("assigned_us", "epoch")).alias("_open"))
    slotted = attempts.withColumn("_slot", slot(F.col("read_us")))
    joined = slotted.join(small_side(closed), [*S.PARTITION, "_slot"], "left").join(small_side(opened), S.PARTITION, "left")
    read = F.col("read_us")
    covering = F.filter("_closed", lambda c: (read >= c["assigned_us"]) & (read < c["_until"]))
    in_open = (read >= F.col("_open.assigned_us")) & (
        F.col("_c").isNull() | (F.col("_open.assigned_us") >= F.col("_c.assigned_us"))
    )
    placed = joined.withColumn("_c", F.array_max(covering))
    return placed.withColumn("_m", F.when(in_open, F.col("_open")).otherwise(F.col("_c"))).select(
        *[F.col(c) for c in attempts.columns],
        F.col("_m.epoch").alias("epoch"),
        F.col("_m.assigned_us").alias("assigned_us"),
        F.col("_m.revoked_us").alias("revoked_us"),
    )


def flag_orphaned(attempts: DataFrame, assignments: DataFrame) -> DataFrame:
    """Adds ``orphaned``: read during an assignment that was revoked before the attempt finished."""
    placed = assignment_at(attempts, assignments)
    finish = F.coalesce(F.col("done_us"), F.lit(S.NEVER_US).cast("bigint"))
    return placed.withColumn("orphaned", F.coalesce(finish > F.col("revoked_us"), F.lit(False)))


def flag_first_after_rebalance(attempts: DataFrame, assignments: DataFrame) -> DataFrame:
    """Adds ``first_after_rebalance``: the first attempt read on its partition in its assignment.

    Of attempts read at the same instant the one with the lowest offset is first.
    """
    placed = assignment_at(attempts, assignments)
    rank = ordered_pair("read_us", "offset")
    firsts = (
        placed.filter(F.col("epoch").isNotNull())
        .groupBy(*S.PARTITION, "epoch")
        .agg(F.min_by("offset", rank).alias("offset"), F.min("read_us").alias("read_us"))
        .drop("epoch")
        .withColumn("_is_first", F.lit(True))
    )
    joined = placed.join(small_side(firsts), [*S.COORDINATES, "read_us"], "left")
    return joined.select(
        *placed.columns, F.coalesce(F.col("_is_first"), F.lit(False)).alias("first_after_rebalance")
    )


def lag_report(watermarks: DataFrame, end_offsets: DataFrame) -> DataFrame:
    """Records between the watermark and the end of each partition; ``end_offset`` is the next offset to be written."""
    joined = end_offsets.join(watermarks, S.PARTITION, "left")
    ready = F.coalesce(F.col("highest_ready_offset"), F.lit(-1).cast("bigint"))
    return joined.select(
        *S.PARTITION,
        ready.alias("committed_offset"),
        "end_offset",
        F.greatest(F.col("end_offset") - ready - 1, F.lit(0).cast("bigint")).alias("lag"),
    )


def run_verdict(attempts: DataFrame, expected: int) -> DataFrame:
    """Did the run process everything: distinct records finished, no dead letters, nothing left unfinished."""
    records = attempts.groupBy(*S.COORDINATES).agg(
        F.max(F.col("done_us").isNotNull()).alias("_done"),
        F.max(F.coalesce(F.col("outcome") == "ok", F.lit(False)) & F.col("done_us").isNotNull()).alias("_ok"),
    )
    totals = records.agg(
        F.count("*").alias("records"),
        F.count_if("_ok").alias("processed"),
        F.count_if(F.col("_done") & ~F.col("_ok")).alias("dead_lettered"),
        F.count_if(~F.col("_done")).alias("unfinished"),
    )
    return totals.withColumns(
        {
            "reached_expected": F.col("processed") >= expected,
            "no_dead_letters": F.col("dead_lettered") == 0,
            "success": (F.col("processed") >= expected) & (F.col("dead_lettered") == 0) & (F.col("unfinished") == 0),
        }
    )


def duplicate_rate(attempts: DataFrame) -> DataFrame:
    """Deliveries, distinct records and duplicates per partition. Equals counting the attempts of :func:`flag_duplicates`.

    As there, rows equal in record, ``read_us`` and ``attempt_no`` are one delivery.
    """
    read = attempts.groupBy(*S.COORDINATES, "read_us", "attempt_no").agg(F.lit(1).alias("_one"))
    records = read.groupBy(*S.COORDINATES).agg(F.count("*").alias("_n"))
    return (
        records.groupBy(*S.PARTITION)
        .agg(F.sum("_n").alias("deliveries"), F.count("*").alias("records"))
        .withColumn("duplicates", F.col("deliveries") - F.col("records"))
        .withColumn("duplicates_per_million", F.call_function("div", F.col("duplicates") * 1_000_000, F.col("deliveries")))
    )
