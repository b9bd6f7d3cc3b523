"""Commit watermark and stall alarm of a stream, on state that a batch only touches where it has rows.

The offsets of a partition that lie beyond its watermark are kept in blocks of ``2**BLOCK_BITS`` offsets: the finished ones as ranges,
the ones read but not finished one by one. A batch reads and writes the blocks its rows fall into, one entry with the numbers of the present blocks
per ``2**DIRECTORY_BITS`` blocks, and one head of four numbers, whatever lies between the watermark and the newest offset. Blocks behind the
watermark are removed when it passes them, each once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keyflow import schema as S
from keyflow.streaming.state import KeptMap, with_state

BLOCK_BITS = 12
DIRECTORY_BITS = 10

WATERMARK_SCHEMA = "topic string, partition int, highest_ready_offset bigint, max_offset_seen bigint, gap_buffer_depth bigint"
_SPANS_SCHEMA = "topic string, partition int, lo bigint, hi bigint, done boolean"
BLOCK_STATE = "open array<bigint>, lo array<bigint>, hi array<bigint>"
HEAD_STATE = "ready bigint, seen bigint, depth bigint, first_open bigint"
NONE = -1


def merge_ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted disjoint ranges covering the same whole numbers; neighbours are joined."""
    if len(lo) == 0:
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    first = np.concatenate(([True], lo[1:] > reach[:-1] + 1))
    last = np.concatenate((first[1:], [True]))
    return lo[first], reach[last]


def covered(points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which points lie in one of the sorted ranges."""
    if len(lo) == 0:
        return np.zeros(len(points), bool)
    at = np.searchsorted(lo, points, "right") - 1
    return (at >= 0) & (points <= hi[np.maximum(at, 0)])


def numbers(values) -> np.ndarray:
    return np.array(values, dtype=np.int64)


class OffsetBlocks:
    """One partition's offsets beyond its watermark. ``blocks`` and ``directory`` are maps with ``get``, ``put`` and ``remove``."""

    def __init__(self, blocks, directory, head: tuple[int, int, int, int], bits: int = BLOCK_BITS):
        self.blocks, self.directory, self.bits = blocks, directory, bits
        # The watermark, the newest offset, how many finished offsets lie beyond the watermark, the first offset that is not finished.
        self.ready, self.seen, self.depth, self.first_open = head

    def head(self) -> tuple[int, int, int, int]:
        return self.ready, self.seen, self.depth, self.first_open

    def _read(self, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        found = self.blocks.get(block)
        return None if found is None else tuple(numbers(x) for x in found)

    def _write(self, block: int, is_new: bool, *parts: np.ndarray) -> None:
        if is_new:
            entry = block >> DIRECTORY_BITS
            present = self.directory.get(entry)
            self.directory.put(entry, (sorted([*(present[0] if present else []), block]),))
        self.blocks.put(block, tuple([int(x) for x in part] for part in parts))

    def _remove(self, block: int) -> None:
        entry = block >> DIRECTORY_BITS
        left = [b for b in self.directory.get(entry)[0] if b != block]
        self.directory.put(entry, (left,)) if left else self.directory.remove(entry)
        self.blocks.remove(block)

    def _put_in(self, block: int, open_: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """Add offsets read and ranges finished, all of one block. What is finished is no longer open."""
        old = self._read(block)
        was_open, was_lo, was_hi = old or (numbers([]),) * 3
        lo, hi = merge_ranges(np.concatenate((was_lo, lo)), np.concatenate((was_hi, hi)))
        open_ = np.union1d(was_open, open_)
        open_ = open_[~covered(open_, lo, hi)]
        self.depth += int((hi - lo + 1).sum() - (was_hi - was_lo + 1).sum())
        self._write(block, old is None, open_, lo, hi)

    def present(self) -> Iterator[int]:
        """The numbers of the blocks beyond the watermark, ascending; blocks may be removed on the way."""
        if self.seen > self.ready:
            shift = self.bits + DIRECTORY_BITS
            for entry in range((self.ready + 1) >> shift, (self.seen >> shift) + 1):
                found = self.directory.get(entry)
                yield from list(found[0]) if found else ()


class ReadBlocks(OffsetBlocks):
    """Offsets are known when they are read, so the watermark may pass holes."""

    lowest = None

    def add(self, pdf: pd.DataFrame) -> None:
        offsets, done = pdf["lo"].to_numpy(dtype=np.int64), pdf["done"].to_numpy(dtype=bool)
        beyond = offsets > self.ready
        offsets, done = offsets[beyond], done[beyond]
        if len(offsets) == 0:
            return
        self.seen = max(self.seen, int(offsets.max()))
        of = offsets >> self.bits
        for block in np.unique(of):
            here = of == block
            finished = np.unique(offsets[here & done])
            self._put_in(int(block), np.unique(offsets[here & ~done]), finished, finished)
        if not done.all():
            least = int(offsets[~done].min())
            self.lowest = least if self.lowest is None else min(self.lowest, least)

    def _still_open(self) -> bool:
        """Nothing to do: the first open offset is open as before, and none was read below it."""
        if self.first_open == NONE or (self.lowest is not None and self.lowest < self.first_open):
            return False
        found = self._read(self.first_open >> self.bits)
        return found is not None and self.first_open in found[0]

    def advance(self) -> None:
        if self._still_open():
            return
        self.first_open = NONE
        for block in self.present():
            open_, lo, hi = self._read(block)
            stop = int(open_[0]) if len(open_) else None
            # No range holds an open offset, so each lies wholly on one side of the first one.
            passed = np.ones(len(lo), bool) if stop is None else hi < stop
            if passed.any():
                self.ready = max(self.ready, int(hi[passed].max()))
                self.depth -= int((hi - lo + 1)[passed].sum())
            if stop is not None:
                self.first_open = stop
                if passed.any():
                    self._write(block, False, open_, lo[~passed], hi[~passed])
                return
            self._remove(block)


class IntegerBlocks(OffsetBlocks):
    """Every whole number from the start on is an offset; only finished ranges come in. ``first_open`` is the next one to commit."""

    def add(self, pdf: pd.DataFrame) -> None:
        lo, hi = merge_ranges(pdf["lo"].to_numpy(dtype=np.int64), pdf["hi"].to_numpy(dtype=np.int64))
        for a, b in zip(lo.tolist(), hi.tolist()):
            self.seen = max(self.seen, b)
            if a <= self.first_open:  # joins what is committed: no block needs it
                self.first_open = max(self.first_open, b + 1)
                continue
            for block in range(a >> self.bits, (b >> self.bits) + 1):
                first, last = block << self.bits, ((block + 1) << self.bits) - 1
                self._put_in(block, numbers([]), numbers([max(a, first)]), numbers([min(b, last)]))

    def advance(self) -> None:
        for block in self.present():
            _, lo, hi = self._read(block)
            if lo[0] > self.first_open:
                break
            while len(lo) and lo[0] <= self.first_open:
                self.first_open = max(self.first_open, int(hi[0]) + 1)
                self.depth -= int(hi[0] - lo[0] + 1)
                lo, hi = lo[1:], hi[1:]
            if len(lo):
                self._write(block, False, numbers([]), lo, hi)
                break
            self._remove(block)
        self.ready = self.first_open - 1
        self.seen = max(self.seen, self.ready)


class _Watermark(StatefulProcessor):
    """State: the head, the blocks, and the numbers of the present blocks."""

    def __init__(self, kind: type[OffsetBlocks], start: int = 0):
        self.kind, self.start = kind, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.head = handle.getValueState("head", HEAD_STATE)
        self.blocks = handle.getMapState("blocks", "block bigint", BLOCK_STATE)
        self.directory = handle.getMapState("directory", "entry bigint", "blocks array<bigint>")

    def tracker(self) -> OffsetBlocks:
        begin = (self.start - 1, self.start - 1, 0, self.start) if self.kind is IntegerBlocks else (NONE, NONE, 0, NONE)
        head = tuple(self.head.get()) if self.head.exists() else begin
        return self.kind(KeptMap(self.blocks), KeptMap(self.directory), head)

    def take(self, rows: Iterator[pd.DataFrame]) -> OffsetBlocks:
        tracker = self.tracker()
        for pdf in rows:
            tracker.add(pdf)
        tracker.advance()
        self.head.update(tracker.head())
        return tracker

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = self.take(rows)
        ready = NONE if self.kind is IntegerBlocks and found.ready < self.start else found.ready
        yield pd.DataFrame(
            {
                "topic": [key[0]],
                "partition": [key[1]],
                "highest_ready_offset": [ready],
                "max_offset_seen": [found.seen],
                "gap_buffer_depth": [found.depth],
            }
        )

    def close(self) -> None:
        pass


class _Watchdog(_Watermark):
    """The same state, and a timer that runs while work is behind and starts anew whenever the watermark moves."""

    def __init__(self, quiet_ms: int):
        super().__init__(ReadBlocks)
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle

    def _start(self, timerValues) -> None:
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.quiet_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.head.get()[0] if self.head.exists() else None
        found = self.take(rows)
        timers = list(self.handle.listTimers())
        behind = found.first_open != NONE
        if found.ready != before or not behind:
            for timer in timers:
                self.handle.deleteTimer(timer)
            timers = []
        if behind and not timers:
            self._start(timerValues)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ready, seen, depth, first_open = self.head.get()
        if first_open != NONE:
            self._start(timerValues)
            yield pd.DataFrame(
                {"topic": [key[0]], "partition": [key[1]], "first_open": [first_open], "highest_ready_offset": [ready], "behind": [seen - ready], "held": [depth]}
            )


def _finished_ranges(df: DataFrame) -> DataFrame:
    """Finished offsets as ranges, merged within each task: neighbours of a log are read by the same task."""

    def batches(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in source:
            for (topic, partition), group in pdf.groupby(["topic", "partition"], sort=False):
                offsets = group["offset"].to_numpy(dtype=np.int64)
                lo, hi = merge_ranges(offsets, offsets)
                yield pd.DataFrame({"topic": topic, "partition": partition, "lo": lo, "hi": hi, "done": True})

    finished = df.filter(F.col("done_us").isNotNull()).select(*S.COORDINATES)
    return finished.mapInPandas(batches, _SPANS_SCHEMA)


def _latest_flags(df: DataFrame) -> DataFrame:
    """One row per offset and task batch: has it been finished. Reading and finishing may come as separate rows."""

    def batches(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in source:
            flags = pdf.groupby(["topic", "partition", "lo"], sort=False, as_index=False)["done"].max()
            flags["hi"] = flags["lo"]
            yield flags[["topic", "partition", "lo", "hi", "done"]]

    events = df.select(*S.PARTITION, F.col("offset").alias("lo"), F.col("done_us").isNotNull().alias("done"))
    return events.mapInPandas(batches, _SPANS_SCHEMA)


def commit_watermark_stream(df: DataFrame, mode: str = "read", start: int = 0) -> DataFrame:
    """Commit watermark per partition after each batch; the latest row of a partition counts.

    ``integer`` takes finished offsets and counts up from ``start``. ``read`` takes rows for records read (``done_us``
    null) and finished, in any mix; records must not be read out of offset order across batches, as a log never does.
    """
    if mode == "integer":
        return with_state(_finished_ranges(df), S.PARTITION, _Watermark(IntegerBlocks, start), WATERMARK_SCHEMA)
    if mode != "read":
        raise ValueError(f"mode must be 'read' or 'integer', got {mode!r}")
    return with_state(_latest_flags(df), S.PARTITION, _Watermark(ReadBlocks), WATERMARK_SCHEMA)


STALL_SCHEMA = "topic string, partition int, first_open bigint, highest_ready_offset bigint, behind bigint, held bigint"


def stalled_partitions_stream(attempts: DataFrame, quiet_ms: int) -> DataFrame:
    """A row when a partition's commit watermark has not moved for ``quiet_ms`` of processing time although work is behind, and again after every
    further ``quiet_ms`` as long as that lasts.

    What counts is the contiguous position: work finished above an open record is no progress. ``first_open`` is the record that holds the
    partition up, ``behind`` the distance from the watermark to the newest offset, ``held`` how many finished records wait.
    """
    return with_state(_latest_flags(attempts), S.PARTITION, _Watchdog(quiet_ms), STALL_SCHEMA, "ProcessingTime")
