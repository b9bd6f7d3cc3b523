"""The state store of keyed streams and small helpers around it."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Select the state store keyed state needs; takes effect for queries started afterwards."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def with_state(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema, time_mode: str = "None") -> DataFrame:
    use_state_store(df.sparkSession)
    return df.groupBy(*keys).transformWithStateInPandas(processor, schema, "Update", time_mode)


class KeptMap:
    """A map state with one whole number as key."""

    def __init__(self, state):
        self.state = state

    def get(self, key: int):
        return self.state.getValue((key,)) if self.state.containsKey((key,)) else None

    def put(self, key: int, value: tuple) -> None:
        self.state.updateValue((key,), value)

    def remove(self, key: int) -> None:
        self.state.removeKey((key,))


RUN_STATE = ("run bigint, piece bigint", "rows binary")


class SortedRows:
    """The rows of one key and batch in order, however many there are: an external merge sort with its runs in the state store.

    Up to ``held`` rows are sorted in memory. If there are more, every ``held`` rows become a sorted run, written to the map state in pieces of ``piece`` rows,
    and the runs are merged piece by piece. Memory holds ``held`` rows, then one piece per run; the pieces are removed as they
    are read, so nothing stays behind. Rows equal in ``order`` keep the order they came in.
    """

    def __init__(self, state, order: Sequence[str], held: int = 1 << 17, piece: int = 1 << 10):
        self.state, self.order, self.held, self.piece = state, list(order), held, piece

    def _sorted(self, frames: list[pd.DataFrame]) -> pd.DataFrame:
        whole = frames[0] if len(frames) == 1 else pd.concat(frames)
        return whole.sort_values(self.order, kind="stable")

    def _write(self, run: int, frames: list[pd.DataFrame]) -> int:
        whole, n = self._sorted(frames), 0
        for at in range(0, len(whole), self.piece):
            self.state.updateValue((run, n), (pickle.dumps(whole.iloc[at : at + self.piece]),))
            n += 1
        return n

    def _take(self, run: int, piece: int) -> pd.DataFrame:
        rows = pickle.loads(self.state.getValue((run, piece))[0])
        self.state.removeKey((run, piece))
        return rows

    def _last(self, rows: pd.DataFrame) -> tuple:
        return tuple(rows[c].iloc[-1] for c in self.order)

    def frames(self, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """``rows`` as frames in order."""
        runs, waiting, n = [], [], 0
        for pdf in rows:
            waiting.append(pdf)
            n += len(pdf)
            if n > self.held:
                runs.append(self._write(len(runs), waiting))
                waiting, n = [], 0
        if not runs:
            if n:
                yield self._sorted(waiting)
            return
        if n:
            runs.append(self._write(len(runs), waiting))
        yield from self._merged(runs)

    def _merged(self, runs: list[int]) -> Iterator[pd.DataFrame]:
        """One piece per run in memory. Up to the least of their last rows nothing can come in between any more."""
        heads = {run: self._take(run, 0) for run in range(len(runs))}
        bounds = [(self._last(rows), run) for run, rows in heads.items()]
        heapq.heapify(bounds)
        following = dict.fromkeys(heads, 1)
        while bounds:
            bound = bounds[0][0]
            ready = []
            for run in sorted(heads):
                upto = self._upto(heads[run], bound)
                if upto:
                    ready.append(heads[run].iloc[:upto])
                    heads[run] = heads[run].iloc[upto:]
            # Pieces that are used up give way to the next of their run, which may begin with rows equal to the bound.
            while bounds and bounds[0][0] == bound:
                _, run = heapq.heappop(bounds)
                if following[run] == runs[run]:
                    del heads[run]
                    continue
                rows = self._take(run, following[run])
                following[run] += 1
                last, upto = self._last(rows), self._upto(rows, bound)
                if upto:
                    ready.append(rows.iloc[:upto])
                heads[run] = rows.iloc[upto:]
                heapq.heappush(bounds, (last, run))
            yield self._sorted(ready)

    def _upto(self, rows: pd.DataFrame, bound: tuple) -> int:
        """How many of the sorted rows are not behind ``bound``."""
        low, high = 0, len(rows)
        for column, value in zip(self.order, bound):
            part = rows[column].iloc[low:high]
            first = int(part.searchsorted(value, "left"))
            last = int(part.searchsorted(value, "right"))
            low, high = low + first, low + last
            if first == last:
                return low
        return high
