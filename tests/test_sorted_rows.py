"""The external sort of a key's rows."""

import numpy as np
import pandas as pd
import pytest

from keyflow.streaming.state import SortedRows


class MapState:
    """Counts the rows it holds and those handed out but not yet used up."""

    def __init__(self):
        self.held, self.reads = {}, 0

    def updateValue(self, key, value):
        self.held[key] = value

    def getValue(self, key):
        self.reads += 1
        return self.held[key]

    def removeKey(self, key):
        del self.held[key]


@pytest.mark.parametrize("n,held,piece,spread", [(0, 10, 3, 5), (9, 10, 3, 5), (500, 40, 7, 3), (500, 40, 7, 10_000), (3000, 100, 100, 1), (20_000, 1000, 64, 500)])
def test_rows_come_in_order(n, held, piece, spread):
    rng = np.random.default_rng(n + spread)
    whole = pd.DataFrame({"partition": rng.integers(0, 3, n), "offset": rng.integers(0, spread, n), "name": [f"r{i}" for i in range(n)]})
    chunks = [whole.iloc[i : i + 37].copy() for i in range(0, n, 37)]
    state = MapState()
    got = list(SortedRows(state, ["partition", "offset"], held, piece).frames(iter(chunks)))
    out = pd.concat(got) if got else whole
    want = whole.sort_values(["partition", "offset"], kind="stable")
    assert list(zip(out["partition"], out["offset"])) == list(zip(want["partition"], want["offset"]))
    assert sorted(out["name"]) == sorted(whole["name"])
    assert not state.held and all(out.dtypes == whole.dtypes)


def test_memory_is_one_piece_per_run():
    """Two hundred thousand rows of one key, shuffled: what is handed on at once stays small."""
    n, held, piece = 200_000, 5_000, 100
    rng = np.random.default_rng(1)
    offsets = rng.permutation(n)
    chunks = (pd.DataFrame({"offset": offsets[i : i + 1000]}) for i in range(0, n, 1000))
    state, at = MapState(), 0
    for frame in SortedRows(state, ["offset"], held, piece).frames(chunks):
        assert len(frame) <= piece * (n // held + 1)
        assert (frame["offset"].to_numpy() == np.arange(at, at + len(frame))).all()
        at += len(frame)
    assert at == n and not state.held
