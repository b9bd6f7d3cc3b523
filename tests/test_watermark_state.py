"""The block state of the stream watermark next to a plain set of offsets, and what a batch touches of it."""

import random

import pandas as pd
import pytest

from keyflow.streaming.watermark import IntegerBlocks, ReadBlocks


class Store:
    """A map that counts what is read and written."""

    def __init__(self):
        self.held, self.touched, self.most = {}, 0, 0

    def get(self, key):
        self.touched += 1
        return self.held.get(key)

    def put(self, key, value):
        self.touched += 1
        self.most = max(self.most, sum(map(len, value)))
        self.held[key] = value

    def remove(self, key):
        self.touched += 1
        del self.held[key]


def spans(offsets, done):
    return pd.DataFrame({"lo": offsets, "hi": offsets, "done": done})


def run(kind, head, bits, batches):
    blocks, directory, heads = Store(), Store(), []
    for chunks in batches:
        tracker = kind(blocks, directory, head, bits)
        for pdf in chunks:
            tracker.add(pdf)
        tracker.advance()
        head = tracker.head()
        heads.append(head)
    return heads, blocks, directory


@pytest.mark.parametrize("seed", range(12))
def test_read_mode_is_the_plain_definition(seed):
    rng = random.Random(seed)
    offsets, at = [], rng.randrange(3)
    for _ in range(rng.randrange(1, 400)):
        offsets.append(at)
        at += 1 if rng.random() < 0.7 else rng.choice([2, 3, 50, 3000])
    events = [(i, o, False) for i, o in enumerate(offsets)]
    events += [(i + rng.choice([0, 1, 5, 200]), o, True) for i, o in enumerate(offsets) if rng.random() < 0.95]
    events += [(i + 300, o, rng.random() < 0.5) for i, o in enumerate(offsets) if rng.random() < 0.1 and (i + 300, o, True) not in events]
    events.sort(key=lambda e: e[0])
    step = rng.choice([1, 7, 60])
    batches, state, want = [], {}, []
    for b in range(0, len(events), step):
        part = events[b : b + step]
        rng.shuffle(part)
        cut = rng.randrange(len(part) + 1)
        batches.append([spans([e[1] for e in p], [e[2] for e in p]) for p in (part[:cut], part[cut:]) if p])
        for _, o, done in part:
            state[o] = state.get(o, False) or done
        known = sorted(state)
        first = next((o for o in known if not state[o]), None)
        ready = max([o for o in known if first is None or o < first], default=-1)
        want.append((ready, known[-1], sum(state[o] for o in known if o > ready), -1 if first is None else first))
    got, blocks, directory = run(ReadBlocks, (-1, -1, 0, -1), rng.choice([1, 4, 12]), batches)
    assert got == want
    if want[-1][3] == -1:
        assert not blocks.held and not directory.held


@pytest.mark.parametrize("seed", range(8))
def test_integer_mode_is_the_plain_definition(seed):
    rng = random.Random(seed)
    start, n = rng.choice([0, 17]), 500
    order = sorted(range(start, start + n), key=lambda o: o + rng.choice([0, 3, 100]) * rng.random())
    order += rng.sample(order, 50)
    batches, done, want = [], set(), []
    for b in range(0, len(order), 40):
        part = order[b : b + 40]
        batches.append([spans(part[:25], [True] * len(part[:25]))] + ([spans(part[25:], [True] * len(part[25:]))] if part[25:] else []))
        done |= set(part)
        following = start
        while following in done:
            following += 1
        want.append((following - 1, max(done), sum(o > following for o in done), following))
    got, blocks, _ = run(IntegerBlocks, (start - 1, start - 1, 0, start), rng.choice([1, 3, 12]), batches)
    assert got == want and not blocks.held


@pytest.mark.parametrize("kind", [ReadBlocks, IntegerBlocks])
def test_a_batch_touches_its_blocks_only(kind):
    """One record never finishes; a million offsets later a batch still reads and writes what its own thousand rows need."""
    blocks, directory = Store(), Store()
    head = (-1, -1, 0, -1) if kind is ReadBlocks else (-1, -1, 0, 0)
    costs = []
    for b in range(0, 1_000_000, 10_000):
        offsets = [o for o in range(b, b + 10_000) if o != 5]
        tracker = kind(blocks, directory, head)
        before = blocks.touched + directory.touched
        if kind is ReadBlocks and b == 0:
            tracker.add(spans([5], [False]))
        tracker.add(pd.DataFrame({"lo": offsets, "hi": offsets, "done": True}))
        tracker.advance()
        head = tracker.head()
        costs.append(blocks.touched + directory.touched - before)
    assert max(costs) <= 25 and max(costs[-20:]) <= max(costs[:20]) + 2
    assert blocks.most <= 2 * 4096 and len(blocks.held) <= 1_000_000 // 4096 + 1
    assert head == (4, 999_999, 999_994, 5)
    tracker = kind(blocks, directory, head)
    tracker.add(spans([5], [True]))
    tracker.advance()
    assert tracker.head()[:3] == (999_999, 999_999, 0) and not blocks.held and not directory.held
