"""Conversation repair next to a plain dynamic programme over whole audits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from keyflow.llm import conversations as C

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(key.encode()) % 20
        if what == 0:
            continue
        if what == 1:
            text = ""
        if what == 2:
            text = re.sub("[.!?]", "", text)
        if what == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if what == 3 else 1)
    return out


def best(rows):
    """Cheapest ``(cost, audit, repaired)``: the costs to go, then the audits, of all places behind each row."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(at):
        for _ in range(4):
            for place in list("sua") + [""]:
                for initial in "ua":
                    to = follow.get((place, initial))
                    if to and to in at:
                        cost, audit, kept = at[to]
                        new = (cost + 3, "I" + audit, (f"{names[initial]}:",) + kept)
                        if place not in at or new[:2] < at[place][:2]:
                            at[place] = new
        return at

    at = inserted({"": (0, "", ()), "a": (0, "", ())})
    for (_, _, role, text), fault in zip(reversed(rows), reversed(faults)):
        front = {}
        for place in ["", "s", "u", "a"]:
            options = [(at[place][0] + 4, "D" + at[place][1], at[place][2])]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                to = follow.get((place, role[:1]))
                if to:
                    options.append((at[to][0] + extra, "K" + at[to][1], (f"{role}:{text}",) + at[to][2]))
                for initial in "ua":
                    to = follow.get((place, initial))
                    if to:
                        options.append((at[to][0] + 3 + extra, "R" + at[to][1], (f"{names[initial]}:{text}",) + at[to][2]))
            front[place] = min(options, key=lambda o: o[:2])
        at = inserted(front)
    return at[""], faults


def expected(rows):
    groups, out = defaultdict(list), {}
    for row in damage(rows):
        groups[row[0]].append(row)
    for conv in {r[0] for r in rows}:
        part = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        turns = [r[1] for r in part if r[1] is not None]
        (cost, audit, kept), faults = best(part)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(part, part[1:]))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest(),
        )
    return out


def rows_for(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "well", "", " \t", "Done. \n", "a\nb.", None, "é…", "x" * 9000 + "."]
    rows = []
    for conv in range(25):
        start = rng.randrange(3)
        for i in range(rng.randrange(0, 14)):
            role = "system" if i == 0 and rng.random() < 0.4 else "user" if (i + start) % 2 else "assistant"
            role = role if rng.random() < 0.85 else rng.choice(["user", "assistant", "system", "tool", "", None, "User"])
            rows.append((conv, None if rng.random() < 0.03 else i + 2 * (rng.random() < 0.1), role, f"{i} {rng.choice(texts)}" if rng.random() < 0.7 else rng.choice(texts)))
    rows += [(None, 0, "user", "Hi."), (None, None, "assistant", "Ho."), (rows[0][0], rows[0][1], rows[0][2], rows[0][3])]
    rows += [(100, i, "user", f"{i}.") for i in range(60)]  # never forgets what comes after
    rows += [(101, i, "user", "same.") for i in range(40)] + [(102, i, "user" if i % 2 else "assistant", f"{i}") for i in range(50)]
    rows += [(103, 7, "user", "copy.")] * 30
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,chunk,fixups", [(1, 4096, 3), (2, 3, 3), (3, 5, 0), (4, 1, 40), (5, 7, 1)])
def test_repair_is_the_least(spark, seed, chunk, fixups):
    rows = rows_for(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, row string, state int").repartition(3)
    got = {r["conv_id"]: tuple(r)[1:] for r in C.repair(C.damaged(df), df, chunk, fixups).collect()}
    want = expected(rows)
    assert {k: v for k, v in got.items() if v != want.get(k)} == {} and got.keys() == want.keys()


def test_nothing_to_repair(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert C.repair(C.damaged(df), df).count() == 0


def test_chunk_matrices_multiply():
    rng = random.Random(3)
    for _ in range(200):
        symbols = bytes(rng.randrange(16) for _ in range(rng.randrange(1, 12)))
        cut = rng.randrange(len(symbols) + 1)
        whole = C.product(C.matrix(symbols[:cut]), C.matrix(symbols[cut:])) if 0 < cut < len(symbols) else C.matrix(symbols)
        assert (whole == C.matrix(symbols)).all()
        assert C.normal((whole + C.END).min(1).tolist()) == C.backward(symbols, C.END)[0]
