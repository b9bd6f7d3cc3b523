"""Quality classifier from weak labels.

Heuristic labellers each vote good, bad or nothing on every text. The votes of all documents are counted by pattern in Spark (at most 3 to the
number of labellers). Expectation-maximisation on the pattern counts estimates how often each labeller votes how on good and on bad
documents, without any true label, and gives every pattern a posterior. The posteriors then are soft labels for a linear scorer on hashed features, byte
trigrams and votes, which is fitted on a bounded sample: at most ``FIT_ROWS`` documents per side, picked by a
hash of their text; of one over ``FIT_CHARS`` characters as many of them in a row, from a place picked by that hash. Every whole text is scored.

Defined results: a null or empty text gets its votes (too short) and is scored like any other. If all documents vote alike the scorer's answer is that pattern's
posterior. Repeated rows count as often as they come. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import map_arrow, small_side, stage, texts

GOOD, BAD, NONE = 1, 0, 2
FEATURE_BITS = 16
FIT_ROWS, FIT_CHARS = 1_500, 16_384
STEPS, RATE, RIDGE = 150, 0.05, 1e-5
KEPT_FROM = 0.5
SYMBOLS = re.compile(r"[#*$%&|<>]")
RUNS = re.compile(r"([^\w\s])\1")


_CLASSES: list[np.ndarray] = []


def classes(text: str) -> tuple[int, int, int]:
    """How many characters are upper case, letters, and letters or digits."""
    if not _CLASSES:
        every = list(map(chr, range(0x110000)))
        bits = [np.fromiter(map(test, every), bool, len(every)) for test in (str.isupper, str.isalpha, str.isalnum)]
        _CLASSES.append((bits[0] + 2 * bits[1] + 4 * bits[2]).astype(np.uint8))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.bincount(_CLASSES[0][points], minlength=8)
    return tuple(int(sum(n for k, n in enumerate(found) if k & bit)) for bit in (1, 2, 4))


def votes(text: str) -> list[int]:
    """What each labeller says."""
    words = text.split()
    n, chars = len(words), max(1, sum(map(len, words)))
    lines = [line for line in text.split("\n") if line.strip()]
    upper, letters, alnum = classes(text)
    letters = max(1, letters)
    unique = len(set(words)) / max(1, n)
    odd = sum(1 for w in words if len(w) == 1 and not w.isalnum()) / max(1, n)
    closed = sum(1 for line in lines if line.rstrip()[-1] in ".!?\"'”)") / max(1, len(lines))

    def side(value: float, good: float, bad: float) -> int:
        """Good up to one bound, bad from another."""
        return GOOD if value <= good else BAD if value >= bad else NONE

    signs = chars - alnum
    common = sum(k for _, k in Counter(words).most_common(5)) / max(1, n)
    return [
        side(-n, -3, -2),
        side(len(SYMBOLS.findall(text)) / chars, 0.01, 0.04),
        side(upper / letters, 0.2, 0.5),
        side(1 - len(set(lines)) / max(1, len(lines)), 0.1, 0.4),
        side(-unique, -0.4, -0.25) if n >= 50 else NONE,
        side(-closed, -0.6, -0.1) if n >= 50 else NONE,
        side(text.count("!") / max(1, n), 0.05, 0.3),
        side(odd, 0.02, 0.15),
        side(len(RUNS.findall(text)) / max(1, n), 0.02, 0.2),
        side(signs / chars, 0.1, 0.18),
        side(common, 0.25, 0.4) if n >= 50 else NONE,
    ]


LABELLERS = len(votes(""))


def estimate(patterns: dict[tuple[int, ...], int], rounds: int = 100) -> tuple[float, np.ndarray, dict[tuple[int, ...], float]]:
    """Expectation-maximisation: share of good documents, vote tables ``[class, labeller, vote]`` and a posterior per pattern."""
    keys = sorted(patterns)
    counts = np.array([patterns[k] for k in keys], float)
    votes_ = np.array(keys)
    good, bad = (votes_ == GOOD).sum(1), (votes_ == BAD).sum(1)
    # To begin with, one bad vote is a suspicion and two are a verdict.
    q = np.select([bad >= 2, bad == 1], [0.1, 0.5], np.where(good > 0, 0.97, 0.7))
    onehot = np.eye(3)[votes_]
    onehot[:, :, NONE] = 0  # no vote says nothing
    prior, tables = 0.8, None
    for _ in range(rounds):
        weight = np.stack([(1 - q) * counts, q * counts])
        tables = np.einsum("cp,plv->clv", weight, onehot) + 0.5
        tables /= tables.sum(2, keepdims=True)
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        logs = np.einsum("plv,clv->cp", onehot, np.log(tables)) + np.log([[1 - prior], [prior]])
        logs -= logs.max(0)
        after = np.exp(logs[1]) / np.exp(logs).sum(0)
        if np.abs(after - q).max() < 1e-7:
            break
        q = after
    return prior, tables, dict(zip(keys, q))


def hashed(text: str, voted: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values: shares of byte trigrams (their roots), and the votes."""
    size = 1 << FEATURE_BITS
    data = np.frombuffer(f"  {text} ".encode(), np.uint8).astype(np.uint32)
    grams = ((data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURE_BITS)
    counts = np.bincount(grams, minlength=size) if len(grams) > size // 8 else None
    if counts is None:
        which, times = np.unique(grams, return_counts=True)
    else:
        which = np.flatnonzero(counts)
        times = counts[which]
    marks = np.array([(i * 3 + v + 1) * 0x85EBCA6B % 2**32 >> (32 - FEATURE_BITS) for i, v in enumerate(voted)])
    return np.concatenate([which.astype(np.int64), marks]), np.concatenate([np.sqrt(times / max(1, len(grams))), np.full(len(marks), 0.3)])


def fit(sample: list[tuple[str, float]]) -> np.ndarray:
    """Weights of the linear scorer, the constant last, on soft labels."""
    size = 1 << FEATURE_BITS
    rows = [hashed(t, votes(t)) for t, _ in sample]
    y = np.array([p for _, p in sample])
    which, value = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(owner, w[which] * value, len(rows)) + w[-1]
        miss = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.append(np.bincount(which, value * miss[owner], size), miss.sum()) + RIDGE * w
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def classify(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``quality_score`` (0 to 1), ``weak_label`` (the posterior of its votes) and ``quality_kept``."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    body = names[text]

    def vote(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [int("".join(map(str, votes(t))), 3) for t in texts(batch, body)]
        return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("size"), pa.array(found, pa.int64())], ["key", "size", "pattern"])

    value = F.coalesce(F.col(body), F.lit(""))
    keyed = rows.select(F.xxhash64(value).alias("key"), F.octet_length(value).cast("bigint").alias("size"), body)
    # A few numbers per text.
    voted = stage(map_arrow(keyed, vote, "key bigint, size bigint, pattern bigint"))
    patterns, numbers = {}, {}
    for r in voted.groupBy("pattern").count().collect():  # at most 3 ** LABELLERS rows
        pattern = tuple(map(int, np.base_repr(r["pattern"], 3).zfill(LABELLERS)))
        patterns[pattern], numbers[pattern] = r["count"], r["pattern"]
    if not patterns:
        return docs.withColumns({"quality_score": F.lit(1.0), "weak_label": F.lit(1.0), "quality_kept": F.lit(True)})
    _, _, posterior = estimate(patterns)

    # As many texts from either side of the posterior, by a hash of their key.
    known = docs.sparkSession.createDataFrame([(numbers[k], float(p)) for k, p in posterior.items()], "pattern bigint, p double")
    judged = voted.join(small_side(known), "pattern").select("key", "p").dropDuplicates(["key"])
    sides = [judged.filter(c).orderBy(F.xxhash64("key"), "key").limit(FIT_ROWS) for c in ("p >= 0.5", "p < 0.5")]
    chosen = small_side(sides[0].unionByName(sides[1]))
    begin = F.pmod(F.col("key"), F.greatest(F.length(value) - FIT_CHARS, F.lit(0)) + 1) + 1
    excerpt = F.when(F.length(value) <= FIT_CHARS, value).otherwise(F.substring(value, begin.cast("int"), F.lit(FIT_CHARS)))
    found = keyed.join(chosen, "key").groupBy("key").agg(F.any_value(excerpt).alias("text"), F.any_value("p").alias("p"))
    found = found.orderBy("key").toArrow()
    sample = list(zip(found.column("text").to_pylist(), found.column("p").to_pylist())) or [("", next(iter(posterior.values())))]
    shared = docs.sparkSession.sparkContext.broadcast((fit(sample).astype(np.float32), posterior))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights, known = shared.value
        scores, weak = [], []
        for t in texts(batch, body):
            voted = votes(t)
            which, value = hashed(t, voted)
            z = float(weights[which] @ value + weights[-1])
            scores.append(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))
            weak.append(known.get(tuple(voted), 0.5))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(weak, pa.float64())], [*names.values(), "quality_score", "weak_label"])

    schema = "".join(f"{names[c]} {k}, " for c, k in docs.dtypes) + "quality_score double, weak_label double"
    out = map_arrow(rows, run, schema)
    own = ("quality_score", "weak_label", "quality_kept")
    return out.select(
        *[F.col(n).alias(c) for c, n in names.items() if c not in own], "quality_score", "weak_label", (F.col("quality_score") >= KEPT_FROM).alias("quality_kept")
    )
