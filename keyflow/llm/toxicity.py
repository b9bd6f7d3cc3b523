"""Toxicity by compression distance.

Two zstandard dictionaries: the ordinary one is trained on windows of ordinary documents; the toxic one holds the same content and behind it the segments that
distinguish toxic documents. Both compress every window of a text. A window that the toxic dictionary
compresses shorter holds such segments; as the two dictionaries share their content, nearly all other windows come out equal. A document's differences (the largest, the mean of
the largest four, the share beyond a few bytes) go into a logistic calibration, fitted on labelled documents that were
not used for the dictionaries. Trained on frequency alone, as the library does by itself, the toxic dictionary mostly holds what is
frequent in any text (area under the curve 0.73 against 0.98), hence the choice by contrast. How strong the contrast must be is also settled by the calibration.

Fitting uses a bounded sample of labelled rows: at most ``SAMPLE`` documents per label, each of at most ``FIT_BYTES`` bytes, picked by a hash of their identifier, without near copies.
The calibration, whose features depend on the length, also sees up to ``LONG_SAMPLE`` longer documents per label; of one over ``LONG_CHARS`` characters it sees as
many of them in a row, from a place picked by hash.
Scoring covers every window of every text.

Defined results: a null or empty text is one empty window, without a difference. Without labels of both kinds nothing is toxic: the score is 0.
Repeated label rows count once, toxic if any of them says so. Repeated documents are scored alike.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import BASE, crc_bucket, map_arrow, mixed, rolling, small_side, stage, texts, word_hashes

WINDOW, STRIDE = 64, 48
LEVEL = 3
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 8_192
SAMPLE = {1: 1_500, 0: 2_500}
FIT_BYTES = 16_384
LONG_SAMPLE, LONG_CHARS = 40, 1 << 18
# A word or stem distinguishes toxic documents from this signed root of the G statistic on; the best of these is taken.
CONTRASTS = (3.5, 5.0, 7.0)
LONGEST_WORD = 40
# Beginnings of words count like words, as stems come with many endings.
STEMS = (5, 6)
FEW_BYTES = 4


def windows(text: str) -> list[bytes]:
    data = text.lower().encode()
    return [data[i : i + WINDOW] for i in range(0, max(1, len(data) - (WINDOW - STRIDE)), STRIDE)]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)


def lengths(which: zstandard.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
    compress = which.compress
    return np.fromiter((len(compress(p)) for p in parts), np.int32, len(parts))


def describe(difference: np.ndarray) -> np.ndarray:
    """A document's features out of its windows' differences."""
    n = len(difference)
    top = np.sort(np.partition(difference, n - 4)[n - 4 :] if n > 4 else difference)[::-1].astype(float)
    share = np.count_nonzero(difference >= FEW_BYTES) / n
    return np.array([top[0], top[:4].mean(), share, np.log(n)])


def features(both: tuple, text: str) -> np.ndarray:
    parts = windows(text)
    return describe(lengths(both[0], parts) - lengths(both[1], parts))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton steps on standardised features: (mean, scale, weights with the constant first)."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(a.shape[1])
    penalty = np.full(len(w), ridge)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag(penalty), a.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def probability(model: tuple, x: np.ndarray) -> np.ndarray:
    mean, scale, w = model
    return 1 / (1 + np.exp(-np.clip(w[0] + (x - mean) / scale @ w[1:], -30, 30)))


def distinguishing(toxic: list[str], ordinary: list[str], contrast: float) -> list[bytes]:
    """Words and stems that toxic documents hold significantly more often, the strongest last."""

    def holding(many: list[str]) -> Counter:
        found: Counter = Counter()
        for text in many:
            words = {w for w in text.lower().encode().split() if 4 <= len(w) <= LONGEST_WORD}
            found.update(words | {w[:n] for w in words for n in STEMS})
        return found

    t, o = holding(toxic), holding(ordinary)
    n, m = max(1, len(toxic)), max(1, len(ordinary))
    scored = []
    for word, k in t.items():
        j = o[word]
        expected = (k + j) * n / (n + m)
        if k > expected:
            rest = k + j - expected
            g = 2 * (k * np.log(k / expected) + (j * np.log(j / rest) if j else 0))
            if g > contrast * contrast and k / n > 8 * (j + 1) / m:
                scored.append((g, word))
    return [w for _, w in sorted(scored)]


def fit(toxic: list[str], ordinary: list[str], long_toxic: list[str] = (), long_ordinary: list[str] = ()) -> dict | None:
    """Dictionaries and calibration. The long documents count for the calibration only.

    The calibration sees toxic documents through dictionaries made of the other half of the sample, as they hold words of their own
    that the final ones know, and ordinary documents through the final dictionaries, with whatever these match by chance.
    """
    if len(toxic) < 4 or len(ordinary) < 4:
        return None
    samples = [w for t in ordinary[::2] for w in windows(t)]
    try:
        content = zstandard.train_dictionary(ORDINARY_BYTES, samples, k=24, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        content = b"".join(samples)[:ORDINARY_BYTES]
    plain = compressor(content)

    def measured(many: list[str]) -> list[tuple[list[bytes], np.ndarray]]:
        return [(p, lengths(plain, p)) for p in map(windows, many)]

    def seen(measures: list, sharp: zstandard.ZstdCompressor) -> list[np.ndarray]:
        return [describe(before - lengths(sharp, parts)) for parts, before in measures]

    halves, rest = [measured(toxic[i::2]) for i in (0, 1)], measured([*ordinary, *long_ordinary, *long_toxic])
    y = np.array([1.0] * len(toxic) + [0.0] * (len(ordinary) + len(long_ordinary)) + [1.0] * len(long_toxic))
    best = None
    for contrast in CONTRASTS:
        final = content + segments(toxic, ordinary, contrast)
        x = []
        for i in (0, 1):
            x += seen(halves[i], compressor(content + segments(toxic[1 - i :: 2], ordinary[1 - i :: 2], contrast)))
        x = np.stack(x + seen(rest, compressor(final)))
        model = logistic(x, y)
        p = np.clip(probability(model, x), 1e-6, 1 - 1e-6)
        loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
        if best is None or loss < best["loss"]:
            best = {"ordinary": content, "toxic": final, "calibration": model, "loss": loss, "contrast": contrast}
    return best


def segments(toxic: list[str], ordinary: list[str], contrast: float) -> bytes:
    return b"".join(b" " + w for w in distinguishing(toxic, ordinary, contrast))[-TOXIC_BYTES:]


def without_copies(many: list[str]) -> list[str]:
    """The sample without near copies (a shared least hash of their three-word windows), which would make chance words look telling."""
    seen: set[int] = set()
    out = []
    for text in many:
        values = rolling(word_hashes(text.lower().encode().split()), 3)
        marks = {int(mixed(values ^ np.uint64(i * BASE & (2**64 - 1))).min()) for i in range(1, 5)} if len(values) else set()
        if not marks & seen:
            out.append(text)
        seen |= marks
    return out


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, allowed) -> tuple[dict[int, list[str]], dict[int, list[str]]]:
    """A bounded number of labelled texts per label, and of long ones."""
    marked = labels.select(F.col(doc_id).alias("_id"), F.col(label).alias("_label")).filter("_id IS NOT NULL AND _label IS NOT NULL")
    marked = marked.filter(allowed("_id")).groupBy("_id").agg(F.max("_label").alias("_label"))
    out: dict[int, list[str]] = {}
    long: dict[int, list[str]] = {}
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    short, beyond = rows.filter(F.octet_length("_text") <= FIT_BYTES), rows.filter(F.octet_length("_text") > FIT_BYTES)
    begin = F.pmod(F.xxhash64("_id"), F.greatest(F.length("_text") - LONG_CHARS, F.lit(0)) + 1) + 1
    excerpt = F.when(F.length("_text") <= LONG_CHARS, F.col("_text")).otherwise(F.substring("_text", begin.cast("int"), F.lit(LONG_CHARS)))
    # Labelled long documents by name only, as few numbers each.
    named = stage(beyond.select("_id").join(small_side(marked), "_id").distinct())
    for kind, most in SAMPLE.items():
        # Bounded: ``most`` identifiers, and ``LONG_SAMPLE`` identifiers.
        for source, known, limit, body, held in ((short, marked, most, F.col("_text"), out), (beyond, named, LONG_SAMPLE, excerpt, long)):
            chosen = F.broadcast(known.filter(F.col("_label") == kind).orderBy(F.xxhash64("_id"), "_id").limit(limit).select("_id"))
            found = source.join(chosen, "_id").select("_id", body.alias("_text")).orderBy(F.xxhash64("_id"), "_text").limit(limit)
            held[kind] = without_copies(found.select("_text").toArrow().column(0).to_pylist())
    return out, long


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", allowed=None) -> DataFrame:
    """``docs`` plus ``toxicity`` (0 to 1). ``allowed`` says, by the identifier, which rows labels may be learnt from."""
    allowed = allowed or (lambda c: crc_bucket(c, 3) != 1)
    learnt, long = sample(docs, labels, doc_id, text, label, allowed)
    model = fit(learnt[1], learnt[0], long[1], long[0])
    if model is None:
        return docs.withColumn("toxicity", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = shared.value
        both = compressor(held["ordinary"]), compressor(held["toxic"])
        x = np.stack([features(both, t) for t in texts(batch, names[text])])
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(probability(held["calibration"], x))], [*names.values(), "toxicity"])

    schema = "".join(f"{names[c]} {k}, " for c, k in docs.dtypes) + "toxicity double"
    out = map_arrow(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), run, schema)
    return out.select(*[F.col(n).alias(c) for c, n in names.items() if c != "toxicity"], "toxicity")
