"""Removal of passages that occur more than once: every window of ``width`` words whose word sequence also starts elsewhere.

Windows are named by Rabin-Karp hashes, modulo 2**64, over 64-bit word hashes, and counted in Spark. As a row per window would be
several times the input, windows that cannot repeat are left out first, exactly: each window is represented by the least hash among the
8-word windows inside it. Equal windows have equal representatives, and neighbouring windows mostly share one, so these are few (about 7 % of the
words). A representative that occurs once in the corpus rules out all its windows. Every other window is hashed and counted. Equal texts are
hashed once, with their number of copies. Repeated windows then merge into maximal removal intervals.

Two different windows are taken for equal with a probability of n * n / 2**65 for n counted windows.

Defined results: a null or empty text has no words; a text shorter than the window has no window and keeps all its words. Equal
texts (also repeated rows) of ``width`` words or more lose all their words, as each of their windows starts elsewhere too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import digest, lists, map_arrow, mixed, rolling, small_side, stage, texts, word_hashes

# Words in the short windows that represent long ones.
GRAM = 8


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def representatives(words: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all short windows, and for each long window the least of those inside."""
    grams = mixed(rolling(words, gram))
    return grams, least(grams, width - gram + 1)


def intervals(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal intervals ``[start, end)`` covered by the windows at ``starts`` (ascending)."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > width)
    first = starts[np.concatenate([[0], breaks + 1])]
    last = starts[np.concatenate([breaks, [len(starts) - 1]])] + width
    return list(zip(first.tolist(), last.tolist()))


def repeated_spans(docs: DataFrame, width: int = 35, text: str = "text") -> DataFrame:
    """One row per different text that has something to remove: ``text_digest, spans`` (word intervals, the end excluded)."""
    gram = min(GRAM, width)
    rows = docs.select(digest(text).alias("text_digest"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def represent(batch: pa.RecordBatch) -> pa.RecordBatch:
        single, double, kept = [], [], []
        for i, value in enumerate(texts(batch)):
            words = value.encode().split()
            if len(words) < width:
                continue
            grams, chosen = representatives(word_hashes(words), width, gram)
            distinct, times = np.unique(grams, return_counts=True)
            mine = np.unique(chosen)
            often = times[np.searchsorted(distinct, mine)] > 1
            kept.append(i)
            single.append(mine[~often].view(np.int64))
            double.append(mine[often].view(np.int64))
        names = batch.column("text_digest").take(pa.array(kept, pa.int64()))
        return pa.RecordBatch.from_arrays([names, lists(single, pa.int64()), lists(double, pa.int64())], ["text_digest", "single", "double"])

    chosen = stage(map_arrow(rows, represent, "text_digest binary, single array<bigint>, double array<bigint>"))
    both = F.concat(
        F.transform("single", lambda v: F.struct(v.alias("gram"), F.lit(1).alias("n"))),
        F.transform("double", lambda v: F.struct(v.alias("gram"), F.lit(2).alias("n"))),
    )
    counted = chosen.select(F.explode(both).alias("_g")).groupBy("_g.gram").agg(F.sum("_g.n").alias("n"))
    repeated = counted.filter("n > 1").select("gram")
    hits = (
        chosen.select("text_digest", F.explode(F.concat("single", "double")).alias("gram"))
        .join(repeated, "gram")
        .groupBy("text_digest")
        .agg(F.collect_set("gram").alias("grams"))  # no more than the text has windows
    )
    # Each text that may have a repeated window, once, with its number of copies.
    suspects = stage(
        rows.join(small_side(hits), "text_digest")
        .groupBy("text_digest")
        .agg(F.any_value("text").alias("text"), F.any_value("grams").alias("grams"), F.count("*").alias("copies"))
        .withColumn("text_no", F.monotonically_increasing_id())
    )

    def windows(batch: pa.RecordBatch) -> pa.RecordBatch:
        single, double = [], []
        grams = batch.column("grams")
        for i, value in enumerate(texts(batch)):
            words = word_hashes(value.encode().split())
            _, chosen = representatives(words, width, gram)
            wanted = np.asarray(grams[i].values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
            hashes, times = np.unique(rolling(words, width)[np.isin(chosen, wanted)], return_counts=True)
            single.append(hashes[times == 1].view(np.int64))
            double.append(hashes[times > 1].view(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column("text_no"), batch.column("copies"), lists(single, pa.int64()), lists(double, pa.int64())],
            ["text_no", "copies", "single", "double"],
        )

    hashed = stage(map_arrow(suspects.select("text_no", "copies", "text", "grams"), windows, "text_no bigint, copies bigint, single array<bigint>, double array<bigint>"))
    # Windows that the text itself repeats need no partner; they count twice for others.
    alone = F.when(F.col("copies") > 1, F.lit(2)).otherwise(F.lit(1))
    weighed = F.concat(
        F.transform("single", lambda v: F.struct(v.alias("window"), alone.alias("n"))),
        F.transform("double", lambda v: F.struct(v.alias("window"), F.lit(2).alias("n"))),
    )
    twice = hashed.select(F.explode(weighed).alias("_w")).groupBy("_w.window").agg(F.sum("_w.n").alias("n")).filter("n > 1").select("window")
    found = (
        hashed.filter("copies = 1").select("text_no", F.explode("single").alias("window"))
        .join(twice, "window")
        .groupBy("text_no")
        .agg(F.collect_set("window").alias("found"))
    )
    own = hashed.select("text_no", "double")
    judged = suspects.join(own, "text_no").join(found, "text_no", "left")

    def merge(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, spans = [], []
        doubles, founds, copies = batch.column("double"), batch.column("found"), batch.column("copies").to_pylist()
        for i, value in enumerate(texts(batch)):
            words = value.encode().split()
            if copies[i] > 1:
                merged = [(0, len(words))]
            else:
                marked = [np.asarray(c[i].values.to_numpy(zero_copy_only=False), np.int64) for c in (doubles, founds) if c[i].is_valid]
                hashes = rolling(word_hashes(words), width)
                merged = intervals(np.flatnonzero(np.isin(hashes, np.concatenate(marked).view(np.uint64))), width)
            if merged:
                names.append(i)
                spans.append([{"start": a, "end": b} for a, b in merged])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column("text_digest").take(pa.array(names, pa.int64())), pa.array(spans, kind)], ["text_digest", "spans"])

    merged = map_arrow(judged.select("text_digest", "text", "copies", "double", "found"), merge, "text_digest binary, spans array<struct<start: bigint, end: bigint>>")
    return stage(merged)


def remove_repeated(docs: DataFrame, width: int = 35, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced by its kept words, joined by one space, plus ``n_words`` and ``n_removed``.

    Texts from which nothing goes are left as they are in ``text``; ``kept`` always holds the joined words.
    Columns of ``docs`` with one of the three new names are replaced.
    """
    spans = repeated_spans(docs, width, text)
    kinds = dict(docs.dtypes)
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c != text}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col(text).alias("text"), digest(text).alias("text_digest"))
    joined = rows.join(small_side(spans), "text_digest", "left").select(*names.values(), "text", "spans")

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans, n_words, n_removed, kept, changed = batch.column("spans").to_pylist(), [], [], [], []
        originals = batch.column("text").to_pylist()
        for value, cuts in zip(originals, spans):
            words = (value or "").encode().split()
            left, at = [], 0
            for cut in cuts or ():
                left += words[at : cut["start"]]
                at = cut["end"]
            left += words[at:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
            changed.append(kept[-1] if cuts else value)
        return pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names.values()], pa.array(changed, pa.string()), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
            [*names.values(), "_text", "kept", "n_words", "n_removed"],
        )

    schema = "".join(f"{n} {kinds[c]}, " for c, n in names.items()) + "_text string, kept string, n_words bigint, n_removed bigint"
    out = map_arrow(joined, apply, schema)
    own = ("kept", "n_words", "n_removed")
    back = [F.col("_text").alias(c) if c == text else F.col(names[c]).alias(c) for c in docs.columns if c == text or c not in own]
    return out.select(*back, F.col("kept").alias("kept"), "n_words", "n_removed")
