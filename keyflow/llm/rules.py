"""Quality rules with risk-controlled thresholds. DataFrame operations only.

Four rules each compare a ratio of a text with a cutoff: symbols per word character, repeated lines, words in repeated windows, and
characters per word. The cutoff of a rule in a stratum is chosen from a fixed grid on labelled documents, whose identifiers' crc32 deals
them into two halves:

* The holdout decides which cutoffs are safe. Going from the most lenient to the strictest, a cutoff is certified while the exact
  binomial test rejects "it turns down more than ``risk / rules`` of the good documents" at level ``error / (rules * groups)``, and the first
  failure ends the row (fixed-sequence testing within a rule and group, Bonferroni across them). A group is a stratum with enough good holdout
  documents to certify a cutoff that turns none of them down; all strata with fewer share one group. Only these numbers settle the groups, not what cutoffs
  turn down. So with probability 1 - ``error`` all certified cutoffs together turn down at most ``risk`` of the good documents of every group.
* The other half picks, among the certified cutoffs, the one that turns down most bad documents, less ``regret`` for each good one.

A rule without a certified or useful cutoff in a group turns nothing down there; nor does any rule in a stratum without good holdout documents. Only counts per stratum, rule and cutoff reach the driver.

Defined results: a null or empty text has no words and fails the base rule. Without labels, or labels of one kind, no rule
is switched on. Strata may be as many as they like. Repeated rows are judged and counted as often as they come.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import crc_bucket, small_side, stage

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# The grid: shares in steps of a hundredth; mean word lengths in steps of a tenth of a character beyond four.
SHARES = [round(0.01 * i, 2) for i in range(1, 100)]
LENGTHS = [round(4 + 0.1 * i, 1) for i in range(0, 200)]
RULES = {"symbols": SHARES, "dup_lines": SHARES, "repeats": SHARES, "word_length": LENGTHS}


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, plus the counts. Hashes of words are 64 bits wide."""
    value = F.coalesce(F.col(text), F.lit(""))
    others = [c for c in docs.columns if c != text]
    split = docs.select(
        *others,
        F.array_remove(F.split(value, r"[\x20\x09-\x0D]+"), "").alias("_words"),
        F.filter(F.split(value, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0).alias("_lines"),
        F.length(F.translate(value, SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length(value) - F.length(F.translate(value, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    kept = [*others, "word_chars", "n_symbols"]
    hashed = split.select(
        *kept,
        F.size("_words").cast("bigint").alias("n_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    kept += ["n_words", "n_lines", "n_dup_lines"]
    # Each step is a projection of its own, and refers to the array more than once, so that it is computed once per row.
    windows = hashed.select(
        *kept,
        F.when(
            F.size("_h") >= 3,
            F.transform(F.slice("_h", 1, F.size("_h") - 2), lambda a, i: F.xxhash64(a, F.get("_h", i + 1), F.get("_h", i + 2))),
        ).otherwise(F.array().cast("array<bigint>")).alias("_t"),
    )
    ordered = windows.select(
        *kept,
        F.when(
            F.size(F.array_distinct("_t")) < F.size("_t"),
            F.sort_array(F.transform("_t", lambda t, i: F.struct(t.alias("t"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<t: bigint, i: int>>")).alias("_p"),
    )
    # Windows found twice or more, by position.
    marked = ordered.select(
        *kept,
        F.sort_array(
            F.transform(
                F.filter("_p", lambda x, j: ((j > 0) & (F.get("_p", j - 1)["t"] == x["t"])) | F.coalesce(F.get("_p", j + 1)["t"] == x["t"], F.lit(False))),
                lambda x: x["i"],
            )
        ).alias("_m"),
    )
    covered = F.zip_with("_m", F.slice("_m", 2, F.greatest(F.size("_m"), F.lit(1))), lambda a, b: F.when(a.isNull(), 0).otherwise(F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))))
    return marked.select(*kept, F.aggregate(covered, F.lit(0).cast("bigint"), lambda s, x: s + x).alias("n_repeat_words"))


def ratios() -> dict[str, Column]:
    return {
        "symbols": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
        "word_length": F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
    }


def at_most(k: int, n: int, p: float) -> float:
    """The exact probability of at most ``k`` successes in ``n`` trials."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def certified(false: list[int], good: int, risk: float, level: float) -> list[int]:
    """Positions of the certified cutoffs; ``false[i]`` good holdout documents lie beyond cutoff ``i``, ascending."""
    out = []
    for i in reversed(range(len(false))):  # the highest cutoff is the most lenient
        if false[i] > risk * good or at_most(false[i], good, risk) > level:
            break
        out.append(i)
    return out


def groups(good: dict[str | None, int], risk: float, error: float) -> list[list[str | None]]:
    """Strata that share their cutoffs, by their numbers of good holdout documents: as many as can be certified alone, and the rest together.

    None stands for strata counted as one beforehand, which are never alone.
    """
    order = sorted((s for s, n in good.items() if n and s is not None), key=lambda s: (-good[s], s))
    pooled = [None] if good.get(None) else []
    for alone in range(len(order), 0, -1):
        rest = order[alone:] + pooled
        out = [[s] for s in order[:alone]] + [rest] * bool(rest)
        if at_most(0, good[order[alone - 1]], risk / len(RULES)) <= error / (len(RULES) * len(out)):
            return out
    return [order + pooled] if order or pooled else []


def enough(risk: float, error: float) -> int:
    """With fewer good holdout documents a stratum cannot be certified alone, even if it is the only group."""
    n = 1
    while at_most(0, n, risk / len(RULES)) > error / len(RULES):
        n += 1
    return n


def thresholds(judged: DataFrame, labels: DataFrame, doc_id: str, quality: str, risk: float, error: float, regret: float) -> DataFrame | None:
    """One row per stratum with its cutoffs (equal ones within a group, null where a rule is off), from features with ``_stratum`` and ``base_failed``."""
    marks = labels.select(F.col(doc_id).alias("_id"), F.col(quality).alias("_good")).filter("_id IS NOT NULL AND _good IS NOT NULL")
    marks = marks.groupBy("_id").agg(F.max("_good").alias("_good"))
    known = judged.filter(~F.col("base_failed")).join(small_side(marks), F.col(doc_id) == F.col("_id"))
    # How many cutoffs a document's ratio lies beyond.
    def cutoffs_below(x: Column, grid: list[float]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(c) for c in grid]), lambda c: x > c))

    known = stage(known.select(
        "_stratum", (crc_bucket("_id", 2) == 0).alias("holdout"), (F.col("_good") == 1).alias("good"),
        *[cutoffs_below(x, RULES[r]).alias(r) for r, x in ratios().items()],
    ))
    # However many strata there are, those too small to stand alone are one before anything reaches the driver.
    held = known.groupBy("_stratum").agg(F.count_if(F.col("holdout") & F.col("good")).alias("_held")).filter("_held > 0")
    strata = stage(held.withColumn("_group", F.when(F.col("_held") >= enough(risk, error), F.col("_stratum"))))
    stacked = known.join(small_side(strata.drop("_held")), "_stratum").select(
        "_group", "holdout", "good", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("beyond")) for r in RULES])).alias("_x"),
    )
    # At most one stratum for every ``enough`` labelled documents, and the pooled one.
    counts = stacked.groupBy("_group", "holdout", "good", "_x.rule", "_x.beyond").agg(F.count("*").alias("n")).collect()
    table: dict[tuple, dict[int, int]] = {}
    for r in counts:
        table.setdefault((r["_group"], r["rule"], r["holdout"], r["good"]), {})[r["beyond"]] = r["n"]
    # Every rule has seen the same documents.
    good = {s: sum(table.get((s, "symbols", True, True), {}).values()) for s in {k[0] for k in table}}
    shared = groups(good, risk, error)
    out = {s: dict.fromkeys(RULES) for part in shared for s in part}
    for part in shared:
        for rule, grid in RULES.items():
            def past(holdout: bool, good: bool) -> list[int]:
                n = [x for s in part for x in table.get((s, rule, holdout, good), {}).items()]
                return [sum(v for k, v in n if k > i) for i in range(len(grid))]

            safe = certified(past(True, True), sum(good[s] for s in part), risk / len(RULES), error / (len(RULES) * len(shared)))
            gain = [b - regret * g for b, g in zip(past(False, False), past(False, True))]
            best = max(safe, key=lambda i: (gain[i], i), default=None)
            if best is not None and gain[best] > 0:
                for s in part:
                    out[s][rule] = grid[best]
    if not out:
        return None
    schema = "_of string, " + ", ".join(f"_cut_{r} double" for r in RULES)
    cutoffs = judged.sparkSession.createDataFrame([(s, *cuts.values()) for s, cuts in out.items()], schema)
    return strata.join(F.broadcast(cutoffs), F.col("_group").eqNullSafe(F.col("_of"))).select("_stratum", *[f"_cut_{r}" for r in RULES])


def judge(
    docs: DataFrame, labels: DataFrame, risk: float = 0.04, error: float = 0.05, regret: float = 5.0, stratum: Column | None = None,
    doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``stratum``, ``failed_rules`` and ``kept``. ``quality`` 1 marks good documents."""
    by = F.coalesce((F.col("lang") if stratum is None else stratum).cast("string"), F.lit("und"))
    counted = features(docs.select(F.col(doc_id).alias(doc_id), by.alias("_stratum"), F.col(text).alias("_text")), "_text")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = stage(counted.withColumn("base_failed", base))
    cutoffs = thresholds(judged, labels, doc_id, quality, risk, error, regret)
    names = F.array().cast("array<string>")
    if cutoffs is not None:
        judged = judged.join(small_side(cutoffs), "_stratum", "left")
        names = F.array_compact(F.array(*[F.when(ratio > F.col(f"_cut_{rule}"), F.lit(rule)) for rule, ratio in ratios().items()]))
    out = judged.withColumn("failed_rules", names)
    return out.select(
        doc_id, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), F.col("_stratum").alias("stratum"), "failed_rules",
    )
