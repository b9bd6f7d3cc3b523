"""K-d tree sharding: documents cut along metadata into shards of nearly equal bytes. DataFrame operations only.

The units that are placed are texts, each with the bytes of all its copies, so equal texts stay together. A text that alone would take
more than ``split_share`` of a shard is cut into small equal parts instead, as no cut could balance it otherwise. Every unit is a point: size, language and source
of its text (the least among its copies), each as a number that keeps the order, with bits of the text's digest behind it to
settle ties. Languages and sources are numbered by the rank of the whole name among the distinct ones.
At every level each node is cut along its widest dimension, relative to the dimension's range over all units and without the tie bits, at the
weighted median, or at the share of leaves on its left if their number is odd. The median is found by distributed histograms: every pass over the
units adds up bytes in ``BINS`` bins per node, and the bin that holds the median is refined in the next, until what it holds is negligible.
Only these sums reach the driver: ``BINS`` numbers per node.

Defined results: a null text has no bytes, and every document counts one byte more than its text. Null languages and sources sort first.
Repeated rows are counted as often as they come. Slots are gapless within a shard, in no particular order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import digest, small_side, stage

BINS = 256
TIE_BITS = 24
VALUE_BITS = 38  # value and tie bits stay within 62, so that sums of two never leave 64
# A bin is not refined any more when it holds less than this share of a leaf.
NEGLIGIBLE = 1e-4
# Parts per ``split_share`` of a shard, for a text that is cut.
PARTS = 8
# Copies in such a part, at least.
COPIES = 8
# Documents per block when slots are dealt.
SLOT_BLOCK = 100_000


def ranks(values: DataFrame) -> DataFrame:
    """The distinct ``value``s and their ``rank`` from 0 in the order of their bytes. Sorted by ranges, so that no task holds all of them."""
    ordered = values.distinct().orderBy("value").withColumn("_at", F.monotonically_increasing_id())
    # The number holds the partition above its 33 bits for the row.
    ordered = stage(ordered.select("value", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_row")))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    starts = ordered.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return ordered.join(F.broadcast(starts), "_part").select("value", (F.col("_base") + F.col("_row")).alias("rank"))


def units(docs: DataFrame, text: str, dims: list[Column], leaves: int, split_share: float) -> tuple[DataFrame, DataFrame]:
    """The documents with their unit, and one row per unit: ``unit, part, weight`` and a coordinate per dimension."""
    names = [f"_d{i}" for i in range(len(dims))]
    rows = docs.withColumns({"_unit": digest(text), "_weight": F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1})
    points = rows.select("_unit", "_weight", *[d.alias(n) for n, d in zip(names, dims)])
    for n in [n for n, kind in points.dtypes if kind == "string"]:
        points = points.withColumn(n, F.coalesce(F.col(n), F.lit("")))
        points = points.join(small_side(ranks(points.select(F.col(n).alias("value")))), F.col(n) == F.col("value")).withColumn(n, F.col("rank")).drop("value", "rank")
    grouped = points.groupBy("_unit").agg(F.sum("_weight").alias("weight"), F.count("*").alias("copies"), *[F.min(n).alias(n) for n in names])
    grouped = stage(grouped)
    total = grouped.agg(F.sum("weight")).first()[0] or 0
    limit = max(1, int(total / leaves * split_share))
    # A text that must be cut is cut finely, so that its parts can level the shards, but not finer than its copies can be dealt evenly.
    fine = F.least(F.ceil(F.col("weight") * PARTS / limit), F.ceil(F.col("copies") / COPIES))
    number = F.greatest(F.ceil(F.col("weight") / limit), fine)
    parts = grouped.withColumn("parts", F.when(F.col("weight") > limit, number).otherwise(1).cast("int"))
    tie = F.conv(F.substring(F.hex("_unit"), 1, TIE_BITS // 4), 16, 10).cast("bigint")
    cut = parts.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select(
        "_unit", "parts", "part", (F.col("weight") / F.col("parts")).alias("weight"),
        *[
            (F.shiftleft(F.least(F.coalesce(F.col(n), F.lit(0)), F.lit((1 << VALUE_BITS) - 1)), TIE_BITS)
             + F.pmod(tie + F.col("part") * 7919, F.lit(1 << TIE_BITS))).alias(n)
            for n in names
        ],
    )
    return rows, stage(cut)


def kd_tree(points: DataFrame, dims: list[str], leaves: int) -> DataFrame:
    """``points`` with a ``leaf`` from 0; ``weight`` is what is balanced. Coordinates end in ``TIE_BITS`` tie bits."""
    spark = points.sparkSession
    ranges = points.agg(*[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims], F.sum("weight").alias("total")).first()
    if ranges["total"] is None:
        return points.withColumn("leaf", F.lit(0))
    negligible = ranges["total"] / leaves * NEGLIGIBLE
    # A node is the half-open span of leaves it will become.
    nodes = {(0, leaves)}
    column = F.struct(F.lit(0).alias("from"), F.lit(leaves).alias("to"))
    first, last = F.lit(0), F.lit(leaves)
    placed = points.withColumns({"_from": first, "_to": last})
    while any(b - a > 1 for a, b in nodes):
        inner = placed.filter(F.col("_to") - F.col("_from") > 1)
        boxes = inner.groupBy("_from", "_to").agg(
            *[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims], F.sum("weight").alias("weight")
        ).collect()  # one row per node
        cuts = {}
        for box in boxes:
            def width(ends, d: str) -> int:
                return (ends[f"hi_{d}"] >> TIE_BITS) - (ends[f"lo_{d}"] >> TIE_BITS)

            spread = {d: width(box, d) / max(1, width(ranges, d)) for d in dims}
            widest = max(dims, key=lambda d: spread[d])
            a, b = box["_from"], box["_to"]
            middle = (a + b) // 2
            cuts[a, b] = {"dim": widest, "lo": box[f"lo_{widest}"], "hi": box[f"hi_{widest}"], "want": box["weight"] * (middle - a) / (b - a), "middle": middle, "done": False}
        while not all(c["done"] for c in cuts.values()):
            _refine(inner, cuts, negligible)
        goes_left, to, start = F.lit(None), F.col("_to"), F.col("_from")
        for (a, b), cut in cuts.items():
            here = (F.col("_from") == a) & (F.col("_to") == b)
            left = F.col(cut["dim"]) < cut["at"]
            to = F.when(here & left, cut["middle"]).otherwise(to)
            start = F.when(here & ~left, cut["middle"]).otherwise(start)
        placed = placed.withColumns({"_from": start, "_to": to})
        nodes = {n for a, b in cuts for n in ((a, cuts[a, b]["middle"]), (cuts[a, b]["middle"], b))}
        placed = stage(placed)
    return placed.withColumn("leaf", F.col("_from")).drop("_from", "_to")


def _refine(inner: DataFrame, cuts: dict, negligible: float) -> None:
    """One pass: narrows every open cut to the bin that holds its share, or settles it."""
    found = F.lit(None).cast("bigint")
    for (a, b), cut in cuts.items():
        if cut["done"]:
            continue
        cut["width"] = max(1, -(-(cut["hi"] - cut["lo"] + 1) // BINS))
        value = F.col(cut["dim"])
        here = (F.col("_from") == a) & (F.col("_to") == b) & (value >= cut["lo"]) & (value <= cut["hi"])
        found = F.when(here, F.expr(f"({cut['dim']} - {cut['lo']}) div {cut['width']}")).otherwise(found)
    binned = inner.withColumn("_bin", found).filter("_bin IS NOT NULL").groupBy("_from", "_to", "_bin").agg(F.sum("weight").alias("w"))
    sums: dict = {}
    for r in binned.collect():  # BINS rows per node
        sums.setdefault((r["_from"], r["_to"]), {})[r["_bin"]] = r["w"]
    for node, cut in cuts.items():
        if cut["done"]:
            continue
        want, below, bins = cut["want"], 0.0, sorted(sums.get(node, {}).items())
        for k, w in bins:
            if below + w >= want:
                break
            below += w
        lo = cut["lo"] + int(k) * cut["width"]
        if cut["width"] == 1 or w <= negligible:
            # The bin goes to the side that it overshoots less.
            cut["at"] = lo if want - below < below + w - want else lo + cut["width"]
            cut["done"] = True
        else:
            cut["want"], cut["lo"], cut["hi"] = want - below, lo, min(cut["hi"], lo + cut["width"] - 1)


def slots(df: DataFrame, shard: str = "shard", block: int = SLOT_BLOCK) -> DataFrame:
    """``df`` plus ``slot``, gapless from 0 within a shard: blocks are counted, and rows are numbered within a block."""
    n = df.count()
    blocks = max(1, math.ceil(n / block))
    dealt = stage(df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks))))
    counted = dealt.groupBy(shard, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select(shard, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(shard, "_block").orderBy("_row")
    numbered = dealt.withColumn("_n", F.row_number().over(within)).join(small_side(bases), [shard, "_block"])
    return numbered.withColumn("slot", F.col("_base") + F.col("_n") - 1).drop("_row", "_block", "_base", "_n")


def shard_documents(docs: DataFrame, leaves: int = 8, doc_id: str = "doc_id", text: str = "text", dims: list[Column] | None = None, split_share: float = 0.5) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``. ``dims`` are whole numbers from 0, or strings; by default size, language and source."""
    if dims is None:
        dims = [F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"), F.col("lang").cast("string"), F.col("source").cast("string")]
    names = [f"_d{i}" for i in range(len(dims))]
    rows, points = units(docs, text, dims, leaves, split_share)
    leaf = kd_tree(points, names, leaves).select("_unit", "parts", "part", "leaf")
    slim = rows.select(
        F.col(doc_id).alias("doc_id"), F.col("_weight").alias("size"), "_unit",
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"), F.monotonically_increasing_id().alias("_no"),
    )
    whole = leaf.groupBy("_unit").agg(F.min("parts").alias("parts"), F.map_from_entries(F.collect_list(F.struct("part", "leaf"))).alias("leaves"))
    placed = slim.join(small_side(whole), "_unit").select(
        "doc_id", "size", "text_crc32", F.element_at("leaves", F.pmod("_no", F.col("parts")).cast("int")).cast("int").alias("shard")
    )
    return slots(placed)
