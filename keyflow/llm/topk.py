"""Exact top-k search by integer inner product, with vector-approximation files.

1. Components become ``floor(1024 * x)``. Of equal vectors only k rows of each identifier, and of these the first 2k by identifier, are
   searched: a query's own identifier holds at most k of them, so the k others that come first are always among them.
2. Every vector is quantised, one byte per dimension, on a grid between the smallest and largest value of the dimension: the approximation file.
3. Queries come in blocks of bounded size. A block is sent to the tasks that scan the approximations; the cells give a lower and an upper
   bound of every score. A task keeps what can still be among a query's best k by the lower bounds it has seen.
4. The k-th best lower bound over all tasks discards most of the rest. Exact vectors are read in the order of the upper bounds: first the best
   2k, then, if any, those whose upper bound reaches the k-th exact score found. With that the result is certain.

Defined results: vectors that are null or hold null or non-finite components take no part. Vectors of different length are never compared.
Repeated rows count as often as they come, except that a query never meets rows with its own identifier. Rows without an identifier
are candidates, behind all others of their score. Scores outside 64 bits are held at the nearest 64-bit number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import map_arrow, stage

SCALE = 1024
CELLS = 256
# Queries sent to the tasks at once: 16 MB with 64 dimensions.
QUERY_BLOCK = 1 << 15
# Candidates a task holds back before it prunes them.
HELD = 1 << 21


def prepared(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """Usable rows: ``row_no, vec_id, dim, v`` with whole-number components."""
    v = F.col(vector)
    usable = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(usable).select(
        F.monotonically_increasing_id().alias("row_no"), F.col(vec_id).alias("vec_id"), F.size(v).alias("dim"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"),
    )
    return stage(rows)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def by_dim(batch: pa.RecordBatch):
    """Parts of a batch with vectors of one length."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        yield int(dim), batch.filter(pa.array(dims == dim))


def grid(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length, the smallest value and the cell width of each dimension."""

    def ends(batches):
        for batch in batches:
            for dim, part in by_dim(batch):
                v = matrix(part.column("v"), dim)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array(v.min(0), pa.int64()), pa.array(v.max(0), pa.int64())],
                    ["dim", "pos", "lo", "hi"],
                )

    found = rows.select("dim", "v").mapInArrow(ends, "dim int, pos int, lo bigint, hi bigint")
    out: dict[int, list] = {}
    # As many rows as there are dimensions.
    for r in found.groupBy("dim", "pos").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("dim", "pos").collect():
        out.setdefault(r["dim"], []).append((r["lo"], -(-(r["hi"] - r["lo"] + 1) // CELLS)))
    return {d: (np.array([x[0] for x in v], np.int64), np.array([x[1] for x in v], np.int64)) for d, v in out.items()} | {0: (np.zeros(0, np.int64),) * 2}


def quantised(rows: DataFrame, marks: dict) -> DataFrame:
    """The approximation file: a byte per dimension."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cells = [None] * batch.num_rows
        dims = batch.column("dim").to_numpy()
        for dim, part in by_dim(batch):
            lo, width = marks[dim]
            codes = ((matrix(part.column("v"), dim) - lo) // np.maximum(width, 1)).astype(np.uint8)
            for i, row in zip(np.flatnonzero(dims == dim), codes):
                cells[i] = row.tobytes()
        return pa.RecordBatch.from_arrays([batch.column("row_no"), batch.column("vec_id"), batch.column("dim"), pa.array(cells, pa.binary())], ["row_no", "vec_id", "dim", "cells"])

    return stage(map_arrow(rows, run, "row_no bigint, vec_id bigint, dim int, cells binary"))


def scan(approximations: DataFrame, queries: dict, marks: dict, k: int) -> DataFrame:
    """Per query of the block, the rows that can be among its best k: ``query_no, row_no, low, high``."""
    shared = approximations.sparkSession.sparkContext.broadcast((queries, marks))

    def run(batches):
        blocks, grids = shared.value
        best = {d: np.full((len(q[0]), k), -np.inf) for d, q in blocks.items()}
        held, n_held = [], 0

        def pruned():
            parts = []
            for dim, (which, row, low, high) in held:
                keep = high >= best[dim][which, 0]
                parts.append((dim, (which[keep], row[keep], low[keep], high[keep])))
            return parts

        def out(parts):
            for dim, (which, row, low, high) in parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks[dim][0][which]), pa.array(row), pa.array(low), pa.array(high)], ["query_no", "row_no", "low", "high"]
                )

        for batch in batches:
            for dim, part in by_dim(batch):
                if dim not in blocks:
                    continue
                _, ids, plus, minus = blocks[dim]
                lo, width = grids[dim]
                codes = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(part.num_rows, dim)
                least = (lo + codes * width).astype(np.float64)
                most = least + np.maximum(width - 1, 0)
                low, high = plus @ least.T + minus @ most.T, plus @ most.T + minus @ least.T
                # Whole numbers up to 2**53 are exact; beyond, the bounds are widened by more than the rounding.
                size = (plus - minus) @ np.maximum(np.abs(least), np.abs(most)).T
                slack = np.where(size < 2.0**52, 0.0, size * 1e-12)
                low, high = low - slack, high + slack
                own = part.column("vec_id").to_pandas().to_numpy(np.float64, na_value=np.nan) if part.column("vec_id").null_count else part.column("vec_id").to_numpy()
                mine = ids[:, None] == own[None, :]
                low[mine], high[mine] = -np.inf, -np.inf
                top = np.concatenate([best[dim], low], axis=1)
                best[dim] = np.sort(np.partition(top, top.shape[1] - k, axis=1)[:, -k:], axis=1)
                which, row = np.nonzero((high >= best[dim][:, :1]) & ~mine)
                held.append((dim, (which, part.column("row_no").to_numpy()[row], low[which, row], high[which, row])))
                n_held += len(which)
            if n_held > HELD:
                held = pruned()
                n_held = sum(len(p[1][0]) for p in held)
                if n_held > HELD // 2:
                    yield from out(held)
                    held, n_held = [], 0
        yield from out(pruned())

    return approximations.mapInArrow(run, "query_no bigint, row_no bigint, low double, high double")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("decimal(19,0)") * y.cast("decimal(19,0)"))
    total = F.aggregate(products, F.lit(0).cast("decimal(38,0)"), lambda s, p: (s + p).cast("decimal(38,0)"))
    ends = [F.lit(v).cast("decimal(38,0)") for v in (-(2**63), 2**63 - 1)]
    return F.least(F.greatest(total, ends[0]), ends[1]).cast("bigint")


def search(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every query's best ``k`` rows; ``is_query`` is a condition on ``vec_id``."""
    rows = prepared(vectors, vec_id, vector, scale)
    repeats = Window.partitionBy("v", "vec_id").orderBy("row_no")
    same = Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last(), "row_no")
    few = rows.withColumn("_n", F.row_number().over(repeats)).filter(F.col("_n") <= k).drop("_n")
    candidates = stage(few.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= 2 * k).drop("_n"))
    asked = stage(rows.filter(is_query.alias("q")).withColumn("block", F.monotonically_increasing_id()))
    marks = grid(candidates)
    approximations = quantised(candidates, marks)
    exact, questions = candidates.select("row_no", "vec_id", "v"), asked.select(F.col("row_no").alias("query_no"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))

    blocks = -(-asked.count() // QUERY_BLOCK)
    results = []
    for number in range(blocks):
        block: dict[int, tuple] = {}
        # At most about QUERY_BLOCK rows.
        part = asked.filter(F.pmod("block", F.lit(blocks)) == number).select("row_no", "vec_id", "dim", "v").toArrow()
        for batch in part.combine_chunks().to_batches():
            for dim, one in by_dim(batch):
                q = matrix(one.column("v"), dim).astype(np.float64)
                new = (one.column("row_no").to_numpy(), one.column("vec_id").to_numpy(), np.maximum(q, 0), np.minimum(q, 0))
                block[dim] = tuple(np.concatenate(x) for x in zip(block[dim], new)) if dim in block else new
        results.append(_certain(scan(approximations, block, marks, k), exact, questions, k))
    if not results:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _certain(found: DataFrame, exact: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    found = stage(found)

    def ranked(df: DataFrame, *order: Column) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy("query_no").orderBy(*order)))

    def scored(df: DataFrame) -> DataFrame:
        joined = df.join(exact, "row_no").join(questions, "query_no")
        return joined.select("query_no", "query_id", "vec_id", "row_no", dot(F.col("v"), F.col("q")).alias("score"))

    floor = ranked(found, F.col("low").desc()).filter(F.col("rank") == k).select("query_no", F.col("low").alias("floor"))
    left = found.join(floor, "query_no", "left").filter("floor IS NULL OR high >= floor")
    left = stage(ranked(left, F.col("high").desc(), "row_no").select("query_no", "row_no", "high", "rank"))
    first = stage(scored(left.filter(F.col("rank") <= 2 * k)))
    bar = ranked(first, F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row_no").filter(F.col("rank") == k).select("query_no", F.col("score").alias("bar"))
    second = scored(left.filter(F.col("rank") > 2 * k).join(bar, "query_no", "left").filter("bar IS NULL OR high >= bar").select("query_no", "row_no"))
    best = ranked(first.unionByName(second), F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row_no").filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
