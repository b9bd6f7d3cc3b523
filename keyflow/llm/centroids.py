"""Centroid clustering with exact whole-number arithmetic over dictionary-encoded vectors.

1. Components become ``floor(scale * x)``. The dimensions are cut into blocks of equal width; the distinct subvectors of each block are its
   dictionary, and a vector is kept as one code per block. Nothing is lost: the dictionary holds the exact subvectors.
2. A round computes the squared distance of every dictionary entry to that part of every centroid once. The distance of a vector is the sum of
   the entries its codes point to. A task also counts its codes per cluster, so the sums of the components of a cluster are these counts
   times the dictionary; only they leave the task.
3. Every non-empty centroid becomes the exact floor of its mean.

The blocks are the widest ones whose dictionaries together keep within ``max_entries``, by a count over all vectors, so what is sent to the
executors is bounded. If even single dimensions have more distinct values than that, every task makes dictionaries of its own for each batch
of vectors; the answers are the same.

Defined results: vectors that are null, of another length than ``dim``, or hold null or non-finite components take no part. Ties go to the
smaller centroid number. Repeated rows count as often as they come; rows without an identifier take part but come last when the first centroids
are chosen (equal hashes: by components). With fewer vectors than ``k`` there are fewer centroids. An empty table gives no rows. Components
are held within 64 bits, distances too, and sums of distances beyond 64 bits are held at the largest 64-bit number.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import stage

WIDTHS = (8, 4, 2, 1)
# Codes are 16-bit numbers, and with 40 centroids the distances of all entries take 20 MB.
MAX_ENTRIES = 1 << 16
# Vectors looked at before the widths are tried.
LOOK_AT = 1 << 13
# Below it the distances of whole vectors fit 64 bits whatever their sign.
EXACT = 1 << 26
MOST = (1 << 63) - 1
# Vectors a task handles at once.
CHUNK = 4096


@dataclass
class Dictionary:
    """Distinct subvectors of each block: one matrix (entries x width) per block, sorted."""

    width: int
    blocks: list[np.ndarray]


def prepared(vectors: DataFrame, vec_id: str, vector: str, scale: int, dim: int) -> DataFrame:
    """Usable rows: ``vec_id, v``."""
    v = F.col(vector)
    usable = v.isNotNull() & (F.size(v) == dim) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return stage(vectors.filter(usable).select(F.col(vec_id).alias("vec_id"), whole.alias("v")))


def seeds(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors with the smallest hashes of their identifiers."""
    key = F.sha2(F.concat(F.lit(salt + ":"), F.col("vec_id").cast("string")), 256)
    first = rows.select(key.alias("_key"), "v").orderBy(F.asc_nulls_last("_key"), "v").limit(k)
    return np.array([r["v"] for r in first.collect()], np.int64)  # k rows


def plausible(rows: DataFrame, dim: int, max_entries: int) -> list[int]:
    """Widths whose dictionaries are not already too large for a few of the vectors; whether they are for all is counted afterwards."""
    some = np.array([r["v"] for r in rows.select("v").limit(LOOK_AT).collect()], np.int64)
    widths = [w for w in WIDTHS if dim % w == 0]
    return [w for w in widths if sum(len(np.unique(some[:, b : b + w], axis=0)) for b in range(0, dim, w)) <= max_entries]


def dictionary(rows: DataFrame, dim: int, max_entries: int) -> Dictionary | None:
    """The dictionaries of the widest blocks that keep within ``max_entries``, or None."""
    for width in plausible(rows, dim, max_entries):
        blocks = F.array(*[F.struct(F.lit(b // width).alias("block"), F.slice("v", b + 1, width).alias("part")) for b in range(0, dim, width)])
        # Equal parts fall together before the shuffle. One more than allowed is enough to know.
        found = rows.select(F.inline(blocks)).distinct().limit(max_entries + 1).collect()
        if len(found) <= max_entries:
            parts: dict[int, list] = {}
            for r in found:
                parts.setdefault(r["block"], []).append(r["part"])
            return Dictionary(width, [np.array(sorted(parts[b]), np.int64) for b in range(dim // width)])
    return None


def as_keys(parts: np.ndarray) -> np.ndarray:
    """Subvectors as single values that sort like the rows of numbers, for searching."""
    flipped = (parts.astype(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")
    return np.ascontiguousarray(flipped).view(f"S{8 * parts.shape[1]}").ravel() if parts.shape[1] > 1 else parts.ravel()


def encode(v: np.ndarray, words: Dictionary) -> np.ndarray:
    """Vectors as codes, one per block."""
    out = np.empty((len(v), len(words.blocks)), np.uint16)
    for b, entries in enumerate(words.blocks):
        out[:, b] = np.searchsorted(as_keys(entries), as_keys(v[:, b * words.width : (b + 1) * words.width]))
    return out


def partial_distances(words: Dictionary, centroids: np.ndarray) -> list[np.ndarray]:
    """Per block, the squared distance of every entry to every centroid (entries x centroids)."""
    out = []
    for b, entries in enumerate(words.blocks):
        part = centroids[:, b * words.width : (b + 1) * words.width]
        large = max(np.abs(entries.astype(float)).max(initial=0), np.abs(part.astype(float)).max(initial=0)) >= EXACT
        e, c = (entries.astype(object), part.astype(object)) if large else (entries, part)
        out.append(((e[:, None, :] - c[None, :, :]) ** 2).sum(-1))
    return out


def nearest(codes: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and distance of every encoded vector: the partial distances summed up by code."""
    total = tables[0][codes[:, 0]]
    for b in range(1, len(tables)):
        total = total + tables[b][codes[:, b]]
    cluster = np.argmin(total, axis=1)
    return cluster, total[np.arange(len(total)), cluster]


def component_sums(codes: np.ndarray, cluster: np.ndarray, words: Dictionary, k: int) -> np.ndarray:
    """Sums of the components per cluster (k x dim), from counts of codes, as Python numbers."""
    out = []
    for b, entries in enumerate(words.blocks):
        counts = np.bincount(cluster * len(entries) + codes[:, b], minlength=k * len(entries)).reshape(k, len(entries))
        out.append(counts.astype(object) @ entries.astype(object) if np.abs(entries.astype(float)).max(initial=0) >= EXACT else (counts @ entries).astype(object))
    return np.concatenate(out, axis=1)


def chunks(batches, name: str, width: int):
    """Arrow batches put together: ``batch, matrix`` with about CHUNK rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= CHUNK:
            yield joined(held, name, width)
            held, n = [], 0
    if n:
        yield joined(held, name, width)


def joined(batches: list, name: str, width: int):
    table = pa.Table.from_batches(batches).combine_chunks()
    values = [b.column(name) for b in batches]
    if pa.types.is_binary(values[0].type):
        flat = np.frombuffer(b"".join(x for c in values for x in c.to_pylist()), "<u2")
    else:
        flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in values])
    return table, flat.reshape(-1, width)


class Encoded:
    """The vectors as a staged table, and how a task gets codes and dictionaries of a chunk out of it."""

    def __init__(self, rows: DataFrame, dim: int, max_entries: int):
        self.dim, self.words = dim, dictionary(rows, dim, max_entries)
        self.spark = rows.sparkSession
        if self.words is None:
            self.table, self.column, self.width = rows, "v", dim
            return
        shared, kind = self.spark.sparkContext.broadcast(self.words), dict(rows.dtypes)["vec_id"]
        self.column, self.width = "codes", dim // self.words.width

        def run(batches):
            for table, v in chunks(batches, "v", dim):
                rows_of = encode(v, shared.value).astype("<u2")
                yield from pa.Table.from_arrays([table["vec_id"], pa.array([r.tobytes() for r in rows_of], pa.binary())], ["vec_id", "codes"]).to_batches()

        self.table = stage(rows.mapInArrow(run, f"vec_id {kind}, codes binary"))

    def reader(self, centroids: np.ndarray):
        """A function for tasks: batches to ``table, codes, dictionary, partial distances``."""
        # One table of distances for all, at most ``max_entries`` x k numbers, or none and the tasks make their own.
        tables = None if self.words is None else partial_distances(self.words, centroids)
        shared = self.spark.sparkContext.broadcast((self.words, tables, centroids))
        column, width = self.column, self.width

        def read(batches):
            words, tables, centroids = shared.value
            for table, values in chunks(batches, column, width):
                if words is not None:
                    yield table, values, words, tables
                    continue
                own = [np.unique(values[:, d], return_inverse=True) for d in range(width)]
                local = Dictionary(1, [u[:, None] for u, _ in own])
                yield table, np.stack([c for _, c in own], axis=1), local, partial_distances(local, centroids)

        return read


def moved(encoded: Encoded, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    read, k, dim = encoded.reader(centroids), len(centroids), encoded.dim

    def run(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), object)
        for _, codes, words, tables in read(batches):
            cluster, _ = nearest(codes, tables)
            counts += np.bincount(cluster, minlength=k)
            sums += component_sums(codes, cluster, words, k)
        used = np.flatnonzero(counts)
        for c in used:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([counts[c]] * dim, pa.int64()), pa.array([str(x) for x in sums[c]])],
                ["cluster", "pos", "n", "total"],
            )

    parts = encoded.table.mapInArrow(run, "cluster int, pos int, n bigint, total string")
    summed = parts.groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = centroids.copy()
    for r in summed.collect():  # k x dim rows
        out[r["cluster"], r["pos"]] = int(r["total"]) // r["n"]
    return out


def assigned(encoded: Encoded, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    read, kind = encoded.reader(centroids), dict(encoded.table.dtypes)["vec_id"]

    def run(batches):
        for table, codes, _, tables in read(batches):
            cluster, distance = nearest(codes, tables)
            held = np.minimum(distance, MOST).astype(np.int64)
            yield from pa.Table.from_arrays([table["vec_id"], pa.array(cluster, pa.int32()), pa.array(held, pa.int64())], ["vec_id", "cluster", "distance"]).to_batches()

    return encoded.table.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, dim: int = 64, salt: str = "2",
    vec_id: str = "vec_id", vector: str = "embedding", max_entries: int = MAX_ENTRIES,
) -> tuple[DataFrame, np.ndarray]:
    """The assignment after ``rounds`` rounds (``vec_id, cluster, distance``), staged, and the centroids it was made with."""
    rows = prepared(vectors, vec_id, vector, scale, dim)
    centroids = seeds(rows, k, salt)
    kind = dict(rows.dtypes)["vec_id"]
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint"), centroids
    encoded = Encoded(rows, dim, min(max_entries, MAX_ENTRIES))
    for _ in range(rounds):
        after = moved(encoded, centroids)
        if np.array_equal(after, centroids):  # nothing can change any more
            break
        centroids = after
    return stage(assigned(encoded, centroids)), centroids


def report(assignment: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The assignment plus ``cluster_inertia, inertia, centroid_sha256``."""
    spark = assignment.sparkSession
    digests = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    # At most one row per centroid.
    sums = assignment.groupBy("cluster").agg(total.alias("_sum"))
    found = {r["cluster"]: int(r["_sum"]) for r in sums.collect()}
    everything = sum(found.values())
    rows = [(i, min(found.get(i, 0), MOST), min(everything, MOST), d) for i, d in digests]
    side = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assignment.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
