"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Bulk-synchronous best fit. Sizes are whole numbers up to the capacity, so documents and gaps, sorted by size, are runs of equal
size, and a round can move whole runs: it takes the longest documents not yet placed, sweeps from their size upwards over the
runs of gaps, and gives each run's gaps, smallest first, to as many of the documents. Conflicts are settled by rank: the
r-th document of a size gets the r-th free gap of the sweep. What finds no gap opens new sequences, all gaps are updated, and
the next round takes the next size. The runs are a table of at most ``capacity`` sizes, taken from a distributed count, so rounds cost
no pass over the documents. The documents themselves are ranked within their size in two distributed steps (blocks, then rows in a block; a size that holds most rows is
spread over all blocks) and meet the moves of the rounds in one join.

Defined results: a null or empty text is one piece holding only the end mark. Longer documents than the capacity are cut into full
pieces and a rest. Repeated rows are packed as often as they come. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import os
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import crc32, map_arrow, small_side, stage, texts

# What a worker remembers of words: this many bytes, an entry counted with its place in the table.
REMEMBERED_BYTES = 40 << 20
REMEMBERED_CHARS = 64
ENTRY_BYTES = 200
# Documents of one size are ranked in this many blocks.
RANK_BLOCKS = 1 << 10

# Outside it lie characters whose lower case or composition depends on neighbours; such texts are encoded whole.
ODD = re.compile("[^\x00-\x1b\x20-\u012f\u0131-\u024f]")
TAIL = ".,;:!?"


class WordEncoder:
    """Ids of whole texts, word by word.

    The vocabulary drops white space and never joins what it separates, so a text's ids are its words' ids in a row. A word's closing
    punctuation is a token of its own after a letter, so word and punctuation are remembered apart. Each worker remembers a bounded
    number of bytes of them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.room = REMEMBERED_BYTES
        # The byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for 256, 257, ...
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.alphabet = "".join(chr(b if b in visible else 256 + hidden.index(b)) for b in range(256))

    def word(self, word: str) -> bytes:
        """A word of lower-case letters only is one token of the first split: its merges suffice."""
        symbols = word.encode().decode("latin-1").translate(self.alphabet)
        return np.asarray([t.id for t in self.library.model.tokenize(symbols)], "<u4").tobytes()

    def whole(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: set[str]) -> dict[str, bytes]:
        parts = {}
        for word in words:
            stem = word.rstrip(TAIL)
            parts[word] = (stem, word[len(stem) :]) if stem and stem[-1].isalpha() else (word, "")
        known = self.known
        fresh = [p for p in {p for pair in parts.values() for p in pair} if p and p not in known]
        found = {"": b""} | {p: self.word(p) for p in fresh if p.isalpha()}
        fresh = [p for p in fresh if p not in found]
        for part, coded in zip(fresh, self.library.encode_batch(fresh, add_special_tokens=False) if fresh else []):
            found[part] = np.asarray(coded.ids, "<u4").tobytes()
        out = {}
        for word, (stem, tail) in parts.items():
            out[word] = (known.get(stem) or found.get(stem, b"")) + (known.get(tail) or found.get(tail, b""))
        for source in (found, out):
            for w, ids in source.items():
                if self.room <= 0:
                    return out
                if ids and len(w) <= REMEMBERED_CHARS and w not in known:
                    known[w] = ids
                    self.room -= ENTRY_BYTES + len(w) + len(ids)
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if ODD.search(text):
            return self.whole(text)
        words, known = text.lower().split(), self.known
        missing = {w for w in words if w not in known}
        fresh = self.learn(missing) if missing else {}
        return b"".join([known.get(w) or fresh[w] for w in words])


_LOADED: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0, text: str = "text", doc_id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, the ``ids``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        code, rows, pieces, starts, sizes, sums, ids = encoder(tokenizer), [], [], [], [], [], []
        for i, value in enumerate(texts(batch)):
            data = code.encode(value) + end
            for k, at in enumerate(range(0, len(data), 4 * capacity)):
                part = data[at : at + 4 * capacity]
                rows.append(i)
                pieces.append(k)
                starts.append(at // 4)
                sizes.append(len(part) // 4)
                sums.append(crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, "<u4").astype(np.int64))
        columns = [
            batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
            pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
        ]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.int64())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    return map_arrow(rows, run, schema)


def moves(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """The rounds of best fit on runs of equal size.

    ``counts`` says how many documents there are of each size. A move ``(size, first, n, sequence, at, rows)`` puts the documents
    ``first .. first + n - 1`` of a size into sequences from ``sequence`` on, ``rows`` of them behind each other from ``at`` in
    each. As the smallest gap that fits stays the smallest while it still fits, that is what single best-fit steps would do.
    """
    out = []
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap size -> runs (first sequence, how many)
    gaps: list[int] = []  # sizes that have runs, ascending
    sequences = 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if not runs[gap]:
                bisect.insort(gaps, gap)
            runs[gap].append((first, n))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            k = bisect.bisect_left(gaps, size)
            if k == len(gaps):
                opened = -(-left // (capacity // size))
                leave(capacity, sequences, opened)
                sequences += opened
                continue
            gap = gaps[k]
            first, have = runs[gap].pop()
            if not runs[gap]:
                gaps.pop(k)
            rows = gap // size
            n = min(left, have * rows)
            full, part = divmod(n, rows)
            out.append((size, rank, n, first, capacity - gap, rows))
            leave(gap - rows * size, first, full)
            if part:
                leave(gap - part * size, first + full, 1)
                full += 1
            leave(gap, first + full, have - full)
            rank, left = rank + n, left - n
    return out


def pack(pieces: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """``pieces`` (each at most ``capacity`` long) plus ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    # The blocks are dealt by arrival, not by content, so equal rows and equal sizes spread; staging fixes them.
    row = F.monotonically_increasing_id()
    dealt = stage(pieces.withColumns({"_row": row, "_block": F.pmod(row + F.spark_partition_id() * 7919, F.lit(RANK_BLOCKS))}))
    counted = stage(dealt.groupBy(F.col(length).alias("_size"), "_block").agg(F.count("*").alias("_n")))
    before = Window.partitionBy("_size").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_size", "_block", "_base")
    # At most ``capacity`` rows.
    counts = {r["_size"]: r["n"] for r in counted.groupBy("_size").agg(F.sum("_n").alias("n")).collect()}
    if counts and (min(counts) < 1 or max(counts) > capacity):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    plan = moves(counts, capacity)
    schema = "_size bigint, _first bigint, _count bigint, _sequence bigint, _at bigint, _rows int"
    moved = small_side(spark.createDataFrame(plan, schema))
    within = Window.partitionBy("_size", "_block").orderBy("_row")
    ranked = (
        dealt.withColumn("_size", F.col(length).cast("bigint"))
        .withColumn("_rank", F.row_number().over(within) - 1)
        .join(small_side(bases), ["_size", "_block"])
        .withColumn("_rank", F.col("_rank") + F.col("_base"))
    )
    fits = (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_first") + F.col("_count"))
    placed = ranked.join(moved.withColumnRenamed("_size", "_moved"), (F.col("_size") == F.col("_moved")) & fits)
    place = F.col("_rank") - F.col("_first")
    return placed.select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(place / F.col("_rows"))).cast("bigint").alias("sequence_id"),
        (F.col("_at") + place % F.col("_rows") * F.col("_size")).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, **options) -> DataFrame:
    """Tokenise, cut and pack: one row per piece."""
    return pack(cut(docs, tokenizer, capacity, **options), capacity)
