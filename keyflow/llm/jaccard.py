"""Exact join of documents by the Jaccard similarity of their word shingles, with set-relation skipping.

1. Every text becomes a set of shingle hashes. Equal sets become one node, however many copies there are, with one row to stand for it.
2. Nodes are indexed by the shingles of their prefix: a node of n shingles can only link with another if they share one of
   its first ``n - ceil(s * n) + 1`` shingles in a common order. The order puts shingles that many documents share last; which
   these are is counted over all documents, chunk by chunk. Any order gives the same links; a good one keeps the lists short.
3. Answer-level skipping. In each index list the most central node is the pivot and is compared with the list's other nodes, which costs one
   comparison per entry. Nodes that link with the same pivot are known to be connected and are never compared with each other.
4. Index-level skipping. What is left in a list, nodes of different pivots, is sorted by set size and cut into blocks of sizes; a node looks
   only into blocks whose sizes can reach the similarity, and there skips entries whose positions leave too few shingles. Distances to a
   common pivot skip no pair: they are only known where a node links with the pivot, and two such distances never differ by more than the threshold.
5. Pairs are compared on a quarter of their sets first, which bounds what the whole can reach, and then exactly. Links become components by label propagation in the cluster.

A shingle is a 64-bit Rabin-Karp hash of its words; two different ones of a pair are taken for equal with a probability of about n * n / 2**64.

Defined results: a null text, or one without words, has an empty set, links with nothing and is its own component. A text with fewer words than a
shingle is one shingle. Repeated rows and equal texts share a component. ``component_id`` is the smallest identifier; null identifiers
only count where a component has no other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import lists, map_arrow, mixed, rolling, small_side, stage, texts, word_hashes

# Shingles counted at once in a worker: 8 MB, and three times that while they are sorted.
CHUNK = 1_000_000
# Shingles found in more documents than this move to the end of the order; at most this many are kept, the most frequent: 2 MB.
FREQUENT = 32
FREQUENT_KEPT = 250_000


def shingles(text: str, width: int) -> np.ndarray:
    """The sorted set of a text's shingle hashes."""
    words = word_hashes(text.encode().lower().split())
    if not len(words):
        return words
    return np.unique(mixed(rolling(words, min(width, len(words))) + np.uint64(min(width, len(words)))))


def signature(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def described(docs: DataFrame, width: int) -> DataFrame:
    """Per document: how many shingles, and the signature of the set (null when empty)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, width) for t in texts(batch)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([signature(s) if len(s) else None for s in sets], pa.binary())],
            ["doc_id", "text_key", "n", "signature"],
        )

    return map_arrow(docs, run, f"doc_id {dict(docs.dtypes)['doc_id']}, text_key bigint, n bigint, signature binary")


def frequent(docs: DataFrame, width: int) -> DataFrame:
    """Shingles that many documents share, with a lower bound of the number.

    Each worker counts chunks of its input and reports what a chunk holds twice or more, so everything is counted and a shingle
    in more documents than there are chunks is always reported.
    """

    def count(batches):
        held, size = [], 0

        def report():
            values, times = np.unique(np.concatenate(held), return_counts=True)
            often = times > 1
            return pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(times[often].astype(np.int64))], ["shingle", "n"])

        for batch in batches:
            for text in texts(batch):
                values = shingles(text, width)
                held.append(values)
                size += len(values)
            if size >= CHUNK:
                yield report()
                held, size = [], 0
        if size:
            yield report()

    counted = docs.select("text").mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") > FREQUENT).orderBy(F.col("n").desc(), "shingle").limit(FREQUENT_KEPT)


def prefixes(docs: DataFrame, width: int, percent: int, late: np.ndarray) -> DataFrame:
    """Per document its signature, size and prefix in the common order. ``late`` holds frequent shingles, the most frequent last."""
    place = np.argsort(late, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((late[place], place))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, rank = shared.value
        kept, names, sizes, out = [], [], [], []
        for i, text in enumerate(texts(batch)):
            values = shingles(text, width)
            n = len(values)
            if not n:
                continue
            kept.append(i)
            take = prefix_size(n, percent)
            if len(known):
                at = np.searchsorted(known, values)
                at[at == len(known)] = 0
                is_late = known[at] == values
                ordered = np.concatenate([values[~is_late], values[is_late][np.argsort(rank[at[is_late]])]])
            else:
                ordered = values
            names.append(signature(values))
            sizes.append(n)
            out.append(ordered[:take].view(np.int64))
        at = pa.array(kept, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()), lists(out, pa.int64())],
            ["doc_id", "text_key", "signature", "n", "prefix"],
        )

    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(docs, run, f"doc_id {kind}, text_key bigint, signature binary, n bigint, prefix array<bigint>")


class Standing:
    """The one row that stands for each set: of the sets found more than once, that of the least identifier (null ones last) and text.

    Rows equal in identifier and text cannot be told apart; where such rows are chosen their text is kept once, in a table of its own.
    """

    def __init__(self, rows: DataFrame, known: DataFrame):
        self.rows = rows
        # Sets found once need nothing; their rows do not come together to be counted.
        counted = known.filter("n > 0").groupBy("signature").agg(F.min("doc_id").alias("first"), F.count("*").alias("_n"))
        self.firsts = counted.select("signature", "first")
        repeated = small_side(counted.filter("_n > 1").select("signature"))
        pairs = known.join(repeated, "signature").groupBy("signature", "doc_id", "text_key").agg(F.count("*").alias("_times"))
        pairs = stage(pairs)
        least = pairs.groupBy("signature").agg(F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "text_key")).alias("_least"))
        chosen = least.select("signature", F.col("_least.doc_id").alias("_id"), F.col("_least.text_key").alias("_key"))
        placed = pairs.join(small_side(chosen), "signature")
        is_chosen = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
        # Rows not chosen, and chosen ones that are not alone.
        out = placed.filter(~is_chosen | (F.col("_times") > 1)).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), is_chosen.alias("many"))
        self.left_out = small_side(out)
        many = small_side(self.left_out.filter("many").select("_id", "_key"))
        self.many = None if many.isEmpty() else stage(
            rows.join(many, self._same(), "left_semi").groupBy("doc_id", "text_key").agg(F.any_value("text").alias("text"))
        )

    @staticmethod
    def _same():
        return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))

    def all(self) -> DataFrame:
        """One row per set, ``doc_id, text, text_key``, and the rows without words."""
        once = self.rows.join(self.left_out, self._same(), "left_anti")
        return once if self.many is None else once.unionByName(self.many)

    def of(self, names: DataFrame) -> DataFrame:
        """The texts of nodes: ``names`` holds ``node, _id, _key``, those of rows that stand for a set."""
        if self.many is None:
            return self.rows.join(names, self._same()).select("node", "text")
        kept_once = small_side(self.many.select(F.col("doc_id").alias("_i"), F.col("text_key").alias("_k")))
        apart = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k"))
        alone = self.rows.join(small_side(names.join(kept_once, apart, "left_anti")), self._same())
        return alone.select("node", "text").unionByName(self.many.join(names, self._same()).select("node", "text"))


def sets_of_nodes(standing: Standing, nodes: DataFrame, wanted: DataFrame, width: int, part: int) -> DataFrame:
    """``node, n, members`` of the wanted nodes: the share ``1 / part`` of the set with the least hashes (1: the whole set)."""
    names = wanted.select("node").distinct().join(nodes.select("node", "doc_id", "text_key"), "node")
    found = standing.of(small_side(names.select("node", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))))
    limit = np.uint64(2**64 // part - 1)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, width) for t in texts(batch)]
        parts = [s[: np.searchsorted(s, limit, side="right")].view(np.int64) for s in sets]
        return pa.RecordBatch.from_arrays([batch.column("node"), pa.array(map(len, sets), pa.int64()), lists(parts, pa.int64())], ["node", "n", "members"])

    return stage(map_arrow(found.select("node", "text"), run, "node bigint, n bigint, members array<bigint>"))


def compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that can reach the similarity, with ``common`` and ``either``: how many shingles are in both and in either set.

    Where ``sets`` holds only a part of each set, what is missing is taken to agree as far as the sizes allow, so no pair
    that links is lost; with whole sets the answer is exact. The parts of ``a`` travel to the pairs' other side; a node with very many pairs is an ordinary skewed join key.
    """
    pairs = stage(pairs.select("a", "b"))
    first = sets.select(F.col("node").alias("a"), "n", F.col("members").alias("first")).join(small_side(pairs), "a")
    second = sets.join(small_side(pairs.select(F.col("b").alias("node")).distinct()), "node", "left_semi")
    second = second.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("members").alias("second"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        common = []
        one, two = batch.column("first"), batch.column("second")
        n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
        for i in range(batch.num_rows):
            x, y = (np.asarray(c[i].values.to_numpy(zero_copy_only=False)) for c in (one, two))
            same = len(np.intersect1d(x, y, assume_unique=True))
            common.append(same + min(n[i] - len(x), m[i] - len(y)))
        common = np.array(common, np.int64)
        fits = pa.array((100 + percent) * common >= percent * (n + m))
        out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common), pa.array(n + m - common)], ["a", "b", "common", "either"])
        return out.filter(fits)

    return stage(map_arrow(first.join(second, "b").select("a", "b", "n", "m", "first", "second"), run, "a bigint, b bigint, common bigint, either bigint"))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that can be reached, for nodes that have links.

    Every round gives a node the smallest label around it and then the label of that label, so paths shrink by halves.
    """
    edges = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stage(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("was")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        after = stage(
            nearer.join(jump, "label", "left").select("node", F.coalesce(F.least("label", "beyond"), "label").alias("label"), "was")
        )
        if after.filter("label <> was").isEmpty():
            return after.select("node", F.col("label").alias("component"))
        labels = after.select("node", "label")


def similar(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``, and the ``text_key`` of its text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key"))
    known = stage(described(rows, width))

    # One row stands for all with the same set; what is equal is joined up at the end, over the sets.
    standing = Standing(rows, known)
    singles = standing.all()
    late = frequent(singles, width).select("shingle").toArrow().column(0).to_numpy().view(np.uint64)[::-1]
    nodes = stage(prefixes(singles, width, percent, late).withColumn("node", F.monotonically_increasing_id()))

    # Index lists: shingles that more than one node has in its prefix.
    # Size and position travel as one number.
    entries = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "shingle"))
    entries = entries.select("shingle", "node", (F.shiftleft(F.col("n"), 31) + F.col("pos")).alias("_np"))
    shared = nodes.select(F.explode("prefix").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("_k")).filter("_k > 1")
    listed = stage(entries.join(shared, "shingle"))
    listed = listed.select("shingle", "node", F.shiftright("_np", 31).alias("n"), (F.col("_np") % (1 << 31)).cast("int").alias("pos"), "_k")
    # The pivot of a list is its most central node: the original of a group of copies shares its whole prefix with many, a
    # changed copy only what it left unchanged.
    central = listed.groupBy("node").agg((F.sum("_k") / (F.max("n") - F.ceil(F.max("n") * percent / 100) + 1)).alias("central"))
    pivot = F.max_by("node", F.struct("central", (-F.col("node")).alias("_first"))).alias("pivot")
    chosen = listed.join(central, "node").groupBy("shingle").agg(pivot)
    index = stage(listed.drop("_k").join(chosen, "shingle"))

    # Every list's nodes against its pivot.
    pivots = nodes.select(F.col("node").alias("pivot"), F.col("n").alias("m"))
    near_size = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    asked = index.filter("node <> pivot").select("node", "pivot", "n").distinct()
    to_pivot = stage(asked.join(pivots, "pivot").filter(near_size).select(F.col("node").alias("a"), F.col("pivot").alias("b")))
    # A quarter of each set rules most pairs out; whole sets are made for the rest.
    some = sets_of_nodes(standing, nodes, index, width, 4)

    def exactly(pairs: DataFrame) -> DataFrame:
        close = compare(pairs, some, percent).select("a", "b")
        both = close.select(F.col("a").alias("node")).unionByName(close.select(F.col("b").alias("node")))
        return compare(close, sets_of_nodes(standing, nodes, both, width, 1), percent)

    met = exactly(to_pivot)
    linked = met.select("a", "b")

    # What is left: nodes of one list that have different homes.
    home = linked.groupBy("a").agg(F.min("b").alias("home")).withColumnRenamed("a", "node")
    base = 101 / percent  # a little over the largest ratio of sizes, so sizes that can link lie in the same or the next block
    left = (
        index.filter("node <> pivot")
        .join(home, "node", "left")
        .withColumn("home", F.coalesce("home", "node"))
    )
    open_ = left.groupBy("shingle").agg(F.min("home").alias("_one"), F.max("home").alias("_other")).filter("_one < _other").select("shingle")
    left = stage(left.join(open_, "shingle").withColumn("block", F.floor(F.log("n") / F.log(F.lit(base)))))
    small = left.select(
        "shingle", F.explode(F.array("block", F.col("block") + 1)).alias("block"), F.col("node").alias("a"), "n", "pos", "home"
    )
    large = left.select(
        "shingle", "block", F.col("node").alias("b"), F.col("n").alias("m"), F.col("pos").alias("at"), F.col("home").alias("house"),
    )
    within = f"""home <> house AND (n < m OR n = m AND a < b) AND 100 * n >= {percent} * m
        AND {100 + percent} * (1 + least(n - pos - 1, m - at - 1)) >= {percent} * (n + m)"""
    rest = small.join(large, ["shingle", "block"]).filter(within).select("a", "b").distinct()
    more = exactly(rest).select("a", "b")
    found = components(nodes, linked.unionByName(more))

    # Back to documents, over the sets.
    sets_of = nodes.select("signature", "node").join(standing.firsts, "signature").join(found, "node", "left")
    sets_of = stage(sets_of.withColumn("component", F.coalesce("component", "node")))
    smallest = sets_of.groupBy("component").agg(F.min("first").alias("component_id"))
    named = sets_of.join(smallest, "component").select("signature", "component", "component_id")
    out = known.join(small_side(named), "signature", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "text_key", "component")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest identifier, null ones last. Rows without words all stay."""
    key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    # The columns of the documents travel as one, so their names cannot clash with those used here.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(doc_id).alias("_own_id"), key.alias("_own_key"))
    judged = stage(similar(docs, width, percent, doc_id, text).select("doc_id", "text_key", "component", "n_shingles"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "text_key")).alias("_k")
    kept = judged.filter("n_shingles > 0").groupBy("component").agg(least)
    # How many rows are equal to the kept one in identifier and text.
    names = kept.select(F.col("_k.doc_id").alias("_id"), F.col("_k.text_key").alias("_key"))
    twins = judged.join(names, judged["doc_id"].eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left_semi")
    twins = twins.groupBy("doc_id", "text_key").agg(F.count("*").alias("_n")).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "_n")
    chosen = rows.join(small_side(twins), F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_key") == F.col("_key")))
    single = chosen.filter("_n = 1")
    double = chosen.filter("_n > 1").dropDuplicates(["_id", "_key"])
    wordless = judged.filter("n_shingles = 0").select("text_key").distinct().select(F.col("text_key").alias("_key"))
    empty = rows.join(small_side(wordless), F.col("_own_key") == F.col("_key"), "left_semi")
    return single.select("_row").unionByName(double.select("_row")).unionByName(empty.select("_row")).select("_row.*")
