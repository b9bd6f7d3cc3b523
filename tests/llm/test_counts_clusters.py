"""Token counts next to the library; centroid clustering next to plain rounds over whole numbers."""

import hashlib
import math
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from keyflow.llm import centroids, token_counts

BYTE_BPE, WORD_BPE, PIECE_BPE = (public_tokenizers.path(n) for n in ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
PARTS = ["a", "b1", " ", "  ", "\n", "'s", "'", "é", "\xa0", "\x1c", "<|endoftext|>", "1", "12", "don't", "😀", "the", " and", " of", "\t", "\r\n", ".", "</s>"]


def plain(path):
    if path.endswith(".json"):
        library = Tokenizer.from_file(path)
        return lambda text: len(library.encode(text, add_special_tokens=False).ids)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda text: len(library.encode(text))


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE, PIECE_BPE])
def test_pieces_add_up(path):
    rng, counter, count = random.Random(1), token_counts.Counter(path), plain(path)
    values = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(60))) for _ in range(1500)] + ["", "x" * 3000, "ab " * 2000]
    assert counter.totals(values, 5, 40) == [count(v) for v in values]


def test_long_texts_are_cut():
    counter = token_counts.Counter(BYTE_BPE)
    assert max(map(len, counter.pieces("word and 2nd " * 5000, 100))) < 120
    assert "".join(counter.pieces("word and 2nd " * 50, 100)) == "word and 2nd " * 50


@pytest.mark.parametrize("spread", [4 << 20, 600])
def test_every_row_is_counted(spark, docs, corpus, nothing, spread):
    count = plain(BYTE_BPE)
    want = sorted(((r[0], len((r[1] or "").encode()), count(r[1] or "")) for r in corpus), key=repr)
    got = token_counts.count_tokens(docs, BYTE_BPE, piece_chars=200, spread_bytes=spread)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert token_counts.count_tokens(nothing, BYTE_BPE).count() == 0


def rounds(vectors, k, n, scale, dim, salt):
    rows = []
    for vec_id, v in vectors:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            rows.append((vec_id, tuple(max(min(math.floor(x * scale), 2**63 - 1), -(2**63)) for x in v)))
    keyed = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in keyed[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres))

    for _ in range(n):
        members = {}
        for _, v in rows:
            members.setdefault(nearest(v)[1], []).append(v)
        centres = [tuple(sum(col) // len(col) for col in zip(*members[i])) if i in members else c for i, c in enumerate(centres)]
    placed = [(vec_id, *reversed(nearest(v))) for vec_id, v in rows]
    within = {}
    for _, c, d in placed:
        within[c] = within.get(c, 0) + d
    most = 2**63 - 1
    return sorted(
        ((i, c, min(d, most), min(within[c], most), min(sum(within.values()), most), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for i, c, d in placed),
        key=repr,
    )


def vectors(kind):
    rng = random.Random(kind)
    values = {"few": lambda: rng.choice([-0.25, 0.0, 0.5]), "many": lambda: rng.gauss(0, 1), "huge": lambda: rng.choice([1e30, -1e30, 3e5, 1.0, -7e10])}[kind]
    rows = [(i, [values() for _ in range(8)]) for i in range(120)]
    rows += [(3, rows[3][1])] * 5 + [(None, rows[9][1]), (500, None), (501, [1.0] * 7), (502, [None] + [1.0] * 7), (503, [math.nan] * 8), (504, [math.inf] * 8), (505, [])]
    return rows + [(600 + i, rows[7][1]) for i in range(40)]


@pytest.mark.parametrize("kind,entries", [("few", 1 << 16), ("few", 24), ("many", 1 << 16), ("many", 300), ("many", 5), ("huge", 1 << 16), ("huge", 3)])
def test_clusters_are_those_of_plain_rounds(spark, kind, entries):
    rows = vectors(kind)
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, v int").repartition(3)
    got = centroids.report(*centroids.cluster(df, 12, 5, 256, 8, "2", max_entries=entries))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == rounds(rows, 12, 5, 256, 8, "2")


def test_widths_follow_the_dictionaries(spark):
    rows = spark.createDataFrame([(i, [i % 2] * 8) for i in range(50)], "vec_id bigint, v array<bigint>")
    assert centroids.dictionary(rows, 8, 100).width == 8
    varied = spark.createDataFrame([(i, [(i >> d) % 2 for d in range(8)]) for i in range(256)], "vec_id bigint, v array<bigint>")
    assert [getattr(centroids.dictionary(varied, 8, n), "width", None) for n in (256, 32, 16, 15)] == [8, 4, 2, None]


def test_few_or_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    empty = spark.createDataFrame([], schema)
    assert centroids.report(*centroids.cluster(empty, dim=2)).count() == 0
    few = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.25, 1.0])], schema)
    assert {r["distance"] for r in centroids.report(*centroids.cluster(few, dim=2)).collect()} == {0}
