"""Operators with exact answers, next to brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from keyflow.llm import jaccard, packing, pieces, rules, sharding, substring, topk

WORD_BPE, PIECE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_words_are_encoded_like_whole_texts(corpus):
    code = packing.WordEncoder(WORD_BPE)
    rng = random.Random(1)
    odd = ["".join(rng.choice("aB .,'s!é\n<|İ\xa0ß5;-Σ\x1ć") for _ in range(rng.randrange(40))) for _ in range(500)]
    odd += ["<|endoftext|>.", "a<|startoftext|>b", "x...y..", "don't. it's, '"]
    for text in odd + [r[1] or "" for r in corpus]:
        assert code.encode(text) == code.whole(text)


def test_moves_are_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(100):
        capacity = rng.choice([10, 50, 2048])
        counts = {rng.randrange(1, capacity + 1): rng.randrange(1, 40) for _ in range(rng.randrange(1, 40))}
        sequences, seen = defaultdict(list), set()
        for size, first, n, sequence, at, rows in packing.moves(counts, capacity):
            for p in range(n):
                assert (size, first + p) not in seen
                seen.add((size, first + p))
                sequences[sequence + p // rows].append((at + p % rows * size, size))
        assert len(seen) == sum(counts.values())
        for parts in sequences.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            assert at <= capacity
        bins = []
        for size in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
            fitting = [b for b in bins if b >= size]
            if fitting:
                bins.remove(min(fitting))
            bins.append((min(fitting) if fitting else capacity) - size)
        assert len(bins) == len(sequences)


def test_packing(docs, nothing, corpus):
    out = packing.pack_documents(docs, WORD_BPE, 256).collect()
    code, want = packing.WordEncoder(WORD_BPE), Counter()
    for r in corpus:
        data = code.whole(r[1] or "") + b"\0\0\0\0"
        for k in range(0, len(data), 1024):
            want[r[0], k // 1024, k // 4, len(data[k : k + 1024]) // 4, zlib.crc32(data[k : k + 1024])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 256
    assert len(sequences) <= 1.05 * sum(r.length for r in out) / 256 + 1
    assert packing.pack_documents(nothing, WORD_BPE, 256).collect() == []


def removed(rows, width):
    words = [(r[1] or "").encode().split() for r in rows]
    counts = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for r, w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if counts[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((r[0], len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [3, 8, 35])
def test_substring(docs, corpus, width):
    out = substring.remove_repeated(docs, width)
    assert out.columns == [*docs.columns, "kept", "n_words", "n_removed"]
    got = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in out.collect()], key=repr)
    assert got == removed(corpus, width)


def test_substring_of_nothing(nothing):
    assert substring.remove_repeated(nothing, 35).collect() == []


def test_intervals_are_maximal():
    assert substring.intervals(np.array([0, 1, 5, 9, 30]), 4) == [(0, 13), (30, 34)]
    assert substring.intervals(np.array([], int), 4) == []


def linked(rows, width, percent):
    sets = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                label[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    names = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), names[root(i)]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_jaccard(docs, corpus, percent):
    out = jaccard.similar(docs, 5, percent).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in out], key=repr) == linked(corpus, 5, percent)


def test_jaccard_with_shared_shingles_at_the_end_of_the_order(docs, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 1)
    out = jaccard.similar(docs, 2, 60).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in out], key=repr) == linked(corpus, 2, 60)


def test_one_of_each_group_stays(docs, corpus, nothing):
    out = jaccard.keep_one(docs, 5, 80)
    assert out.columns == docs.columns
    groups = {c for _, n, c in linked(corpus, 5, 80) if n}
    wordless = sum(1 for _, n, _ in linked(corpus, 5, 80) if not n)
    got = out.collect()
    assert len(got) == len(groups) + wordless
    assert jaccard.similar(nothing).collect() == [] and jaccard.keep_one(nothing).collect() == []


def vectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, rows[100][1]) for i in range(30)]  # equal vectors: ties
    rows += [(300, None), (301, [float("nan")] * 6), (302, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (303, [float("inf")] * 6), (400, [1.0, 2.0]), (401, [3.0, 4.0])]
    rows += [(100, rows[7][1]), (500, []), (501, []), (None, rows[3][1]), (600, [1e30] * 6)]
    return rows, spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "vec_id bigint, embedding array<double>, v string, dim int")


@pytest.mark.parametrize("k", [1, 10, 400])
def test_topk(spark, k):
    rows, df = vectors(spark)
    usable = [(a, [int(np.floor(1024 * x)) for x in v]) for a, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    # Components beyond 64 bits are held at the nearest number.
    usable = [(a, [min(2**63 - 1, x) for x in v]) for a, v in usable]
    want = []
    for a, q in usable:
        if a is None or a % 100:
            continue
        scored = [(-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(q, v)))), b is None, b or 0) for b, v in usable if len(v) == len(q) and b != a]
        want += [(a, i + 1, None if none else b, -s) for i, (s, none, b) in enumerate(sorted(scored)[:k])]
    got = [tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0, k).select("query_id", "rank", "vec_id", "score").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert topk.search(df.limit(0), F.col("vec_id") % 100 == 0, k).collect() == []


@pytest.mark.parametrize("repeats", [2, 11, 30])
def test_topk_of_a_repeated_query_row(spark, repeats):
    vector = [0.5, -0.25, 0.75]
    rows = [(100, vector)] * repeats + [(200 + i, vector) for i in range(30)] + [(None, vector)] * 15 + [(300 + i, [0.1, 0.1, 0.1]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    score = sum(int(np.floor(1024 * x)) ** 2 for x in vector)
    got = [tuple(r) for r in topk.search(df, F.col("vec_id") == 100, 10).select("query_id", "rank", "vec_id", "score").collect()]
    assert sorted(got) == sorted([(100, i + 1, 200 + i, score) for i in range(10)] * repeats)


def test_sharding(docs, nothing, corpus):
    out = sharding.shard_documents(docs.filter("length(text) < 4000 or text is null"), 4).collect()
    size, slots = Counter(), defaultdict(list)
    for r in out:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total = sum(size.values())
    assert total == sum(len((r[1] or "").encode()) + 1 for r in corpus if r[1] is None or len(r[1]) < 4000)
    assert set(size) == {0, 1, 2, 3} and max(size.values()) - min(size.values()) < 0.25 * total / 4
    assert sharding.shard_documents(nothing, 4).collect() == []


def test_a_text_that_holds_most_bytes_is_split(spark):
    df = spark.createDataFrame([(i, "same text here", "en", "s") for i in range(1800)] + [(5000 + i, f"other {i}", "de", "t") for i in range(600)], "doc_id int, text string, lang string, source string")
    size = Counter()
    for r in sharding.shard_documents(df, 4).collect():
        size[r.shard] += r.size
    assert max(size.values()) - min(size.values()) <= 0.2 * sum(size.values()) / 4


def test_shards_follow_whole_source_names(spark):
    rows = [(i, f"text {i:04}", "en", f"http://site/{i % 8}") for i in range(400)]
    where = defaultdict(Counter)
    source = {r[0]: r[3] for r in rows}
    for r in sharding.shard_documents(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string"), 4).collect():
        where[r.shard][source[r.doc_id]] += 1
    # Two sources to a shard, in the order of their names.
    names = [sorted(c) for c in where.values()]
    assert sorted(names) == [[f"http://site/{i}", f"http://site/{i + 1}"] for i in range(0, 8, 2)]


def test_names_are_ranked_whole(spark):
    values = [f"src{i}" for i in range(300)] + ["", "é", "src1"]
    df = spark.createDataFrame([(v,) for v in values], "value string").repartition(5)
    assert {r["value"]: r["rank"] for r in sharding.ranks(df).collect()} == {v: i for i, v in enumerate(sorted(set(values), key=str.encode))}


def test_pieces(docs, nothing, corpus):
    agenda = pieces.load(PIECE_BPE)
    rng = random.Random(4)
    odd = ["".join(rng.choice("ab ▁é日<s>0\n") for _ in range(rng.randrange(60))) for _ in range(500)] + [" " * 70, "x" * 300, "<0x0A>"]
    for text in odd:
        assert agenda.encode(text) == agenda.library.encode(text)
        for chunk in agenda.chunks(text):
            assert agenda.scanned(chunk) == agenda.queued(chunk)
    got = pieces.encode_decode(docs, PIECE_BPE).collect()
    want = []
    for r in corpus:
        ids = agenda.library.encode(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), agenda.library.decode(ids) if ids else "", 0, ids))
    assert sorted([tuple(r) for r in got], key=repr) == sorted(want, key=repr)
    assert pieces.encode_decode(nothing, PIECE_BPE).collect() == []


def counted(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows, cover, seen, dup = Counter(zip(words, words[1:], words[2:])), set(), set(), 0
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            cover |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_rule_features(docs, corpus):
    out = rules.features(docs.select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted([tuple(r) for r in out.collect()], key=repr) == sorted([(r[0], *counted(r[1])) for r in corpus], key=repr)


def test_binomial_bound():
    assert rules.at_most(0, 100, 0.03) == pytest.approx(0.97**100)
    assert rules.at_most(5, 5, 0.5) == 1.0
    assert rules.at_most(2, 10, 0.5) == pytest.approx((1 + 10 + 45) / 1024)
    # Ten cutoffs; the two strictest turn down too many of 2,000 good documents.
    assert rules.certified([400, 30, 5, 4, 3, 2, 1, 0, 0, 0], 2000, 0.01, 0.01) == [9, 8, 7, 6, 5, 4, 3, 2]
    assert rules.certified([0], 50, 0.01, 0.01) == []


def test_rules_keep_good_documents(spark, docs, nothing):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(3000):
        body = [rng.choice(words) for _ in range(60)]
        bad = i % 5 == 0
        rows.append((i, " ".join(w + "##" if bad else w for w in body), "en"))
        labels += [(i, 0 if bad else 1, "x")] * (1 + i % 2)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame([*labels, (None, 1, "x"), (1, None, "x")], "doc_id bigint, quality int, lang string")
    got = {r.doc_id: r.kept for r in rules.judge(frame, marks).collect()}
    assert not any(got[i] for i in range(0, 3000, 5)) and sum(got[i] for i in range(3000) if i % 5) > 0.97 * 2400
    assert all(not r.failed_rules for r in rules.judge(docs, marks.limit(0)).collect())
    assert rules.judge(nothing, marks).collect() == []


def test_strata_that_cannot_be_certified_alone_share_their_cutoffs():
    assert rules.groups({"en": 1064, "de": 270, "fr": 248, "es": 156, "it": 0}, 0.04, 0.05) == [["en"], ["de", "fr", "es"]]
    assert rules.groups({"a": 5000, "b": 4000}, 0.04, 0.05) == [["a"], ["b"]]
    assert rules.groups({"a": 300, "b": 300}, 0.04, 0.05) == [["a", "b"]] and rules.groups({}, 0.04, 0.05) == []


def test_rules_reach_strata_with_few_labels(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(4200):
        lang = ["en", "en", "en", "de", "fr", "es", "it"][i % 7]
        bad = i % 5 == 0
        rows.append((i, " ".join(rng.choice(words) + "##" * bad for _ in range(60)), lang))
        if lang != "it":
            labels.append((i, 0 if bad else 1))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = rules.judge(frame, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    rejected = Counter(r.stratum for r in out if not r.kept)
    assert rejected == {"en": 360, "de": 120, "fr": 120, "es": 120} and all(r.doc_id % 5 == 0 for r in out if not r.kept)


def test_hundreds_of_strata_keep_their_names_and_share_cutoffs(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    rows = []
    for i in range(4800):
        rows.append((i, " ".join(rng.choice(words) + "##" * (i % 5 == 0) for _ in range(52)), "big" if i % 2 else f"l{i // 2 % 601}"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(4800)], "doc_id bigint, quality int")
    out = rules.judge(frame, labels).collect()
    assert len(out) == 4800 and {r.stratum for r in out} == {r[2] for r in rows}
    poor = {r.doc_id for r in out if not r.kept}
    # A stratum without a good holdout document has no cutoff.
    held = {r[2] for r in rows if r[0] % 5 and zlib.crc32(str(r[0]).encode()) % 2 == 0}
    assert poor == {r[0] for r in rows if r[0] % 5 == 0 and r[2] in held} and len(poor) > 800


def test_enough_is_the_least_number_that_can_be_certified():
    n = rules.enough(0.04, 0.05)
    assert n == 437 and rules.groups({"a": n}, 0.04, 0.05) == [["a"]]
    assert rules.groups({"a": 5000, None: 9000, "b": 40}, 0.04, 0.05) == [["a"], ["b", None]]
    assert rules.groups({None: 7}, 0.04, 0.05) == [[None]]
