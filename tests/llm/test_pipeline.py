"""The stages of the pipeline, and the joins under them, on odd input: repeated rows, null ids, clashing columns, empty tables."""

import random
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keyflow.llm import jaccard

CLASHING = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, n_removed int, kept string, quality_score double, "
    "weak_label string, quality_kept int, toxicity double, _id int, _key int, _n int, _text_key int, _row int, node int, signature int"
)
WORDS = [f"w{i}" for i in range(300)]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def row(doc_id, value):
    return (doc_id, value, "en", "s", None if value is None else len(value), "seven", 7, "own", -5.0, "own", 3, -5.0, 1, 2, 3, 4, 5, 6, 7)


@pytest.fixture(scope="module")
def clashing(spark):
    rng = random.Random(3)
    same = text(rng, 80)
    rows = [row(i, text(rng, rng.randrange(20, 90))) for i in range(30)]
    rows += [row(100, same), row(101, same), row(None, same), row(None, None), row(102, ""), row(103, same.replace("w1 ", "w2 "))]
    rows += [rows[4]] * 30 + [row(None, rows[5][1])] * 30
    return spark.createDataFrame(rows, CLASHING).repartition(3)


@pytest.fixture(scope="module")
def folder(spark, clashing, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("sf"))
    clashing.write.parquet(f"{base}/documents.parquet")
    labels = [(i, 1, int(i % 7 == 0)) for i in range(30)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns_of_the_documents(spark, clashing, folder, name, stage):
    out = stage(spark, clashing, folder)
    assert out.columns == clashing.columns and [t for _, t in out.dtypes] == [t for _, t in clashing.dtypes]
    unchanged = [c for c in clashing.columns if c not in ("text", "n_chars")]
    assert out.select(*unchanged).exceptAll(clashing.select(*unchanged)).isEmpty(), "what is kept is what came in"
    assert out.filter("toxicity <> -5 or quality_score <> -5 or n_words <> 'seven'").isEmpty()
    assert stage(spark, clashing.filter("false"), folder).count() == 0


def test_near_copies_leave_one_row_each(spark, clashing):
    kept = jaccard.keep_one(clashing).select("doc_id", "text").collect()
    ids = sorted(r.doc_id for r in kept if r.doc_id is not None)
    assert ids == [*range(30), 100, 102], "a null id never wins over another"
    assert [r.text for r in kept if r.doc_id is None] == [None]


def test_last_stage_packs_every_piece_once(spark, clashing, folder):
    out = corpus_pipeline.STAGES[-1][1](spark, clashing, folder)
    assert out.count() == clashing.count()
    per = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert per.filter("n > 2048 or n <> end").isEmpty()


def test_run_is_the_stages_one_after_the_other(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
    want = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert got.columns == want.columns
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(map(tuple, want.select(*columns).collect()), key=repr)
    packed = got.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert packed.filter("n > 2048").isEmpty()


def test_many_repeated_rows_and_null_ids_are_one_node_each(spark):
    rng = random.Random(4)
    long, other = text(rng, 120), text(rng, 100)
    rows = [(i, text(rng, 60)) for i in range(40)] + [(500, long)] * 1000 + [(None, other)] * 1000
    rows += [(600 + i, long + f" end{i}") for i in range(20)] + [(None, long.replace("w7", "w8"))] * 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    begin = time.time()
    out = jaccard.similar(docs).select("doc_id", "component_id", "n_shingles").collect()
    assert time.time() - begin < 120
    assert len(out) == len(rows)
    sets = [frozenset(zip(*[t.split()[k:] for k in range(5)])) for _, t in rows]
    distinct = list(dict.fromkeys(sets))
    parent = list(range(len(distinct)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(distinct):
        for j in range(i):
            if 100 * len(a & distinct[j]) >= 80 * len(a | distinct[j]):
                parent[root(i)] = root(j)
    place = {s: root(i) for i, s in enumerate(distinct)}
    least = {}
    for (doc_id, _), s in zip(rows, sets):
        if doc_id is not None:
            least[place[s]] = min(least.get(place[s], doc_id), doc_id)
    want = sorted((repr(d), repr(least.get(place[s], d)), len(s)) for (d, _), s in zip(rows, sets))
    assert sorted((repr(r.doc_id), repr(r.component_id), r.n_shingles) for r in out) == want
