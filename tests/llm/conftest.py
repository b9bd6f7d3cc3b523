import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node bigint, spans string, length string, _c0 int"


def sentence(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows with nulls, empty and long texts, copies, near copies, shared passages, repeated rows and clashing columns."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    passage = sentence(rng, 60, words)
    texts = [None, "", "   \t\n", "one", "one two three four", "ONE two Three four", "x" * 5000, "é É ß Σ ΑΣ 日本 😀 \x1c a\x85b"]
    for i in range(40):
        texts.append(sentence(rng, rng.randrange(20, 200), words) + ("\n" if i % 3 else " ") + (passage if i % 4 == 0 else ""))
    base = texts[20].split()
    for i in range(12):  # near copies, in a chain
        base = base[:]
        base[rng.randrange(len(base))] = f"edit{i}"
        texts.append(" ".join(base))
    texts += [texts[12], texts[12], texts[13], sentence(rng, 5000, words), " ".join(["again and again"] * 40)]
    rows = [(i, t, rng.choice(["en", "de", None]), f"src{i % 3}", None if t is None else len(t), 7, "s", "l", 1) for i, t in enumerate(texts)]
    return rows + [rows[9], rows[9], rows[1], (None, texts[15], None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_text(rows, *names):
    return sorted([tuple(r[n] for n in names) for r in rows], key=repr)
