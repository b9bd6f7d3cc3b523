"""Language identification with a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes, the last one filled up with zeros. Filters of several widths run over a window's
bytes, each keeps its largest response, and a softmax layer turns these into languages. The network is trained in numpy, with
gradients written out, on a bounded sample of labelled texts: of every language at most ``FIT_ROWS`` documents, however long, picked by a hash of
their identifier, and at most ``FIT_WINDOWS`` windows from all over each. So a rare language is learnt from all it has up to that number; the sample, 512 bytes a document,
and the time to fit grow with the number of languages. A text's prediction is the mean of its windows' log probabilities, weighted by their bytes; all windows of the whole text count.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing could be learnt. Null languages are never learnt.
Repeated rows are learnt once and predicted alike. A very long text is many windows, handled in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import crc_bucket, map_arrow, small_side, stage

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
FIT_ROWS, FIT_WINDOWS = 750, 4
EPOCHS, BATCH, RATE = 6, 64, 0.01
# Windows handled at once.
BLOCK = 4_096
UNKNOWN = "und"


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text as rows of windows, and how many bytes each row has."""
    data = np.frombuffer(text.encode().lower(), np.uint8)
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(data)] = data
    sizes = np.full(n, WINDOW, np.float32)
    sizes[-1] = max(1, len(data) - (n - 1) * WINDOW)
    return out.reshape(n, WINDOW), sizes


class Network:
    def __init__(self, classes: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        # A filter is a weight per place and byte.
        self.filters = [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, classes)).astype(np.float32)
        self.bias = np.zeros(classes, np.float32)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The largest response of every filter, and where it was."""
        best, places = [], []
        for weights in self.filters:
            width = len(weights)
            span = WINDOW - width + 1
            response = weights[0][x[:, :span]]
            for j in range(1, width):
                response += weights[j][x[:, j : j + span]]
            if self.training:
                at = response.argmax(1)
                places.append(at)
                best.append(np.take_along_axis(response, at[:, None, :], 1)[:, 0])
            else:
                best.append(response.max(1))
        return np.concatenate(best, 1), places

    training = False

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        scores = np.tanh(self.pooled(x)[0]) @ self.out + self.bias
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        self.training = True
        response, places = self.pooled(x)
        self.training = False
        hidden = np.tanh(response)
        scores = hidden @ self.out + self.bias
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        back = (p @ self.out.T) * (1 - hidden**2)
        found = []
        number, rows = np.arange(FILTERS)[None, :], np.arange(len(y))[:, None]
        for i, (weights, at) in enumerate(zip(self.filters, places)):
            gradient = np.zeros_like(weights)
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            for j in range(len(weights)):
                np.add.at(gradient[j], (x[rows, at + j], np.broadcast_to(number, at.shape)), part)
            found.append(gradient)
        return [*found, hidden.T @ p, p.sum(0)]

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        weights = [*self.filters, self.out, self.bias]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                chosen = order[at : at + BATCH]
                step += 1
                for w, g, m, v in zip(weights, self.gradients(x[chosen], y[chosen]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def learnable(text: str) -> bytes:
    """The windows of a text that are learnt from."""
    parts = windows(text)[0]
    return parts[np.unique(np.linspace(0, len(parts) - 1, FIT_WINDOWS).astype(int))].tobytes()


def fit(rows: list[tuple[bytes, str]]) -> tuple[list[str], Network] | None:
    """Languages and network, from (learnable windows, language)."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return None
    number = {lang: i for i, lang in enumerate(languages)}
    x = np.frombuffer(b"".join(parts for parts, _ in rows), np.uint8).reshape(-1, WINDOW)
    y = np.repeat([number[lang] for _, lang in rows], [len(parts) // WINDOW for parts, _ in rows])
    network = Network(len(languages))
    network.train(x, y)
    return languages, network


def sample(usable: DataFrame) -> list[tuple[bytes, str]]:
    """At most ``FIT_ROWS`` rows of each language, as learnable windows."""
    keyed = usable.select("text", "lang", F.xxhash64("doc_id").alias("_h"), F.xxhash64("text").alias("_key"))
    keys = ["lang", "_h", "_key"]
    # Keys are ranked, not texts, and only those of the first ranges of hashes that hold enough, so that a common language is not sorted in one task.
    known = stage(keyed.select(*keys).distinct().withColumn("_range", F.shiftright("_h", 54)))
    before = Window.partitionBy("lang").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = known.groupBy("lang", "_range").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    first = known.join(small_side(ranges.filter(F.col("_before") < FIT_ROWS).select("lang", "_range")), ["lang", "_range"])
    least = Window.partitionBy("lang").orderBy("_h", "_key")
    chosen = first.select(*keys).withColumn("_n", F.row_number().over(least)).filter(F.col("_n") <= FIT_ROWS).drop("_n")
    found = keyed.join(small_side(chosen), keys)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = pa.array([learnable(t) for t in batch.column("text").to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keys], parts], [*keys, "parts"])

    cut = map_arrow(found.select("text", *keys), run, "lang string, _h bigint, _key bigint, parts binary")
    learnt = cut.groupBy(*keys).agg(F.min("parts").alias("parts")).orderBy("_h", "_key", "lang").select("parts", "lang").toArrow()
    return list(zip(learnt.column("parts").to_pylist(), learnt.column("lang").to_pylist()))


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def predict(model: tuple[list[str], Network], values: list[str | None]) -> tuple[list[str], list[float]]:
    languages, network = model
    known = [i for i, t in enumerate(values) if has_letter(t)]
    names, scores = [UNKNOWN] * len(values), [0.0] * len(values)
    cut = [windows(values[i]) for i in known]
    if not cut:
        return names, scores
    x, sizes = np.concatenate([c[0] for c in cut]), np.concatenate([c[1] for c in cut])
    logs = np.concatenate([network.log_probabilities(x[at : at + BLOCK]) for at in range(0, len(x), BLOCK)])
    starts = np.concatenate([[0], np.cumsum([len(c[0]) for c in cut])[:-1]])
    mean = np.add.reduceat(logs * sizes[:, None], starts) / np.add.reduceat(sizes, starts)[:, None]
    p = np.exp(mean - mean.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    for i, k, s in zip(known, p.argmax(1), p.max(1)):
        names[i], scores[i] = languages[k], min(1.0, float(s))
    return names, scores


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", allowed=None) -> DataFrame:
    """``doc_id, lang_pred, score``. ``allowed`` says, by the identifier, which rows may be learnt from."""
    allowed = allowed or (lambda c: crc_bucket(c, 4) != 2)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    usable = rows.filter(allowed("doc_id") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    model = fit(sample(usable))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column("text").to_pylist()
        names, scores = predict(shared.value, values) if shared.value else ([UNKNOWN] * len(values), [0.0] * len(values))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return map_arrow(rows.select("doc_id", "text"), run, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")
