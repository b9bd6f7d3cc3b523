"""Token counts of whole texts, by the tokeniser's own library.

Arrow functions encode texts in batches and return lengths only; no id leaves a task. Long texts are cut at safe boundaries into pieces of about
``PIECE_CHARS``, and pieces are put together to batches of about ``BATCH_CHARS``, so that a batch costs about the same whatever the
texts are. A boundary is safe where the splitting rule of the vocabulary can never put both sides into one token, so a
text's count is the sum of its pieces' counts:

* byte-level vocabularies (``.json``) start a token at white space that follows something else, and between a letter and a digit; the
  strings of special tokens hold neither;
* sentencepiece vocabularies (``.model``) are cut at a single space between ASCII letters, if no piece of the vocabulary holds the mark of a
  space behind another character and the library puts that mark before every text: the space is left out, the library adds it again;
* texts of other vocabularies stay whole.

Texts over ``SPREAD_BYTES`` would keep one task busy for long. Their pieces are dealt to all tasks by a shuffle, equal texts only once.

Defined results: a null or empty text has 0 bytes and 0 tokens. Strings of special tokens inside a text count as the library does by
default. Repeated rows are counted as often as they come. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import digest, map_arrow, small_side, stage, texts

PIECE_CHARS = 1 << 16
BATCH_CHARS = 1 << 18
SPREAD_BYTES = 4 << 20

_BYTE_LEVEL = re.compile(r"(?<=[^\s])(?=[ \t\n\r])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
_SPACE_MARK = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
SPACE = "▁"


class Counter:
    """One loaded vocabulary: how many tokens texts have, and where they may be cut."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            self.count = lambda batch: [len(e) for e in library.encode_batch_fast(batch, add_special_tokens=False)]
            rule = (library.pre_tokenizer, library.normalizer)
            plain = type(rule[0]).__name__ == "ByteLevel" and rule[1] is None and not rule[0].add_prefix_space
            self.boundary = _BYTE_LEVEL if plain else None
        else:
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = lambda batch: [len(ids) for ids in library.encode(batch, num_threads=1)]
            names = (library.id_to_piece(i) for i in range(library.get_piece_size()))
            own_mark = library.encode("a", out_type=str)[0].startswith(SPACE)
            self.boundary = _SPACE_MARK if own_mark and not any(SPACE in name.lstrip(SPACE) for name in names) else None

    def pieces(self, text: str, size: int) -> list[str]:
        """The text in pieces of at least ``size`` characters (the last may be shorter), cut at the first safe boundary behind that."""
        if self.boundary is None or len(text) <= size:
            return [text]
        out, at = [], 0
        while len(text) - at > size:
            found = self.boundary.search(text, at + size)
            if not found:
                break
            out.append(text[at : found.start()])
            at = found.end()
        out.append(text[at:])
        return out

    def totals(self, values: list[str], piece: int = PIECE_CHARS, batch: int = BATCH_CHARS) -> list[int]:
        """Tokens of each text."""
        out, held, owners, size = [0] * len(values), [], [], 0

        def flush():
            for owner, n in zip(owners, self.count(held)):
                out[owner] += n
            held.clear()
            owners.clear()

        for i, text in enumerate(values):
            for part in self.pieces(text, piece):
                if held and size + len(part) > batch:
                    flush()
                    size = 0
                held.append(part)
                owners.append(i)
                size += len(part)
        if held:
            flush()
        return out


_LOADED: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _LOADED:
        _LOADED[path] = Counter(path)
    return _LOADED[path]


def count_tokens(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", piece_chars: int = PIECE_CHARS, spread_bytes: int = SPREAD_BYTES
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    long = F.col("n_bytes") > spread_bytes
    kind = dict(rows.dtypes)["doc_id"]

    def in_place(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Counts of all but the longest texts, which come without their text here."""
        counts = counter(tokenizer).totals(texts(batch), piece_chars)
        known = [None if key is not None else n for key, n in zip(batch.column("key").to_pylist(), counts)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), batch.column("key"), pa.array(known, pa.int64())], ["doc_id", "n_bytes", "key", "n_tokens"]
        )

    keyed = rows.select("doc_id", F.when(~long, F.col("text")).alias("text"), "n_bytes", F.when(long, digest("text")).alias("key"))
    counted = stage(map_arrow(keyed, in_place, f"doc_id {kind}, n_bytes bigint, key binary, n_tokens bigint"))
    if counted.filter(F.col("key").isNotNull()).isEmpty():
        return counted.select("doc_id", "n_bytes", "n_tokens")

    def cut(batches):
        for batch in batches:
            for key, value in zip(batch.column("key").to_pylist(), texts(batch)):
                for i, part in enumerate(counter(tokenizer).pieces(value, piece_chars)):
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([i]), pa.array([part])], ["key", "piece", "text"])

    def sizes(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = counter(tokenizer).totals(texts(batch), piece_chars)
        return pa.RecordBatch.from_arrays([batch.column("key"), pa.array(counts, pa.int64())], ["key", "n"])

    cuts = rows.filter(long).select(digest("text").alias("key"), "text").mapInArrow(cut, "key binary, piece bigint, text string")
    # Equal texts have equal pieces: the first one of each is kept before and after the shuffle, which deals pieces to all tasks.
    dealt = cuts.groupBy("key", "piece").agg(F.first("text").alias("text"))
    spread = map_arrow(dealt.select("key", "text"), sizes, "key binary, n bigint").groupBy("key").agg(F.sum("n").alias("_n"))
    # One row per different text of over SPREAD_BYTES.
    found = counted.filter(F.col("key").isNotNull()).join(small_side(spread), "key")
    return counted.filter(F.col("key").isNull()).select("doc_id", "n_bytes", "n_tokens").unionByName(found.select("doc_id", "n_bytes", F.col("_n").alias("n_tokens")))
