"""Encoding and decoding with a merge-type (BPE) sentencepiece vocabulary.

A text is cut before every run of spaces: no piece of such a vocabulary has a space after another character, so no merge
crosses a cut (checked when the vocabulary is loaded; else a text is one chunk). A chunk is cut further between two characters that are
neighbours in no piece, such as a letter and a full stop. Each part is encoded by an agenda of adjacent
symbol pairs: the pair whose joint piece has the best score is merged first, the leftmost of equal scores; stale entries
are skipped. Chunks and parts repeat, so each worker remembers a bounded number of them. What is new in an Arrow batch is also encoded by the
sentencepiece library; where the two differ the library's ids count and the row says how many of its chunks differed.

Defined results: a null or empty text has no ids and decodes to ''. Very long texts, also without any space, are
encoded whole: the agenda takes n log n steps. Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from keyflow.llm.common import map_arrow, texts

SPACE = "▁"
# Chunks remembered per worker, each a short text: about 250 MB.
REMEMBERED = 1_000_000
# Up to this length the agenda is a list, beyond it a heap.
SCANNED_CHARS = 48
NEVER = float("inf")
# Where a chunk may be cut: around runs of letters and digits.
RUNS = re.compile(f"{SPACE}*\\w+|[^\\w{SPACE}]+|{SPACE}+")
# A chunk longer than this is not remembered.
REMEMBERED_CHARS = 64

NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Agenda:
    """The vocabulary, and the merge procedure."""

    def __init__(self, path: str):
        proto = model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != model_pb2.TrainerSpec.BPE:
            raise ValueError("a merge-type (BPE) vocabulary is needed")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
            raise ValueError("only the identity normaliser with a leading space is supported")
        if any(p.type in (USER_DEFINED, UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.rank = {p.piece: -p.score for p in proto.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.neighbours = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.known: dict[str, tuple[tuple[int, ...], bytes]] = {}

    def symbols(self, chunk: str) -> list[str]:
        """The pieces left when no neighbouring pair can be merged any more."""
        return self.scanned(chunk) if len(chunk) <= SCANNED_CHARS else self.queued(chunk)

    def scanned(self, chunk: str) -> list[str]:
        """The agenda as a plain list with one score per neighbouring pair: fastest for words."""
        parts, score = list(chunk), self.rank.get
        agenda = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            joint = parts[i] + parts[i + 1]
            parts[i : i + 2] = [joint]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = score(joint + parts[i + 1], NEVER)
            if i:
                agenda[i - 1] = score(parts[i - 1] + joint, NEVER)
        return parts

    def queued(self, chunk: str) -> list[str]:
        """The agenda as a heap: n log n steps for chunks of any length."""
        parts: list[str | None] = list(chunk)
        n, rank = len(parts), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            joint = parts[i] + parts[i + 1]
            if joint in rank:
                agenda.append((rank[joint], i, joint))
        heapq.heapify(agenda)
        while agenda:
            _, i, joint = heapq.heappop(agenda)
            left = parts[i]
            if left is None or after[i] >= n:
                continue
            j = after[i]
            if len(left) + len(parts[j]) != len(joint) or left + parts[j] != joint:
                continue
            parts[i], parts[j] = joint, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                longer = joint + parts[k]
                if longer in rank:
                    heapq.heappush(agenda, (rank[longer], i, longer))
            h = before[i]
            if h >= 0:
                longer = parts[h] + joint
                if longer in rank:
                    heapq.heappush(agenda, (rank[longer], h, longer))
        return [p for p in parts if p is not None]

    def parts(self, chunk: str) -> list[str]:
        """The runs of a chunk; two stay together where a piece has their neighbouring characters side by side."""
        if chunk[1:].isalpha() and chunk[0] == SPACE:
            return [chunk]
        runs = RUNS.findall(chunk)
        if len(runs) < 2:
            return [chunk]
        out, begin, end = [], 0, len(runs[0])
        for run in runs[1:]:
            if chunk[end - 1 : end + 1] not in self.neighbours:
                out.append(chunk[begin:end])
                begin = end
            end += len(run)
        out.append(chunk[begin:])
        return out

    def encode_chunk(self, chunk: str) -> tuple[int, ...]:
        parts = self.parts(chunk)
        return self.encode_part(chunk) if len(parts) == 1 else tuple(chain.from_iterable(map(self.remembered_part, parts)))

    def remembered_part(self, part: str) -> tuple[int, ...]:
        found = self.known.get(part)
        if found is not None:
            return found[0]
        ids = self.encode_part(part)
        if len(self.known) < REMEMBERED and len(part) <= REMEMBERED_CHARS:
            self.known[part] = (ids, ",".join(map(str, ids)).encode())
        return ids

    def encode_part(self, part: str) -> tuple[int, ...]:
        symbols = self.symbols(part)
        try:
            return tuple(map(self.ids.__getitem__, symbols))
        except KeyError:  # characters outside the vocabulary
            pass
        out: list[int] = []
        for piece in symbols:
            found = self.ids.get(piece)
            if found is not None:
                out.append(found)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in piece.encode())
            else:
                out.append(self.unknown)
        return tuple(out)

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        if not self.cuts:
            return [text]
        if SPACE + SPACE not in text:
            return [SPACE + w for w in text[1:].split(SPACE)]
        return re.findall(f"{SPACE}+[^{SPACE}]*", text)

    def learn(self, chunks: set[str]) -> tuple[dict, set[str]]:
        """Encodings of chunks that are not remembered, and those on which the library disagrees."""
        fresh = [c for c in chunks if c not in self.known]
        found, differing = {}, set()
        # The library puts a space in front by itself.
        for chunk, want in zip(fresh, self.library.encode([c[1:] for c in fresh], num_threads=1) if fresh else []):
            ids = self.encode_chunk(chunk)
            if chunk != SPACE and ids != tuple(want):  # the library has no ids for an empty text
                differing.add(chunk)
                ids = tuple(want)
            value = (ids, ",".join(map(str, ids)).encode())
            if len(self.known) < REMEMBERED and len(chunk) <= REMEMBERED_CHARS and chunk not in differing:
                self.known[chunk] = value
            else:
                found[chunk] = value
        return found, differing

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.encode_chunk(c) for c in self.chunks(text)))


_LOADED: dict[str, Agenda] = {}


def load(path: str) -> Agenda:
    """One vocabulary per worker and path."""
    if path not in _LOADED:
        _LOADED[path] = Agenda(path)
    return _LOADED[path]


def encode_decode(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True) -> DataFrame:
    """``keep`` plus ``n_tokens``, ``ids_sha256``, ``decoded`` and ``n_differing``; with ``with_ids`` also the ``ids``."""
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).alias("text"))
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{n} {kinds[c]}" for c, n in zip(keep, names)) + (
        ", n_tokens bigint, ids_sha256 string, decoded string, n_differing bigint" + (", ids array<int>" if with_ids else "")
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        agenda = load(model)
        known = agenda.known
        counts, hashes, decoded, differ, all_ids = [], [], [], [], []
        in_texts = list(map(agenda.chunks, texts(batch)))
        fresh, differing = agenda.learn(set().union(*in_texts))
        for chunks in in_texts:
            found = list(map(known.get, chunks))
            if None in found:
                found = [f or fresh[c] for c, f in zip(chunks, found)]
            ids = list(chain.from_iterable([f[0] for f in found]))
            counts.append(len(ids))
            hashes.append(hashlib.sha256(b",".join([f[1] for f in found])).hexdigest())
            decoded.append(agenda.library.decode(ids) if ids else "")
            differ.append(sum(c in differing for c in chunks) if differing else 0)
            if with_ids:
                all_ids.append(ids)
        columns = [batch.column(n) for n in names] + [
            pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string()), pa.array(differ, pa.int64())
        ]
        out = [*names, "n_tokens", "ids_sha256", "decoded", "n_differing"]
        if with_ids:
            columns.append(pa.array(all_ids, pa.list_(pa.int32())))
            out.append("ids")
        return pa.RecordBatch.from_arrays(columns, out)

    result = map_arrow(rows, run, schema)
    return result.withColumnsRenamed(dict(zip(names, keep)))
