"""Repair of the turn structure of conversations at the least cost.

A conversation must read ``(s?(ua)+)?`` in the initials of its roles: an optional system row, then pairs of user and assistant. Rows are kept (0), given
the role user or assistant (3) or deleted (4; blank rows and repetitions must be), and empty user or assistant rows are inserted anywhere (3).
A row that breaks off and stays adds 3. Of the cheapest ways the one whose edit initials are the ASCII-least is taken.

The least costs to go are a vector over the four places a conversation can be in (nothing yet, after s, after u, after a), computed from
the end backwards. Conversations are cut into chunks, and rank-convergence makes the chunks independent:

1. Rows are sorted over all tasks by conversation and turn; a chunk is a run of neighbouring rows, so a long conversation lies in many tasks.
2. Every chunk starts from a speculative cost vector, the one of a conversation's end, and hands its own vector to the chunk before it.
3. Fix-up passes rerun the chunks whose true vector differs from the one used by more than a constant, until none does. Most rows forget what
   comes after them, so one or two passes do. Rows of one role in a row may never forget (their vectors alternate); what still differs
   after ``fixups`` passes gets its vectors from the chunks' cost matrices, multiplied in a two-level scan.
4. With the stitched vectors every chunk knows, for each place it may be entered at, the least edits and the place it ends at. A scan of these maps gives the
   places of entry, and every chunk is traced once more from there.

Defined results: rows equal in conversation and turn are sorted by content, so repetitions are neighbours. Nulls in role and text
count as one space. A null conversation is one of its own. Roles are told by their first character; one that is not s, u or a cannot be kept.
An empty table gives no rows. Columns other than ``conv_id, turn, role, text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import small_side, stage
from keyflow.operators.scan import exclusive_scan

CHUNK_ROWS = 4096
FIXUPS = 3

INITIALS = "sua"
# Places: 0 nothing yet, 1 after s, 2 after u, 3 after a. Where a row of role s, u, a leads from each of them (None: not allowed).
FOLLOW = ((1, 2, None), (None, 2, None), (None, None, 3), (None, 2, None))
# The only place and role that an inserted or newly named row can have.
GIVEN = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))
KEEP, RENAME, DELETE, INSERT, BROKEN = 0, 3, 4, 3, 3
FAR = 1 << 50

# A row is one symbol: its initial (s, u, a, other) plus 4 times its state.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)


# ---- one chunk -----------------------------------------------------------------------------------------------------


def closed(costs: list[int]) -> tuple[int, ...]:
    """Costs to go when rows may be inserted first."""
    for _ in range(3):
        costs = [min(c, costs[GIVEN[q][0]] + INSERT) for q, c in enumerate(costs)]
    return tuple(costs)


END = closed([0, FAR, FAR, 0])


def kept(symbol: int, place: int) -> tuple[int, int] | None:
    """Cost and next place of keeping a row."""
    state, initial = divmod(symbol, 4)
    if state >= BLANK or initial == 3 or FOLLOW[place][initial] is None:
        return None
    return KEEP + (BROKEN if state == TRUNCATED else 0), FOLLOW[place][initial]


def renamed(symbol: int, place: int) -> tuple[int, int] | None:
    state = symbol // 4
    return None if state >= BLANK else (RENAME + (BROKEN if state == TRUNCATED else 0), GIVEN[place][0])


def before(symbol: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a row from those behind it."""
    out = []
    for place in range(4):
        options = [DELETE + costs[place]]
        options += [found[0] + costs[found[1]] for found in (kept(symbol, place), renamed(symbol, place)) if found]
        out.append(min(min(options), FAR))
    return closed(out)


def normal(costs) -> tuple[int, ...]:
    least = min(costs)
    return tuple(c - least for c in costs)


_STEPS: dict[tuple, tuple[int, ...]] = {}


def normal_before(symbol: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """:func:`before` up to a constant. There are few different vectors up to constants, so steps are remembered."""
    key = (symbol, costs)
    found = _STEPS.get(key)
    if found is None:
        if len(_STEPS) > 100_000:
            _STEPS.clear()
        found = _STEPS[key] = normal(before(symbol, costs))
    return found


def backward(symbols: bytes, costs: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Vectors, up to constants, before each row, and behind the last one."""
    out = [normal(costs)]
    for symbol in reversed(symbols):
        out.append(normal_before(symbol, out[-1]))
    out.reverse()
    return out


def matrix(symbols: bytes) -> np.ndarray:
    """Least costs from each place before the chunk to each place behind it."""
    columns = []
    for place in range(4):
        costs = closed([0 if q == place else FAR for q in range(4)])
        for symbol in reversed(symbols):
            costs = before(symbol, costs)
        columns.append(costs)
    return np.minimum(np.array(columns, np.int64).T, FAR)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), FAR)


def trace(symbols: bytes, vectors: list[tuple[int, ...]], place: int, last: bool) -> tuple[list[tuple[str, int, str | None]], int]:
    """The least cheapest edits from a place of entry, ``(letter, row or -1, new role)``, and the place behind them."""
    out = []
    for i, symbol in enumerate(symbols):
        behind = vectors[i + 1]
        while True:
            options = [(DELETE + behind[place], "D", place)]
            # Inserting leads to another place before the same row, and what may be done with the row from there counts.
            steps, reach, paid = [], place, 0
            for _ in range(3):
                for found, letter in ((kept(symbol, reach), "K"), (renamed(symbol, reach), "R")):
                    if found:
                        steps.append((paid + found[0] + behind[found[1]], letter if not paid else "I", found[1]))
                if paid:
                    steps.append((paid + DELETE + behind[reach], "I", reach))
                reach, paid = GIVEN[reach][0], paid + INSERT
            cost = min(o[0] for o in options + steps)
            least = min(o[1] for o in options + steps if o[0] == cost)
            if least == "I":
                out.append(("I", -1, GIVEN[place][1]))
                place = GIVEN[place][0]
                continue
            to = next(o[2] for o in options + steps if o[0] == cost and o[1] == least)
            out.append((least, i, GIVEN[place][1] if least == "R" else None))
            place = to
            break
    while last and place not in (0, 3):
        out.append(("I", -1, GIVEN[place][1]))
        place = GIVEN[place][0]
    return out, place


def cost_of(edits, symbols: bytes) -> int:
    total = 0
    for letter, row, _ in edits:
        total += {"K": KEEP, "R": RENAME, "D": DELETE, "I": INSERT}[letter]
        total += BROKEN if letter in "KR" and symbols[row] // 4 == TRUNCATED else 0
    return total


# ---- rows ----------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with some rows dropped, emptied, without closing marks, repeated or given to the user."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(F.encode(place, "UTF-8")) % 20).alias("_what"))
    rows = rows.filter(F.col("_what") != 0).select(
        "conv_id", "turn",
        F.when(F.col("_what") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_what") == 1, F.lit("")).when(F.col("_what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return rows.drop("_copy")


def marked(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, key, row, initial, state`` of rows that have a ``row`` number: everything but their texts."""
    closing = F.expr(r"substring(trim(TRAILING ' \t\n\u000b\u000c\r' FROM text), -1, 1)")
    content = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    lean = rows.select(
        "conv_id", "turn", "row", F.unhex(F.md5(F.encode(content, "UTF-8"))).alias("key"),
        # instr finds an empty text at 1
        F.when((initial == 0) | (F.length("role") == 0), 3).otherwise(initial - 1).alias("initial"),
        F.when(closing == "", BLANK).when(closing.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED).alias("state"),
    )
    # The first of each content, found before the shuffle; joined by the number of the row, so a row found a million times is no hot key.
    first = lean.filter(F.col("state") != BLANK).groupBy("conv_id", "key").agg(F.min(F.struct("turn", "row")).alias("_first"))
    out = lean.join(first.select(F.col("_first.row").alias("row"), F.lit(True).alias("_is_first")), "row", "left")
    again = (F.col("state") != BLANK) & F.col("_is_first").isNull()
    return out.withColumn("state", F.when(again, DUPLICATE).otherwise(F.col("state"))).drop("_is_first")


CHUNK_FIELDS = "part int, chunk int, first int, last int, illegal bigint, symbols binary, rows array<bigint>"


def legal(one: int, two: int) -> bool:
    return (one, two) in ((0, 1), (1, 2), (2, 1))


def chunked(lean: DataFrame, chunk_rows: int) -> DataFrame:
    """Sorted rows in chunks: ``conv_id`` and CHUNK_FIELDS. ``(part, chunk)`` sorts the chunks and is different for each."""
    order = ["conv_id", "turn", "key", "row"]
    kind = dict(lean.dtypes)["conv_id"]
    ordered = lean.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("conv_id", "row", (F.col("initial") + 4 * F.col("state")).alias("symbol"), F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, current, held, out = 0, None, [], []

        def close():
            nonlocal number
            symbols = bytes(s for _, s in held)
            roles = [s % 4 for s in symbols]
            wrong = sum(not legal(a, b) for a, b in zip(roles, roles[1:]))
            out.append((current[0], current[1], number, roles[0], roles[-1], wrong, symbols, [r for r, _ in held]))
            number += 1
            held.clear()

        def flush():
            types = [conv_type, pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            names = ["conv_id", "part", "chunk", "first", "last", "illegal", "symbols", "rows"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out.clear()
            return batch

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for conv, row, symbol, part in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (current != (conv, part) or len(held) == chunk_rows):
                    close()
                current = (conv, part)
                held.append((row, symbol))
            if len(out) > 256 or sum(len(o[7]) for o in out) > 4 * chunk_rows:
                yield flush()
        if held:
            close()
        if out:
            yield flush()

    return stage(ordered.mapInArrow(run, f"conv_id {kind}, {CHUNK_FIELDS}"))


def placed(chunks: DataFrame) -> DataFrame:
    """``conv_id, part, chunk, number, of, illegal``: the chunks of each conversation numbered, one row per chunk, without their rows."""
    by = Window.partitionBy("conv_id").orderBy("part", "chunk")
    whole = Window.partitionBy("conv_id")
    met = F.concat(F.lag("last").over(by).cast("string"), F.col("first").cast("string"))
    return chunks.select("conv_id", "part", "chunk", "first", "last", "illegal").select(
        "conv_id", "part", "chunk", F.row_number().over(by).cast("bigint").alias("number"), F.count("*").over(whole).alias("of"),
        (F.col("illegal") + F.coalesce((~met.isin("01", "12", "21")).cast("bigint"), F.lit(0))).alias("illegal"),
        F.lead("part").over(by).alias("next_part"), F.lead("chunk").over(by).alias("next_chunk"),
    )


AT = ["part", "chunk"]


def _each(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` of every row's values, giving a row."""

    def run(batches):
        for batch in batches:
            rows = [fn(*row) for row in zip(*[c.to_pylist() for c in batch.columns])]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    names = [f.split()[0] for f in schema.split(", ")]
    types = [kinds[f.split()[1]] for f in schema.split(", ")]
    return df.mapInArrow(run, schema)


def end_vectors(chunks: DataFrame, places: DataFrame, fixups: int) -> DataFrame:
    """The vector behind each chunk that is not the last one of its conversation, up to a constant: ``part, chunk, behind``."""
    follows = places.filter(F.col("of") > 1)
    long = stage(follows.select(*AT, "conv_id", "number", "next_part", "next_chunk").join(chunks.select(*AT, "symbols"), AT))

    def rerun(df: DataFrame) -> DataFrame:
        fields = "part int, chunk int, next_part int, next_chunk int, used array<int>, front array<int>"
        return _each(
            df.select(*AT, "next_part", "next_chunk", "used", "symbols"),
            lambda part, chunk, np_, nc, used, symbols: (part, chunk, np_, nc, used, backward(symbols, tuple(used))[0]), fields,
        )

    end = F.array(*[F.lit(c) for c in normal(END)])
    state = stage(rerun(long.withColumn("used", end)))
    for _ in range(fixups):
        given = state.select(F.col("part").alias("next_part"), F.col("chunk").alias("next_chunk"), F.col("front").alias("true"))
        looked = stage(state.join(given, ["next_part", "next_chunk"], "left"))
        wrong = F.col("true").isNotNull() & (F.col("true") != F.col("used"))
        stale = looked.filter(wrong)
        if stale.isEmpty():
            return state.filter(F.col("next_part").isNotNull()).select(*AT, F.col("used").alias("behind"))
        again = rerun(stale.select(*AT, "next_part", "next_chunk", F.col("true").alias("used")).join(long.select(*AT, "symbols"), AT))
        state = stage(looked.filter(~wrong).select(*state.columns).unionByName(again))
    given = state.select(F.col("part").alias("next_part"), F.col("chunk").alias("next_chunk"), F.col("front").alias("true"))
    looked = stage(state.join(given, ["next_part", "next_chunk"], "left").join(long.select(*AT, "conv_id", "number"), AT))
    stale = looked.filter(F.col("true") != F.col("used")).select(F.col("conv_id").alias("_conv")).distinct()
    open_ = small_side(stale)
    same = long["conv_id"].eqNullSafe(open_["_conv"])
    known = looked.filter(F.col("next_part").isNotNull()).join(open_, looked["conv_id"].eqNullSafe(open_["_conv"]), "left_anti")
    matrices = _each(
        long.join(open_, same, "left_semi").select("number", *AT, "symbols"),
        lambda number, part, chunk, symbols: (number, part, chunk, matrix(symbols).tobytes()), "number bigint, part int, chunk int, state binary",
    )
    named = stage(matrices.join(long.select(*AT, "conv_id"), AT))

    def times(later: bytes, earlier: bytes) -> bytes:
        return product(np.frombuffer(earlier, np.int64).reshape(4, 4), np.frombuffer(later, np.int64).reshape(4, 4)).tobytes()

    carried = exclusive_scan(named, ["conv_id"], "number", "state", times, reverse=True)
    met = carried.alias("c").join(
        long.select(*AT, "conv_id", "number").alias("l"), F.expr("c.number = l.number AND c.conv_id <=> l.conv_id")
    ).filter("c.carry IS NOT NULL").select("l.part", "l.chunk", "c.carry")

    def through(part, chunk, carry):
        to_end = np.frombuffer(carry, np.int64).reshape(4, 4) + np.array(END, np.int64)
        return part, chunk, normal(to_end.min(1).tolist())

    return known.select(*AT, F.col("used").alias("behind")).unionByName(_each(met, through, "part int, chunk int, behind array<int>"))


def entries(chunks: DataFrame, places: DataFrame, behind: DataFrame) -> DataFrame:
    """The place at which each chunk of a long conversation is entered: ``part, chunk, entry``."""
    long = places.filter(F.col("of") > 1).select("conv_id", "number", *AT).join(chunks.select(*AT, "symbols"), AT).join(behind, AT, "left")

    def leads(number, part, chunk, symbols, vector):
        vectors = backward(symbols, tuple(vector or END))
        return number, part, chunk, bytes(trace(symbols, vectors, place, vector is None)[1] for place in range(4))

    maps = _each(long.select("number", *AT, "symbols", "behind"), leads, "number bigint, part int, chunk int, state binary")
    named = stage(maps.join(places.select(*AT, "conv_id"), AT))
    carried = exclusive_scan(named, ["conv_id"], "number", "state", lambda a, b: bytes(b[place] for place in a))
    met = carried.alias("c").join(named.select(*AT, "conv_id", "number").alias("l"), F.expr("c.number = l.number AND c.conv_id <=> l.conv_id"))
    # Every conversation begins at place 0.
    entry = F.when(F.col("c.carry").isNull(), 0).otherwise(F.conv(F.hex(F.substring("c.carry", 1, 1)), 16, 10).cast("int"))
    return met.select("l.part", "l.chunk", entry.alias("entry"))


EDIT_FIELDS = "conv_id {}, number bigint, part int, chunk int, seq int, edit string, row bigint, new_role string, cost int"


def edits(lean: DataFrame, chunk_rows: int = CHUNK_ROWS, fixups: int = FIXUPS) -> tuple[DataFrame, DataFrame]:
    """The least edits, one row per edit (EDIT_FIELDS; inserted rows have no ``row``), and ``conv_id, illegal`` per chunk; both staged."""
    chunks = chunked(lean, chunk_rows)
    places = stage(placed(chunks))
    known = chunks.select("conv_id", *AT, "symbols", "rows").join(places.select(*AT, "number", "of"), AT)
    if places.filter(F.col("of") > 1).isEmpty():
        joined = known.select("*", F.lit(None).cast("array<int>").alias("behind"), F.lit(0).alias("entry"))
    else:
        behind = stage(end_vectors(chunks, places, fixups))
        joined = known.join(behind, AT, "left").join(entries(chunks, places, behind), AT, "left")
    kind = dict(chunks.dtypes)["conv_id"]

    def run(batches):
        for batch in batches:
            out, size = [], 0
            for conv, number, part, chunk, symbols, rows, vector, entry in zip(*[c.to_pylist() for c in batch.columns]):
                found, _ = trace(symbols, backward(symbols, tuple(vector or END)), entry or 0, vector is None)
                for seq, edit in enumerate(found):
                    letter, row, role = edit
                    out.append((conv, number, part, chunk, seq, letter, rows[row] if row >= 0 else None, role, cost_of([edit], symbols)))
                if len(out) > 8192:
                    yield table(out, batch.schema.field("conv_id").type)
                    out = []
            if out:
                yield table(out, batch.schema.field("conv_id").type)

    def table(out, conv_type):
        types = [conv_type, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int32()]
        names = ["conv_id", "number", "part", "chunk", "seq", "edit", "row", "new_role", "cost"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    found = joined.select("conv_id", "number", *AT, "symbols", "rows", "behind", "entry").mapInArrow(run, EDIT_FIELDS.format(kind))
    return stage(found), places.select("conv_id", "illegal")


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with a number of their own, fixed by staging."""
    space = F.lit(" ")
    return stage(rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.monotonically_increasing_id().alias("row")))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Every edit with the row it leaves: ``conv_id, number, seq, edit, cost, role, text``; role and text are null for deleted rows."""
    with_row = found.filter(F.col("row").isNotNull()).join(rows.select("row", F.col("role").alias("_role"), F.col("text").alias("_text")), "row")
    stays = F.col("edit") != "D"
    columns = ["conv_id", "number", "seq", "edit", "cost"]
    old = with_row.select(*columns, F.when(stays, F.coalesce("new_role", "_role")).alias("role"), F.when(stays, F.col("_text")).alias("text"))
    new = found.filter(F.col("row").isNull()).select(*columns, F.col("new_role").alias("role"), F.lit("").alias("text"))
    return old.unionByName(new)


def written(edited: DataFrame) -> DataFrame:
    """``conv_id, cost, audit, repaired_sha256``. A digest runs through a conversation in order, so one task streams each; it holds a batch."""
    kind = dict(edited.dtypes)["conv_id"]
    columns = ["conv_id", "edit", "cost", "role", "text"]
    ordered = edited.repartition("conv_id").sortWithinPartitions("conv_id", "number", "seq").select(*columns)

    def run(batches):
        current, conv_type = None, None

        def result():
            (conv,), total, letters, sha, _ = current
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], conv_type), pa.array([total]), pa.array(["".join(letters)]), pa.array([sha.hexdigest()])],
                ["conv_id", "cost", "audit", "repaired_sha256"],
            )

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for conv, edit, cost, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if current is None or current[0] != (conv,):
                    if current:
                        yield result()
                    current = [(conv,), 0, [], hashlib.sha256(), False]
                current[1] += cost
                current[2].append(edit)
                if role is not None:
                    current[3].update((("\n" if current[4] else "") + f"{role}:{text}").encode())
                    current[4] = True
        if current:
            yield result()

    return ordered.mapInArrow(run, f"conv_id {kind}, cost bigint, audit string, repaired_sha256 string")


def repair(rows: DataFrame, all_ids: DataFrame | None = None, chunk_rows: int = CHUNK_ROWS, fixups: int = FIXUPS) -> DataFrame:
    """One row per conversation of ``rows`` and of ``all_ids``:
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    rows = numbered(rows)
    lean = stage(marked(rows))
    found, illegal = edits(lean, chunk_rows, fixups)

    def of(state):
        return F.sum((F.col("state") == state).cast("bigint"))

    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = lean.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"), of(BLANK).alias("blank"), of(DUPLICATE).alias("duplicate"), of(TRUNCATED).alias("truncated")
    )
    parts = [counts, illegal, written(repaired(rows, found))] + ([all_ids.select("conv_id").distinct()] if all_ids is not None else [])
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    zero = F.lit(0).cast("bigint")
    # Grouping keeps null apart as a value, which a join would not.
    sums = [F.coalesce(F.sum(c), zero).alias(c) for c in ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]]
    nothing = hashlib.sha256(b"").hexdigest()
    return stacked.groupBy("conv_id").agg(*sums, F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"))
