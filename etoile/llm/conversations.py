"""Operator 12, conversation structure repair: cheapest edits by Four-Russians block tables.

A conversation should be nothing, or an optional system turn and then pairs of user and assistant turns, by the initials of the roles: ``(s?(ua)+)?``. Rows may be kept (0), given the role
user or assistant (3), deleted (4; blank rows and repetitions must be), and empty user or assistant turns inserted (3). A truncated row that is not deleted adds 3. Of the cheapest edits those
whose initials (Delete, Insert, Keep, Rerole) come first in ASCII are taken.

*Method.* A row is one of nine symbols (must go; or role's initial s, u, a, other, with or without truncation). ``G(i)`` holds, for each of four states (what stands before: nothing, system,
user, assistant), the cost of finishing from row i on. Less its smallest number it is one of a few dozen vectors (``tables`` finds all of them). The transition of every vector by every block of
``BLOCK`` symbols is precomputed, so the pass from the end looks up one block at a time and stores a vector at the blocks' borders only. Tracing goes forward: each block is expanded backward from its stored vector
to the single rows, and the first letter that keeps to the cheapest cost is taken; it fixes the next state, so ties are safe.

*Plan.* Rows are sorted once over ranges of (conversation, turn) and packed into pieces: a conversation, or a part of it of at most ``PIECE_ROWS`` rows or about ``PIECE_BYTES`` of text. Blocks compose, so a piece
that its neighbours continue sends a summary (vector and state after it, for each vector and state before it: 300 bytes), and the summaries of a conversation are chained: vectors backward, states
forward. Then all pieces are traced on their own: a conversation with a third of all rows is many pieces. Repetitions are found by grouping hashes (combined before the exchange) and marked by rows that sort right behind
the repeated one, so the texts move once. Digests of whole conversations (``report``) stream over the pieces in order and hold only the hash's state; SHA-256 allows no other way.

*Rules.* Null roles and texts are one space. A null ``conv_id`` is a conversation. Rows go by turn (nulls first), those of one turn by role, the text's first ``LEAD`` characters and its hash; equal rows are
alike. A row's first fault counts: blank (no character but space and 0x09-0x0D), duplicate (an earlier row of the conversation has the same role and text), truncated (the last such character is none of ``.!?``).
Texts of any length are whole. An empty table gives an empty result; a conversation without rows has zeros, no edits and no text. Other columns may have any name and are left out.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etoile.session import materialize

BLOCK = 4                             # symbols looked up together
PIECE_ROWS, PIECE_BYTES = 1 << 14, 1 << 22
LEAD = 64
SPACE = " \t\n\x0b\x0c\r"
DELETE, CHANGE, INSERT, TRUNCATED = 4, 3, 3, 3
ROLES = "sua"                         # initials with a meaning; any other is the fourth
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]      # states after a row of this initial
MADE = [USER, USER, ASSISTANT, USER]                                                  # the state after an inserted or changed row
NAME = {USER: "user", ASSISTANT: "assistant"}
SYMBOLS = 9


def symbol(must_go: bool, role: str, truncated: bool) -> int:
    return 0 if must_go else 1 + 2 * (ROLES.find(role[:1]) if role[:1] and role[:1] in ROLES else 3) + truncated


def _inserted(g: list[int]) -> tuple[int, ...]:
    """Costs when rows may be inserted first: at most three in a row can help."""
    for _ in range(3):
        g = [min(g[s], INSERT + g[MADE[s]]) for s in range(4)]
    return tuple(g)


def _step(after: tuple[int, ...], sym: int) -> tuple[int, ...]:
    """Costs before a row, from those after it."""
    if sym == 0:
        return _inserted([DELETE + g for g in after])
    initial, extra = (ROLES + "-")[(sym - 1) // 2], TRUNCATED * ((sym - 1) % 2)
    costs = []
    for s in range(4):
        ways = [DELETE + after[s], CHANGE + extra + after[MADE[s]]]
        if initial in FOLLOWS[s]:
            ways.append(extra + after[FOLLOWS[s][initial]])
        costs.append(min(ways))
    return _inserted(costs)


@dataclass
class Tables:
    """``to[v * SYMBOLS + sym]``: the vector before a row; ``blocks``: before a block of BLOCK rows; ``edits``: per vector after, symbol and state."""
    vectors: list
    to: list
    blocks: list
    edits: list


@functools.cache
def tables() -> Tables:
    big = 1 << 20
    end = _inserted([0, big, big, 0])
    vectors, number = [end], {end: 0}
    to, gain = [], []
    for v in vectors:                                          # grows while new vectors turn up
        for sym in range(SYMBOLS):
            g = _step(v, sym)
            least = min(g)
            norm = tuple(x - least for x in g)
            if norm not in number:
                number[norm] = len(vectors)
                vectors.append(norm)
            to.append(number[norm])
            gain.append(least)
    blocks, width = to, SYMBOLS
    for _ in range(BLOCK - 1):                                 # one more row in front of every block
        blocks = [to[blocks[v * width + b] * SYMBOLS + sym] for v in range(len(vectors)) for sym in range(SYMBOLS) for b in range(width)]
        width *= SYMBOLS
    edits = [_edits(vectors, v, to[v * SYMBOLS + sym], gain[v * SYMBOLS + sym], sym, s) for v in range(len(vectors)) for sym in range(SYMBOLS) for s in range(4)]
    return Tables(vectors, to, blocks, edits)


def _edits(vectors, after: int, before: int, gain: int, sym: int, state: int) -> tuple[str, tuple[str, ...], int]:
    """From a state before a row: the letters up to the row's own, the roles inserted and (for R) given, the state behind it."""
    letters, roles, h = "", [], vectors[after]
    initial, extra = ((ROLES + "-")[(sym - 1) // 2], TRUNCATED * ((sym - 1) % 2)) if sym else ("", 0)
    while True:
        cost = vectors[before][state] + gain
        if DELETE + h[state] == cost:
            return letters + "D", tuple(roles), state
        if INSERT + vectors[before][MADE[state]] + gain == cost:
            letters, state = letters + "I", MADE[state]
            roles.append(NAME[state])
        elif sym and initial in FOLLOWS[state] and extra + h[FOLLOWS[state][initial]] == cost:
            return letters + "K", tuple(roles), FOLLOWS[state][initial]
        else:
            return letters + "R", (*roles, NAME[MADE[state]]), MADE[state]


def borders(symbols: bytes, after: int) -> list[int]:
    """Vectors at the blocks' ends, the last one (``after`` the symbols) included; entry 0 is before the first block."""
    t, whole = tables(), len(symbols) // BLOCK * BLOCK
    width, v = SYMBOLS ** BLOCK, after
    for sym in reversed(symbols[whole:]):
        v = t.to[v * SYMBOLS + sym]
    out = [v]
    for i in range(whole - BLOCK, -1, -BLOCK):
        code = 0
        for sym in symbols[i:i + BLOCK]:
            code = code * SYMBOLS + sym
        v = t.blocks[v * width + code]
        out.append(v)
    return out[::-1]


def trace(symbols: bytes, after: int, state: int):
    """Edits of every row in turn, as in ``Tables.edits``: blocks are expanded backward from the vector at their end."""
    t, ends = tables(), borders(symbols, after)
    for n, i in enumerate(range(0, len(symbols), BLOCK)):
        block = symbols[i:i + BLOCK]
        v, inner = (ends[n + 1] if len(block) == BLOCK else after), []
        for sym in reversed(block):
            inner.append(v)
            v = t.to[v * SYMBOLS + sym]
        for sym, v in zip(block, reversed(inner)):
            edit = t.edits[(v * SYMBOLS + sym) * 4 + state]
            state = edit[2]
            yield edit


def closing(state: int) -> tuple[list[str], int]:
    """Roles inserted behind the last row, and the state then."""
    roles = []
    while state in (SYSTEM, USER):
        state = MADE[state]
        roles.append(NAME[state])
    return roles, state


# ------------------------------------------------------------------ rows, in order, as pieces

def _faults(rows: DataFrame) -> DataFrame:
    """Rows with their faults, hash and number; written once."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    key = F.concat(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")), F.lit("\n"), F.octet_length("role"), F.lit(":"), "role", "text")
    return materialize(rows.select("*", (F.length(last) == 0).alias("blank"), (~last.isin(*".!?")).alias("cut"), F.sha2(key, 256).alias("said"),
                                   F.monotonically_increasing_id().alias("row")), "conversation-rows")


def _repeated(rows: DataFrame) -> DataFrame:
    """Rows that say what an earlier one of the conversation says: all but the first by turn."""
    light = rows.where("not blank").select("conv_id", "turn", "role", F.substring("text", 1, LEAD).alias("lead"), "said", "row")
    first = light.groupBy("said").agg(F.min(F.struct("turn", "row")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return light.join(first, "said").where("row <> first.row")


KIND_HEAD, KIND_ROW, KIND_MARK = 0, 1, 2


def pieces(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """Conversations in pieces, each a row: conv_id, part and seq (their order), starts, goes_on, and lists of turns, roles, texts and symbols.

    ``starts``: nothing of the conversation is before; ``goes_on``: something may follow.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    whole = _faults(rows)
    lead = F.substring("text", 1, LEAD).alias("lead")
    items = whole.select("conv_id", F.lit(1).alias("is_row"), "turn", "role", lead, "said", "row", F.lit(KIND_ROW).alias("kind"), "text", "blank", "cut")
    marks = _repeated(whole).select("conv_id", F.lit(1).alias("is_row"), "turn", "role", "lead", "said", "row", F.lit(KIND_MARK).alias("kind"))
    heads = conversations.select(F.col("conv_id").cast(kind).alias("conv_id")).distinct().select("conv_id", F.lit(0).alias("is_row"), F.lit(KIND_HEAD).alias("kind"))
    every = items.unionByName(marks, allowMissingColumns=True).unionByName(heads, allowMissingColumns=True)
    order = ["conv_id", "is_row", "turn", "role", "lead", "said", "row"]
    ordered = every.repartitionByRange(*order).sortWithinPartitions(*order, "kind").select("conv_id", "turn", "role", "text", "blank", "cut", "kind")
    return materialize(ordered.mapInArrow(_pack, f"conv_id {kind}, part int, seq int, starts boolean, goes_on boolean, turns array<long>, roles array<string>, "
                                                 "texts array<string>, symbols binary"), "conversation-pieces")


@dataclass
class _Piece:
    conv: object
    starts: bool
    turns: list = field(default_factory=list)
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)
    symbols: bytearray = field(default_factory=bytearray)
    size: int = 0


def _rows(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            yield from zip(*(c.to_pylist() for c in batch.slice(a, 512).columns))


class _Out:
    """Rows gathered into Arrow batches of a few megabytes."""

    def __init__(self, schema: pa.Schema, limit: int = PIECE_BYTES):
        self.schema, self.limit, self.rows, self.size = schema, limit, [], 0

    def add(self, row: tuple, size: int):
        self.rows.append(row)
        self.size += size + 100
        if self.size >= self.limit:
            yield from self.flush()

    def flush(self):
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
            self.rows, self.size = [], 0


def _pack(batches):
    part, seq, piece, out, batch = TaskContext.get().partitionId(), 0, None, None, None

    def closed(goes_on: bool):
        return (piece.conv, part, seq, piece.starts, goes_on, piece.turns, piece.roles, piece.texts, bytes(piece.symbols))

    def typed():
        for b in batches:
            nonlocal out
            if out is None:
                out = _Out(pa.schema([("conv_id", b.schema.field("conv_id").type), ("part", pa.int32()), ("seq", pa.int32()), ("starts", pa.bool_()), ("goes_on", pa.bool_()),
                                      ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("symbols", pa.binary())]))
            yield b
    for conv, turn, role, text, blank, cut, kind in _rows(typed()):
        if kind == KIND_MARK:                                  # of the row before it
            piece.symbols[-1] = symbol(True, "", False)
            continue
        if piece is None or piece.conv != conv or kind == KIND_HEAD:
            if piece is not None:
                yield from out.add(closed(False), piece.size)
                seq += 1
            piece = _Piece(conv, kind == KIND_HEAD)
        elif len(piece.turns) >= PIECE_ROWS or piece.size >= PIECE_BYTES:
            yield from out.add(closed(True), piece.size)
            seq, piece = seq + 1, _Piece(conv, False)
        if kind == KIND_ROW:
            piece.turns.append(turn)
            piece.roles.append(role)
            piece.texts.append(text)
            piece.symbols.append(symbol(blank, role, cut))
            piece.size += len(text) + 50
    if piece is not None:
        yield from out.add(closed(True), piece.size)           # the next partition may begin with more of it
        yield from out.flush()


# ------------------------------------------------------------------ pieces of one conversation, chained

def _summaries(batches):
    """For each piece: vector before it per vector after it; state after it per vector after and state before; its outer rows."""
    n = len(tables().vectors)
    for batch in batches:
        out = []
        for conv, part, seq, turns, roles, symbols in _rows([batch]):
            to = bytes(borders(symbols, v)[0] for v in range(n))
            states = bytearray()
            for v in range(n):
                for s in range(4):
                    for *_, s in trace(symbols, v, s):
                        pass
                    states.append(s)
            some = bool(turns)
            out.append((conv, part, seq, to, bytes(states), some, roles[-1][:1] if some else None, str(turns[-1]) if some and turns[-1] is not None else None))
        if out:
            types = [batch.schema.field("conv_id").type, pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.bool_(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["conv_id", "part", "seq", "vectors", "states", "some", "initial", "turn"])


def _chained(group: pd.DataFrame) -> pd.DataFrame:
    """What each piece of a conversation needs to know of the others: vector after it, state before it, the row before it, whether it is the last."""
    group = group.sort_values(["part", "seq"])
    after, v = [], 0
    for to in reversed(group["vectors"].tolist()):
        after.append(v)
        v = to[v]
    after.reverse()
    state, previous, rows = START, (None, None), []
    for v, states, some, initial, turn in zip(after, group["states"], group["some"], group["initial"], group["turn"]):
        rows.append((v, state, *previous))
        state = states[v * 4 + state]
        if some:
            previous = (initial, turn)
    out = pd.DataFrame(rows, columns=["after", "state", "initial_before", "turn_before"], index=group.index)
    out["last"] = [False] * (len(out) - 1) + [True]
    return pd.concat([group[["part", "seq"]], out], axis=1)


REPAIRED = ("part int, seq int, single boolean, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, roles array<string>, texts array<string>")


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Repaired conversations in pieces: conv_id, part, seq, roles and texts in order, audit, cost, counts of faults; ``single``: the piece is all of it.

    ``conversations``: conv_id of all that are to be reported, with or without rows (default: those of ``rows``).
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    packed = pieces(rows, rows.select("conv_id") if conversations is None else conversations)
    open_ended = packed.where("goes_on or not starts")
    summaries = open_ended.select("conv_id", "part", "seq", "turns", "roles", "symbols").mapInArrow(
        _summaries, f"conv_id {kind}, part int, seq int, vectors binary, states binary, some boolean, initial string, turn string")
    chain = summaries.groupBy("conv_id").applyInPandas(_chained, "part int, seq int, after int, state int, initial_before string, turn_before string, last boolean")
    asked = packed.join(chain, ["part", "seq"], "left").select("conv_id", "part", "seq", "turns", "roles", "texts", "symbols", "after", "state", "initial_before", "turn_before", "last")
    return asked.mapInArrow(_repair, f"conv_id {kind}, {REPAIRED}")


LEGAL = ("su", "ua", "au")


def _repair(batches):
    out = None
    for batch in batches:
        if out is None:
            t = pa.int64()
            out = _Out(pa.schema([("conv_id", batch.schema.field("conv_id").type), ("part", pa.int32()), ("seq", pa.int32()), ("single", pa.bool_()), ("first_turn", t), ("last_turn", t),
                                  ("turns", t), ("blank", t), ("duplicate", t), ("truncated", t), ("illegal", t), ("cost", t), ("audit", pa.string()),
                                  ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]))
        for conv, part, seq, turns, roles, texts, symbols, after, state, initial, turn, last in _rows([batch]):
            alone = after is None
            letters, new_roles, new_texts, cost = [], [], [], 0
            for role, text, sym, (edits, given, behind) in zip(roles, texts, symbols, trace(symbols, after or 0, state or START)):
                own = edits[-1]
                letters.append(edits)
                inserted = given[:-1] if own == "R" else given
                new_roles += inserted
                new_texts += [""] * len(inserted)
                cost += INSERT * len(inserted) + (DELETE if own == "D" else (own == "R") * CHANGE + (sym % 2 == 0) * TRUNCATED)
                if own != "D":
                    new_roles.append(given[-1] if own == "R" else role)
                    new_texts.append(text)
                state = behind
            if alone or last:
                added, _ = closing(state or START)
                letters.append("I" * len(added))
                new_roles += added
                new_texts += [""] * len(added)
                cost += INSERT * len(added)
            known = [x for x in turns if x is not None]
            pairs = [initial, *(r[:1] for r in roles)] if initial is not None else [r[:1] for r in roles]
            distinct = len(set(known)) - (turn is not None and int(turn) in known[:1])
            blank = sum(not x.strip(SPACE) for x in texts)
            row = (conv, part, seq, alone, min(known, default=None), max(known, default=None), distinct, blank, symbols.count(0) - blank,
                   sum(s > 0 and s % 2 == 0 for s in symbols), sum(a + b not in LEGAL for a, b in zip(pairs, pairs[1:])), cost, "".join(letters), new_roles, new_texts)
            yield from out.add(row, sum(map(len, new_texts)) + 60 * len(new_texts))
    if out is not None:
        yield from out.flush()


# ------------------------------------------------------------------ one row per conversation

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _report(batches):
    """Pieces in order, those of a conversation together: one row each, holding only its sums, its letters and the hash's state."""
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    conv = spans = None

    def row():
        low, high, turns = spans
        return (conv, high - low + 1 - turns if low is not None else 0, *sums, "".join(audit), digest.hexdigest())
    out = None
    for batch in batches:
        if out is None:
            out = _Out(pa.schema([("conv_id", batch.schema.field("conv_id").type), *((n, pa.int64()) for n in names), ("audit", pa.string()), ("repaired_sha256", pa.string())]))
        for this, low, high, turns, *counts, letters, roles, texts in _rows([batch]):
            if spans is None or this != conv:
                if spans is not None:
                    yield from out.add(row(), len(audit))
                conv, spans, sums, audit, digest, begun = this, (None, None, 0), [0] * 5, [], hashlib.sha256(), False
            known = [x for x in (spans[0], low) if x is not None], [x for x in (spans[1], high) if x is not None]
            spans = (min(known[0], default=None), max(known[1], default=None), spans[2] + turns)
            sums = [a + b for a, b in zip(sums, counts)]
            audit.append(letters)
            for role, text in zip(roles, texts):
                digest.update(f"{chr(10) * begun}{role}:{text}".encode())
                begun = True
    if spans is not None:
        yield from out.add(row(), len(audit))
        yield from out.flush()


def report(repaired: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of ``repair``'s pieces, one row per conversation."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "roles", "texts"]
    repaired = materialize(repaired, "conversation-repaired")
    parts = repaired.where("not single").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").select(columns)
    schema = f"conv_id {kind}, {REPORT}"
    return repaired.where("single").select(columns).mapInArrow(_report, schema).unionByName(parts.mapInArrow(_report, schema))
