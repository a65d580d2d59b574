from __future__ import annotations

import functools
import hashlib
import random
import sys

import pytest

from etoile.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, part int, kind string, symbols string, row long"
TEXTS = [None, "", " \n", "Yes.", "No!", "what", "a b? ", "é.", "long " * 3000 + "."]
ROLES = ["user", "assistant", "system", "tool", None, "", "u", "user", "assistant"]


sys.setrecursionlimit(20_000)


def best(rows):
    """(cost, audit, repaired rows) from the definition: every way, the least by cost, then letters."""
    follows = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    name = {2: "user", 3: "assistant"}

    @functools.cache
    def go(i, state, room):
        ways = []
        if i == len(rows) and state in (0, 3):
            ways.append((0, "", ()))
        if room:
            for to in (s for s in follows[state].values() if s in name):
                c, a, t = go(i, to, room - 1)
                ways.append((c + 3, "I" + a, (f"{name[to]}:", *t)))
        if i < len(rows):
            role, text, gone, cut = rows[i]
            c, a, t = go(i + 1, state, 6)
            ways.append((c + 4, "D" + a, t))
            if not gone:
                to = follows[state].get(role[:1])
                if to:
                    c, a, t = go(i + 1, to, 6)
                    ways.append((c + 3 * cut, "K" + a, (f"{role}:{text}", *t)))
                for to in (s for s in follows[state].values() if s in name):
                    c, a, t = go(i + 1, to, 6)
                    ways.append((c + 3 + 3 * cut, "R" + a, (f"{name[to]}:{text}", *t)))
        return min(ways, default=(10 ** 9, "", ()))
    return go(0, 0, 6)


def brute(rows, convs):
    out = []
    for conv in convs:
        own = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        key = f"\n" if conv is None else f"={conv}\n"
        own.sort(key=lambda o: (o[0] is not None, o[0] or 0, o[1].encode(), o[2][:cv.LEAD].encode(),
                                hashlib.sha256(f"{key}{len(o[1].encode())}:{o[1]}{o[2]}".encode()).hexdigest()))
        seen, faults, marked = set(), [0, 0, 0], []
        for _, r, x in own:
            bare = x.strip(cv.SPACE)
            fault = 0 if not bare else 1 if (r, x) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((r, x))
            if fault is not None:
                faults[fault] += 1
            marked.append((r, x, fault in (0, 1), fault == 2))
        turns = [t for t, _, _ in own if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, text = best(tuple(marked))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults, illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)


def found(spark, rows, convs, parts=5):
    listed = spark.createDataFrame([(c, 1) for c in [*convs, *convs]], "conv_id long, part int")
    return sorted((tuple(r) for r in cv.report(cv.repair(frame(spark, rows).repartition(parts), listed)).collect()), key=str)


def some_rows(seed, convs=40, most=9):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(convs), None]:
        rows += [(c, rnd.choice([t, t, t, 2 * t, 0, None]), rnd.choice(ROLES), rnd.choice(TEXTS)) for t in range(rnd.randint(0, most))]
    return rows + rows[:20]


def test_equals_brute_force(spark):
    rows = some_rows(1)
    convs = [*range(45), None]                                # some have no rows
    assert found(spark, rows, convs) == brute(rows, convs)


@pytest.mark.parametrize("piece, size", [(1, 1 << 22), (3, 1 << 22), (100, 40)])
def test_long_conversations_in_many_pieces(spark, monkeypatch, piece, size):
    monkeypatch.setattr(cv, "PIECE_ROWS", piece)
    monkeypatch.setattr(cv, "PIECE_BYTES", size)
    rnd = random.Random(piece)
    rows = some_rows(2, 8) + [(100, t, rnd.choice(ROLES[:3]), rnd.choice(["Yes.", f"n{t}.", "what"])) for t in range(150)]     # most rows in one
    assert found(spark, rows, [*range(8), None, 100], 7) == brute(rows, [*range(8), None, 100])


def test_empty_table_and_conversations_without_rows(spark):
    assert found(spark, [], []) == []
    nothing = hashlib.sha256(b"").hexdigest()
    assert found(spark, [], [3]) == [(3, 0, 0, 0, 0, 0, 0, "", nothing)]
    assert cv.report(cv.repair(frame(spark, [(1, 0, "user", "Hi.")]))).collect()[0].audit == "KI"


@pytest.mark.parametrize("block", [1, 2, 4])
def test_block_tables_equal_single_steps(monkeypatch, block):
    monkeypatch.setattr(cv, "BLOCK", block)
    cv.tables.cache_clear()
    rnd = random.Random(block)
    initials = ["system", "user", "assistant", "tool"]
    for n in [*range(8), 33]:
        for _ in range(20):
            symbols = bytes(rnd.randrange(cv.SYMBOLS) for _ in range(n))
            rows = tuple((initials[(s - 1) // 2] if s else "user", "x", s == 0, s > 0 and s % 2 == 0) for s in symbols)
            letters, state = "", cv.START
            for edits, _, state in cv.trace(symbols, 0, state):
                letters += edits
            assert letters + "I" * len(cv.closing(state)[0]) == best(rows)[1]
    cv.tables.cache_clear()
    assert len(cv.tables().vectors) == 30
