"""Repaired conversations against a plain forward program over (cost, letters)."""

import hashlib
import random
import re
import zlib

import pytest

from merchantlake.llm import conversation_repair as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NEXT, FULL = {"0": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}


def put(best, state, value):
    if state not in best or value[:2] < best[state][:2]:
        best[state] = value


def with_inserts(best):
    for _ in range(3):
        for q, (cost, letters, lines) in list(best.items()):
            put(best, NEXT[q], (cost + 3, letters + "I", [*lines, FULL[NEXT[q]] + ":"]))


def cheapest(rows, faults):
    best = {"0": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        with_inserts(best)
        new = {}
        for q, (cost, letters, lines) in best.items():
            put(new, q, (cost + 4, letters + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            if role[:1] == NEXT[q] or q == "0" and role[:1] == "s":
                put(new, role[:1], (cost + more, letters + "K", [*lines, f"{role}:{text}"]))
            put(new, NEXT[q], (cost + 3 + more, letters + "R", [*lines, f"{FULL[NEXT[q]]}:{text}"]))
        best = new
    with_inserts(best)
    return min(best[q] for q in ("0", "a") if q in best)


def brute(rows):
    conversations = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        held = conversations.setdefault(conv, [])
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm:
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            held += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    out = []
    for conv, held in conversations.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in held:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in held if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, letters, lines = cheapest(held, faults)
        out.append((conv, gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed):
    r = random.Random(seed)
    rows = []
    for conv in [*range(150), None]:
        for turn in range(r.randrange(1, 14)):
            for _ in range(r.choice([1, 1, 1, 2])):
                role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
                rows.append((conv, r.choice([turn, turn, turn, turn + 1, None, turn * 2]), role, r.choice(["a.", "b", "c!", " ", "x. ", None, "d?\n", "é", "~" * 3000])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, rows, seed):
    given = conversations(seed)
    df = spark.createDataFrame(given, SCHEMA).repartition(5)
    assert rows(C.repaired(df)) == brute(given)


def test_long_runs(spark, rows):
    """Hundreds of equal rows, of rows of one role, and of rows without an end."""
    given = [(1, 5, "user", "same.")] * 500 + [(2, k, "user", f"same {k}.") for k in range(300)] + [(3, k, "assistant", f"same {k}") for k in range(200)]
    given += [(4, k, "system", f"{k}!") for k in range(50)] + [(5, None, "tool", f"{k}.") for k in range(60)]
    assert rows(C.repaired(spark.createDataFrame(given, SCHEMA).repartition(3))) == brute(given)


def test_powers_equal_single_steps():
    for symbol in (("u", 0), ("a", 3), ("s", 0), ("t", 0), ("u", 2)):
        costs = C._inserts()[:, list(C.FINAL)].min(axis=1)
        stepped = costs
        for n in range(1, 40):
            stepped = (C.power(symbol, 0) + stepped).min(axis=1)
            assert (C.advanced(symbol, n, costs) == stepped).all(), (symbol, n)


def test_a_conversation_that_loses_all_rows_and_an_empty_table(spark, rows):
    lost = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 0, "user", "Hello.")], SCHEMA)
    assert rows(C.repaired(df)) == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert C.repaired(df.where("false")).count() == 0


def test_columns_with_clashing_names_and_text_ids(spark, rows):
    from pyspark.sql import functions as F

    given = [(str(c), t, r, x) for c, t, r, x in conversations(4) if c is not None]
    df = spark.createDataFrame(given, SCHEMA.replace("conv_id bigint", "conv_id string"))
    more = df.withColumns({c: F.lit("x") for c in ("conv", "key", "times", "fault", "digest", "first", "audit", "cost")})
    assert rows(C.repaired(more)) == brute(given)
