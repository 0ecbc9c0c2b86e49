"""Repaired conversations against plain search over single rows."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import conversation_repair as R

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def cheapest(rows):
    """Best-first search over (cost, audit); a row is (initial, must go, truncated)."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if (i, q) in seen:
            continue
        seen.add((i, q))
        if i == len(rows) and q in ("", "a"):
            return cost, audit
        if i < len(rows):
            initial, must_go, late = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q))
            if not must_go:
                if (q, initial) in NEXT:
                    heapq.heappush(heap, (cost + 5 * late, audit + "K", i + 1, NEXT[q, initial]))
                for other in "ua":
                    if (q, other) in NEXT:
                        heapq.heappush(heap, (cost + 1 + 5 * late, audit + "R", i + 1, NEXT[q, other]))
        for other in "ua":
            if (q, other) in NEXT:
                heapq.heappush(heap, (cost + 5, audit + "I", i, NEXT[q, other]))


def plain(conversations):
    out, by_id = {}, {}
    for c, t, role, text in conversations:
        by_id.setdefault(c, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        fate = zlib.crc32(key.encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        by_id[c] += [(t, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    for c, rows in by_id.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults, symbols = set(), [], []
        for _, role, text in rows:
            ink = text.strip(" \t\n\v\f\r")
            faults.append("blank" if not ink else "duplicate" if (role, text) in seen else
                          "truncated" if ink[-1] not in ".!?" else "")
            symbols.append((role[:1], faults[-1] in ("blank", "duplicate"), faults[-1] == "truncated"))
            seen.add((role, text))
        cost, audit = cheapest(symbols)
        lines, i = [], 0
        kept = sum(e in "KRI" for e in audit)
        for e in audit:
            wanted = "assistant" if (kept - len(lines)) % 2 else "user"
            if e == "K":
                lines.append(f"{rows[i][1]}:{rows[i][2]}")
            elif e == "R":
                lines.append(f"{wanted}:{rows[i][2]}")
            elif e == "I":
                lines.append(f"{wanted}:")
            i += e != "I"
        turns = [r[0] for r in rows if r[0] is not None]
        out[c] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in (
                "blank", "duplicate", "truncated")],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(rows, **options):
    return {r[0]: tuple(r[1:]) for r in R.repair(R.damaged(rows), rows, **options).collect()}


def test_matrices_agree_with_search():
    draw = random.Random(1)
    sequences = ["".join(draw.choices(R.SYMBOLS, k=draw.randrange(0, 14))) for _ in range(300)]
    sequences += ["u" * 50, "ua" * 40, "d" * 9, "sS" * 20]
    for s, m in zip(sequences, R.evaluate(sequences), strict=True):
        whole = R.times(m, R.INSERTED)[R.START]
        cost, audit = min((c, R.rope_text(r)) for q, (c, r) in whole.items() if q in R.ENDS)
        rows = [(c.lower(), c == R.DELETED, c.isupper()) for c in s]
        assert (cost, audit) == cheapest(rows), s


def test_grammar_expands_to_the_sequences():
    draw = random.Random(2)
    sequences = [np.array(draw.choices(range(9), [5, 3, 9, 9, 1, 1, 1, 1, 1], k=n), np.int64) for n in (0, 1, 2, 700)]
    sequences.append(np.full(33, 2))
    rules, short = R.re_pair(sequences)

    def expand(x):
        return [x] if x < len(R.SYMBOLS) else [y for side in rules[x - len(R.SYMBOLS)] for y in expand(side)]

    for s, compressed in zip(sequences, short, strict=True):
        assert [y for x in compressed for y in expand(int(x))] == s.tolist()
    assert len(rules) > 20 and sum(map(len, short)) < 450
    left = [(int(a), int(b)) for s in short for a, b in zip(s, s[1:])]
    assert all(left.count(p) < 2 or p[0] == p[1] for p in left)


def test_whole_table_agrees_with_search(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert got(rows) == plain([(r.conv_id, r.turn, r.role, r.text) for r in rows.collect()])


@pytest.mark.parametrize("slices", [1, 7])
def test_long_conversations_and_odd_rows(spark, slices, monkeypatch):
    draw = random.Random(3)
    roles = ["user", "assistant", "system", "unknown", "tool", "", None, "User"]
    texts = ["Yes.", "No", "", " \t", None, "What? ", "Fine!\n", "é…", "long " * 2000 + "."]
    rows = [(c, draw.choice([None, *range(40)]), draw.choices(roles, [9, 9, 2, 1, 1, 1, 1, 1])[0],
             draw.choice(texts) if draw.random() < 0.4 else f"text {i}" + draw.choice(["", ".", "?"]))
            for i, c in enumerate(draw.choices([1, 2, 3, None, 9], [300, 30, 5, 9, 1], k=800))]
    rows += rows[:40] + [(4, None, "user", "x."), (5, 3, None, None), (77, 1, "user", "same.")] + [(6, 1, "user", "same.")] * 50
    monkeypatch.setattr(R, "SEGMENT", 16)
    monkeypatch.setattr(R, "CHUNK", 3000)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit(c) for c in ("n", "key", "seq", "sid", "line", "kept", "matrix")}).repartition(5)
    assert got(table, slices=slices) == plain(rows)


def test_text_ids_and_empty_tables(spark):
    rows = [("a", 0, "user", "Hi."), ("a", 1, "assistant", "Yes."), (None, 0, "user", "Alone.")]
    table = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert got(table) == plain(rows)
    assert got(table.limit(0)) == {}


def test_conversation_without_rows_after_the_damage(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert got(rows) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
