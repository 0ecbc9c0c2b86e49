"""Repair of conversation structure by dynamic programming over grammar-compressed sequences.

A conversation's rows become a sequence of symbols, each a role's initial and a fault. The cheapest edits that leave a
sequence of role initials like ``(s?(ua)+)?`` are found by products of min-plus matrices over four states (nothing yet,
after system, user, assistant): an entry holds the least cost of going from one state to another and, as a rope, the
edits that do so. Sequences are compressed by Re-Pair: a pair of symbols that occurs often becomes a rule, whose matrix is
worked out once, bottom-up, from those of its two sides and serves every conversation in which the rule occurs.

In Spark: rows without their texts are counted by content, marked, range-partitioned in order into slices and cut into
segments, so that a conversation of any length spreads over slices. Distinct sequences alone are compressed and
evaluated, in batches of bounded size; segments are joined with their matrices and a conversation only multiplies those
of its segments. Then texts and edits meet by content, are ordered once more, and every slice hashes the conversations
that lie inside it; only those across a slice's ends are put together from chunks. The audit and the digest of one
conversation are one string and one stream by definition, with one line a row and 1 MB a chunk.

Costs depend on the audit alone, so of two audits of equal cost neither begins with the other, and the least audit of
a whole is made of the least audits of its parts: the matrices' order (cost, then audit) is kept by products.

Defined cases: a null conversation id is a conversation of its own; null turns come first and count for no gap; rows of
one turn come by role, then by the MD5 of their text; rows that repeat in full follow each other and all but the first
are duplicates; an empty role has no initial and is part of no legal pair; a role other than the three can be kept if its
initial fits; a conversation without rows after the damage has zeros, an empty audit and the digest of the empty text; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.checkpoints import stored
from .common import bound_batches

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
# Where a role's initial leads from each state; the states in which a conversation may end.
MOVES = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ENDS = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
DELETED = "d"  # the symbol of a row that must go; others are an initial, upper-case for a truncated text
# Symbols of a segment, and of the distinct sequences that are compressed together.
SEGMENT, BATCH = 20_000, 200_000
ROWS_A_SLICE, CHUNK = 250_000, 1 << 20
# Characters up to which a rope is one string.
FLAT = 200

Rope = str | tuple
Matrix = list[dict[int, tuple[int, Rope]]]


def damaged(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``conv_id, turn, role, text, n``: the rows with their planted faults; ``n`` is 2 for a row that is repeated."""
    def or_blank(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(or_blank(conv_id), F.lit(":"), or_blank(turn)).cast("binary")) % 20
    changed = F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace(or_blank(text), "[.!?]", "")).otherwise(
        or_blank(text))
    return rows.filter(fate != 0).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.when(fate == 4, F.lit("user")).otherwise(or_blank(role)).alias("role"), changed.alias("text"),
        F.when(fate == 3, 2).otherwise(1).cast("long").alias("n"))


def rope_pieces(rope: Rope) -> Iterator[str]:
    left = [rope]
    while left:
        top = left.pop()
        if isinstance(top, str):
            yield top
        else:
            left += (top[1], top[0])


def rope_text(rope: Rope) -> str:
    return "".join(rope_pieces(rope))


def joined(a: Rope, b: Rope) -> Rope:
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= FLAT:
        return a + b
    return (a, b) if a and b else a or b


def comes_first(a: Rope, b: Rope) -> bool:
    """Whether the text of one rope sorts before that of another; shared pieces are passed over as they stand."""
    left, right, x, y = rope_pieces(a), rope_pieces(b), "", ""
    while True:
        x, y = x or next(left, ""), y or next(right, "")
        n = min(len(x), len(y))
        if not n:
            return len(x) < len(y)
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def better(new: tuple[int, Rope], old: tuple[int, Rope] | None) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and comes_first(new[1], old[1]))


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: the best edits through any state in between."""
    out: Matrix = []
    for row in a:
        best: dict[int, tuple[int, Rope]] = {}
        for middle, (cost, rope) in row.items():
            for end, (more, rest) in b[middle].items():
                known = best.get(end)
                if known is None or cost + more <= known[0]:
                    new = (cost + more, joined(rope, rest))
                    if better(new, known):
                        best[end] = new
        out.append(best)
    return out


def _either(*matrices: Matrix) -> Matrix:
    out: Matrix = [{} for _ in range(4)]
    for matrix in matrices:
        for best, row in zip(out, matrix):
            for end, entry in row.items():
                if better(entry, best.get(end)):
                    best[end] = entry
    return out


UNIT: Matrix = [{q: (0, "")} for q in range(4)]


def _insertions() -> Matrix:
    """Any number of inserted rows; three suffice to go from any state to any other that can be reached."""
    one: Matrix = [{move[q]: (INSERT_COST, INSERT) for move in (MOVES["u"], MOVES["a"]) if q in move} for q in range(4)]
    two = times(one, one)
    return _either(UNIT, one, two, times(two, one))


INSERTED = _insertions()


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions before a row, and what can be done with the row."""
    row: Matrix = [{q: (DELETE_COST, DELETE)} for q in range(4)]
    if symbol != DELETED:
        late = TRUNCATED_COST if symbol.isupper() else 0
        for q in range(4):
            for initial in "ua":
                if q in MOVES[initial]:
                    row[q][MOVES[initial][q]] = (REROLE_COST + late, REROLE)
            if q in MOVES.get(symbol.lower(), {}):
                row[q][MOVES[symbol.lower()][q]] = (late, KEEP)
    return times(INSERTED, row)


def symbol_of(initial: str, truncated: bool) -> str:
    known = initial if initial in MOVES else "x"
    return known.upper() if truncated else known


SYMBOLS = [DELETED, *"suax", *"SUAX"]


def re_pair(sequences: Sequence[np.ndarray]) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Rules ``(left, right)`` for the symbols from ``len(SYMBOLS)`` on, and the sequences written with them.

    The most frequent pair becomes a rule until none occurs twice. Pairs at least half as frequent whose occurrences cannot
    overlap (no symbol ends one and begins another) are replaced in the same round.
    """
    at = np.concatenate([np.append(s, -1) for s in sequences]) if sequences else np.empty(0, np.int64)
    rules: list[tuple[int, int]] = []
    while True:
        top = len(SYMBOLS) + len(rules)
        inside = (at[:-1] >= 0) & (at[1:] >= 0)
        pairs = np.where(inside, at[:-1] * top + at[1:], -1)
        found, n = np.unique(pairs[inside], return_counts=True)
        if not len(n) or n.max() < 2:
            break
        chosen, lefts, rights = [], set(), set()
        for place in np.argsort(-n, kind="stable"):
            left, right = divmod(int(found[place]), top)
            if n[place] < 2 or 2 * n[place] < n.max():
                break
            if left == right:
                if chosen:
                    continue
                chosen = [found[place]]
                break
            if left not in rights and right not in lefts:
                chosen.append(found[place])
                lefts.add(left)
                rights.add(right)
        order = np.sort(np.array(chosen))
        rank = np.searchsorted(order, pairs)
        rank[rank == len(order)] = 0
        here = np.flatnonzero(order[rank] == pairs)
        if order[0] // top == order[0] % top:  # of a run of equal symbols every other place begins a pair
            run = np.flatnonzero(np.diff(here, prepend=-2) != 1)
            offset = np.arange(len(here)) - np.repeat(run, np.diff(np.append(run, len(here))))
            here = here[offset % 2 == 0]
        rules += [(int(p) // top, int(p) % top) for p in order]
        at[here] = top + rank[here]
        at = np.delete(at, here + 1)
    cuts = np.flatnonzero(at < 0)
    return rules, [at[a:b] for a, b in zip(np.append(0, cuts[:-1] + 1), cuts)]


def evaluate(sequences: Sequence[str]) -> list[Matrix]:
    """The matrix of every sequence of symbols, by one grammar for all of them."""
    number = {s: i for i, s in enumerate(SYMBOLS)}
    rules, short = re_pair([np.array([number[c] for c in s], np.int64) for s in sequences])
    matrices = [symbol_matrix(s) for s in SYMBOLS]
    for left, right in rules:
        matrices.append(times(matrices[left], matrices[right]))
    out = []
    for s in short:
        whole = UNIT
        for symbol in s:
            whole = times(whole, matrices[symbol])
        out.append(whole)
    return out


def _matrices(sequences: DataFrame) -> DataFrame:
    """``seq`` and its ``matrix``: the entries ``(i, j, cost, audit)``."""
    entry = pa.struct([("i", pa.int32()), ("j", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    schema = pa.schema([("seq", pa.string()), ("matrix", pa.list_(entry))])

    def rows(held: list[str]) -> pa.RecordBatch:
        entries = [[{"i": i, "j": j, "cost": cost, "audit": rope_text(rope)} for i, row in enumerate(m)
                    for j, (cost, rope) in row.items()] for m in evaluate(held)]
        return pa.RecordBatch.from_arrays([pa.array(held), pa.array(entries, schema.field(1).type)], schema=schema)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for seq in batch.column(0).to_pylist():
                held.append(seq)
                size += len(seq)
                if size >= BATCH:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    return sequences.mapInArrow(compute, "seq string, matrix array<struct<i:int,j:int,cost:bigint,audit:string>>")


def _segments(rows: DataFrame, conv_type: str) -> DataFrame:
    """Cut sorted slices of rows into segments: their symbols, counts, and the rows themselves.

    A segment ends with its conversation, its slice, or when it is full; ``sid`` numbers segments in order.
    """
    kind = (f"sid long, conv_id {conv_type}, seq string, first string, last string, blank long, duplicate long, "
            "truncated long, illegal long, rows array<struct<turn:bigint,role:string,key:string,n:bigint>>")

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sid, held, conv, size = TaskContext.get().partitionId() << 32, [], None, 0
        schema = None

        def done() -> dict:
            symbols, illegal, before = [], 0, None
            blank = duplicate = truncated = 0
            for r in held:
                initial, n = r["role"][:1], r["n"]
                if r["blank"]:
                    blank += n
                else:
                    duplicate += n - r["fresh"]
                    truncated += r["fresh"] and r["truncated"]
                alive = r["fresh"] and not r["blank"]
                symbols.append(symbol_of(initial, r["truncated"]) if alive else DELETED)
                symbols.append(DELETED * (n - 1))
                illegal += (before is not None and before + initial not in LEGAL) + n - 1
                before = initial
            return {"sid": sid, "conv_id": conv, "seq": "".join(symbols), "first": held[0]["role"][:1], "last": before,
                    "blank": blank, "duplicate": duplicate, "truncated": int(truncated), "illegal": int(illegal),
                    "rows": [{k: r[k] for k in ("turn", "role", "key", "n")} for r in held]}

        out, sent = [], 0
        for batch in batches:
            if schema is None:
                row = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("key", pa.string()), ("n", pa.int64())])
                longs = [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")]
                schema = pa.schema([
                    ("sid", pa.int64()), ("conv_id", batch.schema.field("conv_id").type),
                    *[(c, pa.string()) for c in ("seq", "first", "last")], *longs, ("rows", pa.list_(row))])
            for r in batch.to_pylist():
                if held and (r["conv_id"] != conv or size >= SEGMENT):
                    out.append(done())
                    sent += len(held)
                    sid, held, size = sid + 1, [], 0
                    if sent >= SEGMENT:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, sent = [], 0
                conv = r["conv_id"]
                held.append(r)
                size += r["n"]
        if held:
            out.append(done())
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.mapInArrow(compute, kind)


def _choices(conversations: DataFrame, conv_type: str) -> DataFrame:
    """Per conversation the least cost with its audit, and each segment's share of it: entry state and edits."""
    kind = (f"conv_id {conv_type}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
            "shares array<struct<sid:bigint,state:int,edits:string>>")

    def best_of(segments: list[dict]) -> dict:
        reached: dict[int, tuple[int, Rope]] = {START: (0, "")}
        trail = []  # per segment and state behind it, the state before it and the edits in between
        tail: Matrix = INSERTED
        steps = [[{} for _ in range(4)] for _ in segments]
        for step, s in zip(steps, segments):
            for e in s["matrix"]:
                step[e["i"]][e["j"]] = (e["cost"], e["audit"])
        steps.append(tail)
        for step in steps:
            after: dict[int, tuple[int, Rope]] = {}
            through: dict[int, tuple[int, str]] = {}
            for q, (cost, rope) in reached.items():
                for end, (more, edits) in step[q].items():
                    new = (cost + more, joined(rope, edits))
                    if better(new, after.get(end)):
                        after[end], through[end] = new, (q, edits)
            trail.append(through)
            reached = after
        end = START
        for q in ENDS:
            if q in reached and (end not in reached or better(reached[q], reached[end])):
                end = q
        cost, audit = reached[end]
        shares, q = [], end
        closing = ""
        for k in range(len(steps) - 1, -1, -1):
            q, edits = trail[k][q]
            if k == len(segments):
                closing = rope_text(edits)
            else:
                shares.append({"sid": segments[k]["sid"], "state": q, "edits": edits + closing})
                closing = ""
        joints = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(segments, segments[1:]))
        return {"cost": cost, "audit": rope_text(audit), "shares": shares,
                "illegal": joints + sum(s["illegal"] for s in segments)} | {
                    c: sum(s[c] for s in segments) for c in ("blank", "duplicate", "truncated")}

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = pa.struct([("sid", pa.int64()), ("state", pa.int32()), ("edits", pa.string())])
            longs = [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), *longs, ("audit", pa.string()),
                                ("shares", pa.list_(share))])
            for row in batch.to_pylist():
                segments = sorted(row["segments"], key=lambda s: s["sid"])
                yield pa.RecordBatch.from_pylist([{"conv_id": row["conv_id"], **best_of(segments)}], schema=schema)

    return conversations.mapInArrow(_together(compute), kind)


def _together(compute, rows: int = 2000):
    """The same record batches, several small ones put together."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in compute(batches):
            held.append(b)
            if len(held) >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run


def _plan(segments: DataFrame, conv_type: str) -> DataFrame:
    """Per row that is kept or has insertions beside it: the lines before it, its role if kept, the lines after it."""
    kind = f"conv_id {conv_type}, turn long, role string, key string, lead string, kept string, trail string"

    def follow(s: dict) -> Iterator[dict]:
        q, at, edits = s["state"], 0, s["edits"]

        def inserted() -> str:
            nonlocal q, at
            lines = ""
            while edits[at:at + 1] == INSERT:
                role, q = ("assistant", ASSISTANT) if q == USER else ("user", USER)
                lines += f"\n{role}:"
                at += 1
            return lines

        for place, r in enumerate(s["rows"]):
            lead, kept, trail = inserted(), None, ""
            edit, at = edits[at], at + 1
            if edit == KEEP:
                kept, q = r["role"], MOVES[r["role"][:1]][q]
            elif edit == REROLE:
                kept, q = ("assistant", ASSISTANT) if q == USER else ("user", USER)
            for _ in range(r["n"] - 1):
                trail += inserted()
                at += 1
            if place + 1 == len(s["rows"]):
                trail += inserted()
            if lead or kept is not None or trail:
                yield {"conv_id": s["conv_id"], "turn": r["turn"], "role": r["role"], "key": r["key"], "lead": lead,
                       "kept": kept, "trail": trail}

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(c, pa.string()) for c in ("role", "key", "lead", "kept", "trail")]
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("turn", pa.int64()), *texts])
            for s in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(list(follow(s)), schema=schema)

    return segments.mapInArrow(_together(compute), kind)


def _digests(lines: DataFrame, conv_type: str, slices: int) -> DataFrame:
    """``conv_id, repaired_sha256`` of conversations from their ``lines``, in order and each with a line feed before it."""
    order = ["conv_id", "turn", "role", "key"]
    sorted_ = lines.repartitionByRange(slices, *order).sortWithinPartitions(*order)

    def inside(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, conv, body, at, whole = TaskContext.get().partitionId(), None, [], 0, False
        size, schema, rows = 0, None, []

        def chunk() -> dict:
            return {"conv_id": conv, "slice": place, "at": at, "body": b"".join(body), "digest": None}

        def digest() -> dict:
            return {"conv_id": conv, "slice": None, "at": None, "body": None,
                    "digest": hashlib.sha256(b"".join(body)[1:]).hexdigest()}

        started = False
        for batch in batches:
            schema = schema or pa.schema([
                ("conv_id", batch.schema.field("conv_id").type), ("slice", pa.int64()), ("at", pa.int64()),
                ("body", pa.binary()), ("digest", pa.string())])
            for name, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if started and name != conv:
                    rows.append(digest() if whole else chunk())
                    whole, body, size, at = True, [], 0, 0
                conv, started = name, True
                body.append(line.encode())
                size += len(body[-1])
                if size >= CHUNK:
                    rows.append(chunk())
                    whole, body, size, at = False, [], 0, at + 1
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        if started:
            yield pa.RecordBatch.from_pylist([chunk()], schema=schema)

    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, first, schema = None, None, True, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conv_id": conv, "digest": state.hexdigest()}], schema=schema)

        for batch in batches:
            schema = schema or pa.schema([("conv_id", batch.schema.field("conv_id").type), ("digest", pa.string())])
            for name, body in zip(batch.column("conv_id").to_pylist(), batch.column("body").to_pylist()):
                if state is not None and name != conv:
                    yield done()
                    state = None
                if state is None:
                    conv, state, first = name, hashlib.sha256(), True
                state.update(body[1:] if first and body else body)
                first = first and not body
        if state is not None:
            yield done()

    pieces = stored(sorted_.select("conv_id", "line").mapInArrow(
        inside, f"conv_id {conv_type}, slice long, at long, body binary, digest string"), "repaired-pieces")
    split = pieces.filter("digest IS NULL").repartition("conv_id").sortWithinPartitions("conv_id", "slice", "at").select(
        "conv_id", "body").mapInArrow(across, f"conv_id {conv_type}, digest string")
    return pieces.filter("digest IS NOT NULL").select("conv_id", "digest").unionByName(split).withColumnRenamed(
        "digest", "repaired_sha256")


def repair(
    rows: DataFrame, original: DataFrame | None = None, slices: int | None = None,
) -> DataFrame:
    """Per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``rows`` are ``conv_id, turn, role, text, n`` as :func:`damaged` gives them, without nulls in role, text and n.
    ``original`` names the conversations to report, those of ``rows`` if it is not given.
    """
    bound_batches(rows.sparkSession)
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    keyed = rows.withColumn("key", F.md5(F.col("text").cast("binary")))
    narrow = stored(
        keyed.select("conv_id", "turn", "role", "key", "n", (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
                     (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"))
        .groupBy("conv_id", "turn", "role", "key").agg(
            F.sum("n").alias("n"), F.bool_or("blank").alias("blank"), F.bool_or("truncated").alias("truncated")),
        "conversation-rows")
    if slices is None:
        slices = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), narrow.count() // ROWS_A_SLICE)
    # Texts that a conversation repeats in other turns; compared null-safely, so that a hot one can be split.
    again = narrow.groupBy("conv_id", "role", "key").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("least"),
        F.count(F.lit(1)).alias("turns")).filter("turns > 1").select(
        F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("key").alias("_k"), "least")
    marked = narrow.join(
        again, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("role").eqNullSafe(F.col("_r"))
        & F.col("key").eqNullSafe(F.col("_k")), "left").withColumn(
        "fresh", F.when(F.col("least").isNull(), True).otherwise(F.col("turn").eqNullSafe(F.col("least.turn"))).cast("int"))
    order = ["conv_id", "turn", "role", "key"]
    segments = stored(
        _segments(marked.select(*order, "n", "blank", "truncated", "fresh").repartitionByRange(slices, *order)
                  .sortWithinPartitions(*order), conv_type), "segments")
    matrices = _matrices(segments.select("seq").distinct())
    whole = segments.drop("rows").join(matrices, "seq").groupBy("conv_id").agg(
        F.collect_list(F.struct("sid", "first", "last", "blank", "duplicate", "truncated", "illegal", "matrix"))
        .alias("segments"))
    choices = stored(_choices(whole, conv_type), "choices")
    shares = choices.select(F.inline("shares"))
    plan = _plan(segments.select("sid", "conv_id", "rows").join(shares, "sid"), conv_type)
    # Texts and what becomes of them meet by content, once each, however often a row is repeated.
    none = F.lit(None).cast("string")
    lines = (
        keyed.select(*order, "text", none.alias("lead"), none.alias("kept"), none.alias("trail"))
        .unionByName(plan.withColumn("text", none))
        .groupBy(*order).agg(*[F.max(c).alias(c) for c in ("text", "lead", "kept", "trail")])
        .filter(F.col("lead").isNotNull())
        .select(*order, F.concat("lead", F.when(F.col("kept").isNotNull(), F.concat(
            F.lit("\n"), "kept", F.lit(":"), "text")).otherwise(F.lit("")), "trail").alias("line"))
    )
    digests = _digests(lines, conv_type, slices)
    turns = narrow.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("conv_id", "_id")
        return left.join(right, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")

    ids = (rows if original is None else original).select("conv_id").distinct()
    out = beside(beside(beside(ids, choices.drop("shares")), turns), digests)
    zero = F.lit(0).cast("long")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
