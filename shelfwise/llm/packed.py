"""Exact counts of 64-bit codes with a small shuffle.

Workers count a chunk of codes, sort them and send them by ranges of codes ("buckets"), one row per bucket and group:
the codes as differences of few bytes, and their numbers. So a code crosses the network once per chunk, however often it
occurs, in about six bytes, and no code is hot. A bucket is put together in one task; their number is chosen by the bytes
of the texts, so that a bucket stays small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Codes that a worker counts at a time, codes meant for one bucket, and rows of a result batch.
CHUNK, BUCKET, SENT_AT_ONCE = 2_000_000, 2_000_000, 250_000
BYTES_A_WORD = 6
# Bits of a bitmap, as a power of two, and the bits of one of Spark's bitmap rows.
BITMAP, BITMAP_ROW = 28, 32_768

# A group, its codes, their numbers (none: 1 each), and a small mark for each, of which one of those given is kept.
Codes = tuple[int, np.ndarray, np.ndarray | None] | tuple[int, np.ndarray, np.ndarray | None, np.ndarray]


def pack(codes: np.ndarray) -> bytes:
    """Sorted distinct codes: the width of a difference, the first code, the differences."""
    if not len(codes):
        return b""
    gaps = np.diff(codes)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    return bytes([width]) + codes[:1].tobytes() + gaps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, np.uint64)
    gaps = np.frombuffer(data, np.uint8, offset=9).reshape(-1, data[0])
    out = np.zeros((len(gaps) + 1, 8), np.uint8)
    out[0] = np.frombuffer(data, np.uint8, 8, 1)
    out[1:, :data[0]] = gaps
    return np.cumsum(out.reshape(-1).view(np.uint64), dtype=np.uint64)


def pack_numbers(n: np.ndarray) -> bytes:
    """Numbers in the fewest bytes that hold the largest."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(n) or int(n.max()) < 1 << 8 * w)
    return bytes([width]) + n.astype(f"<u{width}").tobytes()


def unpack_numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def summed(
    codes: np.ndarray, n: np.ndarray | None, marks: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Distinct codes in order, the sums of their numbers (1 each if there are none), and a mark of each."""
    if n is None and marks is None:
        return *np.unique(codes, return_counts=True), None
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.empty(0, np.int64)
    if n is None:
        total = np.diff(np.append(first, len(codes)))
    else:
        total = np.add.reduceat(n[order], first) if len(first) else n
    return codes[first], total, None if marks is None else marks[order[first]]


def bucket_count(texts: DataFrame, text: str, least: int) -> int:
    """Buckets for the words of the texts: one per ``BUCKET`` of them, and one per shuffle partition at least."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return max(least, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BYTES_A_WORD // BUCKET + 1)


def bucket_bounds(buckets: int) -> np.ndarray:
    """The first code of every bucket but the first."""
    return np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)


def count(
    rows: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[Codes]]], buckets: int, least: int = 1,
    marked: bool = False,
) -> DataFrame:
    """``grp, code, n``: exact sums of codes per group, those of ``least`` at least; with ``mark`` if they are marked.

    ``make`` is called once per task and gives a function from a record batch to :data:`Codes`.
    """
    schema = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("codes", pa.binary()), ("numbers", pa.binary()),
                        ("marks", pa.binary())])

    def send(held: dict[int, list[Codes]]) -> Iterator[pa.RecordBatch]:
        bounds = bucket_bounds(buckets)
        for group, parts in held.items():
            codes = np.concatenate([p[1] for p in parts])
            numbers = None if all(p[2] is None for p in parts) else np.concatenate(
                [np.ones(len(p[1]), np.int64) if p[2] is None else p[2] for p in parts])
            marks = np.concatenate([p[3] for p in parts]) if marked else None
            parts.clear()
            codes, numbers, marks = summed(codes, numbers, marks)
            cuts = np.concatenate([[0], np.searchsorted(codes, bounds), [len(codes)]])
            full = np.flatnonzero(np.diff(cuts))
            for at in range(0, len(full), 64):
                some = full[at:at + 64]
                ranges = [slice(cuts[b], cuts[b + 1]) for b in some]
                yield pa.RecordBatch.from_arrays([
                    pa.array(some, pa.int32()), pa.array([group] * len(some), pa.int32()),
                    pa.array([pack(codes[r]) for r in ranges], pa.binary()),
                    pa.array([pack_numbers(numbers[r]) for r in ranges], pa.binary()),
                    pa.array([pack_numbers(marks[r]) if marked else None for r in ranges], pa.binary())], schema=schema)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of, held, size = make(), {}, 0
        for batch in batches:
            for codes in codes_of(batch):
                if len(codes[1]):
                    held.setdefault(codes[0], []).append(codes)
                    size += len(codes[1])
                if size >= CHUNK:
                    yield from send(held)
                    held, size = {}, 0
        yield from send(held)

    result = pa.schema([("grp", pa.int32()), ("code", pa.int64()), ("n", pa.int64()), *[("mark", pa.int64())] * marked])

    def whole(key: tuple[int, int], parts: list[tuple[bytes, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        codes, n, marks = summed(
            np.concatenate([unpack(p[0]) for p in parts]), np.concatenate([unpack_numbers(p[1]) for p in parts]),
            np.concatenate([unpack_numbers(p[2]) for p in parts]) if marked else None)
        wanted = n >= least
        columns = [codes[wanted].view(np.int64), n[wanted], *([marks[wanted]] if marked else [])]
        for at in range(0, len(columns[0]), SENT_AT_ONCE):
            some = [pa.array(c[at:at + SENT_AT_ONCE]) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some[0]), key[1], np.int32)), *some], schema=result)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            for bucket, group, *packed in zip(*[c.to_pylist() for c in batch.columns]):
                if parts and (bucket, group) != key:
                    yield from whole(key, parts)
                    parts = []
                key = (bucket, group)
                parts.append(packed)
        if parts:
            yield from whole(key, parts)

    sent = rows.mapInArrow(partial, "bucket int, grp int, codes binary, numbers binary, marks binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket", "grp").mapInArrow(
        merge, "grp int, code long, n long" + ", mark long" * marked)


def bitmap_of(codes: DataFrame, code: str | Column = "code") -> np.ndarray:
    """A bitmap with two bits for every code; its size does not depend on their number."""
    mask, code = (1 << BITMAP) - 1, F.col(code) if isinstance(code, str) else code
    rows = (
        codes.select(F.explode(F.array(F.shiftrightunsigned(code, 64 - BITMAP), code.bitwiseAND(F.lit(mask)))).alias("bit"))
        .groupBy(F.floor(F.col("bit") / BITMAP_ROW).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("bit") % BITMAP_ROW).alias("bits")).toArrow())
    out = np.zeros(1 << BITMAP - 3, np.uint8)
    for part, bits in zip(rows.column("part").to_pylist(), rows.column("bits").to_pylist()):
        at = part * BITMAP_ROW // 8
        out[at:at + len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def fitted_bitmap(codes: DataFrame, code: str | Column = "code") -> np.ndarray:
    """As :func:`bitmap_of`, with 16 bits for each code and 2 ** ``BITMAP`` at most; workers put it together in slices."""
    size = min(BITMAP, max(18, (16 * codes.count()).bit_length()))
    width = size - 6  # of a slice's bits, as a power of two

    def send(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        code = np.concatenate(held)
        bits = np.unique(np.concatenate([code >> np.uint64(64 - size), code & np.uint64((1 << size) - 1)]))
        cuts = np.searchsorted(bits, np.arange(65, dtype=np.uint64) << np.uint64(width))
        full = np.flatnonzero(np.diff(cuts)).tolist()
        yield pa.RecordBatch.from_arrays([
            pa.array(full, pa.int32()), pa.array([pack(bits[cuts[i]:cuts[i + 1]]) for i in full], pa.binary())], ["slice", "bits"])

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size_ = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            size_ += batch.num_rows
            if size_ >= CHUNK:
                yield from send(held)
                held, size_ = [], 0
        if size_:
            yield from send(held)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, packed in zip(*[c.to_pylist() for c in batch.columns]):
                held = slices.setdefault(at, np.zeros(1 << width, bool))
                held[unpack(packed) & np.uint64((1 << width) - 1)] = True
        for at, held in slices.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([at], pa.int32()), pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())],
                ["slice", "bits"])

    code = F.col(code) if isinstance(code, str) else code
    rows = codes.select(code.alias("code")).mapInArrow(partial, "slice int, bits binary").repartition("slice").mapInArrow(
        merge, "slice int, bits binary").toArrow()
    out = np.zeros((64, 1 << width - 3), np.uint8)
    for at, bits in zip(rows.column("slice").to_pylist(), rows.column("bits").to_pylist()):
        out[at] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def may_hold(bitmap: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """False where a code is certainly not among those of the bitmap."""
    size = len(bitmap).bit_length() + 2

    def set_at(bit: np.ndarray) -> np.ndarray:
        return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1

    return set_at(codes >> np.uint64(64 - size)) & set_at(codes & np.uint64((1 << size) - 1))
