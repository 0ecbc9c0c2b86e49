"""Exact Jaccard self-join of documents on their word n-grams, by prefixes of token combinations.

A document's tokens are the hashes of its distinct shingles. At a similarity of ``percent`` at most ``spare`` of its tokens are
missing from a partner. Tokens are ordered by frequency, rarest first, and fall into classes: rare ones are indexed alone,
frequent ones as pairs, very frequent ones as triples within small sub-classes (a hash of the token). A token alone
catches a pair unless it is missing; a sub-class with c tokens of a prefix catches it unless c - k + 1 of them are missing.
So a prefix is extended until these numbers add up to more than ``spare``, and two similar documents, whose prefixes follow
one order and one division into sub-classes, share a combination. The division goes by the power of two of the size; a
document that may have partners in the power below is indexed there, too. No link is lost.

Steps: (1) one row per distinct set; copies only carry its number. (2) A sure test drops most documents: of the tokens
in a fixed share of the hash range, all but ``spare`` have to occur in another document. (3) Frequencies among those left, exact,
from one shuffle of packed tokens that brings every document its shared tokens with their frequencies; a document with
more than ``spare`` tokens of its own has no partner. (4) The combinations are indexed; each member of a list is
compared with the smallest, which joins most groups at a linear price; lists that still hold several groups are looked
through for pairs across groups, whose odd sketches (parities of hashed bits) allow the similarity. Every link is confirmed on the full sets: shared tokens are all that can intersect.

A list of a rare token holds at most ``RARE`` documents. What workers are sent are bitmaps of fixed size, which only spare
them documents that certainly have no part. Shingles are told apart by 64-bit hashes.

Defined cases: documents without words have no shingles and are linked with nothing; a document with fewer words than a
shingle has its whole sequence as the only one; rows without an id are linked with nothing; rows that repeat an id count as
one document; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.checkpoints import stored
from .common import bound_batches, utf8
from .components import components
from .near_dup import WordHashes, _mix, odd_sketch, shingle_set
from .packed import (
    CHUNK, bitmap_of, bucket_bounds, bucket_count, may_hold, pack, pack_numbers, summed, unpack, unpack_numbers,
)

# Documents up to which a token is rare, and up to which it is indexed in pairs; above, in triples.
RARE, PAIRED = 32, 1024
# Sizes below 2 ** ALONE are indexed by single tokens only; tokens to a sub-class of pairs and of triples at the least.
ALONE, PER_PAIRS, PER_TRIPLES = 3, 4, 8
# Share of the hash range, in 1 / 1000, whose tokens decide whether a document can have a partner.
TESTED = 300
ODD, SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
LIMIT = np.uint64((TESTED << 64) // 1000)


def spare(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` that a partner can lack."""
    return n - -(-n * percent // 100)


def levels_of(n: int, percent: int) -> list[int]:
    """Powers of two at which a set of ``n`` tokens is indexed: its own, and that of its smallest partners."""
    own = n.bit_length() - 1
    return [own] + [own - 1] * (own > 0 and n - spare(n, percent) < 1 << own)


def combinations_of(n: int, codes: np.ndarray, freqs: np.ndarray, percent: int) -> np.ndarray:
    """The distinct keys under which a set is indexed; ``codes`` are its tokens that others have, too."""
    lack, alone = spare(n, percent), n - len(codes)
    if alone > lack:
        return np.empty(0, np.uint64)
    order = np.lexsort((codes, freqs))
    codes, freqs = codes[order], freqs[order]
    keys = []
    for level in levels_of(n, percent):
        k = np.ones(len(codes), np.int64)
        if level >= ALONE:
            k += (freqs > RARE).astype(np.int64) + (freqs > PAIRED)
        parts = np.array([1, 1, max(1, (1 << level) // PER_PAIRS), max(1, (1 << level) // PER_TRIPLES)], np.uint64)[k]
        group = (_mix(codes ^ SALT) % parts).astype(np.int64) * 4 + k
        by_group = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.diff(group[by_group], prepend=-1))
        place = np.empty(len(codes), np.int64)
        place[by_group] = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
        caught = alone + np.cumsum((place >= k - 1) | (k == 1))
        end = int(np.searchsorted(caught, lack + 1)) + 1
        salt = np.uint64(level * int(ODD) % 2**64)
        single = codes[:end][k[:end] == 1]
        keys.append(_mix(single + salt))
        held: dict[int, list[int]] = {}
        for g, size, code in zip(group[:end].tolist(), k[:end].tolist(), codes[:end].tolist()):
            if size > 1:
                held.setdefault(g, []).append(code)
        for size in (2, 3):
            found = [c for g, some in held.items() if g % 4 == size for c in combinations(sorted(some), size)]
            if found:
                columns = np.array(found, np.uint64)
                key = np.full(len(columns), salt)
                for column in columns.T:
                    key = _mix(key * ODD + column)
                keys.append(key)
    return np.unique(np.concatenate(keys))


def folded(sketch: Column, words: Column) -> Column:
    """An odd sketch in the shorter length ``words``.

    A token's bit is its place in 2 ** k bits, so the halves of a sketch, added without carry, are that of half the length.
    """
    return F.aggregate(
        F.sequence(words, F.size(sketch) - 1, words), F.slice(sketch, 1, words),
        lambda done, at: F.zip_with(done, F.slice(sketch, at + 1, words), lambda a, b: a.bitwiseXOR(b)))


def halved(sketch: Column) -> Column:
    """An odd sketch in half its length; null for a single word."""
    return F.when(F.size(sketch) > 1, folded(sketch, F.floor(F.size(sketch) / 2).cast("int")))


def odd_bits(x: str, y: str) -> Column:
    """Bits in which the odd sketches of two rows with ``odd, half`` differ, compared in the length of the shorter one."""
    a, b, half_a, half_b = (F.col(f"{side}.{c}") for c in ("odd", "half") for side in (x, y))
    words = F.least(F.size(a), F.size(b))

    def bits(one: Column, two: Column) -> Column:
        return F.aggregate(F.zip_with(one, two, lambda v, w: F.bit_count(v.bitwiseXOR(w))), F.lit(0), lambda s, v: s + v)

    return (
        F.when(F.size(a) == F.size(b), bits(a, b))
        .when(F.size(half_a) == F.size(b), bits(half_a, b)).when(F.size(a) == F.size(half_b), bits(a, half_b))
        .when(F.size(a) > F.size(b), bits(folded(a, words), b)).otherwise(bits(a, folded(b, words))))


def _id_codes(ids: np.ndarray) -> np.ndarray:
    return _mix(ids.astype(np.int64).view(np.uint64) * ODD + SALT)


def _id_bitmap(ids: DataFrame) -> np.ndarray:
    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_id_codes(b.column(0).to_numpy()).view(np.int64))], ["code"])

    return bitmap_of(ids.mapInArrow(compute, "code long"))


class Join:
    """One self-join of ``docs``."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, words: int, percent: int):
        self.texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
        self.words, self.percent, self.spark = words, percent, docs.sparkSession
        self.buckets = bucket_count(self.texts, "text", 1)

    def sets(self) -> DataFrame:
        """``id, n, tested, d1, d2``: sizes, and a 128-bit digest of the set."""
        words = self.words
        schema = pa.schema([(c, pa.int64()) for c in ("id", "n", "tested", "d1", "d2")])

        def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in batches:
                rows = []
                for body in utf8(batch.column(1)):
                    s = shingle_set(body, words, hashes)
                    other = _mix(s ^ np.uint64(0x5851F42D4C957F2D))
                    rows.append((len(s), int(np.searchsorted(s, LIMIT)), int(s.sum(dtype=np.uint64).astype(np.int64)),
                                 int(other.sum(dtype=np.uint64).astype(np.int64))))
                columns = zip(*rows) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], schema=schema)

        return self.texts.mapInArrow(compute, "id long, n long, tested long, d1 long, d2 long")

    def _tokens(self, wanted: np.ndarray):
        """A reader of the sets of documents whose id a bitmap may hold."""
        sent, words = self.spark.sparkContext.broadcast(wanted), self.words

        def read(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
            hashes = WordHashes()
            for batch in batches:
                batch = batch.filter(batch.column(0).is_valid())
                batch = batch.filter(pa.array(may_hold(sent.value, _id_codes(batch.column(0).to_numpy()))))
                for i, body in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                    s = shingle_set(body, words, hashes)
                    if len(s):
                        yield i, s

        return read

    def possible(self, heads: DataFrame) -> DataFrame:
        """The ids of those sets ``(id, n, tested)`` that pass the test on a share of the hash range."""
        read, buckets, percent = self._tokens(_id_bitmap(heads.select("id"))), self.buckets, self.percent
        schema = pa.schema([("bucket", pa.int32()), ("codes", pa.binary()), ("owners", pa.binary())])

        def send(codes: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            codes, owners = np.concatenate(codes), np.concatenate(owners)
            order = np.argsort(codes)
            codes, owners = codes[order], owners[order]
            bounds = [(i * int(LIMIT)) // buckets for i in range(1, buckets)]
            cuts = np.concatenate([[0], np.searchsorted(codes, np.array(bounds, np.uint64)), [len(codes)]])
            for b in np.flatnonzero(np.diff(cuts)):
                some = slice(cuts[b], cuts[b + 1])
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([pack(codes[some])], pa.binary()),
                                                  pa.array([owners[some].tobytes()], pa.binary())], schema=schema)

        def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, owners, size = [], [], 0
            for i, s in read(batches):
                s = s[:np.searchsorted(s, LIMIT)]
                codes.append(s)
                owners.append(np.full(len(s), _id_codes(np.array([i]))[0] >> np.uint64(32), np.uint32))
                size += len(s)
                if size >= CHUNK:
                    yield from send(codes, owners)
                    codes, owners, size = [], [], 0
            if size:
                yield from send(codes, owners)

        def shared(parts: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
            codes = np.concatenate([unpack(c) for c, _ in parts])
            owners = np.concatenate([np.frombuffer(o, np.uint32) for _, o in parts])
            order = np.argsort(codes, kind="stable")
            codes, owners = codes[order], owners[order]
            same = codes[1:] == codes[:-1]
            owner, n = np.unique(owners[np.append(same, False) | np.append(False, same)], return_counts=True)
            for b, some in _cut(owner.astype(np.uint64) << np.uint64(32), buckets):
                yield pa.RecordBatch.from_arrays([
                    pa.array([b], pa.int32()), pa.array([owner[some].tobytes()], pa.binary()),
                    pa.array([pack_numbers(n[some])], pa.binary())], ["part", "owners", "numbers"])

        def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for parts in _by_key(batches):
                yield from shared(parts)

        def total(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for parts in _by_key(batches):
                owner, n, _ = summed(np.concatenate([np.frombuffer(o, np.uint32) for o, _ in parts]),
                                     np.concatenate([unpack_numbers(m) for _, m in parts]))
                yield pa.RecordBatch.from_arrays([pa.array(owner.astype(np.int64)), pa.array(n)], ["owner", "found"])

        found = (
            self.texts.mapInArrow(partial, "bucket int, codes binary, owners binary")
            .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "part int, owners binary, numbers binary")
            .repartition("part").sortWithinPartitions("part").mapInArrow(total, "owner long, found long"))
        # Documents whose ids share 32 bits count together, which lets a document pass at worst.

        def owners_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                owner = (_id_codes(b.column(0).to_numpy()) >> np.uint64(32)).astype(np.int64)
                lack = np.array([t - spare(n, percent) for n, t in zip(*[b.column(c).to_pylist() for c in (1, 2)])], np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(owner), pa.array(lack)], ["id", "owner", "least"])

        return heads.select("id", "n", "tested").mapInArrow(owners_of, "id long, owner long, least long").join(
            found, "owner", "left").filter(F.coalesce("found", F.lit(0)) >= F.col("least")).select("id")

    def shared_tokens(self, ids: DataFrame) -> DataFrame:
        """The tokens of documents that others have, and in how many they are: packed by ranges of hashed ids (``part``)."""
        read, buckets = self._tokens(_id_bitmap(ids)), self.buckets
        schema = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("codes", "places", "ids", "sizes")]])

        def send(held: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            codes = np.concatenate([s for _, s in held])
            owners = np.repeat(np.arange(len(held)), [len(s) for _, s in held])
            names = np.array([i for i, _ in held], np.int64)
            sizes = np.array([len(s) for _, s in held], np.int64)
            order = np.argsort(codes)
            codes, owners = codes[order], owners[order]
            for b, some in _cut(codes, buckets):
                used, places = np.unique(owners[some], return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32())] + [pa.array([x], pa.binary()) for x in (
                    pack(codes[some]), pack_numbers(places), names[used].tobytes(), sizes[used].tobytes())], schema=schema)

        def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for i, s in read(batches):
                held.append((i, s))
                size += len(s)
                if size >= CHUNK:
                    yield from send(held)
                    held, size = [], 0
            if held:
                yield from send(held)

        def grouped(parts: list[tuple[bytes, ...]]) -> Iterator[pa.RecordBatch]:
            codes = np.concatenate([unpack(p[0]) for p in parts])
            places = [unpack_numbers(p[1]) for p in parts]
            ids = np.concatenate([np.frombuffer(p[2], np.int64)[at] for p, at in zip(parts, places)])
            sizes = np.concatenate([np.frombuffer(p[3], np.int64)[at] for p, at in zip(parts, places)])
            order = np.lexsort((ids, codes))
            codes, ids, sizes = codes[order], ids[order], sizes[order]
            once = np.append(True, (codes[1:] != codes[:-1]) | (ids[1:] != ids[:-1])) if len(codes) else codes.astype(bool)
            codes, ids, sizes = codes[once], ids[once], sizes[once]
            starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            freqs = np.repeat(*[np.diff(np.append(starts, len(codes)))] * 2)
            wanted = np.flatnonzero(freqs > 1)
            owner = _id_codes(ids[wanted])
            order = np.argsort(owner, kind="stable")
            wanted, owner = wanted[order], owner[order]
            for b, some in _cut(owner, buckets):
                some = wanted[some]
                used, places = np.unique(ids[some], return_inverse=True)
                named = np.empty(len(used), np.int64)
                named[places] = sizes[some]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32())] + [pa.array([x], pa.binary()) for x in (
                    codes[some].tobytes(), pack_numbers(freqs[some]), pack_numbers(places), used.tobytes(), named.tobytes())],
                    ["part", "codes", "freqs", "places", "ids", "sizes"])

        def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for parts in _by_key(batches):
                yield from grouped(parts)

        return self.texts.mapInArrow(partial, "bucket int, codes binary, places binary, ids binary, sizes binary").repartition(
            "bucket").sortWithinPartitions("bucket").mapInArrow(
            merge, "part int, codes binary, freqs binary, places binary, ids binary, sizes binary")

    def indexed(self, ids: DataFrame) -> DataFrame:
        """``id, n, tokens, keys, odd`` of the documents that can have a partner; ``odd`` is the tokens' odd sketch."""
        percent, longs = self.percent, pa.list_(pa.int64())
        schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("tokens", longs), ("keys", longs), ("odd", longs)])

        def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for parts in _by_key(batches):
                places = [unpack_numbers(p[2]) for p in parts]
                codes = np.concatenate([np.frombuffer(p[0], np.uint64) for p in parts])
                freqs = np.concatenate([unpack_numbers(p[1]) for p in parts])
                ids = np.concatenate([np.frombuffer(p[3], np.int64)[at] for p, at in zip(parts, places)])
                sizes = np.concatenate([np.frombuffer(p[4], np.int64)[at] for p, at in zip(parts, places)])
                order = np.argsort(ids, kind="stable")
                starts = np.flatnonzero(np.diff(ids[order], prepend=ids[order][:1] - 1))
                for some in np.split(order, starts[1:]):
                    i, n = int(ids[some[0]]), int(sizes[some[0]])
                    keys = combinations_of(n, codes[some], freqs[some], percent)
                    if len(keys):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([i]), pa.array([n]), pa.array([codes[some].view(np.int64)], longs),
                            pa.array([keys.view(np.int64)], longs), pa.array([odd_sketch(codes[some])], longs)], schema=schema)

        return self.shared_tokens(ids).repartition("part").sortWithinPartitions("part").mapInArrow(
            compute, "id long, n long, tokens array<long>, keys array<long>, odd array<long>")

    def confirm(self, sets: DataFrame, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` whose sets are similar enough."""
        one, two = (sets.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"s{x}")) for x in "ab")
        both, na, nb = F.size(F.array_intersect("sa", "sb")), F.col("na"), F.col("nb")
        return stored(stored(pairs, "candidate-pairs").join(one, "a").join(two, "b").filter(
            both * 100 >= (na + nb - both) * self.percent).select("a", "b"), "links")

    def links(self, sets: DataFrame) -> DataFrame:
        """Confirmed links that join every two linked documents."""
        listed = stored(sets.select("id", "n", F.explode("keys").alias("key")), "listed")
        lists = stored(listed.groupBy("key").agg(F.min(F.struct("id", "n")).alias("low"), F.max("id").alias("high")).filter(
            "low.id < high").select("key", "low"), "lists")

        def fits(n: str, m: str):
            return F.least(n, m) * 100 >= F.greatest(n, m) * self.percent

        # The lists are stored, so that the join shuffles for itself and a hot key can be split.
        shared = stored(listed.join(lists, "key"), "shared-lists")
        first = self.confirm(sets, shared.filter("id > low.id").filter(fits("n", "low.n")).select(
            F.col("id").alias("a"), F.col("low.id").alias("b")).distinct())
        groups = stored(components(first), "groups").withColumnsRenamed({"node": "id", "component": "grp"})
        members = stored(shared.drop("low").join(groups, "id", "left").withColumn("grp", F.coalesce("grp", "id")), "members")
        mains = stored(
            members.groupBy("key", "grp").agg(F.count(F.lit(1)).alias("rows")).groupBy("key").agg(
                F.max_by("grp", F.struct("rows", "grp")).alias("main"), F.count(F.lit(1)).alias("grps"))
            .filter("grps > 1").select("key", "main"), "mixed-lists")
        sketches = sets.select("id", "odd", halved(F.col("odd")).alias("half"), (F.col("n") - F.size("tokens")).alias("alone"))
        mixed = stored(members.join(mains, "key").join(sketches, "id"), "mixed-members")
        x, y = mixed.filter("grp != main").alias("x"), mixed.alias("y")
        # Odd sketches and tokens of one's own never exceed the difference of two sets, so that no link is lost here.
        apart = F.col("x.alone") + F.col("y.alone") + odd_bits("x", "y")
        close = apart * (100 + self.percent) <= (F.col("x.n") + F.col("y.n")) * (100 - self.percent)
        pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.grp") != F.col("y.grp")) & fits("x.n", "y.n") & close).select(
            F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")).distinct()
        return first.unionByName(self.confirm(sets, pairs))


def _cut(codes: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """The ranges of sorted codes that fall into each of ``parts`` equal parts of the hash range."""
    cuts = np.concatenate([[0], np.searchsorted(codes, bucket_bounds(parts)), [len(codes)]])
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, slice(cuts[b], cuts[b + 1])


def _by_key(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[bytes, ...]]]:
    """The rows of each value of the first column; rows are sorted by it."""
    key, parts = None, []
    for batch in batches:
        for value, *rest in zip(*[c.to_pylist() for c in batch.columns]):
            if parts and value != key:
                yield parts
                parts = []
            key = value
            parts.append(tuple(rest))
    if parts:
        yield parts


def ngram_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``.

    Documents are linked when 100 * intersection >= ``percent`` * union of their shingle sets; the component is the
    smallest id that can be reached.
    """
    bound_batches(docs.sparkSession)
    join = Join(docs, doc_id, text, words, percent)
    sets = stored(join.sets(), "sets")
    heads = stored(sets.filter("n > 0 AND id IS NOT NULL").groupBy("d1", "d2").agg(
        F.min("id").alias("rep"), F.any_value("n").alias("n"), F.any_value("tested").alias("tested")), "heads")
    possible = stored(join.possible(heads.withColumnRenamed("rep", "id")), "possible")
    indexed = stored(join.indexed(possible), "indexed")
    groups = stored(components(join.links(indexed)), "components").withColumnRenamed("node", "rep")
    named = heads.join(groups, "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component"))
    linked = F.col("id").isNotNull() & (F.col("n") > 0)
    return sets.join(stored(named, "named"), ["d1", "d2"], "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(linked, F.col("component")).otherwise(F.col("id")).alias("component_id"))
