"""Near-duplicate documents by tensored banding.

Two collections of half bands, ``left`` and ``right``, are made of few minhashes each. A hash table belongs to every
pair of a left and a right half band, so ``tables`` half bands a side give ``tables ** 2`` tables from only
``2 * tables * rows`` minhashes. Two documents of similarity J meet in some table unless all left or all right half
bands differ: the share missed is below ``2 * (1 - J ** rows) ** tables``, 5e-5 at J = 0.8 for 20 half bands of 4.
Every link is confirmed on the full shingle sets.

Steps: (1) one row per distinct shingle set; copies only carry its number. (2) Half bands that nobody shares are
dropped. (3) The tables (i, i) link each member to the smallest of its bucket, which joins most groups at a linear
price. (4) All tables: those with the same left half band are visited together. Only buckets that still hold several
groups go on, and there only the members outside the bucket's main group look for partners: documents of another group
that share a right half band too. A pair comes up at its first common left half band alone, and only if the sizes of
the two sets and their odd sketches (parities of hashed bits, whose difference never exceeds that of the sets) allow
the similarity. So no link of a table is lost, and a group that step 3 has joined is never expanded into its pairs.

Defined cases: documents without words have no shingles and are linked with nothing; a document with fewer words than
a shingle has its whole sequence as the only one; rows without an id are linked with nothing and kept; rows that
repeat an id count as one document; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.checkpoints import stored
from .common import bound_batches, utf8
from .components import components

# Words of 64 bits that an odd sketch has at most.
SKETCH_WORDS = 1024
# Words whose hash a worker remembers before it starts anew.
REMEMBERED = 400_000
CHUNK = 4096


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; a bijection."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text, lower-cased in ASCII."""
    h = hashes.of(text.lower().split())
    if not len(h):
        return h
    k = min(words, len(h))
    n = len(h) - k + 1
    s = np.full(n, k, np.uint64)
    for j in range(k):
        s = _mix(s * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n])
    return np.unique(s)


class TensoredBands:
    """The half-band keys of a shingle set: ``tables`` left ones, then ``tables`` right ones."""

    def __init__(self, tables: int, rows: int, seed: int):
        draw = np.random.default_rng(seed)
        self.tables, self.rows, n = tables, rows, 2 * tables * rows
        self.flip = draw.integers(0, 2**63, n, dtype=np.uint64)[:, None]
        self.scale = (draw.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
        self.salt = draw.integers(0, 2**63, 2 * tables, dtype=np.uint64)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.flip), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), CHUNK):
            hashed = shingles[None, at:at + CHUNK] ^ self.flip
            hashed *= self.scale
            np.minimum(least, hashed.min(axis=1), out=least)
        key = self.salt.copy()
        for column in least.reshape(2 * self.tables, self.rows).T:
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
        return key


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the shingles' hashed bits, in words; at least two bits a shingle up to the bound."""
    words = 1
    while words < SKETCH_WORDS and words * 64 < 2 * len(shingles):
        words *= 2
    bits = (shingles >> np.uint64(40)) & np.uint64(64 * words - 1)
    return np.packbits(np.bincount(bits.astype(np.int64), minlength=64 * words).astype(np.uint8) & 1).view(np.int64)


def signatures(
    docs: DataFrame, doc_id: str, text: str, words: int, tables: int, rows: int, seed: int,
) -> DataFrame:
    """``doc_id``, set size ``n``, a 128-bit digest ``(d1, d2)`` of the set, its half-band ``keys``, and its
    ``odd`` sketch."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                        ("keys", longs), ("odd", longs)])

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bands = WordHashes(), TensoredBands(tables, rows, seed)
        for batch in batches:
            sizes, first, second, keys, odd = [], [], [], [], []
            for body in utf8(batch.column(1)):
                s = shingle_set(body, words, hashes)
                sizes.append(len(s))
                first.append(int(s.sum(dtype=np.uint64).astype(np.int64)))
                second.append(int(_mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                keys.append(bands.keys(s).astype(np.int64) if len(s) else None)
                odd.append(odd_sketch(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(second, pa.int64()), pa.array(keys, longs), pa.array(odd, longs)], schema=schema)

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        compute, "doc_id long, n long, d1 long, d2 long, keys array<long>, odd array<long>")


def shingle_sets(docs: DataFrame, doc_id: str, text: str, words: int, ids: DataFrame) -> DataFrame:
    """The full shingle sets ``(id, shingles)`` of the documents in ``ids (id)``."""
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(body, words, hashes).astype(np.int64) for body in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], schema=schema)

    # The join takes the same way at every size of the ids: a hash table of a part of them, past which texts stream.
    wanted = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(
        ids.hint("shuffle_hash"), "id", "left_semi")
    return wanted.mapInArrow(compute, "id long, shingles array<long>")


class Confirm:
    """Confirms candidate pairs ``(a, b)`` on full shingle sets ``(id, shingles)``.

    Nothing follows the joins that needs their partitioning, so that the rows of a group's smallest member can be split.
    """

    def __init__(self, sets: DataFrame, percent: int):
        self.sets, self.percent = sets, percent

    def __call__(self, pairs: DataFrame) -> DataFrame:
        one = self.sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
        two = self.sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        both, na, nb = F.size(F.array_intersect("sa", "sb")), F.size("sa"), F.size("sb")
        fits = (F.least(na, nb) * 100 >= F.greatest(na, nb) * self.percent)
        return stored(
            stored(pairs, "candidate-pairs").join(one, "a").join(two, "b").filter(fits)
            .filter(both * 100 >= (na + nb - both) * self.percent).select("a", "b"), "links")


def _compatible(x: str, y: str, tables: int, percent: int) -> Column:
    """Whether two rows of different groups can be linked and meet first in this left half band."""
    def of(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def part(side: str, begin: int) -> Column:
        return F.slice(of(side, "keys"), begin + 1, tables)

    total = of(x, "n") + of(y, "n")
    apart = F.aggregate(F.zip_with(of(x, "odd"), of(y, "odd"), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0),
                        lambda s, v: s + v)
    first = F.array_position(F.zip_with(part(x, 0), part(y, 0), lambda a, b: a == b), True)
    return (
        (of(x, "group") != of(y, "group"))
        & (F.least(of(x, "n"), of(y, "n")) * 100 >= F.greatest(of(x, "n"), of(y, "n")) * percent)
        & F.arrays_overlap(part(x, tables), part(y, tables))
        & ((F.size(of(x, "odd")) != F.size(of(y, "odd"))) | (apart * (100 + percent) <= total * (100 - percent)))
        & (first == of(x, "pos") + 1)
    )


def _links(cand: DataFrame, tables: int, percent: int, confirm: Confirm) -> DataFrame:
    """Confirmed links ``(a, b)`` among ``cand (rep, n, odd, keys, halves)`` that join every two linked documents.

    ``halves`` are the half bands ``(pos, h)`` that others share.
    """
    def opposite(left: Column) -> Column:
        return F.filter("halves", lambda r: r["pos"] == left["pos"] + tables)

    lefts = F.filter("halves", lambda x: x["pos"] < tables)
    diagonal = F.transform(F.filter(lefts, lambda x: F.size(opposite(x)) > 0),
                           lambda x: F.xxhash64(x["h"], F.get(opposite(x), 0)["h"]))
    first = cand.select("rep", F.explode(diagonal).alias("key"))
    shared = first.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high")
    links = confirm(first.join(shared, "key").filter("rep > low").select(
        F.col("rep").alias("a"), F.col("low").alias("b")).distinct())

    groups = stored(components(links), "groups").withColumnRenamed("node", "rep")
    grouped = stored(cand.join(groups, "rep", "left").withColumn("group", F.coalesce("component", "rep")).select(
        "rep", "n", "odd", "keys", "group", lefts.alias("lefts")), "grouped")
    narrow = grouped.select("rep", "group", F.explode("lefts.h").alias("h"))
    mains = stored(
        narrow.groupBy("h", "group").agg(F.count(F.lit(1)).alias("n")).groupBy("h").agg(
            F.max_by("group", F.struct("n", "group")).alias("main"), F.count(F.lit(1)).alias("groups"))
        .filter("groups > 1").select("h", "main"), "mixed-buckets")
    members = stored(
        grouped.select("rep", "n", "odd", "keys", "group", F.explode("lefts").alias("left"))
        .select("*", F.col("left.pos").alias("pos"), F.col("left.h").alias("h")).drop("left").join(mains, "h"),
        "mixed-members")
    pairs = (
        members.filter("group != main").alias("x").join(
            members.alias("y"), (F.col("x.h") == F.col("y.h")) & _compatible("x", "y", tables, percent))
        .select(F.greatest("x.rep", "y.rep").alias("a"), F.least("x.rep", "y.rep").alias("b")).distinct()
    )
    return links.unionByName(confirm(pairs))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80,
    tables: int = 20, rows: int = 4, seed: int = 11,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when 100 * intersection >= ``percent`` * union of their shingle sets; the component is the
    smallest id that can be reached, and that document is the one kept.
    """
    bound_batches(docs.sparkSession)
    sig = stored(signatures(docs, doc_id, text, words, tables, rows, seed), "signatures")
    copies = stored(
        sig.filter("n > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
        .select("d1", "d2", "rep"), "copies")
    named = sig.drop("keys", "odd").join(copies, ["d1", "d2"], "left").withColumn(
        "rep", F.when(F.col("n") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")))
    heads = sig.filter("n > 0 AND doc_id IS NOT NULL").join(copies, ["d1", "d2"], "left").filter(
        F.coalesce("rep", "doc_id") == F.col("doc_id")).select(F.col("doc_id").alias("rep"), "n", "odd", "keys")
    halves = heads.select("rep", F.posexplode("keys").alias("pos", "h"))
    shared = stored(halves.groupBy("h").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
                    .filter("low < high").select("h"), "shared-halves")
    both_sides = F.exists("halves", lambda x: x["pos"] < tables) & F.exists("halves", lambda x: x["pos"] >= tables)
    shared_by = halves.join(shared, "h").groupBy("rep").agg(
        F.collect_set(F.struct("pos", "h")).alias("halves")).filter(both_sides)
    cand = stored(heads.join(shared_by, "rep"), "candidates")
    sets = stored(shingle_sets(docs, doc_id, text, words, cand.select(F.col("rep").alias("id"))), "candidate-sets")
    links = _links(cand, tables, percent, Confirm(sets, percent))
    groups = stored(components(links), "components").withColumnRenamed("node", "rep")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return named.join(groups, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the document with the smallest id stays.

    Columns are unchanged. Of rows that repeat an id one stays; rows without an id stay.
    """
    groups = near_duplicates(docs, doc_id, text, **options)
    counted = stored(groups.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).filter("NOT kept OR rows > 1"), "not-kept")
    same = F.col(doc_id).cast("long") == F.col("_id")
    once = docs.join(counted.hint("shuffle_hash"), same, "left_anti")
    return once.unionByName(docs.join(counted.filter("kept"), same, "left_semi").dropDuplicates([doc_id]))
