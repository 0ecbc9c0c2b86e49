"""Phrase collocations by partitioned mining (SON).

Documents are dealt to ``shards``. Every shard is mined completely, length by length, at its share of the support: a
phrase with ``support`` occurrences has ``support / shards`` of them in some shard, so the phrases that reach that number in
any shard are all candidates, and no phrase is lost. A phrase can be frequent in a shard only if its two one-word shorter
parts are, which bitmaps of fixed size tell the next length. Then all candidates are counted in all documents, exactly.
A shard is a mark on a document, not a task: each is counted by as many tasks as the session has, with codes that
are summed before they are sent (:mod:`packed`). Words and phrases are told apart by 64-bit hashes (at 10^9 phrases of a
language the odds of one collision are 3 %). Only frequent phrases are spelt out, and each only by documents of one block
(a part of all documents by a hash), which the count names.

Scores need the counts of a phrase's parts, which are frequent themselves, so the rest are joins of the frequent phrases.
Of the longer phrases that hold a phrase those with one word more suffice: what lies between two phrases is as frequent as
the longer.

Defined cases: a null text is empty, a null language is ``und``; a language without frequent phrases has no rows; rows that
repeat are counted each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.checkpoints import stored
from .common import bound_batches, small_batches, utf8
from .near_dup import WordHashes, _mix
from .packed import bitmap_of, bucket_count, count, may_hold

SHARDS, SUPPORT, LONGEST, CONTAINED, REPORTED = 4, 30, 4, 80, 2000
BREAK = b"\xff"  # stands for the end of a piece; no UTF-8 text holds this byte
ODD, SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)
# Blocks of documents, by a hash: a phrase is spelt out by one of those in which it occurs.
BLOCKS = 256
# Parts of a language that are ranked by themselves first, so that no task sorts all phrases of a language.
PARTS = 64


class Words(WordHashes):
    """Hashes of words; the end of a piece has the hash 0."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = 0 if word == BREAK else xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: bytes) -> list[bytes]:
    """Words, and a break after each piece."""
    return (text.translate(LOWER).replace(b"\n", b" \xff ") + b" \xff").split()


class Chunk:
    """The words of several texts, and the codes of all their phrases."""

    def __init__(self, batch: pa.RecordBatch, words: Words, langs: dict[str, int]):
        """``batch`` has text, language, shard and block."""
        self.texts = [words_of(t) for t in utf8(batch.column(0))]
        lengths = np.array([len(t) for t in self.texts], np.int64)
        parts = [words.of(t) for t in self.texts]
        self.h = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        names = batch.column(1).to_pylist()
        for name in set(names) - langs.keys():
            langs[name] = xxhash.xxh3_64_intdigest(name.encode())
        seeds = np.array([langs[name] for name in names], np.uint64)
        self.seed = np.repeat(seeds, lengths)
        self.shard = np.repeat(batch.column(2).to_numpy().astype(np.int64), lengths)
        self.blocks = batch.column(3).to_numpy().astype(np.int64)
        self.block = np.repeat(self.blocks, lengths)
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        self.start = np.cumsum(lengths) - lengths
        # All words of a language are counted under the code of the empty phrase.
        inked = np.bincount(self.doc[self.h != 0], minlength=len(lengths)) if len(lengths) else lengths
        self.empty, self.inked = _mix(seeds), inked.astype(np.int64)

    def levels(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per length: the codes of the phrases that end at each word, which exist, and the codes one word shorter."""
        known = self.h != 0
        codes, ok = _mix(self.h + _mix(self.seed)), known
        yield 1, codes, ok, codes
        for k in range(2, LONGEST + 1):
            shorter, before = codes, np.zeros_like(codes)
            before[1:] = codes[:-1]
            inside = np.zeros_like(ok)
            inside[1:] = ok[:-1]
            ok = inside & known
            codes = _mix(before * ODD + self.h + SALT)
            yield k, codes, ok, shorter

    def in_shards(self, codes: np.ndarray, ok: np.ndarray) -> Iterator[tuple[int, np.ndarray, None]]:
        for s in np.unique(self.shard[ok]):
            yield int(s), codes[ok & (self.shard == s)], None


def _reader(use: Callable[[Chunk], Iterable[tuple[int, np.ndarray, np.ndarray | None]]]):
    """A maker of functions from record batches of texts to codes."""
    def make():
        words, langs = Words(), {}

        def codes_of(batch: pa.RecordBatch):
            for small in small_batches([batch]):
                yield from use(Chunk(small, words, langs))

        return codes_of

    return make


def _local(codes: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Codes as bits of a shard's, or a block's, share of a bitmap."""
    return codes ^ (part.astype(np.uint64) + np.uint64(1)) * ODD


def _local_column(code: str, part: str) -> Column:
    odd = int(ODD)
    by_part = F.array(*[F.lit(((p + 1) * odd + 2**63) % 2**64 - 2**63).cast("long") for p in range(BLOCKS)])
    return F.col(code).bitwiseXOR(F.get(by_part, F.col(part)))


def frequent_phrases(
    docs: DataFrame, text: str, lang: str, support: int = SUPPORT, shards: int = SHARDS, doc_id: str | None = None,
) -> DataFrame:
    """``lang, phrase, k, f``: phrases of up to four words with at least ``support`` occurrences in their language.

    The empty phrase (``k`` = 0) stands for all words of a language, whatever their number.
    """
    if not 1 <= shards <= BLOCKS:
        raise ValueError(f"shards must be from 1 to {BLOCKS}")
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession
    hashed = F.xxhash64(*([F.col(doc_id)] if doc_id else []), F.col(text).cast("string"))
    rows = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.pmod(hashed, F.lit(shards)).cast("int").alias("shard"),
                       F.shiftrightunsigned(hashed, 56).cast("int").alias("block"))
    buckets = bucket_count(rows, "text", shards)
    share = -(-support // shards)

    def mined(name: str, lengths: tuple[int, ...], below: DataFrame | None) -> DataFrame:
        """Phrases of some lengths that are frequent in a shard."""
        sent = spark.sparkContext.broadcast(
            None if below is None else bitmap_of(below, _local_column("code", "grp")))

        def use(chunk: Chunk):
            for k, codes, ok, shorter in chunk.levels():
                if k > max(lengths):
                    return
                if k in lengths:
                    if sent.value is not None:
                        often = may_hold(sent.value, _local(shorter, chunk.shard))
                        ok = ok & often
                        ok[1:] &= often[:-1]
                    yield from chunk.in_shards(codes, ok)

        return stored(count(rows, _reader(use), buckets, share), name)

    # Words and pairs are mined in one reading; longer phrases each by what the length below left.
    pairs = mined("mined-pairs", (1, 2), None)
    triples = mined("mined-triples", (3,), pairs)
    fours = mined("mined-fours", (4,), triples)
    candidates = spark.sparkContext.broadcast(bitmap_of(pairs.unionByName(triples).unionByName(fours)))

    def candidate_codes(chunk: Chunk):
        yield 0, chunk.empty, chunk.inked, chunk.blocks
        for _, codes, ok, _ in chunk.levels():
            here = np.flatnonzero(ok)
            here = here[may_hold(candidates.value, codes[here])]
            yield 1, codes[here], None, chunk.block[here]

    counted = count(rows, _reader(candidate_codes), buckets, marked=True)
    frequent = stored(counted.filter((F.col("grp") == 0) | (F.col("n") >= support)).drop("grp"), "frequent")
    wanted = spark.sparkContext.broadcast(bitmap_of(frequent, _local_column("code", "mark")))
    schema = pa.schema([("code", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32())])

    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, langs = Words(), {}
        for batch in small_batches(batches):
            chunk = Chunk(batch, words, langs)
            names, out = batch.column(1).to_pylist(), []
            named = np.flatnonzero(may_hold(wanted.value, _local(chunk.empty, chunk.blocks)))
            found = [(chunk.empty[named], named, 0)]
            for k, codes, ok, _ in chunk.levels():
                here = np.flatnonzero(ok)
                here = here[may_hold(wanted.value, _local(codes[here], chunk.block[here]))]
                found.append((codes[here], here, k))
            for codes, places, k in found:
                codes, first = np.unique(codes.view(np.int64), return_index=True)
                for code, place in zip(codes.tolist(), places[first].tolist()):
                    doc = int(chunk.doc[place]) if k else place
                    end = place - int(chunk.start[doc]) + 1
                    phrase = b" ".join(chunk.texts[doc][end - k:end]) if k else b""
                    out.append((code, names[doc], phrase.decode(), k))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    spelt = rows.mapInArrow(spell, "code long, lang string, phrase string, k int").groupBy("code").agg(
        *[F.any_value(c).alias(c) for c in ("lang", "phrase", "k")])
    return frequent.join(spelt, "code").select("lang", "phrase", "k", F.col("n").alias("f"))


def _exact(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, shards: int = SHARDS,
    contained: int = CONTAINED, reported: int = REPORTED, doc_id: str | None = None,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first phrases of every language by their weakest cut."""
    phrases = stored(frequent_phrases(docs, text, lang, support, shards, doc_id), "phrases")
    total = phrases.filter("k = 0").select("lang", F.col("f").alias("n"))
    known = phrases.filter("k > 0").select("lang", F.col("phrase").alias("part"), "f")
    several = phrases.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"))
    cuts = several.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "*", F.expr("substring_index(phrase, ' ', cut)").alias("head"), F.expr("substring_index(phrase, ' ', cut - k)").alias("tail"))
    scored = (
        cuts.join(known.withColumnsRenamed({"part": "head", "f": "l"}), ["lang", "head"])
        .join(known.withColumnsRenamed({"part": "tail", "f": "r"}), ["lang", "tail"])
        .withColumn("score", F.expr(
            "(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))"))
        .groupBy("lang", "phrase").agg(F.any_value("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    )
    inside = several.filter("k > 2").select("lang", F.col("a").alias("longer"), F.explode(F.array(
        F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substring_index(phrase, ' ', 1 - k)"))).alias("phrase")).groupBy(
        "lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * contained)).select(
        "lang", "phrase", "a", "best.l", "best.r", F.col("best.score").cast("long").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = kept.withColumn("_place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).filter(
        F.col("_place") <= reported)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(
        F.col("rank") <= reported)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
