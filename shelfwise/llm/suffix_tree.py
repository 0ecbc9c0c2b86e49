"""Language-model scores from a probabilistic suffix tree over words.

The tree's states are contexts of up to ``depth`` words. A transition (a context and the word after it) is counted
when it occurs ``MIN_COUNT`` times, at every size of the corpus. A context is kept when the distribution of what follows
it diverges from that of its longest kept suffix by more than its description costs. Next-word distributions are
smoothed by discounting every count and giving what is freed to the suffix's distribution; the root discounts in favour
of unseen words. A token is scored in the state of the longest kept suffix before it.

The tree is a Spark table of word sequences (grams) and grows with the corpus. It is built a level at a time by joins
with the level below: a gram's suffix has the lower probability, its prefix the total. A text's log-probability is a sum
over its words and grams, one number for each: what a gram gains as a transition over its suffix, and what it leaves to
its suffix as a context. Both are known for a level when the contexts of the next one are, so texts are scored a level at
a time, and no more than two levels are on disk. In each pass texts look their grams up in one exchange: the codes they
ask for meet the table's entries in ranges of codes, packed; a second one brings the answers to a chunk of texts together.
What the workers get is bounded: the words and grams with a share of ``known_share`` of all tokens, so that no range is
hot, and bitmaps of bounded size that only save looking up what is certainly absent. Above some 10^8 grams they save
little; results stay the same. Words and grams are told apart by 64-bit hashes: 10^9 grams hold two of one hash with a
chance of about 3%, and such two count as one.

Texts are hashed once and stored in blocks, the tokens as places in a list of the block's words. A level reads them twice:
codes are counted packed (see ``packed``), then those that occur often enough are sent with their prefix and suffix, by
the blocks with the mark that came with the count. What a step leaves behind on disk is deleted as soon as nothing reads it.

Defined cases: null and empty texts have the end token only; rows without an id are scored like any other and take
part in training as their empty id text decides; without training tokens every token is unseen; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.checkpoints import discard, stored
from .common import bound_batches, small_batches
from .near_dup import _mix
from .packed import (
    BUCKET, CHUNK, SENT_AT_ONCE, bucket_bounds, count, fitted_bitmap, may_hold, pack, pack_numbers, unpack, unpack_numbers,
)

# Share of all training tokens from which a word or gram is sent to the workers instead of joined.
KNOWN_SHARE = 1e-6
# Occurrences that a word, state or transition of the tree needs; a share of all tokens can be asked for on top.
MIN_COUNT, NODE_SHARE = 2, 0.0
DEPTH = 3
DISCOUNT = 0.5
END = np.uint64(0)
# Marks of blocks of texts; blocks with one of them send a gram with its parts. Tokens of a block, unless one text has more.
BLOCKS, BLOCK_TOKENS = 256, 1 << 20
ODD, SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def grams(h: np.ndarray, starts: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per level: the codes of the grams that end at each token, of their prefixes and suffixes, and which ones exist.

    A text is preceded by an end token, and grams do not reach further back.
    """
    offset = np.arange(len(h)) - np.repeat(starts, np.diff(np.append(starts, len(h))))
    below = h
    for k in range(depth):
        prefix = np.empty_like(below)
        prefix[:1], prefix[1:] = END, below[:-1]
        codes = _mix(prefix * ODD + h + SALT)
        yield codes, prefix, below, offset >= k
        below = codes


def find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of ``values`` in a sorted table, -1 where absent."""
    if not len(table):
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return np.where(table[at] == values, at, -1)


def tokenized(rows: DataFrame) -> DataFrame:
    """Blocks of the texts in ``doc_id, text, training``, apart by ``training``.

    ``words`` has the hashes of a block's distinct words, the end token first, ``tokens`` the places in it of all its
    tokens, byte by byte, ``sizes`` the tokens of each text, ``docs`` and ``rows`` its id and number, ``block`` one of
    ``BLOCKS`` marks. Marks and numbers are fixed only when the table is stored.
    """
    longs = pa.list_(pa.int64())
    schema = pa.schema([("training", pa.bool_()), ("block", pa.int64()), ("docs", longs), ("rows", longs),
                        ("sizes", longs), ("words", pa.binary()), ("tokens", pa.binary())])

    def block(training: bool | None, held: list[tuple]) -> pa.RecordBatch:
        docs, numbers, lengths = (np.concatenate(c) if i else [d for some in c for d in some]
                                  for i, c in enumerate(list(zip(*held))[:3]))
        coded = pa.chunked_array([h[3] for h in held]).combine_chunks().dictionary_encode()
        words = np.array([int(END), *map(xxhash.xxh3_64_intdigest, coded.dictionary.cast(pa.large_binary()).to_pylist())], np.uint64)
        places = np.zeros(len(coded) + len(lengths), np.uint32)  # 0: the end token
        inside = np.ones(len(places), bool)
        inside[np.cumsum(lengths + 1) - 1] = False
        places[inside] = coded.indices.to_numpy() + 1
        mark = int(numbers[0]) * int(ODD) % 2**64 * BLOCKS >> 64
        return pa.RecordBatch.from_arrays([
            pa.array([training], pa.bool_()), pa.array([mark]), pa.array([docs], longs), pa.array([numbers], longs),
            pa.array([lengths + 1], longs), pa.array([words.tobytes()], pa.binary()),
            pa.array([_places_packed(places, len(words))], pa.binary())], schema=schema)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, blocks_ = TaskContext.get().partitionId() << 33, {}
        for batch in small_batches(batches):
            numbers = np.arange(number, number + batch.num_rows)
            number += batch.num_rows
            marks = batch.column(2).to_pylist()
            for training in set(marks):
                chosen = np.array([m is training for m in marks])
                some = batch.filter(pa.array(chosen))
                # Cuts at the six bytes of WORD; blanks at either end of a text give empty words.
                split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(some.column(1), "")))
                words, text = split.flatten(), pc.list_parent_indices(split).to_numpy()
                full = pc.greater(pc.binary_length(words), 0)
                lengths = np.bincount(text[full.to_numpy(zero_copy_only=False)], minlength=some.num_rows)
                held, size = blocks_.get(training, ([], 0))
                held.append((some.column(0).to_pylist(), numbers[chosen], lengths, words.filter(full)))
                size += int(lengths.sum()) + some.num_rows
                blocks_[training] = held, size
                if size >= BLOCK_TOKENS:
                    yield block(training, blocks_.pop(training)[0])
        for training, (held, _) in blocks_.items():
            yield block(training, held)

    return rows.select("doc_id", "text", "training").mapInArrow(
        compute, "training boolean, block long, docs array<long>, rows array<long>, sizes array<long>, words binary, tokens binary")


def _places_packed(places: np.ndarray, size: int) -> bytes:
    """Numbers below ``size`` in the fewest bytes: all lowest bytes, then all second ones, and so on."""
    width = max(1, ((size - 1).bit_length() + 7) // 8)
    return places.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()


def _places_unpacked(data: bytes, length: int) -> np.ndarray:
    columns = np.frombuffer(data, np.uint8).reshape(-1, length)
    out = np.zeros((length, 4), np.uint8)
    out[:, :len(columns)] = columns.T
    return out.reshape(-1).view("<u4")


@dataclass
class Block:
    """Texts behind each other: hashes of the distinct words, tokens as places in them, where each text starts."""

    mark: int
    words: np.ndarray
    places: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    rows: np.ndarray

    @property
    def tokens(self) -> np.ndarray:
        return self.words[self.places]

    def level(self, level: int) -> tuple[np.ndarray, ...]:
        """Codes, prefixes and suffixes of a level's grams, and which of them exist."""
        return list(grams(self.tokens, self.starts, level))[-1]


STORED_BLOCK = ["block", "rows", "sizes", "words", "tokens"]


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    """The blocks in batches of the columns ``STORED_BLOCK``."""
    for batch in batches:
        for mark, rows, sizes, words, tokens in zip(*[batch.column(c) for c in STORED_BLOCK]):
            lengths = sizes.values.to_numpy()
            starts = np.cumsum(lengths) - lengths
            yield Block(mark.as_py(), np.frombuffer(words.as_buffer(), np.uint64),
                        _places_unpacked(tokens.as_buffer(), int(lengths.sum())), starts, lengths, rows.values.to_numpy())


@contextmanager
def _sent(table: DataFrame, value: object) -> Iterator[Broadcast]:
    """``value`` sent to the workers, for jobs that end inside; its copies on their disks go afterwards."""
    sent = table.sparkSession.sparkContext.broadcast(value)
    try:
        yield sent
    finally:
        sent.destroy()


def _of_block(codes: np.ndarray, mark: int) -> np.ndarray:
    """Codes as bits of the share that a mark of blocks has of a bitmap."""
    return codes ^ np.uint64((mark + 1) * int(ODD) % 2**64)


def _of_block_column(code: str, block: str) -> Column:
    shares = F.array(*[F.lit(((b + 1) * int(ODD) + 2**63) % 2**64 - 2**63).cast("long") for b in range(BLOCKS)])
    return F.col(code).bitwiseXOR(F.get(shares, F.col(block).cast("int")))


def _count_words(tokens: DataFrame, buckets: int) -> DataFrame:
    def make():
        def codes_of(batch: pa.RecordBatch):
            for b in blocks([batch]):
                yield 0, b.words, np.bincount(b.places, minlength=len(b.words))

        return codes_of

    # The end token is in every block's list of words, and in every text.
    return count(tokens, make, buckets).select("code", "n")


def _count_grams(tokens: DataFrame, level: int, sent: Broadcast, least: float, buckets: int) -> DataFrame:
    """``code, n, mark`` of grams with ``least`` occurrences; ``mark`` is that of a block of texts that has one.

    A gram whose prefix or suffix is too rare is too rare itself; ``sent`` is a bitmap of those that are not.
    """
    def make():
        def codes_of(batch: pa.RecordBatch):
            for b in blocks([batch]):
                code, _, suffix, ok = b.level(level)
                often = may_hold(sent.value, b.words)[b.places] if level == 1 else may_hold(sent.value, suffix)
                ok = ok & often
                ok[1:] &= often[:-1]
                code = code[ok]
                yield 0, code, None, np.full(len(code), b.mark)

        return codes_of

    return count(tokens, make, buckets, least, marked=True).select("code", "n", "mark")


def _take_apart(tokens: DataFrame, level: int, counted: DataFrame, sent: Broadcast, buckets: int) -> DataFrame:
    """``code, prefix, suffix, n`` of counted grams; ``sent`` is a bitmap of them with their marks.

    Both the grams with their parts and the counts are sent packed, by ranges of codes.
    """
    schema = pa.schema([("bucket", pa.int32()), ("codes", pa.binary()), ("prefixes", pa.binary()), ("suffixes", pa.binary()),
                        ("numbers", pa.binary())])
    kinds = "bucket int, codes binary, prefixes binary, suffixes binary, numbers binary"

    def row(bucket: int, codes: np.ndarray, prefixes: bytes | None, suffixes: bytes | None, numbers: bytes | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *[
            pa.array([c], pa.binary()) for c in (pack(codes), prefixes, suffixes, numbers)]], schema=schema)

    def send(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        code, prefix, suffix = (np.concatenate(c) for c in zip(*held))
        code, first = np.unique(code, return_index=True)
        prefix, suffix = prefix[first], suffix[first]
        for b, some in _ranges(code, buckets):
            yield row(b, code[some], prefix[some].tobytes(), suffix[some].tobytes(), None)

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in blocks(batches):
            code, prefix, suffix, ok = b.level(level)
            here = np.flatnonzero(ok)
            here = here[may_hold(sent.value, _of_block(code[here], b.mark))]
            held.append((code[here], prefix[here], suffix[here]))
            size += len(here)
            if size >= CHUNK:
                yield from send(held)
                held, size = [], 0
        if size:
            yield from send(held)

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy().view(np.uint64)
            order = np.argsort(code)
            code, n = code[order], batch.column(1).to_numpy()[order]
            for b, some in _ranges(code, buckets):
                yield row(b, code[some], None, None, pack_numbers(n[some]))

    def whole(found: list[tuple], counted_: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not found or not counted_:
            return
        code, prefix, suffix = (np.concatenate(c) for c in zip(*found))
        known, n = (np.concatenate(c) for c in zip(*counted_))
        order = np.argsort(known)
        known, n = known[order], n[order]
        code, first = np.unique(code, return_index=True)
        place = find(known, code)
        first, place = first[place >= 0], place[place >= 0]
        columns = known[place].view(np.int64), prefix[first].view(np.int64), suffix[first].view(np.int64), n[place]
        for at in range(0, len(place), SENT_AT_ONCE):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[at:at + SENT_AT_ONCE]) for c in columns], ["code", "prefix", "suffix", "n"])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, found, counted_ = None, [], []
        for batch in batches:
            for b, codes, prefixes, suffixes, numbers in zip(*[c.to_pylist() for c in batch.columns]):
                if b != bucket:
                    yield from whole(found, counted_)
                    bucket, found, counted_ = b, [], []
                if numbers is None:
                    found.append((unpack(codes), np.frombuffer(prefixes, np.uint64), np.frombuffer(suffixes, np.uint64)))
                else:
                    counted_.append((unpack(codes), unpack_numbers(numbers)))
        yield from whole(found, counted_)

    sent_rows = tokens.mapInArrow(parts, kinds).unionByName(counted.select("code", "n").mapInArrow(counts, kinds))
    return sent_rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        merge, "code long, prefix long, suffix long, n long")


def _arrays(rows: DataFrame) -> list[np.ndarray]:
    """A bounded table as arrays, sorted by the unsigned code in its first column."""
    data = rows.toArrow()
    codes = data.column(0).to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(codes)
    return [codes[order], *[data.column(i).to_numpy()[order] for i in range(1, data.num_columns)]]


def _ranges(codes: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The ranges of sorted codes that fall into each bucket."""
    cuts = np.concatenate([[0], np.searchsorted(codes, bucket_bounds(buckets)), [len(codes)]])
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, slice(cuts[b], cuts[b + 1])


@dataclass
class Model:
    """Totals of the training tokens, and ``counts``: ``code, n`` of all words."""

    tokens: int
    distinct: int
    singles: int
    doubles: int
    counts: DataFrame
    buckets: int

    @property
    def root_discount(self) -> float:
        return (self.singles + 0.5) / (self.singles + 2 * self.doubles + 1.0)

    @property
    def unseen(self) -> float:
        """Probability of all unseen words together."""
        return self.root_discount * self.distinct / max(1, self.tokens) if self.distinct else 1.0


def _level(parts: DataFrame, lower: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decide which contexts of a level are kept and smooth their transitions.

    ``parts`` has ``code, prefix, suffix, n``, ``lower`` the level below: ``code, n, logp``. A context's distribution is
    compared with the one its suffix gives: the gain in log-likelihood over its occurrences, for the counted transitions and
    for all the rest, has to exceed the price of its parameters. Returns the level with the ``value`` of each transition,
    and the kept contexts.
    """
    grams_ = stored(parts.join(lower.select(F.col("code").alias("suffix"), F.col("logp").alias("lower")), "suffix")
                    .select("code", "prefix", "n", "lower"), "grams", clean=True)
    discard(parts)
    n, total = F.col("n"), F.col("total")
    rest = F.greatest(1 - F.col("mass"), F.lit(0.0))
    spent = F.when(rest > 0, total * rest * F.log(rest / F.greatest(1 - F.col("below"), F.lit(1e-12)))).otherwise(0.0)
    states = (
        grams_.groupBy("prefix").agg(
            F.sum("n").alias("followed"), F.count(F.lit(1)).alias("entries"),
            F.sum(n * (F.log(n) - F.col("lower"))).alias("gain"), F.sum(F.exp("lower")).alias("below"))
        .join(lower.select(F.col("code").alias("prefix"), F.col("n").alias("total")), "prefix")
        .withColumn("mass", F.col("followed") / total)
        .filter(F.col("gain") - F.col("followed") * F.log(total) + spent
                > 0.5 * (F.col("entries") + 1) * F.log(F.greatest(total, F.lit(2))))
        .select("prefix", "total", (1 - (F.col("followed") - DISCOUNT * F.col("entries")) / total).alias("rest")))
    states = stored(states, "contexts", clean=True)
    logp = F.coalesce(F.log((n - DISCOUNT) / total + F.col("rest") * F.exp("lower")), F.col("lower"))
    level = stored(grams_.join(states, "prefix", "left").select(
        "code", "n", logp.alias("logp"),
        F.coalesce(logp - F.col("lower") - F.log("rest"), F.lit(0.0)).alias("value")), "level", clean=True)
    discard(grams_)
    return level, states


def count_words(tokens: DataFrame) -> Model:
    """Learn from a table of ``STORED_BLOCK`` as :func:`tokenized` gives it."""
    size = tokens.agg(F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)), F.lit(0))).first()[0]
    buckets = max(int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET + 1)
    counts = stored(_count_words(tokens, buckets), "token-counts", clean=True)
    total = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words"),
        F.count_if(F.col("n") == 1).alias("singles"), F.count_if(F.col("n") == 2).alias("doubles")).first()
    return Model(total["tokens"], total["words"], total["singles"], total["doubles"], counts, buckets)


def tables(tokens: DataFrame, model: Model, depth: int = DEPTH, node_share: float = NODE_SHARE) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Per level, words first: ``code, n, value`` of its words or grams, and of those that are contexts.

    The two values of a gram add up to the natural logarithm by which each of its occurrences changes a text's probability:
    as a transition (0 for words) and as a context. The tables are deleted when the next ones are asked for.
    """
    least = max(MIN_COUNT, node_share * model.tokens)  # of a word, state or transition of the tree
    lower = model.counts.filter(F.col("n") >= least).withColumn(
        "logp", F.log((F.col("n") - model.root_discount) / max(1, model.tokens)))
    table, below = model.counts.withColumn("value", F.lit(0.0)), [model.counts]
    for d in range(1, depth + 1):
        with _sent(tokens, fitted_bitmap(lower)) as sent:
            counted = stored(_count_grams(tokens, d, sent, least, model.buckets), "gram-counts", clean=True)
        with _sent(tokens, fitted_bitmap(counted, _of_block_column("code", "mark"))) as sent:
            parts = stored(_take_apart(tokens, d, counted, sent, model.buckets), "parts", clean=True)
        discard(counted)
        level, states = _level(parts, lower)
        contexts = states.select(F.col("prefix").alias("code"), F.col("total").alias("n"), F.log("rest").alias("value"))
        yield table, contexts
        discard(states, *below)
        table, lower, below = level.select("code", "n", "value"), level.drop("value"), [level]
    yield table, table.limit(0)
    discard(*below)


# What meets in a bucket: entries of the table (no chunk; ``values`` are theirs), codes that a chunk of texts asks for (with
# the ``numbers`` of its texts), and a chunk's own sums. What meets for a chunk: its own sums, with its texts' rows, and
# what each bucket adds to the texts of ``numbers``.
ASKED = pa.schema([
    ("bucket", pa.int32()), ("chunk", pa.int64()), ("codes", pa.binary()), ("numbers", pa.binary()), ("values", pa.binary()),
    ("rows", pa.binary())])
ANSWERED = pa.schema([("chunk", pa.int64()), ("numbers", pa.binary()), ("values", pa.binary()), ("rows", pa.binary())])
SUMS = pa.schema([("row", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("model", pa.float64())])
SQL_TYPES = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double", pa.binary(): "binary"}


def _sql(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {SQL_TYPES[f.type]}" for f in schema)


def _row(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A row with some columns of a schema, nulls in the others."""
    return pa.RecordBatch.from_arrays([pa.array([columns.get(f.name)], f.type) for f in schema], schema=schema)


def _merged(codes: np.ndarray, n: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct codes with the sums of their numbers and values."""
    order = np.argsort(codes)
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.empty(0, np.int64)
    if len(first) == len(codes):
        return codes, n[order], values[order]
    return codes[first], np.add.reduceat(n[order], first), np.add.reduceat(values[order], first)


def _sums(texts: DataFrame, level: int, table: DataFrame, contexts: DataFrame, least: float) -> DataFrame:
    """``row, n_known, base, model``: per text, the sums over its words or its grams of a level that are in the table.

    ``table`` and ``contexts`` have ``code, n, value``. Each word of the table that is found adds 1 to ``n_known`` and
    log10(n + 1) to ``base``; the values of each code that is found are added to ``model``. Codes that occur ``least`` times
    go to the workers.
    """
    spark, often, none = texts.sparkSession, F.col("n") >= least, F.lit(0).cast("long")
    entries_ = table.select("code", F.col("n") if level == 0 else none.alias("n"), "value", often.alias("often")).unionByName(
        contexts.select("code", none.alias("n"), "value", often.alias("often")))
    rare = entries_.filter(~F.col("often")).drop("often")
    known = *_merged(*_arrays(entries_.filter("often").drop("often"))), fitted_bitmap(rare) if level else None
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rare.count() // BUCKET + 1)
    wide = 3 if level == 0 else 1  # sums of a text: model, base, n_known

    def adds(n: np.ndarray, value: np.ndarray) -> list[np.ndarray]:
        return [value, np.log10(n + 1), (n > 0).astype(float)][:wide]

    def asked(chunk: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows, sums, codes, numbers = (np.concatenate(c, axis=-1) for c in zip(*held))
        yield _row(ASKED, bucket=chunk % buckets, chunk=chunk, values=sums.tobytes(), rows=rows.tobytes())
        order = np.argsort(codes)
        codes, numbers = codes[order], numbers[order]
        for b, some in _ranges(codes, buckets):
            yield _row(ASKED, bucket=b, chunk=chunk, codes=pack(codes[some]), numbers=pack_numbers(numbers[some]))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, value, bitmap = sent.value
        gains = [np.append(a, 0.0) for a in adds(n, value)]  # the last one for place -1
        chunk, held, size, at = None, [], 0, 0
        for b in blocks(batches):
            texts_ = np.repeat(np.arange(len(b.lengths)), b.lengths)
            if level:
                code, _, _, ok = b.level(level)
                here = np.flatnonzero(ok)
                code, texts_ = code[here], texts_[here]
                place = find(codes, code)
                ask = (place < 0) & may_hold(bitmap, code)
            else:
                code, place = b.tokens, find(codes, b.words)[b.places]
                ask = place < 0
            chunk = int(b.rows[0]) if chunk is None else chunk
            held.append((b.rows, np.array([np.bincount(texts_, g[place], len(b.lengths)) for g in gains]),
                         code[ask], at + texts_[ask]))
            at, size = at + len(b.lengths), size + len(held[-1][2]) + len(b.lengths)
            if size >= CHUNK:
                yield from asked(chunk, held)
                chunk, held, size, at = None, [], 0, 0
        if held:
            yield from asked(chunk, held)

    def pack_table(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy().view(np.uint64)
            order = np.argsort(code)
            code, n, value = code[order], batch.column(1).to_numpy()[order], batch.column(2).to_numpy()[order]
            for b, some in _ranges(code, buckets):
                yield _row(ASKED, bucket=b, codes=pack(code[some]), numbers=pack_numbers(n[some]), values=value[some].tobytes())

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, entries = None, [], None
        for batch in batches:
            for b, chunk, codes, numbers, values, rows in zip(*[c.to_pylist() for c in batch.columns]):
                if b != bucket:
                    bucket, held, entries = b, [], None
                if rows is not None:
                    yield _row(ANSWERED, chunk=chunk, values=values, rows=rows)
                elif chunk is None:
                    held.append((unpack(codes), unpack_numbers(numbers), np.frombuffer(values)))
                elif held:
                    if entries is None:
                        code, n, value = _merged(*[np.concatenate(c) for c in zip(*held)])
                        entries = code, adds(n, value)
                    place = find(entries[0], unpack(codes))
                    hit = place >= 0
                    text, place = unpack_numbers(numbers)[hit], place[hit]
                    if len(text):
                        used = np.flatnonzero(np.bincount(text))
                        sums = np.array([np.bincount(text, g[place])[used] for g in entries[1]])
                        yield _row(ANSWERED, chunk=chunk, numbers=pack_numbers(used), values=sums.tobytes())

    def added(rows: bytes, own: bytes, more: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        sums = np.frombuffer(own).reshape(wide, -1).copy()
        for numbers, values in more:
            sums[:, unpack_numbers(numbers)] += np.frombuffer(values).reshape(wide, -1)
        model, base, n_known = [*sums, *[np.zeros(sums.shape[1])] * (3 - wide)]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.frombuffer(rows, np.int64)), pa.array(n_known.round().astype(np.int64)), pa.array(base), pa.array(model),
        ], schema=SUMS)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, own, more = None, None, []
        for batch in batches:
            for c, numbers, values, rows in zip(*[c.to_pylist() for c in batch.columns]):
                if c != chunk:
                    if own:
                        yield from added(*own, more)
                    chunk, own, more = c, None, []
                if rows is not None:
                    own = rows, values
                else:
                    more.append((numbers, values))
        if own:
            yield from added(*own, more)

    with _sent(texts, known) as sent:
        parts = texts.select(*STORED_BLOCK).mapInArrow(compute, _sql(ASKED)).unionByName(
            rare.mapInArrow(pack_table, _sql(ASKED)))
        # Entries of the table come first in their bucket.
        answers = parts.repartition("bucket").sortWithinPartitions("bucket", F.col("chunk").asc_nulls_first()).mapInArrow(
            answer, _sql(ANSWERED))
        return stored(answers.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, _sql(SUMS)), "sums", clean=True)


def score(
    docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH,
    known_share: float = KNOWN_SHARE, node_share: float = NODE_SHARE,
) -> DataFrame:
    """Per row: ``doc_id, training, n_tokens, n_known, train_tokens, base_score, score``.

    ``training`` marks the rows to learn from. ``base_score`` is that of add-one single-word frequencies.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       training.alias("training"))
    texts = stored(tokenized(rows), "tokens", clean=True)
    tokens = texts.filter("training").select(*STORED_BLOCK)
    model = count_words(tokens)
    total, unseen = max(1, model.tokens), log(model.unseen)
    sums = []
    for level, (table, contexts) in enumerate(tables(tokens, model, depth, node_share)):
        if level == 0:
            logp = F.log((F.col("n") - model.root_discount) / total)
            table = table.withColumn("value", logp + F.col("value") - unseen)
        else:
            table = table.filter(F.col("value") != 0)
        sums.append(_sums(texts, level, table, contexts, known_share * model.tokens))
    n, below = F.col("n_tokens"), F.lit(float(model.tokens + model.distinct + 1))
    parts = texts.select("training", F.explode(F.arrays_zip("rows", "docs", "sizes")).alias("t")).select(
        F.col("t.rows").alias("row"), F.col("t.docs").alias("doc_id"), "training", F.col("t.sizes").alias("n_tokens"))
    for some in sums:
        parts = parts.unionByName(some, allowMissingColumns=True)
    # Every token counts as unseen first; each one found adds to that.
    scored = parts.groupBy("row").agg(
        *[F.max(c).alias(c) for c in ("doc_id", "training", "n_tokens")],
        *[F.sum(c).alias(c) for c in ("n_known", "base", "model")]).select(
        "doc_id", "training", "n_tokens", "n_known", (F.col("base") - n * F.log10(below)).alias("base"),
        (F.col("model") + n * unseen).alias("model"))
    scored = stored(scored, "scored", clean=True)
    discard(texts, *sums)
    return scored.select(
        "doc_id", "training", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("model") / log(10)).alias("score"))
