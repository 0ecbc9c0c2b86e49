"""Token ids in binary files with Elias-Fano coded document boundaries.

A file holds the concatenated ids of its documents and two monotone sequences: the start of every document and the
document ids. Each is kept as low bits, packed, and high bits in unary with a sample of every 256th one: about
``2 + log2(universe / n)`` bits a value, and ``select`` finds one value without a table of 64-bit offsets.

Documents are dealt to shards by ranges of their id, sorted there, encoded and written as they come; a shard starts a
new file when ``file_ids`` ids are reached, so a task holds one file's ids at most. The manifest has a row per file.

Defined cases: a null text is empty and has the end id only; rows without an id come first, in order of their text;
rows that repeat stand next to each other; an empty table gives an empty store.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.checkpoints import scratch_path
from .common import bound_batches, utf8
from .files import NewFile, range_limits, read_file, shard_of

MAGIC = b"IDEF"
HEADER, SECTION = "<4sHHQQQq", "<QQBQQ"
SAMPLE = 256
REMEMBERED = 1_200_000
# White space other than blanks and line feeds. Fixed values.
OTHER_BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in ' \n']
NULL_KEY = -(2**63)


class EliasFano:
    """A non-decreasing sequence of numbers from 0."""

    def __init__(self, n: int, universe: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 0
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        return cls(n, universe, low_bits, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes(),
                   np.packbits(unary, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = struct.pack(SECTION, self.n, self.universe, self.low_bits, len(self.low), len(self.high))
        return head + self.low + self.high + self.samples.tobytes()

    @classmethod
    def read(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        """The sequence that starts at byte ``at``, and where it ends."""
        n, universe, low_bits, nl, nh = struct.unpack_from(SECTION, data, at)
        at += struct.calcsize(SECTION)
        count = -(-n // SAMPLE)
        samples = np.frombuffer(data, "<u4", count, at + nl + nh)
        return cls(n, universe, low_bits, data[at:at + nl], data[at + nl:at + nl + nh], samples), at + nl + nh + 4 * count

    def _lows(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, np.uint64)
        begin, end = first * self.low_bits, (first + count) * self.low_bits
        packed = np.frombuffer(self.low, np.uint8)[begin // 8:-(-end // 8)]
        bits = np.unpackbits(packed, bitorder="little")[begin % 8:begin % 8 + end - begin]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (bits.reshape(count, self.low_bits).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The value at place ``i``: from the sample before it, over at most one sample's span of high bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        block = i // SAMPLE
        begin = int(self.samples[block])
        end = int(self.samples[block + 1]) if block + 1 < len(self.samples) else len(self.high) * 8
        packed = np.frombuffer(self.high, np.uint8)[begin // 8:end // 8 + 1]
        ones = np.flatnonzero(np.unpackbits(packed, bitorder="little")[begin % 8:])
        place = begin + int(ones[i - block * SAMPLE])
        return (place - i << self.low_bits) + int(self._lows(i, 1)[0])

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[:self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) + self._lows(0, self.n)


class Numbers(dict):
    """Numbers of words in the order in which they come up first."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Ids of whole texts as little-endian bytes of ``width`` bytes an id.

    The pre-tokenizer never joins what stands before a single blank, or around a single line feed, with what follows.
    So the ids of each such piece are worked out once and kept in one array, up to a bound; a text is put together
    from them. Texts with any other white space, or several in a row, go to the tokenizer as a whole.

    With ``added`` the string of an added token stands for its id, as the library has it by default, and texts with such a
    string go to the tokenizer as a whole; without, strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, width: int, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        tokens = [t for t in self.tokenizer.get_added_tokens_decoder().values() if added or not t.special]
        # Strings that pieces may make up when they are put together, or that a text holds only once normalized.
        self.whole = any(any(c.isspace() for c in t.content) or t.normalized and self.tokenizer.normalizer is not None
                         for t in tokens)
        self.added = [t.content for t in tokens]
        self.kind = f"<u{width}"
        blank = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        self.blank = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.blank[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith(blank)]] = True
        self.feed = len(self._direct(["\n"])[0])
        self._forget()

    def _forget(self) -> None:
        self.numbers = Numbers()
        self.ids, self.starts, self.sizes = np.empty(0, self.kind), np.empty(0, np.int64), np.empty(0, np.int64)

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, text: str) -> list[str] | None:
        """The words; the first one of a line has its line feed in front, also the first one of the text.

        None if the white space of the text is not that plain, or an added token stands in it.
        """
        if (self.whole or any(t in text for t in self.added) or text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text
                or any(c in text for c in OTHER_BLANKS)):
            return None
        return ("\n" + text.replace("\n", " \n")).split(" ")

    def _learn(self) -> None:
        """Work out the ids of new words. Those with a blank in front are encoded many at a time: only a word's first
        token starts with its blank."""
        words, self.numbers.new = self.numbers.new, []
        starts, sizes = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        parts, at = [self.ids], len(self.ids)
        first = [n for n, w in enumerate(words) if w[0] == "\n"]
        for n, ids in zip(first, self._direct([words[n] for n in first])):
            starts[n], sizes[n] = at, len(ids)
            parts.append(ids)
            at += len(ids)
        spaced = [n for n, w in enumerate(words) if w[0] != "\n"]
        for begin in range(0, len(spaced), 1024):
            some = spaced[begin:begin + 1024]
            ids = self._direct([" " + " ".join([words[n] for n in some])])[0]
            inside = np.flatnonzero(self.blank[ids])
            if len(inside) != len(some):
                raise ValueError("the tokenizer joins words across blanks")
            starts[some], sizes[some] = at + inside, np.diff(np.append(inside, len(ids)))
            parts.append(ids)
            at += len(ids)
        self.ids = np.concatenate(parts)
        self.starts, self.sizes = np.append(self.starts, starts), np.append(self.sizes, sizes)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of texts, of which a few hundred are held at a time."""
        try:
            return [ids for at in range(0, len(texts), 256) for ids in self._some(texts[at:at + 256])]
        except BaseException:
            self._forget()  # words may have numbers, but no ids yet
            raise

    def _some(self, texts: list[str]) -> list[bytes]:
        if len(self.numbers) > REMEMBERED:
            self._forget()
        cut = [self.pieces(t) if t else [] for t in texts]
        counts = np.array([len(c or ()) for c in cut])
        words = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(c for c in cut if c)), np.int64, counts.sum())
        if self.numbers.new:
            self._learn()
        sizes = self.sizes[words]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.starts[words] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [self._direct([t])[0].tobytes() if c is None else ids[min(a + self.feed, b):b].tobytes()
                for t, c, a, b in zip(texts, cut, upto, upto[1:])]


@lru_cache(maxsize=1)
def _encoder(path: str, width: int, added: bool, changed: int) -> Encoder:
    return Encoder(path, width, added)


def encoder_of(path: str, width: int, added: bool) -> Encoder:
    """The encoder that a worker keeps from task to task, with the words it has learned."""
    return _encoder(path, width, added, os.stat(path).st_mtime_ns)


MANIFEST = "shard long, part long, name string, docs long, ids long, bytes long, sha256 string"


def _file_bytes(keys: list[int | None], parts: list[bytes], width: int) -> Iterator[bytes]:
    """A file's bytes: header, starts, document ids, token ids."""
    nulls = sum(k is None for k in keys)
    known = np.array([k for k in keys if k is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    sizes = np.array([len(p) // width for p in parts], np.uint64)
    starts = np.concatenate([np.zeros(1, np.uint64), np.cumsum(sizes, dtype=np.uint64)])
    yield struct.pack(HEADER, MAGIC, 1, width, len(keys), int(starts[-1]), nulls, least)
    yield EliasFano.of(starts).to_bytes()
    yield EliasFano.of(known.astype(np.uint64) - np.uint64(least & (2**64 - 1))).to_bytes()
    yield from parts


class TokenFile:
    """A file read back."""

    def __init__(self, data: bytes):
        magic, version, width, self.docs, self.ids, self.nulls, self.least = struct.unpack_from(HEADER, data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token file")
        self.starts, at = EliasFano.read(data, struct.calcsize(HEADER))
        self.keys, at = EliasFano.read(data, at)
        self.tokens = np.frombuffer(data, f"<u{width}", self.ids, at)

    def document(self, i: int) -> np.ndarray:
        """The ids of document ``i``, end id included."""
        return self.tokens[self.starts.select(i):self.starts.select(i + 1)]

    def doc_ids(self) -> list[int | None]:
        known = (self.keys.values() + np.uint64(self.least & (2**64 - 1))).astype(np.int64)
        return [None] * self.nulls + known.tolist()


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2,
    width: int = 2, file_ids: int = 8_000_000, rows_per_shard: int = 16_384,
) -> DataFrame:
    """Write the store below ``folder``; returns its manifest, which is written last.

    ``tokenizer`` is the path of a tokenizer file that every worker can open; ``width`` the bytes of an id.
    """
    bound_batches(docs.sparkSession)
    key = F.coalesce(F.col("doc_id"), F.lit(NULL_KEY))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    limits = range_limits(rows.select("doc_id"), key, rows_per_shard)
    dealt = (
        rows.withColumn("shard", shard_of(key, limits)).repartitionById(len(limits) + 1, "shard")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    schema = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("name", pa.string()), ("docs", pa.int64()),
                        ("ids", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
    end = np.array([end_id], f"<u{width}").tobytes()

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, keys, parts, held, part, shard = None, [], [], 0, 0, None

        def roll() -> pa.RecordBatch:
            nonlocal keys, parts, held, part
            name = f"tokens-{shard:06d}-{part:06d}.bin"
            out = NewFile(folder, name)
            for piece in _file_bytes(keys, parts, width):
                out.write(piece)
            row = [shard, part, name, len(keys), held, out.size, out.commit()]
            keys, parts, held, part = [], [], 0, part + 1
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, schema)], schema=schema)

        for batch in batches:
            encoder = encoder or encoder_of(tokenizer, width, True)
            shard = batch.column(2)[0].as_py() if batch.num_rows else shard
            encoded = encoder.encode([b.decode("utf-8", "replace") for b in utf8(batch.column(1))])
            for k, ids in zip(batch.column(0).to_pylist(), encoded):
                keys.append(k)
                parts.append(ids + end)
                held += len(ids) // width + 1
                if held >= file_ids:
                    yield roll()
        if keys:
            yield roll()

    dealt.select("doc_id", "text", F.col("shard").cast("long")).mapInArrow(write, MANIFEST).write.parquet(
        f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of a store: ``doc_id, start`` (ids of all documents before it), ``n_tokens, ids_crc32``.

    The crc32 is that of the ids as little-endian unsigned 32-bit integers.
    """
    by_shard = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard, bounded
    by_part = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.groupBy("shard").agg(F.sum("ids").alias("_ids")).select(
        "shard", F.coalesce(F.sum("_ids").over(by_shard), F.lit(0)).alias("_base"))
    files = manifest.join(shards, "shard").select(
        "name", (F.col("_base") + F.coalesce(F.sum("ids").over(by_part), F.lit(0))).alias("base"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                stored = TokenFile(read_file(folder, name))
                starts = stored.starts.values().astype(np.int64)
                wide = stored.tokens.astype("<u4").tobytes()
                crc = [zlib.crc32(wide[4 * a:4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(stored.doc_ids(), pa.int64()), pa.array(starts[:-1] + base),
                     pa.array(np.diff(starts)), pa.array(crc, pa.int64())], schema=schema)

    return files.repartition(max(1, manifest.count())).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_tokens(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write a store in the shared folder and read it back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer, **options), folder)
