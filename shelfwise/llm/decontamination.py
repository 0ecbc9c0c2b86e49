"""Benchmark decontamination by greedy string tiling.

Items of a benchmark are found in documents even when their parts stand in another order. A seed is a run of
``min_match`` words; documents that share a seed with an item are tiled: the longest run of words that both sides
have, not yet covered on either, is marked again and again until no run of ``min_match`` words is left. The share of
the item's words under tiles is its coverage; an item is leaked by a document that covers at least ``threshold``.

Documents are read once per block of items. A block holds at most ``BLOCK_WORDS`` words of items, whatever the size of
the benchmark, so what is sent to the workers is bounded; an item longer than that is a block of its own.

Defined cases: null or empty texts and documents without seeds have no hits; items without words are skipped, items
shorter than ``min_match`` count as leaked where all their words stand together; items that repeat under several ids
are found under each, and texts that share an id each for itself; null item ids are skipped; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bound_batches, utf8
from .near_dup import WordHashes

MIN_MATCH = 4
THRESHOLD = 0.5
# Bound of the words of benchmark items that one pass over the documents carries.
BLOCK_WORDS = 2_000_000

# Bytes that are no part of a word become blanks; bytes of other scripts stay.
LOWERED = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))

MODULUS_BITS = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWERED).split()


def folded(text: bytes) -> bytes:
    """Lower case in every script, so that passages are found whatever their case."""
    return text if text.isascii() else text.decode("utf-8", "replace").lower().encode()


def run_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``length`` word hashes, modulo 2**64.

    Each run's polynomial is built from those of half its length, so that any length costs a few vector steps.
    """
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    if length == 1:
        return h.copy()
    half = length // 2
    part = run_hashes(h, half)
    out = part[:n] * np.uint64(pow(int(MODULUS_BITS), half, 2**64)) + part[half:half + n]
    return out * MODULUS_BITS + h[length - 1:length - 1 + n] if length % 2 else out


def tiling(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiles ``(place in item, place in doc, length)`` of two sequences of word hashes.

    The search length starts at the longest possible one and halves when all shared unmarked runs of it are dealt
    with. A match is lengthened to its full extent; the longest comes first, ties by place.
    """
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)
    tiles: list[tuple[int, int, int]] = []

    def open_runs(free: np.ndarray, length: int) -> np.ndarray:
        used = np.concatenate([[0], np.cumsum(~free)])
        return np.flatnonzero(used[length:] - used[:-length] == 0)

    length = min(len(item), len(doc))
    while length >= min_match:
        matches = []
        of_item, of_doc = run_hashes(item, length), run_hashes(doc, length)
        places = defaultdict(list)
        for at in open_runs(free_item, length):
            places[int(of_item[at])].append(int(at))
        open_doc = open_runs(free_doc, length)
        wanted = np.fromiter(places, np.uint64, len(places))
        for at in open_doc[np.isin(of_doc[open_doc], wanted)].tolist():
            for place in places[int(of_doc[at])]:
                if (place and at and free_item[place - 1] and free_doc[at - 1] and item[place - 1] == doc[at - 1]):
                    continue  # part of the match that starts one word earlier
                n = 0
                while (place + n < len(item) and at + n < len(doc) and free_item[place + n] and free_doc[at + n]
                       and item[place + n] == doc[at + n]):
                    n += 1
                if n >= length:
                    matches.append((-n, place, at))
        heapify(matches)
        while matches:
            n, place, at = heappop(matches)
            free = free_item[place:place - n] & free_doc[at:at - n]
            if free.all():
                free_item[place:place - n] = free_doc[at:at - n] = False
                tiles.append((place, at, -n))
                continue
            # Partly covered by now: what is left waits for its turn.
            edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
            for a, b in edges.reshape(-1, 2).tolist():
                if b - a >= length:
                    heappush(matches, (a - b, place + a, at + a))
        length = max(min_match, length // 2) if length > min_match else 0
    return tiles


def near_seeds(places: np.ndarray, span: int, n: int) -> list[tuple[int, int]]:
    """Stretches of a document, ``span`` words around each seed, merged where they touch."""
    merged: list[list[int]] = []
    for at in places.tolist():
        low, high = max(0, at - span), min(n, at + 2 * span)
        if merged and low <= merged[-1][1]:
            merged[-1][1] = high
        else:
            merged.append([low, high])
    return [(a, b) for a, b in merged]


class Block:
    """Items of one block and the index of their seeds."""

    def __init__(self, items: Sequence[tuple[int, bytes]], min_match: int):
        hashes = WordHashes()
        self.min_match = min_match
        self.ids = [item_id for item_id, _ in items]
        self.items = [hashes.of(words_of(folded(text))) for _, text in items]
        self.short: dict[int, list[int]] = defaultdict(list)
        seeds, owners = [], []
        for key, h in enumerate(self.items):
            if not len(h):
                continue
            if len(h) < min_match:
                self.short[len(h)].append(key)
                continue
            runs = np.unique(run_hashes(h, min_match))
            seeds.append(runs)
            owners.append(np.full(len(runs), key, np.int64))
        self.seeds = np.concatenate(seeds) if seeds else np.empty(0, np.uint64)
        self.owners = np.concatenate(owners) if owners else np.empty(0, np.int64)
        order = np.argsort(self.seeds, kind="stable")
        self.seeds, self.owners = self.seeds[order], self.owners[order]

    def covered(self, h: np.ndarray) -> dict[int, int]:
        """Words of each item (by its place in the block) that tiles of this document cover; items with no seed in it
        are left out."""
        found: dict[int, int] = {}
        for n, keys in self.short.items():
            runs = run_hashes(h, n)
            for key in keys:
                if len(runs) and (runs == run_hashes(self.items[key], n)[0]).any():
                    found[key] = n
        runs = run_hashes(h, self.min_match)
        if not len(runs) or not len(self.seeds):
            return found
        at = np.searchsorted(self.seeds, runs)
        hit = np.flatnonzero(self.seeds[np.minimum(at, len(self.seeds) - 1)] == runs)
        places = defaultdict(list)
        for place in hit.tolist():
            i = at[place]
            while i < len(self.seeds) and self.seeds[i] == runs[place]:
                places[int(self.owners[i])].append(place)
                i += 1
        for key, where in places.items():
            item = self.items[key]
            # Words outside of these stretches share no seed with the item, so no tile can lie there. A blank hash
            # of its own between stretches keeps runs from crossing them.
            parts = []
            for low, high in near_seeds(np.array(where), self.min_match, len(h)):
                parts += [h[low:high], np.array([len(parts)], np.uint64)]
            found[key] = sum(n for _, _, n in tiling(item, np.concatenate(parts), self.min_match))
        return found


def blocks_of(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of at most ``block_words`` words, fetched one partition at a time."""
    block, size = [], 0
    rows = benchmark.filter(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("long").alias("key"), F.col(text).alias("body")).distinct().orderBy("key", "body")
    for key, body in rows.toLocalIterator():
        data = (body or "").encode()
        n = len(data) // 2 + 1
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((key, data))
        size += n
    if block:
        yield block


def coverage(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    min_match: int = MIN_MATCH, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS,
):
    """A column with the leaked items of a text: an array of ``(item_id, item_words, covered, share)`` structs."""
    bound_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("item_words", pa.int64()), ("covered", pa.int64()),
                               ("share", pa.float64())]))
    sql = "array<struct<item_id: long, item_words: long, covered: long, share: double>>"

    def hits_with(items: list[tuple[int, bytes]]):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        @F.arrow_udf(sql)
        def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            block, hashes = Block(sent.value, min_match), WordHashes()
            for texts in batches:
                out = []
                for body in utf8(texts):
                    found = block.covered(hashes.of(words_of(folded(body))))
                    out.append([
                        {"item_id": block.ids[k], "item_words": len(block.items[k]), "covered": n,
                         "share": n / len(block.items[k])}
                        for k, n in sorted(found.items()) if n >= threshold * len(block.items[k])])
                yield pa.array(out, kind)

        return hits(F.coalesce(F.col(text), F.lit("")))

    found = [hits_with(b) for b in blocks_of(benchmark, item_id, item_text, block_words)]
    return F.concat(*found) if found else F.array().cast(sql)


def scan(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options,
) -> DataFrame:
    """Per document: ``doc_id``, its leaked ``items`` in order, the largest ``share`` (0 without any), ``leaked``."""
    hits = coverage(docs, benchmark, text, **options)
    return docs.select(F.col(doc_id).alias("doc_id"), hits.alias("hits")).select(
        "doc_id", F.array_sort(F.transform("hits", lambda x: x["item_id"])).alias("items"),
        F.coalesce(F.array_max(F.transform("hits", lambda x: x["share"])), F.lit(0.0)).alias("share"),
        (F.size("hits") > 0).alias("leaked"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows that leak no item, columns unchanged."""
    return docs.filter(F.size(coverage(docs, benchmark, text, **options)) == 0)
