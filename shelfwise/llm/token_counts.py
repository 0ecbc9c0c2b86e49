"""Token counts under a unigram vocabulary, with a trie that shares the work of common prefixes.

The best segmentation of a pre-token is found by forward scores: the best score of a prefix is the largest, over the
pieces that end it, of the piece's score plus the best score of what is left. That depends on the prefix only, so in
a trie over the distinct pre-tokens each node's score is worked out once, and a pre-token's count is that of its last
node, which is kept. Every worker walks the trie of the pre-tokens that it meets first, depth first, with the current
path in memory, and remembers ``REMEMBERED`` counts at most: no shuffle, and a bounded memory for any vocabulary and text.

A pre-token is a word with the mark of a blank in front. A code point that no piece covers counts as its UTF-8 bytes.
Of segmentations with equal scores the one with fewer tokens counts.

Defined cases: null and empty texts have no tokens; rows without an id are counted like others; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import bound_batches, utf8

MARK = "▁"
# Counts of pre-tokens that a worker keeps.
REMEMBERED = 1_000_000
# What a byte scores below the least likely piece.
BYTE_PENALTY = 10.0


def ranked_scores(model_file: str) -> dict[str, float]:
    """Log-probabilities by Zipf's rule, from the order of the pieces in a public vocabulary file.

    Control and byte pieces are left out.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = math.log(sum(1 / rank for rank in range(1, len(pieces) + 1)))
    return {piece: -math.log(rank) - total for rank, piece in enumerate(pieces, 1)}


def suffix_index(scores: Mapping[str, float]) -> dict:
    """The pieces by their characters from the last to the first; the empty key holds a piece's score."""
    index: dict = {}
    for piece, score in scores.items():
        node = index
        for c in reversed(piece):
            node = node.setdefault(c, {})
        node[""] = score
    return index


class TrieCounts(dict):
    """Number of tokens of pre-tokens given as UTF-8 words."""

    def __init__(self, scores: Mapping[str, float], remembered: int = REMEMBERED):
        super().__init__()
        self.index, self.remembered = suffix_index(scores), remembered
        self.byte = min(scores.values(), default=0.0) - BYTE_PENALTY
        self.prefixes = 0  # whose scores were worked out

    def learn(self, words: Iterable[bytes]) -> None:
        """Walk the trie of new words depth first.

        In order of their text the words that share a prefix follow each other, so the path to the current word is
        all that is held: the best score and the number of tokens of each of its prefixes.
        """
        last, score, tokens = "", [0.0], [0]
        for word in sorted(words):
            text = MARK + word.decode("utf-8", "replace")
            shared, most = 0, min(len(last), len(text))
            while shared < most and last[shared] == text[shared]:
                shared += 1
            del score[shared + 1:], tokens[shared + 1:]
            for end in range(shared, len(text)):
                self._extend(text, end, score, tokens)
            last = text
            self[word] = tokens[-1]

    def _extend(self, text: str, end: int, score: list[float], tokens: list[int]) -> None:
        """Append the best score and tokens of the prefix that ends with the character at ``end``."""
        best, fewest, begin, node = -math.inf, 0, end, self.index
        while begin >= 0:
            node = node.get(text[begin])
            if node is None:
                break
            piece = node.get("")
            if piece is not None:
                found = score[begin] + piece
                if found > best or found == best and tokens[begin] + 1 < fewest:
                    best, fewest = found, tokens[begin] + 1
            begin -= 1
        if "" not in self.index.get(text[end], ()):
            n = len(text[end].encode("utf-8", "replace"))
            found = score[end] + n * self.byte
            if found > best or found == best and tokens[end] + n < fewest:
                best, fewest = found, tokens[end] + n
        self.prefixes += 1
        score.append(best)
        tokens.append(fewest)

    def of(self, texts: list[list[bytes]]) -> list[int]:
        """The number of tokens of texts that are cut into words."""
        if len(self) > self.remembered:
            self.clear()
        self.learn(set(chain.from_iterable(texts)).difference(self))
        return [sum(map(self.__getitem__, words)) for words in texts]


def counts_of(scores: Mapping[str, float], text: Column | str) -> Column:
    """A struct per text: ``n_words`` and ``n_tokens``."""
    kind = pa.struct([("n_words", pa.int64()), ("n_tokens", pa.int64())])

    @F.arrow_udf("struct<n_words: long, n_tokens: long>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie = TrieCounts(scores)
        for texts in batches:
            rows = []
            for at in range(0, len(texts), 1024):
                split = [body.split() for body in utf8(texts.slice(at, 1024))]
                rows += [{"n_words": len(w), "n_tokens": n} for w, n in zip(split, trie.of(split))]
            yield pa.array(rows, kind)

    return count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def token_counts(
    docs: DataFrame, scores: Mapping[str, float], doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: ``doc_id, n_words, n_tokens``. ``scores`` maps pieces to log-probabilities."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).alias("doc_id"), counts_of(scores, text).alias("found")).select(
        "doc_id", "found.n_words", "found.n_tokens")
