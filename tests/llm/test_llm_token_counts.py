"""Token counts of the trie against a plain search for every word."""

import random

import public_tokenizers
import pytest

from shelfwise.llm import token_counts as T


def plain_count(word, scores, byte):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        found = []
        for start in range(end):
            piece = word[start:end]
            if piece in scores:
                found.append((best[start][0] + scores[piece], best[start][1] - 1))
            elif len(piece) == 1:
                n = len(piece.encode())
                found.append((best[start][0] + n * byte, best[start][1] - n))
        best.append(max(found))
    return -best[-1][1]


@pytest.mark.parametrize("remembered", [5, 100_000])
def test_random_words(remembered):
    draw = random.Random(4)
    scores = {"".join(draw.choices("abc", k=draw.randrange(1, 5))): -draw.randrange(1, 9) / 2 for _ in range(25)}
    scores["▁"] = -1.0
    trie = T.TrieCounts(scores, remembered)
    for _ in range(60):
        texts = [["".join(draw.choices("abcdé", k=draw.randrange(1, 12))) for _ in range(8)] for _ in range(3)]
        want = [sum(plain_count("▁" + word, scores, trie.byte) for word in words) for words in texts]
        assert trie.of([[word.encode() for word in words] for words in texts]) == want


def test_common_prefixes_are_worked_out_once():
    trie = T.TrieCounts({"▁": -1.0, "a": -1.0, "ab": -1.5})
    trie.of([[b"aaab", b"aaaa"], [b"aaaa"]])
    assert trie.prefixes == 6  # the mark, four letters, and one more
    trie.of([[b"aaaa"]])
    assert trie.prefixes == 6


def test_documents_and_edge_cases(spark, sf_dir):
    scores = T.ranked_scores(public_tokenizers.path("piece_bpe_32k.model"))
    byte = min(scores.values()) - T.BYTE_PENALTY
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(40)
    extra = spark.createDataFrame(
        [(1, None), (2, ""), (None, "two words"), (None, "two words"), (3, " \t\n"), (4, "中文 \U0001f600 x"),
         (5, "long" * 5000)], docs.schema)
    both = docs.unionByName(extra)
    from collections import Counter

    want = Counter()
    for r in both.collect():
        words = [w.decode() for w in (r.text or "").encode().split()]
        want[r.doc_id, len(words), sum(plain_count("▁" + w, scores, byte) if len(w) < 100 else -1 for w in words)] += 1
    got = Counter((r.doc_id, r.n_words, r.n_tokens if r.doc_id != 5 or r.n_words != 1 else -1)
                  for r in T.token_counts(both, scores).collect())
    assert got == want
    assert T.token_counts(docs.limit(0), scores).collect() == []
