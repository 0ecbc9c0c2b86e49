"""Suffix-tree scores against a plain model with dictionaries."""

import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfwise.llm import packed, suffix_tree as S
from shelfwise.llm.common import is_in_fold

END = None


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


class Plain:
    """The same model, word by word."""

    def __init__(self, texts, depth, share):
        seqs = [tokens(t) for t in texts]
        self.c = Counter(w for s in seqs for w in s)
        self.n, self.v, self.depth = sum(self.c.values()), len(self.c), depth
        singles, doubles = (sum(x == k for x in self.c.values()) for k in (1, 2))
        self.d = (singles + 0.5) / (singles + 2 * doubles + 1.0)
        least = max(2.0, share * self.n)
        grams = defaultdict(Counter)
        for s in seqs:
            padded = [END, *s]
            for size in range(2, depth + 2):
                for i in range(len(padded) - size + 1):
                    # Longer states begin inside the text, or at the end token before it.
                    grams[size][tuple(padded[i:i + size])] += 1
        often = {(w,): x for w, x in self.c.items() if x >= least}
        states, self.kept = dict(often), {}
        for size in range(2, depth + 2):
            found = {g: x for g, x in grams[size].items()
                     if x >= least and g[:-1] in states and (g[-1],) in often}
            by_state = defaultdict(dict)
            for g, x in found.items():
                by_state[g[:-1]][g[-1]] = x
            for state, nexts in by_state.items():
                total, gain, mass, lower = states[state], 0.0, 0.0, 0.0
                for w, x in nexts.items():
                    q = self.p(state[1:], w)
                    gain += x * math.log(x / total / q)
                    mass, lower = mass + x / total, lower + q
                rest = max(1 - mass, 0.0)
                if rest > 0:
                    gain += total * rest * math.log(rest / max(1 - lower, 1e-12))
                if gain > 0.5 * (len(nexts) + 1) * math.log(max(total, 2)):
                    shares = {w: (x - S.DISCOUNT) / total for w, x in nexts.items()}
                    self.kept[state] = shares, 1 - sum(shares.values())
            states = found

    def p(self, context, w):
        context = tuple(context)[-self.depth:] if self.depth else ()
        if not context:
            return (self.c[w] - self.d) / self.n if self.c[w] else (self.d * self.v / self.n if self.v else 1.0)
        below = self.p(context[1:], w)
        if context not in self.kept:
            return below
        shares, rest = self.kept[context]
        return shares.get(w, 0.0) + rest * below

    def score(self, text):
        s = [END, *tokens(text)]
        return sum(math.log10(self.p(s[:i], s[i])) for i in range(1, len(s)))

    def base(self, text):
        return sum(math.log10((self.c[w] + 1) / (self.n + self.v + 1)) for w in tokens(text))


def markov(seed, n):
    """Texts in which the word before, or the two before, tell much about the next."""
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        words = ["a"]
        for _ in range(draw.randrange(40)):
            last = words[-1]
            words.append({"a": "b", "b": draw.choice("acd"), "c": "a" if words[-2:] == ["b", "c"] else "d",
                          "d": draw.choice(["A", "rare%d" % draw.randrange(300)])}.get(last, "a"))
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("depth, share", [(0, 1e-3), (1, 1e-3), (2, 1e-3), (3, 5e-3)])
def test_agrees_with_a_plain_model(spark, depth, share):
    texts = [*markov(1, 60), None, "", "A\tB\n C", "unseen words here"]
    rows = [(i, t, i % 4 != 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)
    plain = Plain([t for _, t, learn in rows if learn], depth, share)
    found = S.score(docs, F.col("learn"), depth=depth, known_share=0.01, node_share=share).collect()
    assert len(found) == len(rows)
    for r in found:
        text = texts[r.doc_id]
        assert r.score == pytest.approx(plain.score(text), abs=1e-6)
        assert r.base_score == pytest.approx(plain.base(text), abs=1e-6)
        assert (r.n_tokens, r.n_known) == (len(tokens(text)), sum(plain.c[w] > 0 for w in tokens(text)))
        assert r.train_tokens == plain.n
    if depth == 2:
        assert sum(len(s) == 2 for s in plain.kept) > 0


def test_next_word_distributions_sum_to_one():
    plain = Plain(markov(2, 80), 2, 1e-3)
    for context in [(), ("a",), *list(plain.kept)[:20]]:
        context = tuple(c.encode() if isinstance(c, str) else c for c in context)
        assert sum(plain.p(context, w) for w in plain.c) + plain.p(context, b"never seen") == pytest.approx(1)


def test_held_out_texts_score_better_than_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = is_in_fold("doc_id", 7, 2)
    rows = S.score(docs, ~held_out).collect()
    assert {r.doc_id for r in rows if not r.training} == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2}
    unseen = [r for r in rows if not r.training]
    assert sum(r.score for r in unseen) > 0.85 * sum(r.base_score for r in unseen)
    assert np.mean([r.score > r.base_score for r in unseen]) > 0.8


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(None, None), (1, ""), (1, ""), (2, "x " * 40_000), (3, "x y")], "doc_id long, text string").withColumns(
        {c: F.lit(c) for c in ("training", "n_tokens", "rare", "row", "code")})
    rows = S.score(docs, F.col("doc_id") == 2).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in rows), key=str) == sorted(
        [(None, 1), (1, 1), (1, 1), (2, 40_001), (3, 3)], key=str)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    nothing = S.score(docs, F.lit(False)).collect()
    assert {(r.base_score, r.score, r.n_known, r.train_tokens) for r in nothing} == {(0.0, 0.0, 0, 0)}
    assert S.score(docs.limit(0), F.lit(True)).collect() == []


def test_rare_transitions_stay_in_the_tree_at_any_size(spark):
    # What "p q r" is followed by shows only in three words of context, seen twice in a corpus of 300,000 tokens.
    rare = ["p q r s", "p q r s", "z q r t", "z q r t"]
    texts = [*rare, *["q r u", "w p q v"] * 20, *[" ".join(f"f{(i * 37 + j) % 500}" for j in range(300)) for i in range(1000)]]
    docs = spark.createDataFrame(list(enumerate([*texts, "p q r s"])), "doc_id long, text string").repartition(3)
    plain = Plain(texts, 3, 0.0)
    assert (b"p", b"q", b"r") in plain.kept and plain.c[b"s"] < 1e-5 * plain.n
    held_out = {r.doc_id: r.score for r in S.score(docs, F.col("doc_id") < len(texts)).collect()}
    assert held_out[len(texts)] == pytest.approx(plain.score("p q r s"), abs=1e-6)


def test_nothing_of_the_tree_is_left_when_scores_are_put_together(spark, monkeypatch):
    stored, found, left = S.stored, [], {}

    def recorded(df, label, clean=False):
        if label == "scored":
            left.update({name: files for name, files in found if any(os.path.exists(f) for f in files)})
        table = stored(df, label, clean)
        found.append((label, [f.removeprefix("file://") for f in table.inputFiles()]))
        return table

    monkeypatch.setattr(S, "stored", recorded)
    texts = [t or "" for t in markov(3, 40)]
    assert S.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), F.lit(True)).count() == 40
    assert sorted(left) == ["sums", "tokens"]


def test_blocks_hold_the_words_of_their_texts(spark):
    texts = ["", None, " A\x0bb\x0cÉ c d\x85e \r\n", "x" * 70_000, " ".join(str(i) for i in range(70_000)), "\t \n", "b"]
    rows = spark.createDataFrame([(i, t, i % 3 == 0) for i, t in enumerate(texts)], "doc_id long, text string, training boolean")
    found = {}
    for r in S.tokenized(rows.coalesce(1)).collect():
        words = np.frombuffer(r.words, np.uint64)
        places = S._places_unpacked(r.tokens, sum(r.sizes))
        for doc, part in zip(r.docs, np.split(words[places], np.cumsum(r.sizes)[:-1])):
            found[doc] = part.tolist()
    assert found == {i: [*[xxhash.xxh3_64_intdigest(w) for w in tokens(t)[:-1]], 0] for i, t in enumerate(texts)}


def test_fitted_bitmaps_hold_their_codes(spark):
    codes = np.random.default_rng(1).integers(0, 2**63, 40_000, dtype=np.uint64) * np.uint64(2)
    bitmap = packed.fitted_bitmap(spark.createDataFrame([(int(c),) for c in codes[:20_000].view(np.int64)], "code long"))
    assert packed.may_hold(bitmap, codes[:20_000]).all()
    assert packed.may_hold(bitmap, codes[20_000:]).mean() < 0.05
