"""License scans against all pairs of blocks and templates."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_the_join_finds_every_pair():
    draw = random.Random(6)
    vocabulary = [f"w{i}" for i in range(30)]
    templates = [(f"t{i}", " ".join(draw.choices(vocabulary, k=draw.randrange(1, 15)))) for i in range(25)]
    frequency = {w.encode(): draw.randrange(100) for w in vocabulary}
    for threshold in (0.3, 0.6, 0.8, 1.0):
        index = L.Templates(templates, frequency, threshold)
        for _ in range(300):
            block = [w.encode() for w in draw.choices(vocabulary + ["x", "y", "z"], k=draw.randrange(0, 25))]
            want = []
            for t, (_, text) in enumerate(templates):
                template, distinct = {w.encode() for w in text.split()}, set(block)
                if len(template & distinct) >= threshold * len(template) - 1e-9:
                    want.append((t, len(template & distinct) / len(template)))
            assert sorted(index.matches(block)) == want


def test_places_may_overlap():
    assert L.places_of([b"a", b"a", b"a"], [b"a a"]) == [(0, 0), (1, 0)]
    assert L.places_of([], [b"a"]) == []


def test_blocks_keep_the_numbers_of_their_words():
    text = b"One two. Three four five\nsix\n\nseven. eight 2.0 nine"
    every = L.words_of(text)
    for at, block in L.blocks_of(text):
        assert every[at:at + len(block)] == block


EDGES = [
    (1, "Released under the MIT License."), (2, None), (3, ""), (None, "Apache License"), (4, "mit\nLICENSE mit-license"),
    (5, "Licensed under CC BY-NC 4.0.\nThe rest of it."), (6, "General Public License " * 3), (6, "General Public License " * 3),
    (7, "x " * 40_000 + "\nthis work is licensed under gnu general public license version 3\n" + "y " * 10),
    (8, "Released under MIT"), (9, "ÉMIT LICENSE mit licensé"), (10, "submit license"),
    (11, "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated\n"
         "documentation files (the Software), to deal in the\nSoftware without restriction, including"),
]


def plain_base(text):
    w, places = words(text), []
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_edge_cases(spark):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").withColumns(
        {c: F.lit(c) for c in ("labels", "blocks", "places", "n_words")})
    rows = L.scan(docs).collect()
    base = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)
    assert base == Counter((d, *plain_base(t)) for d, t in EDGES)
    labels = {r.doc_id: (r.labels, r.score) for r in rows}
    assert labels[1] == ("mit", 1.0) and labels[2] == ("", 0.0) and labels[5] == ("cc-by-nc", 1.0)
    assert labels[7] == ("gpl", 1.0) and labels[8] == ("", 0.0) and labels[10] == ("", 0.0)
    assert labels[11] == ("mit", 1.0)  # found as a paragraph, without the phrase
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in rows if r.base_labels)
    assert L.scan(docs.limit(0)).collect() == []


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = L.scan(docs).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows} == {
        d: plain_base(t) for d, t in texts.items()}
    for r in rows:
        assert ("cc-by-nc" in r.labels) == ("Licensed under CC BY-NC 4.0" in texts[r.doc_id])


def test_too_many_template_words_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        L.word_frequencies(docs, "text", [("x", " ".join(f"w{i}" for i in range(L.MAX_TEMPLATE_WORDS + 1)))])


def test_notices_among_many_other_words_are_found(spark):
    filler = " ".join(f"w{i}" for i in range(32))
    texts = [
        f"{filler} Licensed under CC BY 4.0", f"{filler} x y\nreleased under\nthe mit license {filler}",
        f"One {filler}\nLicensed under CC\nBY-NC 4.0 and code released under\nthe MIT License {filler}", filler]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: (r.labels, r.score) for r in L.scan(docs, phrases={}).collect()}
    assert rows == {0: ("cc-by", 1.0), 1: ("mit", 1.0), 2: ("cc-by-nc,mit", 1.0), 3: ("", 0.0)}


def plain_notices(templates, threshold, block):
    """Labels of a block by trying every template and every stretch."""
    sets, labels, left = [set(words(t)) for _, t in templates], set(), list(block)
    while True:
        fits = []
        for (label, _), w in zip(templates, sets):
            others = set().union(*[v for (other, _), v in zip(templates, sets) if other != label])
            need = next(k for k in range(1, 10**6) if k >= threshold * len(w) - 1e-9)
            must = ((w - others) or w) if len(w & others) >= need else set()
            held = w & set(left)
            if len(held) >= need and must <= held:
                fits.append((len(held), len(held) / len(w), held, w, label))
        if not fits:
            return labels
        top = max(f[:2] for f in fits)
        first = next(f for f in fits if f[:2] == top)
        labels |= {f[4] for f in fits if f[:3] == first[:3]}
        ends = [(j - i, i) for i in range(len(left)) for j in range(i, len(left)) if first[2] <= set(left[i:j + 1])
                and not first[2] <= set(left[i + 1:j + 1]) and not first[2] <= set(left[i:j])]
        gone = set()
        for length, low in sorted(ends):
            if not gone & set(range(low, low + length + 1)):
                gone |= set(range(low, low + length + 1))
        left = [w for i, w in enumerate(left) if i not in gone or w not in first[3]]


def test_notices_agree_with_trying_everything():
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(9)]
    for threshold in (0.5, 0.8, 1.0):
        templates = [(f"t{i % 5}", " ".join(draw.choices(vocabulary, k=draw.randrange(2, 8)))) for i in range(8)]
        index = L.Templates(templates, {}, threshold)
        for _ in range(150):
            block = draw.choices(vocabulary + ["x", "y"], k=draw.randrange(0, 25))
            found = index.notices(w := [b.encode() for b in block], index.matches(w))
            assert {index.labels[t] for t in found} == plain_notices(templates, threshold, block)


@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY 4.0, figures licensed under CC BY-NC 4.0", {"cc-by", "cc-by-nc"}),
    ("Licensed under CC BY-NC 4.0, figures under CC BY-NC 4.0", {"cc-by-nc"}),
    ("Licensed under CC BY-SA 4.0, figures licensed under CC BY-NC 4.0, code licensed under CC BY 4.0",
     {"cc-by", "cc-by-nc", "cc-by-sa"}),
    ("This library is released under the BSD license.", set()),
    ("Released under the GNU General Public License.", set()),
    ("The report was released yesterday under an embargo; the press needs a license to print it.", set()),
    ("Code released under MIT license", {"mit"}),
    ("licensed under apache license version 2.0", {"apache"}),
])
def test_notices_of_one_family_and_of_short_templates(text, labels):
    index = L.Templates(L.TEMPLATES, {}, L.THRESHOLD)
    block = L.words_of(text.encode())
    assert {index.labels[t] for t in index.notices(block, index.matches(block))} == labels


def test_a_long_block_of_repeated_notices_is_taken_apart_in_few_steps():
    index = L.Templates(L.TEMPLATES, {}, L.THRESHOLD)
    block = L.words_of(b"licensed under CC BY 4.0 and figures licensed under CC BY-NC 4.0 " * 20_000)
    assert {index.labels[t] for t in index.notices(block, index.matches(block))} == {"cc-by", "cc-by-nc"}


def test_labels_of_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in L.scan(docs).collect():
        want = {x for x in plain_base(texts[r.doc_id])[4].split(",") if x}
        for _, block in L.blocks_of(texts[r.doc_id].encode()):
            distinct = set(block)
            if any(len(distinct & set(L.words_of(t.encode()))) >= L.THRESHOLD * len(set(L.words_of(t.encode()))) - 1e-9
                   for _, t in L.TEMPLATES):
                want |= plain_notices(L.TEMPLATES, L.THRESHOLD, [w.decode("utf-8", "replace") for w in block])
        assert r.labels == ",".join(sorted(want))
