"""License scans by an exact set-similarity join of text blocks with license templates.

A block (a sentence, also one that runs over line feeds, a line, or a paragraph) matches a template when it holds at least ``threshold`` of the template's
distinct words. The words of the templates are counted in all documents and ordered by rising frequency. With
``need = ceil(threshold * size)`` shared words asked for, a matching block must hold one of the template's first
``size - need + 1`` words (prefix filter), must have ``need`` template words at all (length filter), and at every
shared prefix word what is left on both sides must suffice (positional filter). Pairs that pass are verified on the
full sets, so every matching block is found, however many other words it holds.

Labels come from the notices that a block is made of: the template with the most words in it (then with the largest share)
is taken, with the shortest stretches that hold these words; what is left of the block is matched again, until nothing
matches. A template that could match without any word that no other label's templates have needs all its own words
there, or all its words where it has none of its own, to give a label.

Templates and phrases are a parameter of bounded size and travel with the task; texts stay where they are.

Defined cases: null and empty texts have no words and no labels; labels without any are the empty text; equal templates
under several labels give each label; without templates only phrases count; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import bound_batches, utf8
from .decontamination import words_of

# Words of all templates at most; what is sent to the workers is bounded by it.
MAX_TEMPLATE_WORDS = 100_000
THRESHOLD = 0.8

# Phrases whose places are reported, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices as their licenses word them: label and text.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

CUTS = (re.compile(rb"(?<=[.!?])[ \t\r\f\v]+|\n"), re.compile(rb"(?<=[.!?])[ \t\r\f\v\n]+|\n[ \t\r\f\v]*\n"),
        re.compile(rb"\n"), re.compile(rb"\n[ \t\r\f\v]*\n"))


def blocks_of(text: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """Sentences, within lines and across them, lines and paragraphs: the number of the first word, and the words. The same run comes once."""
    seen = set()
    for cut in CUTS:
        at = 0
        for part in cut.split(text):
            words = words_of(part)
            if words and (at, len(words)) not in seen:
                seen.add((at, len(words)))
                yield at, words
            at += len(words)


class Templates:
    """The index of the templates, for one order of their words."""

    def __init__(self, templates: Sequence[tuple[str, str]], frequency: Mapping[bytes, int], threshold: float):
        self.labels = [label for label, _ in templates]
        self.words = [frozenset(words_of(text.encode())) for _, text in templates]
        vocabulary = sorted(set().union(*self.words) if self.words else (), key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(vocabulary)}
        self.need = [max(1, ceil(threshold * len(w) - 1e-9)) for w in self.words]
        self.must = [self._must(t) for t in range(len(self.words))]
        self.prefixes: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, words in enumerate(self.words):
            for i, word in enumerate(sorted(words, key=self.rank.__getitem__)[:len(words) - self.need[t] + 1]):
                self.prefixes[word].append((t, i))
        self.first = frozenset(self.prefixes)

    def matches(self, words: list[bytes]) -> list[tuple[int, float]]:
        """Templates that a block holds, with the share of their words."""
        block = set(words)
        if self.first.isdisjoint(block):
            return []
        ordered = sorted((w for w in block if w in self.rank), key=self.rank.__getitem__)
        shared: dict[int, int] = {}
        for j, word in enumerate(ordered):
            for t, i in self.prefixes.get(word, ()):
                size, need, so_far = len(self.words[t]), self.need[t], shared.get(t, 0)
                if so_far < 0 or len(ordered) < need:
                    continue
                left = min(size - i, len(ordered) - j)
                shared[t] = so_far + 1 if so_far + left >= need else -1
        found = []
        for t, n in shared.items():
            if n > 0:
                overlap = len(self.words[t] & block)
                if overlap >= self.need[t]:
                    found.append((t, overlap / len(self.words[t])))
        return found

    def _must(self, t: int) -> frozenset[bytes]:
        """Words without which a match gives no label."""
        words = self.words[t]
        own = words.difference(*[w for w, label in zip(self.words, self.labels) if label != self.labels[t]])
        return (own or words) if len(words) - len(own) >= self.need[t] else frozenset()

    def notices(self, words: list[bytes], found: list[tuple[int, float]]) -> set[int]:
        """The templates that a block is made of, given those it matches; equally good ones for the same words all count."""
        kept: set[int] = set()
        while True:
            block = set(words)
            held = {t: (self.words[t] & block, share) for t, share in found if self.must[t] <= block}
            if not held:
                return kept
            best = max(held, key=lambda t: (len(held[t][0]), held[t][1], -t))
            kept.update(t for t, match in held.items() if match == held[best])
            words = without(words, held[best][0], self.words[best])
            found = self.matches(words)


def without(words: list[bytes], held: frozenset[bytes], template: frozenset[bytes]) -> list[bytes]:
    """The words less those of ``template`` in stretches that hold all of ``held``: shortest first, none overlapping."""
    last: dict[bytes, int] = {}
    stretches = []
    for at, word in enumerate(words):
        if word in held:
            last[word] = at
            if len(last) == len(held):
                low = min(last.values())
                if not stretches or stretches[-1][1] != low:  # no stretch holds another one
                    stretches.append((at - low, low))
    taken = bytearray(len(words))
    for length, low in sorted(stretches):
        if not taken[low] and not taken[low + length]:
            taken[low:low + length + 1] = b"\1" * (length + 1)
    return [w for w, gone in zip(words, taken) if not gone or w not in template]


def places_of(words: list[bytes], phrases: Sequence[bytes]) -> list[tuple[int, int]]:
    """Every place where the words of a phrase stand consecutively: number of the first word, and of the phrase."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for p, phrase in enumerate(phrases):
        wanted = b" " + phrase + b" "
        at = joined.find(wanted)
        while at >= 0:
            found.append((joined.count(b" ", 0, at), p))
            at = joined.find(wanted, at + 1)
    return sorted(found)


def word_frequencies(docs: DataFrame, text: str, templates: Sequence[tuple[str, str]]) -> dict[bytes, int]:
    """In how many documents each word of the templates occurs."""
    wanted = frozenset(w for _, t in templates for w in words_of(t.encode()))
    if len(wanted) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates with over {MAX_TEMPLATE_WORDS} words")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for body in utf8(batch.column(0)):
                total.update(wanted.intersection(words_of(body)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode("utf-8", "replace") for w in total], pa.string()),
             pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(count, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).collect()  # a row per template word at most
    return {r["word"].encode(): r["n"] for r in rows}


def found_in(
    docs: DataFrame, text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES, threshold: float = THRESHOLD,
) -> Column:
    """A struct per text: ``n_words``, ``places`` of phrases, and matching ``blocks`` with their spans of words.

    Of the templates that a block matches, the ``notices`` are those that give labels.
    """
    bound_batches(docs.sparkSession)
    index = Templates(templates, word_frequencies(docs, text, templates), threshold)
    names, labels = [p.encode() for p in phrases], list(phrases.values())
    kind = pa.struct([
        ("n_words", pa.int64()),
        ("places", pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
        ("blocks", pa.list_(pa.struct([("label", pa.string()), ("share", pa.float64()), ("first_word", pa.int64()),
                                       ("n_words", pa.int64()), ("notice", pa.bool_())])))])

    @F.arrow_udf("struct<n_words: long, places: array<struct<word: long, label: string>>, blocks: "
                 "array<struct<label: string, share: double, first_word: long, n_words: long, notice: boolean>>>")
    def find(texts: pa.Array) -> pa.Array:
        out = []
        for body in utf8(texts):
            words = words_of(body)
            blocks = []
            for at, block in blocks_of(body) if not index.first.isdisjoint(words) else ():
                pairs = index.matches(block)
                notices = index.notices(block, pairs)
                blocks += [{"label": index.labels[t], "share": share, "first_word": at, "n_words": len(block),
                            "notice": t in notices} for t, share in pairs]
            out.append({"n_words": len(words), "blocks": blocks, "places": [
                {"word": at, "label": labels[p]} for at, p in places_of(words, names)]})
        return pa.array(out, kind)

    return find(F.coalesce(F.col(text), F.lit("")))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` and the ``blocks``.

    ``labels`` are those of phrases and of the notices of every matching block.

    The score is 1 where a phrase stands, else the largest share of its template's words that a notice has, else 0.
    """
    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    rows = docs.select(F.col(doc_id).alias("doc_id"), found_in(docs, text, **options).alias("found")).select(
        "doc_id", "found.*")
    notices = F.filter("blocks", lambda b: b["notice"])
    base, method = (F.transform(x, lambda p: p["label"]) for x in ("places", notices))
    starts = F.transform("places", lambda p: p["word"])
    best = F.coalesce(F.array_max(F.transform(notices, lambda b: b["share"])), F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"),
        joined(F.concat(base, method)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"), "blocks")
