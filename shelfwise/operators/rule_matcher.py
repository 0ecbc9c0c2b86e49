"""Very many rules, matched where the rows lie.

The rules are configuration: they go to the workers as arrays, and no row is shuffled, copied or multiplied to meet them.
Rules with equal conditions are one condition. Each is found by one of its tests and the others are looked at only then:

* A contained text, or a pattern of letters and classes of letters (``[ab]``, ``[^x]``, ``^`` in front), by the letters of a
  window. Windows with letters at the same places are compared at once over all texts of a chunk, by the last 16 bits of a sum
  and, where these occur among the rules, by the sum of 64 bits; up to
  ``WINDOW`` letters, beyond which the whole text or pattern is tried on what was found.
* Equalities and lists by the values of their columns, ranges of numbers by the number.

What has no such test is left to the caller. NULL only passes ``is_null``, as in SQL.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import product
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

# Letters of a window, letters of texts taken at once, and keys that the lists of one rule may have.
WINDOW, CHUNK, KEYS = 16, 1 << 16, 64
# Numbers that every double holds.
EXACT = 2**53
_FACTORS = np.random.default_rng(20240229).integers(1, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

Test = tuple[str, tuple]


def letters_of(pattern: str) -> tuple[bool, list[tuple[bool, frozenset]]] | None:
    """Whether a pattern stands at the start, and per letter whether it is one of the set (or else none of it); None for
    patterns of any other kind."""
    start, at, found = pattern.startswith("^"), 0, []
    at = int(start)
    while at < len(pattern):
        c = pattern[at]
        if c == "[":
            end = pattern.find("]", at + 1)
            held = pattern[at + 1:end] if end > 0 else ""
            among = not held.startswith("^")
            held = held if among else held[1:]
            if not held or any(x in held for x in "-[&\\^"):
                return None
            found.append((among, frozenset(held)))
            at = end + 1
        elif c in ".^$|()?*+{}]\\":
            return None
        else:
            found.append((True, frozenset(c)))
            at += 1
    return (start, found) if any(among and len(held) == 1 for among, held in found) else None


def _window(kind: str, operand: str) -> tuple[bool, list[tuple[bool, frozenset]]] | None:
    if kind == "contains":
        return (False, [(True, frozenset(c)) for c in operand]) if operand else None
    return letters_of(operand) if kind == "rlike" else None


def _number(value: Any, kind: str) -> bool:
    return type(value) is int and abs(value) < EXACT or kind == "double" and type(value) is float and value == value


def usable_test(kind: str, test: str, operands: Sequence[Any]) -> bool:
    """Whether a test of a column of this kind (``text``, ``long`` or ``double``) gives here what it gives in SQL."""
    if test in ("is_null", "not_null"):
        return not operands
    if test in ("eq", "in", "not_in"):
        return all(type(v) is str if kind == "text" else _number(v, kind) for v in operands)
    if kind == "text":
        return test in ("contains", "not_contains", "rlike") and type(operands[0]) is str and (
            test != "rlike" or letters_of(operands[0]) is not None)
    return test == "between" and all(_number(v, kind) for v in operands)


def _holds(test: str, operands: tuple) -> Callable[[Any], bool]:
    """The test of a value that is not NULL."""
    if test == "eq":
        return lambda v: v == operands[0]
    if test in ("in", "not_in"):
        held = frozenset(operands)
        return (lambda v: v in held) if test == "in" else (lambda v: v not in held)
    if test == "contains":
        return lambda v: operands[0] in v
    if test == "not_contains":
        return lambda v: operands[0] not in v
    if test == "between":
        return lambda v: operands[0] <= v <= operands[1]
    if test == "rlike":
        start, found = letters_of(operands[0])
        letters = "".join(f"[{'' if among else '^'}{''.join(map(re.escape, sorted(held)))}]" for among, held in found)
        tried = re.compile(letters, re.DOTALL)
        return lambda v: bool((tried.match if start else tried.search)(v))
    return lambda v: test == "not_null"


class Windows:
    """Conditions of one column by the letters of a window."""

    def __init__(self, wanted: Sequence[tuple[int, str, str]]):
        groups: dict[tuple, list[tuple[int, int]]] = {}
        self.tried: dict[int, Test] = {}
        for condition, kind, operand in wanted:
            start, found = _window(kind, operand)
            if len(found) > WINDOW:
                self.tried[condition] = (kind, (operand,))
                first = next(i for i, (among, held) in enumerate(found) if among and len(held) == 1)
                begin = 0 if start else min(first, len(found) - WINDOW)
                found = found[begin:begin + WINDOW]
            fixed = tuple(i for i, (among, held) in enumerate(found) if among and len(held) == 1)
            classes = tuple((i, among, tuple(sorted(map(ord, held)))) for i, (among, held) in enumerate(found) if i not in fixed)
            total = sum(ord(next(iter(found[i][1]))) * int(_FACTORS[i]) for i in fixed) % 2**64
            groups.setdefault((start, len(found), fixed, classes), []).append((total, condition))
        self.groups = []
        for key, members in groups.items():
            members.sort()
            totals, starts = np.unique(np.array([t for t, _ in members], np.uint64), return_index=True)
            bits = np.zeros(1 << 16, bool)
            bits[totals.astype(np.uint16)] = True
            self.groups.append((*key, totals, np.append(starts, len(members)), np.array([c for _, c in members], np.int64),
                                np.packbits(bits)))

    def hits(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """The conditions of each text."""
        if not hasattr(self, "bits"):
            self.bits = [np.unpackbits(g[-1]).view(bool) for g in self.groups]
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            end, n = at, 0
            while end < len(texts) and (end == at or n + len(texts[end] or "") <= CHUNK):
                n += len(texts[end] or "")
                end += 1
            out += self._chunk([t or "" for t in texts[at:end]])
            at = end
        for i, found in enumerate(out):
            if self.tried and len(found):
                out[i] = np.array([c for c in found.tolist() if c not in self.tried or _holds(*self.tried[c])(texts[i])], np.int64)
        return out

    def _chunk(self, texts: list[str]) -> list[np.ndarray]:
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        n, lengths = len(codes), np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        left = np.repeat(ends, lengths) - np.arange(n)  # letters to the end of the text
        text = np.repeat(np.arange(len(texts)), lengths)
        wide = codes.astype(np.uint64)
        parts: dict[int, np.ndarray] = {}
        short: dict[int, np.ndarray] = {}
        pairs = []
        for (anchored, length, fixed, classes, totals, of, conditions, _), bits in zip(self.groups, self.bits, strict=True):
            if n < length:
                continue
            m = n - length + 1
            places = starts[lengths >= length] if anchored else None
            total = None
            for i in fixed:
                if i not in parts:
                    parts[i] = wide * _FACTORS[i]
                    short[i] = parts[i].astype(np.uint16)
                part = short[i][places + i] if anchored else short[i][i:i + m]
                total = part.copy() if total is None else np.add(total, part, out=total)
            found = np.flatnonzero(bits[total])
            at = places[found] if anchored else found
            total = sum((parts[i][at + i] for i in fixed), start=np.zeros(len(at), np.uint64))
            place = np.searchsorted(totals, total)
            same = totals[np.minimum(place, len(totals) - 1)] == total
            found, place = at[same], place[same]
            ok = left[found] >= length
            for i, among, held in classes:
                letters = codes[np.minimum(found + i, n - 1)]
                ok &= np.logical_or.reduce([letters == x for x in held]) == among
            found, place = text[found[ok]], place[ok]
            seen = np.unique(found * len(totals) + place)
            found, place = seen // len(totals), seen % len(totals)
            many = of[place + 1] - of[place]
            index = np.repeat(of[place] - np.cumsum(many) + many, many) + np.arange(many.sum())
            pairs.append((np.repeat(found, many), conditions[index]))
        if not pairs:
            return [np.zeros(0, np.int64) for _ in texts]
        where, what = (np.concatenate(x) for x in zip(*pairs, strict=True))
        order = np.argsort(where, kind="stable")
        return np.split(what[order], np.searchsorted(where[order], np.arange(1, len(texts))))


class Matcher:
    """The conditions of rules (numbered from 1) on columns of the given kinds; ``others`` are rules it does not take."""

    def __init__(self, tests: Sequence[dict[str, Test]], kinds: dict[str, str]):
        self.columns, self.kinds = sorted(kinds), kinds
        numbers: dict[tuple, list[int]] = {}
        self.others: list[int] = []
        for number, of in enumerate(tests, 1):
            if of and all(c in kinds and usable_test(kinds[c], *t) for c, t in of.items()) and self._found_by(of):
                numbers.setdefault(tuple(sorted(of.items())), []).append(number)
            else:
                self.others.append(number)
        self.members = [np.array(v, np.int32) for v in numbers.values()]
        self.firsts = np.array([v[0] for v in numbers.values()], np.int32)
        windows: dict[str, list[tuple[int, str, str]]] = {}
        self.equal: dict[tuple, dict[tuple, list[int]]] = {}
        ranges: dict[str, list[tuple[int, Any, Any]]] = {}
        self.tests = {c: [("true", ())] for c in self.columns}  # the distinct tests that are left to look at
        known: dict[str, dict[Test, int]] = {c: {} for c in self.columns}
        self.rest = {c: np.zeros(len(numbers), np.int32) for c in self.columns}
        for condition, of in enumerate(numbers):
            of = dict(of)
            by = self._found_by(of)
            if by[0] == "window":
                windows.setdefault(by[1], []).append((condition, of[by[1]][0], of[by[1]][1][0]))
            elif by[0] == "range":
                ranges.setdefault(by[1], []).append((condition, *of[by[1]][1]))
            else:
                table = self.equal.setdefault(by[1], {})
                for key in set(product(*[of[c][1] for c in by[1]])):
                    table.setdefault(key, []).append(condition)
            for c, test in of.items():
                if c != by[1] and c not in by[1]:
                    if test not in known[c]:
                        known[c][test] = len(self.tests[c])
                        self.tests[c].append(test)
                    self.rest[c][condition] = known[c][test]
        self.windows = {c: Windows(w) for c, w in windows.items()}
        self.ranges = {c: (np.array([r[1] for r in v], float), np.array([r[2] for r in v], float),
                           np.array([r[0] for r in v], np.int64)) for c, v in ranges.items()}

    def _found_by(self, of: dict[str, Test]) -> tuple[str, Any] | None:
        """The kind of test that a condition is found by, and the column or columns of it."""
        windows = [(min(WINDOW, sum(among and len(held) == 1 for among, held in w[1])), c)
                   for c, (kind, operands) in of.items() if kind in ("contains", "rlike") and (w := _window(kind, operands[0]))]
        if windows and max(windows)[0] >= 3:
            return "window", max(windows)[1]
        equal, keys = [], 1
        for c, (kind, operands) in sorted(of.items()):
            if kind in ("eq", "in") and keys * max(1, len(operands)) <= KEYS:
                keys *= max(1, len(operands))
                equal.append(c)
        if equal:
            return "equal", tuple(equal)
        between = sorted(c for c, (kind, _) in of.items() if kind == "between")
        if between:
            return "range", between[0]
        return ("window", max(windows)[1]) if windows else None

    def _truth(self, c: str, value: Any) -> np.ndarray:
        """Which of the column's tests a value passes."""
        if value is None:
            return np.array([t in ("true", "is_null") for t, _ in self.tests[c]])
        return np.array([t == "true" or tried(value) for (t, _), tried in zip(self.tests[c], self._tried[c], strict=True)])

    def match(self, columns: Sequence[pa.Array], every: bool) -> list[np.ndarray]:
        """The numbers of the matching rules of each row, in order; only the first of them unless ``every``."""
        if not hasattr(self, "_tried"):
            self._tried = {c: [_holds(*t) for t in v] for c, v in self.tests.items()}
        codes, values = {}, {}
        for c, column in zip(self.columns, columns, strict=True):
            if self.kinds[c] == "text":
                column = column.cast(pa.binary())
            coded = column.dictionary_encode(null_encoding="encode")
            codes[c], values[c] = coded.indices.to_pylist(), coded.dictionary.to_pylist()
            if self.kinds[c] == "text":
                values[c] = [None if v is None else v.decode("utf-8", "surrogateescape") for v in values[c]]
        found = {c: w.hits(values[c]) for c, w in self.windows.items()}
        for c, (low, high, conditions) in self.ranges.items():
            inside = [np.zeros(0, np.int64) if v is None else conditions[(low <= v) & (v <= high)] for v in values[c]]
            found[c, ""] = inside
        truth: dict[tuple[str, int], np.ndarray] = {}
        done: dict[tuple, np.ndarray] = {}
        out, none = [], np.zeros(0, np.int32)
        for row in zip(*[codes[c] for c in self.columns], strict=True):
            if row in done:
                out.append(done[row])
                continue
            at = dict(zip(self.columns, row, strict=True))
            met = [found[c][at[c]] for c in self.windows] + [found[c, ""][at[c]] for c in self.ranges]
            for names, table in self.equal.items():
                met.append(np.array(table.get(tuple(values[c][at[c]] for c in names), ()), np.int64))
            met = np.concatenate(met) if met else none
            for c in self.columns:
                if len(self.tests[c]) > 1 and len(met):
                    if (c, at[c]) not in truth:
                        truth[c, at[c]] = self._truth(c, values[c][at[c]])
                    met = met[truth[c, at[c]][self.rest[c][met]]]
            if not len(met):
                numbers = none
            elif every:
                numbers = np.sort(np.concatenate([self.members[i] for i in met.tolist()]))
            else:
                numbers = self.firsts[met].min(keepdims=True)
            done[row] = numbers
            out.append(numbers)
        return out


def kind_of(kind: T.DataType) -> str | None:
    if kind == T.StringType():
        return "text"
    return "long" if isinstance(kind, T.IntegralType) else "double" if isinstance(kind, T.DoubleType) else None


def numbers_of(matcher: Matcher, every: bool) -> Column:
    """The numbers of the matching rules of a row, among those that the matcher takes."""

    @F.arrow_udf(returnType="array<int>")
    def matched(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            found = matcher.match(batch if isinstance(batch, tuple) else (batch,), every)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *found]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return matched(*[F.col(c) for c in matcher.columns])
