"""Many rules on texts, found through an index instead of being tried one by one.

Rules are evaluated on the distinct values of their condition columns only. A rule with a ``contains`` or ``rlike`` test
names a few letters (a gram) that any matching text holds, the rarest of them among all rules. Texts are exploded to their
grams and joined with that table, and only the rules met there are verified, by tests that are data themselves. So the work
for a value depends on its length and on the rules that it nearly meets, not on the number of rules. Equality rules are
joined by their values; what is left is a list of ``CASE``. The result is the list of matching rules per value.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..sources.checkpoints import stored
from .rule_matcher import Matcher, kind_of, numbers_of

# Letters of a gram.
GRAM = 3
TEXT_TESTS = ("eq", "in", "not_in", "contains", "not_contains", "rlike", "is_null", "not_null")


def as_test(test: Any) -> tuple[str, list[Any]]:
    """The kind of a test and its operands."""
    if not isinstance(test, (tuple, list)):
        return "eq", [test]
    kind, *operands = test
    return kind, list(operands[0]) if kind in ("in", "not_in") else operands


def required_text(pattern: str) -> str:
    """A text that any match of a regular expression holds; empty where none is certain.

    Only patterns without alternatives, groups and escapes are looked into.
    """
    if any(c in pattern for c in "|()\\"):
        return ""
    runs, run, at = [], "", 0
    while at < len(pattern):
        c = pattern[at]
        if c == "[":
            at = pattern.find("]", at + 2)
            if at < 0:
                return ""
            runs.append(run)
            run = ""
        elif c == "{":
            end = pattern.find("}", at)
            if end < 0:
                return ""
            at, run = end, run[:-1]
            runs.append(run)
            run = ""
        elif c in "*?":
            runs.append(run[:-1])
            run = ""
        elif c in "+.^$":
            runs.append(run)
            run = ""
        else:
            run += c
        at += 1
    return max([*runs, run], key=len)


def grams(text: str) -> list[str]:
    return [text[i:i + GRAM] for i in range(len(text) - GRAM + 1)]


def _anchors(rules: Sequence[Any], texts: Sequence[str]) -> dict[int, tuple[int, str]]:
    """Per rule number the column and the gram by which it is found, for rules of text tests that have one."""
    options: dict[int, list[tuple[int, str]]] = {}
    for number, rule in enumerate(rules, 1):
        tests = {c: as_test(t) for c, t in rule.when.items()}
        if not all(c in texts and kind in TEXT_TESTS and all(isinstance(v, str) for v in operands)
                   for c, (kind, operands) in tests.items()):
            continue
        held = [(texts.index(c), gram) for c, (kind, operands) in tests.items() if kind in ("contains", "rlike")
                for gram in grams(operands[0] if kind == "contains" else required_text(operands[0]))]
        if held:
            options[number] = held
    common = Counter(option for held in options.values() for option in set(held))
    return {number: min(held, key=lambda o: (common[o], o)) for number, held in options.items()}


def _null_safe(columns: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns], F.lit(True))


def rule_hits(values: DataFrame, rules: Sequence[Any], matches) -> DataFrame:
    """``values`` (distinct) with ``_number`` for every rule of the ordered ``rules`` that matches.

    ``matches`` gives a rule's conditions as SQL text.
    """
    spark, columns = values.sparkSession, values.columns
    texts = [c for c in columns if isinstance(values.schema[c].dataType, T.StringType)]
    anchors = _anchors(rules, texts)
    parts = []
    if anchors:
        test = "struct<c:int,kind:string,operands:array<string>>"
        table = spark.createDataFrame(
            [(at, gram, number, [(texts.index(c), *as_test(t)) for c, t in rules[number - 1].when.items()])
             for number, (at, gram) in anchors.items()],
            f"_at int, _gram string, _number int, _tests array<{test}>")
        used = sorted({at for at, _ in anchors.values()})

        def grams_of(at: int) -> Column:
            # Letters beside themselves moved by one and by two: linear in the length, and outside a lambda.
            letters = F.split(F.coalesce(F.col(texts[at]), F.lit("")), "")
            found = letters
            for moved in range(1, GRAM):
                found = F.zip_with(found, F.slice(letters, F.lit(moved + 1), F.size(letters)), lambda a, b: F.concat(a, b))
            return F.transform(F.array_distinct(F.array_compact(found)),
                               lambda g: F.struct(F.lit(at).alias("_at"), g.alias("_gram")))

        def holds(t: Column) -> Column:
            text, operands = F.get(F.array(*texts), t["c"]), t["operands"]
            first = F.get(operands, F.lit(0))
            return (
                F.when(t["kind"] == "contains", F.contains(text, first))
                .when(t["kind"] == "rlike", F.rlike(text, first))
                .when(t["kind"] == "eq", text == first)
                .when(t["kind"] == "in", F.array_contains(operands, text))
                .when(t["kind"] == "not_in", ~F.array_contains(operands, text))
                .when(t["kind"] == "not_contains", ~F.contains(text, first))
                .when(t["kind"] == "is_null", text.isNull())
                .otherwise(text.isNotNull()))

        met = values.select("*", F.inline(F.flatten(F.array(*map(grams_of, used))))).join(table, ["_at", "_gram"])
        parts.append(met.filter(F.forall("_tests", holds)).select(*columns, "_number"))
    equal: dict[tuple[str, ...], list[tuple]] = {}
    others = []
    for number, rule in enumerate(rules, 1):
        if number in anchors:
            continue
        tests = {c: as_test(t) for c, t in rule.when.items()}
        if tests and all(c in texts and kind in ("eq", "in") and all(isinstance(v, str) for v in operands)
                         for c, (kind, operands) in tests.items()):
            names = tuple(sorted(tests))
            equal.setdefault(names, []).append((*[tests[c][1] for c in names], number))
        else:
            others.append(number)
    for names, rows in equal.items():
        table = spark.createDataFrame(rows, ", ".join([*[f"`_r_{c}` array<string>" for c in names], "_number int"]))
        for c in names:  # lists of one rule are multiplied by Spark
            table = table.withColumn(f"_r_{c}", F.explode(f"_r_{c}"))
        on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_r_{c}") for c in names])
        parts.append(values.join(table, on).select(*columns, "_number"))
    if others:
        tried = F.expr("array(" + ", ".join(f"CASE WHEN {matches(rules[i - 1])} THEN {i} END" for i in others) + ")")
        # Inside a lambda, which Spark evaluates without generated code.
        listed = F.flatten(F.transform(F.array(F.lit(0)), lambda _: F.array_compact(tried)))
        parts.append(values.select(*columns, F.explode(listed).alias("_number")))
    if not parts:
        return values.select(*columns, F.lit(0).alias("_number")).limit(0)
    return reduce(DataFrame.unionByName, parts)


def with_matching_rules(df: DataFrame, rules: Sequence[Any], matches, first: str, every: str) -> DataFrame:
    """``df`` with the number of the first matching rule (NULL for none) and the sorted list of all of them.

    ``df`` is read twice: for the values of the condition columns, and to be joined with what they match. The table of
    values and their rules is stored when the rules are applied, so that of a chain of rule sets each is worked out once.
    The join compares null-safely, so that a value with a large share of the rows can be split.
    """
    columns = sorted({c for rule in rules for c in rule.when})
    values = df.select(*columns).distinct()
    found = rule_hits(values, rules, matches).groupBy(*columns).agg(
        F.min("_number").alias(first), F.sort_array(F.collect_set("_number")).alias(every))
    found = stored(found.withColumnsRenamed({c: f"_m_{c}" for c in columns}), "rules-by-value")
    return df.join(found, _null_safe(columns, "_m_"), "left").drop(*[f"_m_{c}" for c in columns])


def with_rules_in_place(df: DataFrame, rules: Sequence[Any], matches, first: str, every: str, all_of: bool) -> DataFrame:
    """As :func:`with_matching_rules`, for very many rules: rows are matched where they lie, nothing is shuffled or stored.

    ``every`` holds all matching rules only with ``all_of``. Rules that :class:`Matcher` does not take are tried by ``CASE``.
    """
    columns = {c for rule in rules for c in rule.when}
    kinds = {c: kind for c in columns if (kind := kind_of(df.schema[c].dataType))}
    matcher = Matcher([{c: (kind, tuple(operands)) for c, test in rule.when.items() for kind, operands in [as_test(test)]}
                       for rule in rules], kinds)
    parts = [numbers_of(matcher, all_of)] if matcher.members else []
    out = df.withColumn("_met", parts[0]) if parts else df.withColumn("_met", F.array().cast("array<int>"))
    if matcher.others:
        tried = F.expr("array(" + ", ".join(f"CASE WHEN {matches(rules[i - 1])} THEN {i} END" for i in matcher.others) + ")")
        listed = F.flatten(F.transform(F.array(F.lit(0)), lambda _: F.array_compact(tried)))
        out = out.withColumn("_met", F.sort_array(F.concat("_met", listed)))
    return out.withColumns({first: F.get("_met", F.lit(0)), every: F.col("_met")}).drop("_met")
