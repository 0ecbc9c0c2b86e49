"""Decision tables ("rule sets") as column expressions and joins.

A rule set is an ordered list of rules; the first rule whose conditions all hold gives the values of the result
columns. Rules are configuration: they become one flat ``CASE`` over the row, and many equality rules on the same columns
one joined table, which Spark broadcasts by its known size. No Python per row. A table of keys that grows with the
data is joined as a table, see :func:`apply_lookup`.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from itertools import product
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import brand_key
from .joins import enrich_by, interval_join
from .rule_index import as_test, with_matching_rules, with_rules_in_place

# Texts of a rule result that keep the value the row already has. Fixed values.
KEEP = ("", "NULL")
# Rules on the same columns from which their values are joined as a table instead of tested one by one.
JOINED_FROM = 30
# Rules with a test for a part of a text, from which rules are found through an index of such parts.
INDEXED_FROM = 500
# Rules from which indexed sets are matched where the rows lie, and from which lists of their results are one text each.
PLACED_FROM = 6_000
# Branches of a CASE for which Spark may generate code.
COMPILED_UP_TO = 100
# Priority that is noted when no rule matched, and the source of a name built by the gate. Fixed values.
DEFAULT, GATED = "__DEFAULT__", "brand_limit_rule"
# Status of excluded rows. Fixed value.
EXCLUDE = "exclude"


@dataclass(frozen=True)
class Rule:
    """``when`` maps a column to a plain value (equality) or ``(operator, operand...)``; all must hold."""

    priority: int
    when: Mapping[str, Any]
    then: Mapping[str, Any]


@dataclass(frozen=True)
class RuleSet:
    """Rules of one set. ``collect_all`` notes every matching priority instead of the first one only."""

    set_id: int
    rules: Sequence[Rule]
    default: Mapping[str, Any] = field(default_factory=dict)
    collect_all: bool = False

    @property
    def ordered(self) -> list[Rule]:
        return sorted(self.rules, key=lambda r: r.priority)

    @property
    def result_columns(self) -> list[str]:
        return list(dict.fromkeys(c for r in self.rules for c in r.then))


def literal(value: Any) -> str:
    """A rule value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return f"{value}L" if abs(value) >= 2**31 else str(value)
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, Decimal):
        return f"{value:f}BD"
    if isinstance(value, datetime):
        return f"TIMESTAMP'{value.isoformat(' ')}'"
    if isinstance(value, date):
        return f"DATE'{value.isoformat()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def condition_sql(col: str, test: Any) -> str:
    """One test of a rule as SQL text; a NULL value only passes ``is_null``, ``not_in`` and ``not_contains`` never
    pass it."""
    c = f"`{col}`"
    if not isinstance(test, (tuple, list)):
        return f"{c} = {literal(test)}"
    kind, *args = test

    def listed(values: Sequence[Any]) -> str:
        return f"{c} IN ({', '.join(map(literal, values))})" if values else f"({c} IS NULL AND NULL)"

    makers = {
        "eq": lambda v: f"{c} = {literal(v)}",
        "in": listed,
        "not_in": lambda values: f"NOT {listed(values)}" if values else f"{c} IS NOT NULL",
        "contains": lambda text: f"contains({c}, {literal(text)})",
        "not_contains": lambda text: f"NOT contains({c}, {literal(text)})",
        "rlike": lambda pattern: f"{c} RLIKE {literal(pattern)}",
        "between": lambda lo, hi: f"{c} BETWEEN {literal(lo)} AND {literal(hi)}",
        "is_null": lambda: f"{c} IS NULL",
        "not_null": lambda: f"{c} IS NOT NULL",
    }
    if kind not in makers:
        raise ValueError(f"unknown rule test {kind!r}")
    return makers[kind](*args)


def condition(col: str, test: Any) -> Column:
    return F.expr(condition_sql(col, test))


def load_rule_sets(rules: DataFrame) -> dict[int, RuleSet]:
    """Rule sets from a table ``(set_id, priority, conditions, results)`` with JSON conditions and results.

    Rules are configuration and are fetched as a whole; a table of keys that grows with the data is joined with
    :func:`apply_lookup` instead.
    """
    sets: dict[int, list[Rule]] = {}
    # Equal priorities are taken in the order of the rules' texts.
    for r in sorted(rules.select("set_id", "priority", "conditions", "results").collect()):
        sets.setdefault(r["set_id"], []).append(
            Rule(r["priority"], json.loads(r["conditions"]), json.loads(r["results"])))
    return {k: RuleSet(k, v) for k, v in sets.items()}


def _matches(rule: Rule) -> str:
    return " AND ".join(f"({condition_sql(c, t)})" for c, t in rule.when.items()) or "true"


def _one_text(values: Sequence[str | None]) -> tuple[str, str, str] | None:
    """A list as one text, which Spark takes apart once, with what stands between its values and what stands for NULL."""
    held = set().union(*[set(v) for v in values if v is not None])
    free = [chr(c) for c in range(1, 32) if chr(c) not in held]
    return (free[0].join(free[1] if v is None else v for v in values), free[0], free[1]) if len(free) > 1 else None


def _known(value: Any, blank: Sequence[str]) -> Any:
    """The rule value as text, or None where it means "keep"."""
    return None if value is None or str(value) in blank else str(value)


def _equalities(rule: Rule, df: DataFrame) -> dict[str, list[Any]] | None:
    """The values of each column that a rule asks for, if it only tests equality with values of the column's type."""
    found = {}
    for c, test in rule.when.items():
        kind, value = test if isinstance(test, (tuple, list)) and len(test) == 2 else ("eq", test)
        if kind not in ("eq", "in") or isinstance(test, (tuple, list)) and len(test) != 2:
            return None
        values = list(value) if kind == "in" else [value]
        field = df.schema[c].dataType
        fits = (str,) if isinstance(field, T.StringType) else (int,) if isinstance(field, T.IntegralType) else ()
        if not all(type(v) in fits for v in values):
            return None
        found[c] = values
    return found or None


class Matched:
    """A rule set evaluated to a rule number; values and sources are looked up by that number.

    Many rules that test equality of the same columns become a table of these columns' values that is joined; all
    others are one flat CASE. Blank results are turned into NULL while the lookup lists are built, so every value is
    used once, in a ``coalesce``. That keeps the expressions of long chains small when Spark substitutes one into
    the next. Conditions and lists are handed to Spark as SQL text, which takes it one call however many there are.
    """

    def __init__(self, rules: RuleSet, number: str, blank: Sequence[str]):
        self.rules, self.number, self.blank = rules, number, blank
        self.ordered, self.every = rules.ordered, f"{number}_every"
        self.indexed = sum(
            any(as_test(t)[0] in ("contains", "rlike") for t in r.when.values()) for r in self.ordered) >= INDEXED_FROM

    def column(self, among: Sequence[int] | None = None) -> Column:
        """Number of the first rule (of ``among``) whose conditions hold; one more than there are rules for none."""
        none = len(self.ordered) + 1
        among = range(1, none) if among is None else among
        cases = " ".join(f"WHEN {_matches(self.ordered[i - 1])} THEN {i}" for i in among)
        return F.expr(f"CASE {cases} ELSE {none} END") if cases else F.lit(none)

    def _tables(self, df: DataFrame) -> tuple[list[tuple[list[str], dict[tuple, int]]], list[int]]:
        """Tables ``columns, {values: smallest number}`` of rules to be joined, and the numbers of the others."""
        groups: dict[tuple[str, ...], list[tuple[int, dict[str, list[Any]]]]] = {}
        for i, rule in enumerate(self.ordered, 1):
            wanted = _equalities(rule, df)
            if wanted:
                groups.setdefault(tuple(sorted(wanted)), []).append((i, wanted))
        tables, joined = [], set()
        for columns, members in groups.items():
            if len(members) >= JOINED_FROM:
                table: dict[tuple, int] = {}
                for i, wanted in members:
                    for values in product(*[wanted[c] for c in columns]):
                        table.setdefault(values, i)
                    joined.add(i)
                tables.append((list(columns), table))
        return tables, [i for i in range(1, len(self.ordered) + 1) if i not in joined]

    def numbered(self, df: DataFrame) -> DataFrame:
        """``df`` with the rule number.

        The number is exploded out of a one-element array. Spark therefore never copies the conditions into later
        filters and joins on ruled columns, whose size would otherwise multiply with every chained set; filters on
        other columns still move below.
        """
        if self.indexed:
            if len(self.ordered) >= PLACED_FROM:
                out = with_rules_in_place(df, self.ordered, _matches, "_first", self.every, self.rules.collect_all)
            else:
                out = with_matching_rules(df, self.ordered, _matches, "_first", self.every)
            return out.withColumn(self.number, F.explode(F.array(
                F.coalesce("_first", F.lit(len(self.ordered) + 1))))).drop("_first")
        tables, others = self._tables(df)
        numbers, out = [self.column(others)], df
        for t, (columns, table) in enumerate(tables):
            kinds = [df.schema[c].dataType.simpleString() for c in columns]
            schema = ", ".join(f"_r{t}_{n} {kind}" for n, kind in enumerate(kinds))
            keys = df.sparkSession.createDataFrame(
                [(*values, i) for values, i in table.items()], f"{schema}, _r{t} int")
            on = [F.col(c).eqNullSafe(F.col(f"_r{t}_{n}")) for n, c in enumerate(columns)]
            out = out.join(keys, on, "left").drop(*[f"_r{t}_{n}" for n in range(len(columns))])
            numbers.append(F.coalesce(F.col(f"_r{t}"), F.lit(len(self.ordered) + 1)))
        number = F.least(*numbers) if tables else numbers[0]
        if len(others) > COMPILED_UP_TO:
            # Inside a lambda, which Spark evaluates without generated code: so many branches exceed a Java method.
            numbers = F.transform(F.array(F.lit(0)), lambda _: number)
        else:
            numbers = F.array(number)
        return out.withColumn(self.number, F.explode(numbers)).drop(*[f"_r{t}" for t in range(len(tables))])

    def _pick(self, values: Sequence[str | None], kind: Any = "string") -> Column:
        if len(values) >= PLACED_FROM and (one := _one_text(values)):
            text, apart, null = one
            return F.nullif(F.element_at(F.split(F.lit(text), apart), F.col(self.number)), F.lit(null)).try_cast(kind)
        texts = ", ".join("CAST(NULL AS STRING)" if v is None else literal(str(v)) for v in values)
        return F.element_at(F.expr(f"array({texts})"), F.col(self.number)).try_cast(kind)

    def value(self, result: str, kind: Any = "string") -> Column:
        """The result, NULL where the rule keeps the row's own value."""
        texts = [_known(r.then.get(result), self.blank) for r in self.ordered]
        return self._pick([*texts, _known(self.rules.default.get(result), self.blank)], kind)

    def src(self, *results: str) -> Column:
        """``<set id>,<priority>`` where one of the results is written (always, without results); else NULL."""
        def label(priority: Any, values: Mapping[str, Any]) -> str | None:
            written = not results or any(_known(values.get(c), self.blank) is not None for c in results)
            return f"{self.rules.set_id},{priority}" if written else None

        first = self._pick([*[label(r.priority, r.then) for r in self.ordered], label(DEFAULT, self.rules.default)])
        if not self.rules.collect_all:
            return first
        if self.indexed:
            texts = [str(r.priority) for r in self.ordered]
            one = _one_text(texts) if len(texts) >= PLACED_FROM else None
            priorities = F.split(F.lit(one[0]), one[1]) if one else F.expr(f"array({', '.join(map(literal, texts))})")
            every = F.concat_ws(",", F.transform(self.every, lambda i: F.element_at(priorities, i)))
        else:
            every = F.expr("concat_ws(',', " + ", ".join(
                f"CASE WHEN {_matches(r)} THEN {literal(str(r.priority))} END" for r in self.ordered) + ")")
        listed = F.concat(F.lit(f"{self.rules.set_id},"), F.coalesce(F.nullif(every, F.lit("")), F.lit(DEFAULT)))
        return F.when(first.isNotNull(), listed)


def match(df: DataFrame, rules: RuleSet, out: str = "_rule", blank: Sequence[str] = KEEP) -> DataFrame:
    """Add the struct ``out``: per result its value and ``<result>_src``, both NULL where the rule keeps the row's
    own value, and ``src`` of the matching rule in any case."""
    found = Matched(rules, f"{out}_number", blank)
    fields = [found.value(c).alias(c) for c in rules.result_columns]
    fields += [found.src(c).alias(f"{c}_src") for c in rules.result_columns]
    return found.numbered(df).withColumn(
        out, F.struct(*fields, found.src().alias("src"))).drop(found.number, found.every)


def offer(value: Column, label: Column, blank: Sequence[str] = KEEP) -> tuple[Column, Column]:
    """A tier: the value and its label, both NULL when the value is blank."""
    ok = usable(value, blank)
    return F.when(ok, value), F.when(ok, label)


def apply_rules(
    df: DataFrame,
    rules: RuleSet,
    results: Mapping[str, str],
    src_col: str | Mapping[str, str] | None = None,
    blank: Sequence[str] = KEEP,
) -> DataFrame:
    """Overwrite columns by rule results that are not blank; keep the row's own value otherwise.

    ``results`` maps result columns to target columns. ``src_col`` names the column that receives the provenance,
    or maps target columns to theirs; it changes only where a value was written.
    """
    found = Matched(rules, "_rule_number", blank)

    def own(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    changes = {}
    for result, target in results.items():
        kind = df.schema[target].dataType if target in df.columns else "string"
        changes[target] = F.coalesce(found.value(result, kind), own(target))
    notes: dict[str, list[str]] = {}
    for result, target in results.items():
        note = src_col if isinstance(src_col, str) else (src_col or {}).get(target)
        if note:
            notes.setdefault(note, []).append(result)
    changes.update({note: F.coalesce(found.src(*written), own(note)) for note, written in notes.items()})
    return found.numbered(df).withColumns(changes).drop(found.number, found.every)


def usable(value: Column, blank: Sequence[str] = KEEP) -> Column:
    return value.isNotNull() & ~value.isin(*blank)


def apply_chain(df: DataFrame, steps: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Apply rule sets in order; each sees what the ones before it wrote. Steps hold ``apply_rules`` arguments."""
    for step in steps:
        df = apply_rules(df, **step)
    return df


def joined_sources(*parts: Column, sep: str = "；") -> Column:
    """Provenance of several sets that contributed to one value; NULL when none did."""
    return F.nullif(F.concat_ws(sep, *parts), F.lit(""))


def tiered(
    df: DataFrame, col: str, tiers: Sequence[tuple[Column, Column]], src_col: str | None = None,
) -> DataFrame:
    """First tier that has a value, together with its source; the row's own value and source if none has.

    A tier is a pair of value and source that are NULL together: fields of :func:`match`, or an :func:`offer`.
    """
    changes = {col: F.coalesce(*[value for value, _ in tiers], F.col(col))}
    if src_col:
        changes[src_col] = F.coalesce(*[src for _, src in tiers], F.col(src_col))
    return df.withColumns(changes)


def apply_lookup(
    df: DataFrame, rules: DataFrame, on: Sequence[str], results: Mapping[str, str], set_id: int,
    src_col: str | None = None, blank: Sequence[str] = KEEP,
) -> DataFrame:
    """A large equality-only rule set as a join.

    ``rules`` has the ``on`` columns, ``priority`` and the result columns. Per key the smallest priority wins, so
    the number of rows never changes. Spark chooses the join by the measured size of the table.
    """
    columns = list(results)
    best = rules.groupBy(*on).agg(
        F.min_by(F.struct("priority", *columns), F.struct("priority", *columns)).alias("_rule"))
    joined = enrich_by(df, best, on)
    changes: dict[str, Column] = {}
    written = []
    for result, target in results.items():
        value = F.col(f"_rule.{result}")
        ok = usable(value, blank)
        written.append(ok)
        old = F.col(target) if target in df.columns else F.lit(None).cast("string")
        changes[target] = F.when(ok, value).otherwise(old)
    if src_col:
        old = F.col(src_col) if src_col in df.columns else F.lit(None).cast("string")
        note = F.concat(F.lit(f"{set_id},"), F.col("_rule.priority").cast("string"))
        changes[src_col] = F.when(reduce(lambda a, b: a | b, written), note).otherwise(old)
    columns = [*df.columns, *[c for c in changes if c not in df.columns]]
    return joined.withColumns(changes).select(*columns)


def override_numeric(df: DataFrame, rules: RuleSet, result: str, cols: Sequence[str], src_col: str) -> DataFrame:
    """Write the rule's number to every one of ``cols``; a missing or non-numeric result keeps them."""
    found = Matched(rules, "_rule_number", KEEP)
    value = found.value(result, "double")
    changes = {c: F.coalesce(value, F.col(c)) for c in cols}
    changes[src_col] = F.when(value.isNotNull(), found.src()).otherwise(F.col(src_col))
    return found.numbered(df).withColumns(changes).drop(found.number, found.every)


def override_then_scale(
    df: DataFrame, value_rules: RuleSet, value: str, ratio_rules: RuleSet, ratio: str, col: str, src_col: str,
    ratio_col: str,
) -> DataFrame:
    """First set the units by one rule set, then multiply by the ratio of another (truncated), noting the ratio.

    The ratio rules see the units that the first step wrote.
    """
    first = Matched(value_rules, "_rule_number", KEEP)
    number = first.value(value, "double").cast("bigint")
    fixed = first.numbered(df).withColumns({
        col: F.coalesce(number, F.col(col)),
        src_col: F.when(number.isNotNull(), first.src()).otherwise(F.col(src_col)),
    }).drop("_rule_number", "_rule_number_every")
    second = Matched(ratio_rules, "_rule_number", KEEP)
    factor = second.value(ratio, "double")
    applies = factor.isNotNull() & F.col(col).isNotNull()
    return second.numbered(fixed).withColumns({
        col: F.when(applies, (factor * F.col(col).cast("double")).cast("bigint")).otherwise(F.col(col)),
        src_col: F.when(applies, second.src()).otherwise(F.col(src_col)),
        ratio_col: F.coalesce(factor, F.col(ratio_col)) if ratio_col in df.columns else factor,
    }).drop("_rule_number", "_rule_number_every")


def exclusions(df: DataFrame, rules: RuleSet, result: str, listed_label: str, flag: str = "exclude_flag") -> DataFrame:
    """Only the excluded rows, with ``status`` and ``status_src``: the list first, then the rule value ``'1'``."""
    matched = match(df, rules)
    listed = F.coalesce(F.col(flag) == 1, F.lit(False))
    ruled = F.coalesce(F.col(f"_rule.{result}") == "1", F.lit(False))
    return (
        matched.filter(listed | ruled)
        .withColumn("status", F.lit(EXCLUDE))
        .withColumn("status_src", F.when(listed, listed_label).otherwise(F.col("_rule.src")))
        .drop("_rule")
    )


def value_map(c: Column | str, values: Mapping[str, str]) -> Column:
    """Translate listed texts; NULL for others."""
    c = F.col(c) if isinstance(c, str) else c
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.element_at(F.create_map(*pairs), c)


def brand_gate(
    df: DataFrame, gate: DataFrame, naming_set: int, platforms: Sequence[str], machine_label: str,
    built: Sequence[str] = ("std_brand_name", "lifestage", "std_category_3"),
) -> DataFrame:
    """Keep a product name only where the brand may carry one; build it from its parts elsewhere.

    ``gate(std_category_2, std_brand_name, platform, start_time, end_time)`` lists brands by category, platform
    and month range. A row absent from it gets the built name. A row in it keeps its name when a non-default rule
    of ``naming_set`` wrote it on one of ``platforms``, or when its source is not ``machine_label``.
    """
    dates = gate.select(
        F.col("std_category_2"), brand_key("std_brand_name").alias("_brand"), F.lower("platform").alias("_platform"),
        F.col("start_time").alias("_start"), F.col("end_time").alias("_end"), F.lit(True).alias("_gated"),
    )
    keyed = df.withColumns({"_brand": brand_key("std_brand_name"), "_platform": F.lower("platform")})
    joined = interval_join(keyed, dates, ["std_category_2", "_brand", "_platform"], "month_dt", "_start", "_end")
    src = F.col("std_spu_name_src")
    by_rule = src.rlike(str(naming_set)) & ~src.rlike("DEFAULT") & F.col("platform").isin(*platforms)
    annotated = F.col("sku_src") != machine_label
    keep = F.col("_gated").isNotNull() & (F.coalesce(by_rule, F.lit(False)) | F.coalesce(annotated, F.lit(False)))
    name = F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in built])
    return joined.withColumns({
        "std_spu_name": F.when(keep, F.col("std_spu_name")).otherwise(name),
        "std_spu_name_src": F.when(keep, src).otherwise(F.lit(GATED)),
    }).select(*df.columns)
