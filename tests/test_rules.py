"""Decision tables."""

import re
import time

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import rules as R
from shelfwise.operators.rules import Rule, RuleSet


@pytest.fixture
def df(spark):
    return spark.createDataFrame([("a", "x", 1.0), ("b", None, 5.0), (None, "z", None)], "k string, v string, n double")


def out(df, *cols):
    return [tuple(r) for r in df.orderBy(F.col("k").asc_nulls_last()).select(*cols).collect()]


def test_first_match_wins_and_blank_keeps(df):
    rules = RuleSet(9, [Rule(2, {"k": ("in", ["a", "b"])}, {"v": "two"}), Rule(1, {"k": "a"}, {"v": "NULL"})])
    got = R.apply_rules(df, rules, {"v": "v"}, "src")
    assert out(got, "v", "src") == [("x", None), ("two", "9,2"), ("z", None)]
    assert got.count() == df.count()


def test_default_values_and_conditions(df):
    rules = RuleSet(9, [Rule(1, {"v": ("is_null",)}, {"r": "null"}), Rule(2, {"n": ("between", 0, 2)}, {"r": "low"}),
                        Rule(3, {"v": ("rlike", "^z")}, {"r": ""})], default={"r": "other"})
    assert out(R.match(df, rules), "_rule.r", "_rule.src") == [("low", "9,2"), ("null", "9,1"), (None, "9,3")]
    none = RuleSet(9, [Rule(1, {"k": "q"}, {"r": "x"})], default={"r": "other"})
    assert out(R.match(df, none), "_rule.r", "_rule.src") == [("other", "9,__DEFAULT__")] * 3
    with pytest.raises(ValueError):
        R.condition("k", ("like", "x"))


def test_numbers_keep_their_type(df):
    rules = RuleSet(1, [Rule(1, {"k": "a"}, {"n": 9.5}), Rule(2, {"k": "b"}, {"n": "text"})])
    got = R.apply_rules(df, rules, {"n": "n"})
    assert got.schema["n"].dataType == df.schema["n"].dataType
    assert out(got, "n") == [(9.5,), (5.0,), (None,)]


def test_units_then_ratio_truncates(spark):
    df = spark.createDataFrame([("a", 10, None), ("b", 7, None), ("c", None, None)], "k string, u bigint, s string")
    got = R.override_then_scale(df, RuleSet(2, [Rule(1, {"k": "a"}, {"c": "3"})]), "c",
                                RuleSet(3, [Rule(5, {"k": ("not_in", ["z"])}, {"r": 1.3})]), "r", "u", "s", "ratio")
    assert out(got, "u", "s", "ratio") == [(3, "3,5", 1.3), (9, "3,5", 1.3), (None, None, 1.3)]


def test_long_chain_stays_small(spark):
    """29 chained sets, each reading what the one before wrote, and a filter on the last result."""
    df = spark.createDataFrame([("0",)], "v string")
    for i in range(29):
        df = R.apply_rules(df, RuleSet(i, [Rule(1, {"v": str(i)}, {"v": str(i + 1)}), Rule(2, {"v": "q"}, {"v": "w"})]),
                           {"v": "v"}, "src")
    assert [tuple(r) for r in df.collect()] == [("29", "28,1")]
    assert df.filter(F.col("v").startswith("2")).count() == 1


def test_rule_table(spark):
    table = spark.createDataFrame([(1, 2, '{"k": "a"}', '{"v": "late"}'), (1, 1, '{"k": ["in", ["a", "b"]]}', '{"v": "early"}')],
                                  "set_id int, priority int, conditions string, results string")
    sets = R.load_rule_sets(table)
    df = spark.createDataFrame([("a", "x")], "k string, v string")
    assert out(R.apply_rules(df, sets[1], {"v": "v"}, "src"), "v", "src") == [("early", "1,1")]


def many_rules(n):
    """Rules of every kind; each value is asked for by several rules, so the priority decides."""
    kinds = [
        lambda i: {"k": f"k{i % 40}"}, lambda i: {"k": ("in", [f"k{i % 55}", f"q{i}"]), "n": i % 7},
        lambda i: {"k": ("contains", f"{i % 90}'\\\\")}, lambda i: {"k": ("rlike", f"^k{i % 80}$"), "n": ("not_in", [1, 2])},
        lambda i: {"n": ("between", i % 11, i % 11 + 1), "k": ("not_contains", "3")}, lambda i: {"n": i % 13, "k": f"k{i % 60}"},
    ]
    return [R.Rule((i * 7919) % n, kinds[i % len(kinds)](i), {"v": f"v{i}"}) for i in range(n)]


def first_match(rules, k, n):
    """The rule that plain Python would take; NULL passes nothing here."""
    def holds(c, test):
        value = {"k": k, "n": n}[c]
        kind, *args = test if isinstance(test, tuple) else ("eq", test)
        if value is None:
            return False
        return {"eq": lambda v: value == v, "in": lambda v: value in v, "not_in": lambda v: value not in v,
                "contains": lambda v: v in value, "not_contains": lambda v: v not in value,
                "rlike": lambda v: re.search(v, value) is not None, "between": lambda a, b: a <= value <= b}[kind](*args)

    return next((r for r in sorted(rules, key=lambda r: r.priority) if all(holds(c, t) for c, t in r.when.items())), None)


@pytest.mark.parametrize("n", [25, 600, 5000])
def test_many_rules(spark, n):
    rules = many_rules(n)
    rows = [(k, m, "own") for k in [*[f"k{i}" for i in range(70)], "x9'\\\\", None] for m in (*range(14), None)]
    started = time.time()
    df = R.apply_rules(spark.createDataFrame(rows, "k string, n int, v string"), R.RuleSet(1, rules), {"v": "v"}, "src")
    df._jdf.queryExecution().executedPlan()
    assert time.time() - started < 20
    got = {(r.k, r.n): (r.v, r.src) for r in df.collect()}
    for k, m, own in rows:
        rule = first_match(rules, k, m)
        assert got[k, m] == ((rule.then["v"], f"1,{rule.priority}") if rule else (own, None)), (k, m)


def test_lookup_rules_keep_the_row_count(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "k string, v string")
    rules = spark.createDataFrame([("a", 2, "second"), ("a", 1, "first"), ("b", 1, "")], "k string, priority int, w string")
    got = R.apply_lookup(df, rules, ["k"], {"w": "v"}, 4, "src")
    assert out(got, "k", "v", "src") == [("a", "first", "4,1"), ("a", "first", "4,1"), ("b", "y", None)]


def test_gate(spark):
    ddl = ("std_category_2 string, std_brand_name string, platform string, month_dt string, std_spu_name string, "
           "std_spu_name_src string, sku_src string, lifestage string, std_category_3 string")
    df = spark.createDataFrame([
        ("c", "A b!", "JD", "2024-02-01", "keep by rule", "104736,3", "m", "L", "3"),
        ("c", "A b!", "PDD", "2024-02-01", "other platform", "104736,3", "m", "L", "3"),
        ("c", "A b!", "JD", "2024-02-01", "default rule", "104736,__DEFAULT__", "m", None, "3"),
        ("c", "A b!", "JD", "2024-02-01", "keep annotated", "x", "annotated", "L", "3"),
        ("c", "A b!", "JD", "2025-02-01", "out of date", "104736,3", "annotated", "L", "3")], ddl)
    gate = spark.createDataFrame([("c", "ａ", "jd", "2024-01-01", "2024-12-01"), ("c", "aB", "jd", "2024-01-01", "2024-12-01"),
                                  ("c", "ab", "pdd", "2024-01-01", "2024-12-01")],
                                 "std_category_2 string, std_brand_name string, platform string, start_time string, end_time string")
    got = {r["std_spu_name"]: r["std_spu_name_src"] for r in R.brand_gate(df, gate, 104736, ("JD",), "m").collect()}
    assert got == {"keep by rule": "104736,3", "keep annotated": "x", "A b!L3": R.GATED, "A b!3": R.GATED}
