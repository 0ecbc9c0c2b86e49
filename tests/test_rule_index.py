"""Rules found through an index of text parts against the same rules tried one by one."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import rule_index as I
from shelfwise.operators import rules as R
from shelfwise.operators.rules import Rule, RuleSet


@pytest.mark.parametrize("pattern, text", [
    ("gear", "gear"), ("^big.*motor$", "motor"), ("colou?r", "colo"), ("[abc]rest[a-z]+ing", "rest"), ("ab{2,3}cdef", "cdef"),
    ("x+yz", "yz"), ("a|b", ""), ("(abc)?", ""), (r"abc\\d", ""), ("", ""), ("été.*", "été"), ("[]x]long", "long"), ("a[bc", ""),
])
def test_required_text(pattern, text):
    assert I.required_text(pattern) == text
    if text:
        found = re.search(pattern, "a big electric motor, color, crest and arresting abbbcdef xxyz gear été ]long x")
        assert not found or text in found.group()


def some_rules(n, draw):
    words = ["gear", "motor", "red", "small", "zz", "widget", "été", "r", "ed"]
    kinds = [
        lambda: ("contains", " ".join(draw.choices(words, k=draw.choice([1, 1, 2])))),
        lambda: ("not_contains", draw.choice(words)), lambda: ("rlike", f"^{draw.choice(words)}.*{draw.choice(words)}"),
        lambda: ("rlike", f"{draw.choice(words)}|{draw.choice(words)}"), lambda: draw.choice(words),
        lambda: ("in", draw.choices(words, k=3)), lambda: ("not_in", draw.choices(words, k=2)), lambda: ("is_null",),
        lambda: ("not_null",), lambda: ("in", []),
    ]
    rules = []
    for i in range(n):
        when = {c: draw.choice(kinds)() for c in draw.sample(["title", "brand"], draw.choice([1, 1, 2]))}
        if draw.random() < 0.2:
            when["price"] = draw.choice([("between", 2, 5), 3, ("is_null",)])
        rules.append(Rule(i // 2, when, {"r": draw.choice(["x", "y", "", f"v{i}"])}))
    return [*rules, Rule(n, {}, {"r": "any"})] if draw.random() < 0.5 else rules


@pytest.mark.parametrize("seed", range(3))
def test_index_agrees_with_cases(spark, seed, monkeypatch):
    draw = random.Random(seed)
    words = ["gear", "motor", "red", "small", "widget", "été", "", "r"]
    rows = [(i, draw.choice([None, " ".join(draw.choices(words, k=draw.randrange(5)))]), draw.choice([None, *words]),
             draw.choice([None, *range(7)])) for i in range(200)]
    df = spark.createDataFrame(rows * 2, "id int, title string, brand string, price int")
    for collect_all in (False, True):
        rules = RuleSet(4, some_rules(40, draw), {"r": "none"}, collect_all)
        got = {}
        for limit in (1, 10**9):
            monkeypatch.setattr(R, "INDEXED_FROM", limit)
            got[limit] = sorted(map(str, R.apply_rules(R.match(df, rules, "m"), rules, {"r": "brand"}, "src").collect()))
            assert len(got[limit]) == 400
        assert got[1] == got[10**9]


def test_thousands_of_rules_plan_in_seconds(spark):
    rules = RuleSet(1, [Rule(i, {"title": ("contains", f"word{i}x")}, {"r": f"v{i}"}) for i in range(5000)], collect_all=True)
    df = spark.createDataFrame([("a word17x and word4000x",), ("none",), (None,)], "title string")
    began = time.time()
    got = {tuple(r) for r in R.match(df, rules, "m").select("title", "m.r", "m.src").collect()}
    assert got == {("a word17x and word4000x", "v17", "1,17,4000"), ("none", None, "1,__DEFAULT__"), (None, None, "1,__DEFAULT__")}
    assert time.time() - began < 60


def test_rules_met_do_not_grow_with_their_number(spark):
    """Rules verified for a text are those that share its rarest gram, whatever the number of others."""
    values = spark.createDataFrame([("a word17x here",)], "title string")
    met = {}
    for n in (100, 2000):
        rules = [Rule(i, {"title": ("contains", f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{i}x")}, {}) for i in range(n)]
        rules.append(Rule(n, {"title": ("contains", "word17x")}, {}))
        anchors = I._anchors(rules, ["title"])
        grams = set(I.grams("a word17x here"))
        met[n] = sum(gram in grams for _, gram in anchors.values())
        assert [r._number for r in I.rule_hits(values, rules, R._matches).collect()] == [n + 1]
    assert met[100] <= met[2000] <= 20


def test_hot_values_are_joined_for_themselves(spark):
    rules = RuleSet(1, [Rule(i, {"title": ("contains", f"word{i}x")}, {"r": "v"}) for i in range(600)])
    plan = R.match(spark.range(10).select(F.lit("t").alias("title"), "id"), rules)._jdf.queryExecution().toString()
    assert "<=>" in plan
