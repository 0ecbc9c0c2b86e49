"""Very many rules matched in place against the same rules tried one by one."""

import random

import pytest

from shelfwise.operators import rule_matcher as M
from shelfwise.operators import rules as R
from shelfwise.operators.rules import Rule, RuleSet


@pytest.mark.parametrize("pattern, wanted", [
    ("ab", (False, ["a", "b"])), ("^a[^x]", (True, ["a", "^x"])), ("[bc]d", (False, ["bc", "d"])), ("a.b", None), ("a[b-d]", None),
    ("[^x]", None), ("", None), ("a+", None), ("a[b", None), ("(a)", None), ("a\\d", None),
])
def test_patterns_that_are_windows(pattern, wanted):
    found = M.letters_of(pattern)
    told = found and (found[0], [("" if among else "^") + "".join(sorted(held)) for among, held in found[1]])
    assert told == wanted


def many_rules(draw):
    words = ["gear", "motor", "red", "small", "widget", "été", "r"]
    kinds = [
        lambda: ("contains", " ".join(draw.choices(words, k=draw.choice([1, 1, 2, 5])))),
        lambda: ("rlike", draw.choice(["^ge", "[^x]ed", "g[ea]a[^q]", "mot[^x]r sm", "gear small widget[^x]motor re", "red|r", "^small [mg]"])),
        lambda: draw.choice(words), lambda: ("in", draw.choices(words, k=3)), lambda: ("not_in", draw.choices(words, k=2)),
        lambda: ("not_contains", draw.choice(words)), lambda: ("is_null",), lambda: ("not_null",), lambda: ("in", []),
    ]
    numbers = [lambda: ("between", 2, draw.choice([3, 5])), lambda: 3, lambda: ("is_null",), lambda: ("in", [1, 4]), lambda: ("not_in", [2])]
    rules = []
    for i in range(80):
        when = {c: draw.choice(kinds)() for c in draw.sample(["title", "brand"], draw.choice([1, 1, 2]))}
        if draw.random() < 0.4:
            when = {c: t for c, t in when.items() if draw.random() < 0.7} | {draw.choice(["price", "n"]): draw.choice(numbers)()}
        rules.append(Rule(i // 2, when, {"r": draw.choice(["x", "y", "", None, f"v{i}"])}))
    return rules


@pytest.mark.parametrize("seed", range(2))
def test_matching_in_place_agrees_with_cases(spark, seed, monkeypatch):
    draw = random.Random(seed)
    words = ["gear", "motor", "red", "small", "widget", "été", "", "r"]
    rows = [(i, draw.choice([None, " ".join(draw.choices(words, k=draw.randrange(6)))]), draw.choice([None, *words]),
             draw.choice([None, float("nan"), -0.0, *[x / 2 for x in range(14)]]), draw.choice([None, *range(6)])) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, title string, brand string, price double, n bigint")
    for collect_all in (False, True):
        rules, got = RuleSet(4, many_rules(draw), {"r": "none"}, collect_all), {}
        for limit in (1, 10**9):
            monkeypatch.setattr(R, "INDEXED_FROM", limit)
            monkeypatch.setattr(R, "PLACED_FROM", limit)
            got[limit] = sorted(map(str, R.apply_rules(R.match(df, rules, "m"), rules, {"r": "brand"}, "src").collect()))
        assert got[1] == got[10**9]


def test_very_many_rules_shuffle_nothing(spark):
    rules = RuleSet(1, [Rule(i, {"title": ("contains", f"word{i}x"), "price": ("between", i, i + 1)} if i % 2 else
                                {"title": ("rlike", f"[^y]ord{i}x")}, {"r": f"v{i}"}) for i in range(R.PLACED_FROM)], collect_all=True)
    df = spark.createDataFrame([("a word17x and word4000x", 18.0), ("none", 1.0), (None, None)], "title string, price double")
    out = R.match(df, rules, "m").select("title", "m.r", "m.src")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in out.collect()} == {
        ("a word17x and word4000x", "v17", "1,17,4000"), ("none", None, "1,__DEFAULT__"), (None, None, "1,__DEFAULT__")}


def test_ranges_and_equal_conditions_are_not_tried_one_by_one():
    """A rule for every row: conditions that are equal count once, and a number meets its ranges only."""
    tests = [{"price": ("between", (i % 50, i % 50 + 1)), "n": ("eq", (2,))} for i in range(4000)]
    tests += [{"price": ("between", (100 + i, 101 + i))} for i in range(4000)]
    matcher = M.Matcher(tests, {"price": "double", "n": "long"})
    assert not matcher.others and len(matcher.members) == 4050
    columns = [M.pa.array([2, 2, 3, None]), M.pa.array([7.5, 400.0, 7.5, None])]
    assert [x.tolist() for x in matcher.match(columns, False)] == [[8], [4300], [], []]
    assert [len(x) for x in matcher.match(columns, True)] == [80, 2, 0, 0]
    assert matcher.columns == ["n", "price"]
