"""Endpoint expressions against a plain evaluator; pattern joins against trying every pattern."""

import random
import re

import pytest
from pyspark.sql import functions as F

from stowage.operators import expressions as ex
from stowage.operators import patterns as pt
from stowage.operators import placement

SITES = {
    "T1_US_X_Disk": [("tier", "1"), ("country", "US"), ("type", "DISK"), ("free", "12.5")],
    "T1_US_X_Tape": [("tier", "1"), ("country", "US"), ("type", "TAPE")],
    "T2_DE_Y": [("tier", "2"), ("country", "DE"), ("type", "DISK"), ("free", "-3")],
    "T2_FR_Z": [("tier", "2"), ("country", "FR"), ("type", "DISK"), ("free", "n/a"), ("note", "a b")],
    "T0_CH": [("tier", "0"), ("country", "CH"), ("country", "FR")],
}


def holds(term, rse):
    if term == "*" or term == rse:
        return True
    m = re.fullmatch(r"([^=<>]+?)\s*([=<>])\s*(.+)", term)
    if not m:
        return False
    for key, value in SITES[rse]:
        if key == m[1]:
            try:
                if m[2] == "=" and value == m[3] or m[2] == "<" and float(value) < float(m[3]) or m[2] == ">" and float(value) > float(m[3]):
                    return True
            except ValueError:
                pass
    return False


def slow(text, rse):
    """Left to right, by recursion."""
    tokens = [t.strip() for t in re.findall(r"[()&|\\]|[^()&|\\]+", text) if t.strip()]

    def one(i):
        if tokens[i] == "(":
            value, i = many(i + 1)
            return value, i + 1
        return holds(tokens[i], rse), i + 1

    def many(i):
        value, i = one(i)
        while i < len(tokens) and tokens[i] != ")":
            op = tokens[i]
            other, i = one(i + 1)
            value = value and other if op == "&" else value or other if op == "|" else value and not other
        return value, i

    return many(0)[0]


def some_expression(rng, depth=0):
    if depth > 3 or rng.random() < 0.4:
        return rng.choice(["tier=1", "tier=2", "tier<2", "tier>0", "country=US", "country = FR", "type=DISK", "free>0", "free<20.5", "*", "T0_CH", "T9_NO", "note=a b", "x=1"])
    left, right = some_expression(rng, depth + 1), some_expression(rng, depth + 1)
    text = left + rng.choice(["&", "|", "\\", " & "]) + right
    return f"({text})" if rng.random() < 0.5 else text


def test_expressions_against_a_plain_evaluator(spark):
    rng = random.Random(5)
    texts = [some_expression(rng) for _ in range(250)]
    bad = ["", "  ", "(", "a=1&", "&a=1", "a=1 b=2)", "(a=1", "a<b", "()", "a=1(b=2)", "a==", "=x"]
    given = spark.createDataFrame([(i, t, "W") for i, t in enumerate([*texts, texts[0], None, *bad])], "rule_id int, rse_expression string, state string")
    facts = spark.createDataFrame([(r, *a) for r, own in SITES.items() for a in own], "rse string, key string, value string")
    got = {tuple(r) for r in ex.rule_rses(given, facts).collect()}
    want = {(i, r) for i, t in enumerate([*texts, texts[0]]) for r in SITES if slow(t, r)}
    assert got == want
    assert {r[0] for r in ex.malformed_expressions(given).collect()} == set(bad) - {"a=="} | ({"a=="} if ex.parse("a==") is None else set())
    reach = {r.rule_id for r in ex.rules_reaching(given, facts, "T0_CH").collect()}
    assert reach == {i for i, r in want if r == "T0_CH"}
    assert ex.rule_rses(given.limit(0), facts).collect() == []


def test_equal_rank_from_the_left():
    assert ex.parse("a=1|b=2&c=3")[0] == ["a=1", "b=2", "|", "c=3", "&"]
    assert ex.parse("a=1|(b=2&c=3)")[0] == ["a=1", "b=2", "c=3", "&", "|"]


REQUIRED = {
    "/C1.*/Era[0-3]-v1/": ("/C1", "/Era"), "^/.*/NANOAOD(|SIM)$": ("/", "/NANOAOD"), ".*": ("", ""), "a|b": ("", ""), "(?i)abcd": ("", ""),
    r"/a\.b\d+cdefg": ("/a.b", "cdefg"), "abc*de+f": ("ab", "ab"), "ab{0,2}cd": ("a", "cd"), "ab{2}cd": ("ab", "ab"), "a[]x]bcde": ("a", "bcde"),
    "(abc|x)defg": ("", "defg"), "(?:x)?abcd": ("", "abcd"), "abc?": ("ab", "ab"), None: ("", ""), "": ("", ""), r"\Qab.c\E": ("", ""), "a(b(c)[)]d)efghi": ("a", "efghi"),
}


@pytest.mark.parametrize("regex", REQUIRED)
def test_required_text(regex):
    begins, part = pt.required_text(regex)
    assert begins == REQUIRED[regex][0] and (part == REQUIRED[regex][1] or len(part) == len(REQUIRED[regex][1]))


def some_pattern(rng):
    piece = lambda: rng.choice(["/store", "/mc", "/data", "Era1", "Era[12]", ".*", "\\.root", "x?", "(a|b)", "file", "[0-9]+", "NANO(AOD)?", "/"])
    return "".join(piece() for _ in range(rng.randrange(1, 6)))


def test_matches_against_trying_all(spark):
    rng = random.Random(9)
    words = ["store", "mc", "data", "Era1", "Era2", "NANO", "NANOAOD", "file7", "a.root", "x"]
    names = [("/" + "/".join(rng.choice(words) for _ in range(rng.randrange(5))), i) for i in range(300)] + [(None, 900), ("", 901), ("/é日本/store", 902)]
    wants = [(some_pattern(rng), k) for k in range(150)] + [("", 500), (None, 501), ("/store", 502), ("/store", 503), ("/é日", 504)]
    got = pt.pattern_matches(spark.createDataFrame(names, "name string, i int"), spark.createDataFrame(wants, "pattern string, k int"))
    assert {(r.i, r.k) for r in got.collect()} == {(i, k) for n, i in names for p, k in wants if n is not None and p is not None and re.match(p, n)}
    assert got.count() == got.distinct().count()


def test_ten_thousand_patterns_without_a_nested_loop(spark):
    names = spark.range(4000).selectExpr("concat('/store/mc/Era', id % 700, '/set', id, '/NANOAOD') as name", "id")
    wants = spark.range(10000).selectExpr("if(id % 2 = 0, concat('/store/mc/Era', id, '/.*/NANO'), concat('.*/set', id, '/')) as pattern", "id as k")
    got = pt.pattern_matches(names, wants)
    rows = {(r.id, r.k) for r in got.collect()}
    want = {(i, i % 700) for i in range(4000) if i % 700 % 2 == 0} | {(i, i) for i in range(4000) if i % 2}
    assert rows == want
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_tables_equal_settings(spark, rows):
    """The table forms give what the forms with Python settings give."""
    rses = spark.createDataFrame([(f"T{i % 3}_{c}_{s}", f"S{i}", t, c, "AB"[i % 2]) for i, (c, s, t) in enumerate([("US", "X_Tape", "real"), ("DE", "Y", "test"), ("BE", "Z", None), ("US", "W", "real")])], "rse string, site string, cms_type string, country string, region string")
    names = [r.rse for r in rses.collect()]
    matrix = spark.createDataFrame([(a, b, 5) for a in names for b in names], "src string, dest string, distance int")
    settings = [{"src": {"rse": ".*_Tape$"}, "dest": {"cms_type": "test"}}, {"src": {"region": "A", "country": "B."}}, {"dest": {"country": "U"}}]
    table = spark.createDataFrame([(i, side, f, p) for i, r in enumerate(settings) for side in r for f, p in r[side].items()], "rule_id int, side string, field string, pattern string")
    assert rows(pt.excluded_links(matrix, rses, table)) == rows(placement.excluded_links(matrix, rses, settings))
    assert rows(pt.excluded_links(matrix, rses, table.limit(0))) == rows(matrix)


def test_subscription_filters(spark, rows):
    dids = spark.createDataFrame([("/a/x", "F", "cms", "u", None), ("/b/x", "D", "user", None, "p"), (None, "D", "cms", "u", "p")], "name string, did_type string, scope string, account string, project string")
    schema = "subscription string, pattern string, want_type string, want_scope array<string>, want_account array<string>, want_project array<string>, rules array<struct<copies: int, rse_expression: string>>"
    subs = [("all", None, None, None, None, None, [(1, "A"), (2, "B")]), ("cms", "/[ab]/", None, ["cms"], ["u", "v"], None, [(1, "C")]), ("d", ".*x", "D", None, None, ["p"], [(1, "D")]), ("none", "/a", None, None, None, None, None), ("acc", None, None, None, ["u"], None, [(3, "E")])]
    got = rows(pt.subscription_rules(dids, spark.createDataFrame(subs, schema)))
    assert got == sorted([("/a/x", "all", 0, 1, "A"), ("/a/x", "all", 1, 2, "B"), ("/b/x", "all", 0, 1, "A"), ("/b/x", "all", 1, 2, "B"), ("/a/x", "cms", 0, 1, "C"), ("/b/x", "d", 0, 1, "D"), ("/a/x", "acc", 0, 3, "E")], key=str)


def test_rules_of_one_expression_spread(spark):
    rules = spark.range(4000).select(F.col("id").alias("rule_id"), F.when(F.col("id") % 10 < 9, "*").otherwise("t=1").alias("rse_expression"))
    facts = spark.range(50).select(F.concat(F.lit("e"), "id").alias("rse"), F.lit("t").alias("key"), (F.col("id") % 2).cast("string").alias("value"))
    got = ex.rule_rses(rules, facts)
    tasks = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 3600 * 50 + 400 * 25 and max(tasks) < sum(tasks) / 8
