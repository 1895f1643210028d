"""Rule tables against plain Python and against the fixed rules, with thousands of rules and a dominant page."""

import random

import pytest

from footfall.functions import rules as fixed
from footfall.operators import classify, rule_tables
from footfall.operators.rule_tables import RULES

HITS = "i int, domain string, path string"


def holds(value, kind, pattern):
    return {
        "equals": value == pattern,
        "prefix": value.startswith(pattern),
        "prefix_any_case": value.lower().startswith(pattern.lower()),
        "suffix": value.endswith(pattern),
        "contains": pattern in value,
        "filled": value != "",
    }[kind]


def by_hand(row, rules, otherwise):
    found = [(n, label) for n, tests, label in rules if all(holds(row.get(c) or "", k, p) for c, k, p in tests)]
    return min(found, default=(0, otherwise))


def random_text(r, longest):
    return "".join(r.choice("abAB/é") for _ in range(r.randint(0, longest)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_rules(spark, seed):
    r = random.Random(seed)
    rules = []
    for n in range(1, 60):
        for _ in range(r.choice((1, 1, 2))):
            tests = [(c, r.choice(rule_tables.KINDS), random_text(r, 4)) for c in ("a", "b", "c") if r.random() < 0.6]
            rules.append((n, tests, f"label {n}"))
    if seed == 1:
        rules = [x for x in rules if x[1]]
    rows = [(i, *[None if r.random() < 0.1 else random_text(r, 6) for _ in range(3)]) for i in range(300)]
    rows += rows[:50]
    df = spark.createDataFrame(rows, "i int, a string, b string, c string")
    table = spark.createDataFrame(rules, f"{RULES}, label string")
    got = rule_tables.with_first_rule(df, table, ("b", "a", "c"), {"label": "none"}).collect()
    assert len(got) == len(rows)
    values = {i: {"a": a, "b": b, "c": c} for i, a, b, c in rows}
    for x in got:
        assert (x.rule_no, x.label) == by_hand(values[x.i], rules, "none")


def test_page_table_equals_the_fixed_rules(spark):
    r = random.Random(4)
    domains = [None, "", "example.org", *sorted({x[0] for x in fixed.PAGE_RULES})]
    patterns = sorted({p for x in fixed.PAGE_RULES for ps in x[1].values() for p in ps})
    rows = [(i, r.choice(domains), r.choice([None, "", "/", "/x" + r.choice(patterns), r.choice(patterns) + "z", r.choice(patterns).upper(), r.choice(patterns)])) for i in range(2000)]
    df = spark.createDataFrame(rows, HITS)
    want = {x.i: (x.page_rule_no, x.page_name, x.page_job) for x in classify.with_pages(df).collect()}
    got = {x.i: (x.rule_no, x.page_name, x.page_job) for x in rule_tables.with_pages_by_table(df, rule_tables.page_rule_table(spark)).collect()}
    assert got == want and len({w[0] for w in want.values()}) > 30


def test_channel_table_equals_the_fixed_rules(spark):
    r = random.Random(5)
    pick = lambda *xs: r.choice(xs)
    rows = [
        (i, pick(None, "", "?source=ads-1", "?source=em-x", "?a=1&source=sms-2", "?source=zz"), pick(None, "", "CPC", "email", "social", "direct-buy"),
         pick(None, "", "google"), pick(None, "", "https://www.google.com/", "https://bing.com/", "https://m.facebook.com/x", "https://t.co/1", "https://secure.actblue.com/", "https://shop.elizabethwarren.com"))
        for i in range(1500)
    ]
    df = spark.createDataFrame(rows, "i int, query string, utm_medium string, utm_source string, referrer string")
    want = {x.i: x.channel for x in classify.with_channel(df).collect()}
    got = {x.i: x.channel for x in rule_tables.with_channel_by_table(df, rule_tables.channel_rule_table(spark)).collect()}
    assert got == want and len(set(want.values())) > 8


def test_ten_thousand_rules_without_a_case(spark):
    rules = spark.range(1, 10_001).selectExpr(
        "int(id) as rule_no",
        "array(named_struct('column', 'page_path', 'kind', 'prefix', 'pattern', concat('/p', id, '/')), named_struct('column', 'page_domain', 'kind', 'equals', 'pattern', concat('d', id % 7))) as tests",
        "concat('page ', id) as page_name", "'Learn' as page_job",
    )
    rows = spark.range(0, 30_000).selectExpr("int(id) as i", "concat('d', if(id % 3 = 0, 0, id % 7)) as domain", "if(id % 3 = 0, '/p7/x', concat('/p', id, '/', id)) as path")
    result = rule_tables.with_pages_by_table(rows, rules)
    got = {r.i: r.page_name for r in result.collect()}
    assert len(got) == 30_000
    for i in (1, 2, 8, 9_998):
        assert got[i] == (f"page {i}" if i % 3 else "page 7")
    assert got[10_000 + 1] == fixed.UNCLASSIFIED and got[29_999] == fixed.UNCLASSIFIED
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "/p9999/" not in plan and "Cartesian" not in result._jdf.queryExecution().executedPlan().toString()


def test_rules_that_are_wrong_empty_or_match_everything(spark):
    df = spark.createDataFrame([(1, "d", "/")], HITS)
    empty = spark.createDataFrame([], f"{RULES}, label string")
    assert rule_tables.with_first_rule(df, empty, ("path",), {"label": "none"}).collect()[0].label == "none"
    everything = spark.createDataFrame([(2, [], "all"), (1, [("path", "contains", "q")], "q")], f"{RULES}, label string")
    assert rule_tables.with_first_rule(df, everything, ("path",), {"label": "none"}).collect()[0].label == "all"
    for column, kind, pattern in (("other", "equals", "x"), ("path", "like", "x"), ("path", "equals", None)):
        wrong = spark.createDataFrame([(1, [(column, kind, pattern)], "x")], f"{RULES}, label string")
        with pytest.raises(ValueError, match="not a test on path"):
            rule_tables.with_first_rule(df, wrong, ("path",), {"label": "none"})


def test_dominant_page_is_split_over_tasks(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60_000, 1, 8).selectExpr("int(id) as i", "'elizabethwarren.com' as domain", "if(id % 3 = 0, '/', concat('/plans/', id % 500)) as path")
        result = rule_tables.with_pages_by_table(rows, rule_tables.page_rule_table(spark))
        assert {(r.page_name, r["count"]) for r in result.groupBy("page_name").count().collect()} == {("Home", 20_000), ("Plan Detail", 40_000)}
        result.collect()
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
