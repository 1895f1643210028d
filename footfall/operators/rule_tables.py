"""Ordered classification rules kept as tables: an equi-join finds the first rule that matches, however many there are.

A rule row has ``rule_no``, ``tests`` (all must hold; none always does) and label columns; rows of one number are
alternatives, the lowest number that matches decides. A test names a column, a kind (``KINDS``) and a pattern; ``filled`` holds
for any text but the empty one, whatever its pattern.

Every rule is found under one of its tests, the anchor: that on the first of the caller's ``columns`` that it tests, so
the most telling column comes first. The values that occur (``columns`` of the rows, distinct) are looked up under their
whole text, under prefixes and suffixes of the lengths that patterns have, and under all substrings of these lengths;
the other tests of the rules found are checked then. There is no CASE and no comparison of every value with every rule:
short rule sets belong into ``functions.rules``, which moves no row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import rules as fixed
from footfall.operators.classify import with_channel_inputs

KINDS = ("equals", "prefix", "prefix_any_case", "suffix", "contains", "filled")
RULES = "rule_no int, tests array<struct<column: string, kind: string, pattern: string>>"
PAGE_COLUMNS = ("page_path", "page_domain")
CHANNEL_COLUMNS = ("source", "referrer_host", "publisher", "utm_medium", "utm_source", "referrer")

# The default channel conditions as tests: number of the label, then (column, kind, pattern) that must all hold.
CHANNEL_TESTS = (
    (1, ("utm_medium", "equals", "cpc")),
    (1, ("publisher", "equals", "google")),
    (2, ("utm_medium", "equals", "display")),
    (3, ("source", "prefix", "ads-")),
    (4, ("utm_medium", "equals", "direct-buy")),
    (5, ("publisher", "equals", "facebook")),
    (5, ("publisher", "equals", "instagram")),
    (6, ("utm_medium", "equals", "email")),
    (6, ("source", "prefix", "em-")),
    (7, ("utm_medium", "equals", "affiliate")),
    (8, ("referrer_host", "prefix", "google.")),
    (8, ("referrer_host", "contains", ".google.")),
    (8, ("referrer_host", "prefix", "bing.")),
    (8, ("referrer_host", "contains", ".bing.")),
    (9, ("utm_medium", "equals", "social")),
    (9, ("referrer_host", "equals", "t.co")),
    (9, ("referrer_host", "equals", "facebook.com")),
    (9, ("referrer_host", "suffix", ".facebook.com")),
    (9, ("source", "prefix", "soc-")),
    (10, ("utm_medium", "equals", "sms")),
    (10, ("source", "prefix", "sms-")),
    (11, ("source", "filled", "")),
    (12, ("referrer", "equals", ""), ("utm_medium", "equals", ""), ("utm_source", "equals", "")),
    (13, ("referrer_host", "equals", "secure.actblue.com")),
    (13, ("referrer_host", "equals", "shop.elizabethwarren.com")),
)


def page_rule_table(spark: SparkSession, rules: Sequence = fixed.PAGE_RULES) -> DataFrame:
    """Page rules of ``functions.rules`` as a table."""
    rows = []
    for number, (domain, tests, name, job) in enumerate(rules, start=1):
        paths = [[("page_path", kind, p)] for kind, patterns in tests.items() for p in patterns] or [[]]
        rows += [(number, [*path, ("page_domain", "equals", domain)], name, job) for path in paths]
    return spark.createDataFrame(rows, f"{RULES}, page_name string, page_job string")


def channel_rule_table(spark: SparkSession) -> DataFrame:
    """The default channel rules as a table."""
    rows = [(n, list(tests), fixed.CHANNEL_LABELS[n - 1]) for n, *tests in CHANNEL_TESTS]
    return spark.createDataFrame(rows, f"{RULES}, channel string")


def _checked(rules: DataFrame, columns: Sequence[str]) -> None:
    tests = rules.select(F.explode("tests").alias("test")).select("test.*")
    wrong = tests.filter(~F.col("column").isin(*columns) | ~F.col("kind").isin(*KINDS) | F.expr("column is null or kind is null or pattern is null"))
    if found := wrong.first():
        raise ValueError(f"not a test on {', '.join(columns)}: {found.asDict()}")


def _holds(value: Column, kind: Column, pattern: Column) -> Column:
    return (
        F.when(kind == "equals", value == pattern)
        .when(kind == "prefix", F.startswith(value, pattern))
        .when(kind == "prefix_any_case", F.startswith(F.lower(value), F.lower(pattern)))
        .when(kind == "suffix", F.endswith(value, pattern))
        .when(kind == "filled", value != "")
        .otherwise(F.contains(value, pattern))
    )


def _texts(value: Column, kind: str, lengths: Sequence[int]) -> Column:
    """What of a value rules of one kind are found under."""
    if kind == "equals":
        return F.array(value)
    if kind == "filled":
        return F.when(value != "", F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    text = F.lower(value) if kind == "prefix_any_case" else value
    fitting = F.filter(F.lit(list(lengths)), lambda n: n <= F.length(text))
    if kind == "contains":
        parts = F.transform(fitting, lambda n: F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substr(text, i, n)))
        return F.array_distinct(F.flatten(parts))
    if kind == "suffix":
        return F.transform(fitting, lambda n: F.substr(text, F.length(text) - n + 1, n))
    return F.transform(fitting, lambda n: F.substr(text, F.lit(1), n))


def matched_values(values: DataFrame, rules: DataFrame, columns: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """``columns``, ``rule_no`` and ``labels`` of the values that a rule matches; values are distinct and not NULL."""
    _checked(rules, columns)
    own_tests = [F.expr(f"filter(tests, t -> t.column = {fixed.sql_text(c)})") for c in columns]
    anchored = rules.select("rule_no", "tests", F.struct(*labels).alias("labels"), F.coalesce(*[F.get(t, F.lit(0)) for t in own_tests]).alias("anchor"))
    pattern = (
        F.when(F.col("anchor.kind") == "prefix_any_case", F.lower("anchor.pattern"))
        .when(F.col("anchor.kind") == "filled", "")
        .otherwise(F.col("anchor.pattern"))
    )
    found_under = anchored.select(
        F.coalesce("anchor.column", F.lit("")).alias("in"),
        F.coalesce("anchor.kind", F.lit("")).alias("kind"),
        F.coalesce(pattern, F.lit("")).alias("text"),
        "rule_no",
        "tests",
        "labels",
    )
    # As many rows as patterns have lengths, whatever the number of rules.
    shapes = found_under.select("in", "kind", F.length("text").alias("length")).distinct().collect()
    lengths: dict[tuple[str, str], list[int]] = {}
    for s in shapes:
        lengths.setdefault((s["in"], s["kind"]), []).append(s["length"])

    def keys(column: str, kind: str, own: list[int]) -> Column:
        texts = F.array(F.lit("")) if not column else _texts(F.col(column), kind, sorted(own))
        return F.transform(texts, lambda x: F.struct(F.lit(column).alias("in"), F.lit(kind).alias("kind"), x.alias("text")))

    if not lengths:
        return values.select(*columns, F.lit(None).cast("int").alias("rule_no"), *[F.lit(None).cast(rules.schema[c].dataType).alias(c) for c in labels]).limit(0)
    looked_up = values.select(*columns, F.explode(F.concat(*[keys(c, k, own) for (c, k), own in sorted(lengths.items())])).alias("key"))
    value_of = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])
    met = looked_up.select(*columns, "key.*").join(found_under, ["in", "kind", "text"])
    held = met.filter(F.forall("tests", lambda t: _holds(F.element_at(value_of, t["column"]), t["kind"], t["pattern"])))
    first = held.groupBy(*columns).agg(F.min(F.struct("rule_no", "labels")).alias("first"))
    return first.select(*columns, "first.rule_no", "first.labels.*")


def with_first_rule(rows: DataFrame, rules: DataFrame, columns: Sequence[str], otherwise: Mapping[str, str | None]) -> DataFrame:
    """``rows`` with ``rule_no`` (0 for none) and the label columns, the keys of ``otherwise``.

    NULL is tested as an empty text. The distinct values are found map-side first; their rules come back by a left join,
    broadcast while they are few, else shuffled, where AQE may split a value that a third of the rows have.
    """
    labels = list(otherwise)
    tested = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in columns})
    matched = matched_values(tested.select(*columns).distinct(), rules, columns, labels)
    own = [c for c in matched.columns if c not in columns]
    found = matched.select(F.struct(*columns).alias("value_"), F.struct(*own).alias("found_"))
    joined = tested.drop(*own).withColumn("value_", F.struct(*columns)).join(found, "value_", "left")
    filled = {c: F.coalesce(f"found_.{c}", F.lit(otherwise[c])) for c in labels}
    return joined.withColumns({"rule_no": F.coalesce("found_.rule_no", F.lit(0)), **filled}).drop("value_", "found_")


def with_pages_by_table(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Page name and page job of ``domain`` and ``path``, as ``classify.with_pages``."""
    tested = rows.withColumns({"page_domain": F.col("domain"), "page_path": F.col("path")})
    return with_first_rule(tested, rules, PAGE_COLUMNS, {"page_name": fixed.UNCLASSIFIED, "page_job": fixed.UNCLASSIFIED})


def with_channel_by_table(rows: DataFrame, rules: DataFrame, **inputs) -> DataFrame:
    """Marketing channel, as ``classify.with_channel``."""
    return with_first_rule(with_channel_inputs(rows, **inputs), rules, CHANNEL_COLUMNS, {"channel": fixed.OTHER})
