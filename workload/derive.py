"""Web logs derived from the ``events`` table.

Only the shape of the logs is invented here: every event becomes one page view or one conversion log
row, so the work of each query grows with the table. The same lists feed the SQL of ``oracle.py``.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.dates import DateWindow
from footfall.functions.rules import sql_array, sql_text
from footfall.operators import classify, experiments, page_insights, rule_tables, user_totals

MAIN = "elizabethwarren.com"

# --- Fixed values: test inputs -----------------------------------------------------------------------------------
PAGES = [
    (MAIN, "/"), (MAIN, "/meet-elizabeth"), (MAIN, "/plans"), (MAIN, "/plans/"), (MAIN, "/plans/green"),
    (MAIN, "/issues"), (MAIN, "/x/calculator-tax"), (MAIN, "/debt"), (MAIN, "/kids"), (MAIN, "/retirement"),
    (MAIN, "/tax-returns"), (MAIN, "/faqs"), (MAIN, "/wealth-gap"), (MAIN, "/live"), (MAIN, "/watch-live"),
    (MAIN, "/legal-work"), (MAIN, "/pocahontas"), ("learn." + MAIN, "/a"), (MAIN, "/join-us"),
    (MAIN, "/all-in-for-warren"), (MAIN, "/take-action"), (MAIN, "/volunteer"), (MAIN, "/toolkit"),
    (MAIN, "/call-now"), (MAIN, "/RoadWarriors"), ("events." + MAIN, "/"), ("events." + MAIN, "/event/9"),
    ("events." + MAIN, "/map"), ("switchboard." + MAIN, "/"), (MAIN, "/jobs"), ("join." + MAIN, "/j"),
    ("donate." + MAIN, "/d"), (MAIN, "/thanks-for-donating"), (MAIN, "/give-by-mail"),
    ("secure.actblue.com", "/donate/x"), ("caucus-app." + MAIN, "/"), (MAIN, "/vote"), (MAIN, "/pledge"),
    ("shop." + MAIN, "/mug"), (MAIN, "/es/"), (MAIN, "/privacy-policy"), (MAIN, "/terms-of-service"),
    (MAIN, "/contact-us"), (MAIN, "/grassroots-donor-wall"), ("facts." + MAIN, "/f"),
    ("my." + MAIN, "/unsubscribe/me"), ("my." + MAIN, "/page/s/less-email"), ("my." + MAIN, "/page/st/less-email"),
    ("my." + MAIN, "/page/s/survey"), ("my." + MAIN, "/page/st/petition"), ("my." + MAIN, "/page/sp/contest"),
    ("my." + MAIN, "/other"), (MAIN, "/Plans/"), (MAIN, "/unknown"), ("www." + MAIN, "/"), (MAIN, "/escape"),
    ("my." + MAIN, "/page/s/unsubscribe"), (None, "/"), (MAIN, None), ("example.org", "/plans/"),
]
REGIONS = [
    "Iowa", "New Hampshire", "South Carolina", "Nevada", "Alabama", "Arkansas", "California", "Colorado", "Maine",
    "Massachusetts", "Minnesota", "North Carolina", "Oklahoma", "Tennessee", "Texas", "Utah", "Vermont", "Virginia",
    "Idaho", "Michigan", "Mississippi", "Missouri", "North Dakota", "Washington", "Wyoming", "Arizona", "Florida",
    "Illinois", "Ohio", "Georgia", "New York", "Ontario", None,
]
# query, utm_medium, utm_source, referrer
QUERIES = [
    (None, None, None, None),
    ("", None, None, "https://www.google.com/search"),
    ("?source=em-launch", None, None, None),
    ("?utm_medium=email&source=em-second", "email", None, None),
    ("?source=&a=1&source=x", None, None, "https://example.org/"),
    ("?source=ads-g-1&utm_source=google&utm_medium=cpc", "cpc", "google", "https://www.google.com/"),
    ("?resource=zzz", None, None, "https://t.co/x"),
    ("?source=soc-1?source=dup", None, None, None),
    ("?SOURCE=upper", None, None, None),
    ("?source=sms-1#frag", "sms", None, None),
    ("?utm_source=twitter&utm_medium=social", "social", "twitter", "https://t.co/y"),
    ("?source=multi", "display", None, None),
]
ADS_METADATA = [
    ("ads-g-1", "Google"), ("em-second", "House List"), ("multi", "Facebook"), ("multi", "Instagram"),
    ("multi", "Instagram"),
]
# --- End of fixed values -----------------------------------------------------------------------------------------

AS_OF = date(2024, 1, 30)
BEGIN_OFFSET, END_OFFSET = -13, 0
WINDOW = DateWindow.relative(AS_OF, BEGIN_OFFSET, END_OFFSET)
TEST = experiments.Experiment("button_test", "control", date(2024, 1, 5), date(2024, 1, 20), ("/", "/plans/"))
LONG_TEST = experiments.Experiment("long_test", "control", date(1995, 1, 1), date(1996, 6, 30), ("/",))
# Nobody ever has the last one.
METRIC_EVENTS = ("DefaultEventName", "CustomEventName", "NeverEventName")


def home_page() -> Column:
    return (F.col("domain") == MAIN) & (F.col("path") == "/")


def issues_page() -> Column:
    return (F.col("domain") == MAIN) & (F.col("path") == "/issues")


def convert_labels() -> list:
    return [
        (F.col("event_type") == "purchase", "Donate"),
        ((F.col("event_type") == "signup") & (F.col("value") >= 30.0), "Sign Up"),
        (F.col("event_type") == "signup", "Sign Up Started"),
    ]


def engagement_labels() -> list:
    click = F.col("event_type") == "click"
    return [
        (click & (F.col("value") >= 50.0), "Primary", "Large Click", "click, value >= 50"),
        (click, "Secondary", "Small Click", "click, value < 50"),
    ]


def core_labels() -> list:
    return [(F.col("event_type") == "purchase", "Donate"), (F.col("event_type") == "signup", "Sign Up")]


def _nth(rows: list[tuple], names: list[str], index: str) -> str:
    """SQL for one row of a small fixed list, as a struct."""
    structs = [f"struct({', '.join(f'{sql_text(v)} as {n}' for n, v in zip(names, row))})" for row in rows]
    return f"try_element_at(array({', '.join(structs)}), int({index}) + 1)"


class Logs:
    """The logs a site would have, read from one scale factor's tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def hits(self) -> DataFrame:
        return self._hits

    @cached_property
    def _hits(self) -> DataFrame:
        events = self.spark.read.parquet(f"{self.sf_dir}/events.parquet")
        page = "if(cast(regexp_extract(props, '([0-9]+)', 1) as int) % 4 = 0, 0, event_id % 60)"
        query = "(event_id div 7) % 12"
        looked_up = events.selectExpr(
            "*",
            _nth(PAGES, ["domain", "path"], page) + " as page",
            _nth(QUERIES, ["query", "utm_medium", "utm_source", "referrer"], query) + " as arrival",
        )
        return looked_up.selectExpr(
            "event_id",
            "string(user_id) as user_id",
            "concat_ws('-', user_id, (dayofyear(ts) * 24 + hour(ts) + 6) div 48) as session_id",
            "ts as time",
            "event_type",
            "value",
            "case user_id % 3 when 0 then 'Desktop' when 1 then 'Mobile' else 'Tablet' end as device_type",
            f"try_element_at({sql_array(REGIONS)}, int(user_id % 33) + 1) as region",
            "page.*",
            "arrival.*",
            "if(event_id % 2 = 0, '/', '/plans/') as landing_page",
        )

    def pageviews(self) -> DataFrame:
        return self.hits().filter(F.col("event_type").isin("view", "error"))

    def partly_anonymous_views(self) -> DataFrame:
        """Page views of which a third has no user id and another third no session id."""
        return self.pageviews().withColumns(
            {
                "user_id": F.when(F.col("event_id") % 3 != 0, F.col("user_id")),
                "session_id": F.when(F.col("event_id") % 3 != 1, F.col("session_id")),
            }
        )

    def order_events(self) -> DataFrame:
        """Classified events on the dates of ``orders``, which span several years."""
        segments = ", ".join(f"cast(null as string) as {c}" for c in classify.SEGMENTS)
        orders = self.spark.read.parquet(f"{self.sf_dir}/orders.parquet")
        return orders.selectExpr(
            "string(o_custkey) as user_id", "string(o_orderkey) as session_id", "to_date(o_orderdate) as date", *segments.split(", ")
        )

    def convert_logs(self) -> DataFrame:
        return self.hits().filter(F.col("event_type").isin("click", "purchase", "signup"))

    def assigned_variation(self) -> DataFrame:
        views = self.pageviews()
        variation = """case
            when cast(user_id as int) % 50 = 7 and event_id % 2 = 0 then 'control'
            when cast(user_id as int) % 3 = 0 then 'control'
            when cast(user_id as int) % 3 = 1 then 'red button'
            else 'large donate amounts' end"""
        return views.selectExpr(
            "session_id", "user_id", "time", "'button_test' as testname", f"{variation} as variation"
        ).unionByName(
            views.selectExpr("session_id", "user_id", "time", "'other_test' as testname", "'control' as variation")
        )

    def ads_metadata(self) -> DataFrame:
        rows = ", ".join(f"('{s}', '{p}')" for s, p in ADS_METADATA)
        return self.spark.sql(f"select * from values {rows} as t(source, publisher)")

    def metric_events(self) -> DataFrame:
        """Default and custom events come from two logs in practice, hence a union."""
        logs = self.convert_logs().filter(F.col("value") >= 30.0)
        parts = [
            classify.label_events(logs, [(F.col("event_type") == kind, name)], "metric_event_name")
            for kind, name in zip(("purchase", "signup"), METRIC_EVENTS)
        ]
        return classify.union_logs(
            [p.select("user_id", F.col("time").alias("metric_time"), "metric_event_name") for p in parts]
        )

    def metric_amounts(self) -> DataFrame:
        """Metric events with the amount of each."""
        logs = self.convert_logs().filter(F.col("value") >= 30.0)
        labels = [(F.col("event_type") == kind, name) for kind, name in zip(("purchase", "signup"), METRIC_EVENTS)]
        return classify.label_events(logs, labels, "metric_event_name").select(
            "user_id", F.col("time").alias("metric_time"), "metric_event_name", F.col("value").alias("metric_value")
        )

    def conversions(self) -> DataFrame:
        return classify.label_events(self.convert_logs(), convert_labels(), "convert_event")

    def reach_events(self, window: DateWindow | None = WINDOW) -> DataFrame:
        return classify.classify_pageviews(self.pageviews(), window)

    def convert_events(self) -> DataFrame:
        return classify.classify_conversions(self.conversions(), WINDOW, self.ads_metadata())

    def home_views(self) -> DataFrame:
        return page_insights.page_views(self.pageviews(), WINDOW, home_page(), keep=["event_id"])

    def home_sessions(self) -> DataFrame:
        return page_insights.first_views(self.home_views(), ["event_id"])

    def engagement_events(self) -> DataFrame:
        return page_insights.page_engagement_events(self.convert_logs(), WINDOW, home_page(), engagement_labels())

    def core_events(self) -> DataFrame:
        return page_insights.core_conversion_events(self.convert_logs(), WINDOW, core_labels())

    def exposed(self) -> DataFrame:
        return experiments.exposed_users(
            self.pageviews(), experiments.first_variant_logs(self.assigned_variation(), TEST), TEST
        )

    def pages_by_table(self) -> DataFrame:
        return rule_tables.with_pages_by_table(self.hits(), rule_tables.page_rule_table(self.spark))

    def exposed_by(self, *identities: str) -> DataFrame:
        return experiments.exposed_by_identity(self.pageviews(), self.assigned_variation(), TEST, identities)

    def total_results(self, kind: str) -> DataFrame:
        metrics = [user_totals.UserMetric(name, kind) for name in METRIC_EVENTS]
        return user_totals.ab_user_total_results(
            self.pageviews(), self.assigned_variation(), self.metric_amounts(), metrics, TEST, AS_OF
        )

    def conversions_by_user(self) -> DataFrame:
        days = experiments.metric_event_days(self.metric_events(), TEST)
        return experiments.first_conversions(self.exposed(), days, [f"{m} Rate" for m in METRIC_EVENTS])

    def ab_results(self) -> DataFrame:
        return experiments.ab_variant_results(
            self.pageviews(), self.assigned_variation(), self.metric_events(), METRIC_EVENTS, TEST, AS_OF
        )
