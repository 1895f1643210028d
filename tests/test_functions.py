"""Literal edge cases of the column functions."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from footfall.functions import rules, stats
from footfall.functions.dates import DateWindow, Years, calendar_columns, reporting_year
from footfall.functions.urls import traffic_source, url_host
from footfall.operators.classify import with_channel, with_pages

MAIN = "elizabethwarren.com"

PAGE_CASES = [
    (MAIN, "/", "Home", "Gateway"),
    (MAIN, "/meet-elizabeth/early", "Meet Elizabeth", "Learn"),
    (MAIN, "/plans", "Plans Gateway", "Learn"),
    (MAIN, "/plans/", "Plans Gateway", "Learn"),
    (MAIN, "/plans/green", "Plan Detail", "Learn"),
    (MAIN, "/issues", "Issues", "Learn"),
    (MAIN, "/x/calculator-tax", "Calculators", "Learn"),
    (MAIN, "/debt", "Calculators", "Learn"),
    (MAIN, "/kids", "Calculators", "Learn"),
    (MAIN, "/retirement", "Calculators", "Learn"),
    (MAIN, "/tax-returns", "Tax Returns", "Learn"),
    (MAIN, "/faqs", "FAQ", "Learn"),
    (MAIN, "/wealth-gap", "Wealth Gap (Scrolly Telling)", "Learn"),
    (MAIN, "/live", "Live", "Learn"),
    (MAIN, "/watch-live", "Live", "Learn"),
    (MAIN, "/legal-work", "Legal Work", "Learn"),
    (MAIN, "/pocahontas", "Pocahontas", "Learn"),
    ("learn." + MAIN, "/", "learn.ew domain (all)", "Learn"),
    (MAIN, "/join-us", "Join Us", "Volunteer"),
    (MAIN, "/all-in-for-warren", "All In For Warren", "Volunteer"),
    (MAIN, "/take-action", "Take Action", "Volunteer"),
    (MAIN, "/volunteer", "Volunteer", "Volunteer"),
    (MAIN, "/toolkit", "Toolkit", "Volunteer"),
    (MAIN, "/call-now", "Call", "Volunteer"),
    (MAIN, "/ROADwarriors", "Road Warriors", "Volunteer"),
    ("events." + MAIN, "/", "events.ew: Events Gateway", "Volunteer"),
    ("events." + MAIN, "/event/9", "events.ew: Event Detail", "Volunteer"),
    ("events." + MAIN, "/map", "events.ew: Other", "Volunteer"),
    ("events." + MAIN, None, "events.ew: Other", "Volunteer"),
    ("switchboard." + MAIN, "/", "Switchboard", "Volunteer"),
    (MAIN, "/jobs", "Jobs", "Volunteer"),
    ("join." + MAIN, "/j", "join.ew domain (all)", "Volunteer"),
    ("donate." + MAIN, "/d", "donate.ew domain (all)", "Donate"),
    (MAIN, "/thanks-for-donating", "Thanks For Donating", "Donate"),
    (MAIN, "/give-by-mail", "Give By Mail", "Donate"),
    ("secure.actblue.com", None, "ActBlue", "Donate"),
    ("caucus-app." + MAIN, "/", "caucus-app.ew domain (all)", "GOTV/C"),
    (MAIN, "/vote", "Polling Locator", "GOTV/C"),
    (MAIN, "/pledge", "Pledge", "GOTV/C"),
    ("shop." + MAIN, "/mug", "Shop", "Shop"),
    (MAIN, "/es/", "En Espanol (all ew.com/es/)", "Miscellaneous"),
    (MAIN, "/escape", "En Espanol (all ew.com/es/)", "Miscellaneous"),
    (MAIN, "/privacy-policy", "Privacy Policy, TOS", "Miscellaneous"),
    (MAIN, "/terms-of-service", "Privacy Policy, TOS", "Miscellaneous"),
    (MAIN, "/contact-us", "Contact Us", "Miscellaneous"),
    (MAIN, "/grassroots-donor-wall", "Grassroots Donor Wall", "Miscellaneous"),
    ("facts." + MAIN, "/f", "Fact Squad", "Miscellaneous"),
    ("my." + MAIN, "/page/s/unsubscribe", "Email Unsubscribe / Reduce", "Miscellaneous"),
    ("my." + MAIN, "/page/s/less-email", "Email Unsubscribe / Reduce", "Miscellaneous"),
    ("my." + MAIN, "/page/st/less-email", "Email Unsubscribe / Reduce", "Miscellaneous"),
    ("my." + MAIN, "/page/s/survey", "Surveys / Petitions / Contests", "Miscellaneous"),
    ("my." + MAIN, "/page/st/petition", "Surveys / Petitions / Contests", "Miscellaneous"),
    ("my." + MAIN, "/page/sp/contest", "Surveys / Petitions / Contests", "Miscellaneous"),
    ("my." + MAIN, "/other", "Other my.ew.com", "Miscellaneous"),
    ("my." + MAIN, None, "Other my.ew.com", "Miscellaneous"),
    (MAIN, "/Plans/", "Unclassified", "Unclassified"),
    (MAIN, None, "Unclassified", "Unclassified"),
    (None, "/", "Unclassified", "Unclassified"),
    ("www." + MAIN, "/", "Unclassified", "Unclassified"),
    ("example.org", "/plans/", "Unclassified", "Unclassified"),
]


def test_page_rules(spark):
    rows = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(PAGE_CASES)], "i int, domain string, path string")
    got = {r.i: (r.page_name, r.page_job) for r in with_pages(rows).collect()}
    assert got == {i: c[2:] for i, c in enumerate(PAGE_CASES)}
    assert len(rules.PAGE_RULES) == 43
    assert {c[2] for c in PAGE_CASES} == {r[2] for r in rules.PAGE_RULES} | {"Unclassified"}


def test_custom_page_rules_take_quotes(spark):
    rows = spark.createDataFrame([("o'x.org", "/a\\b")], "domain string, path string")
    custom = (("o'x.org", {"prefix": ["/a\\"]}, "It's", "Job's"),)
    assert with_pages(rows, custom).select("page_name", "page_job").first() == ("It's", "Job's")


@pytest.mark.parametrize(
    "region, five, three",
    [
        ("Iowa", "Early", "Early"),
        ("Texas", "Super Tuesday", "Super Tuesday"),
        ("North Dakota", "March 10", "Other"),
        ("Ohio", "March 14-27", "Other"),
        ("New York", "Other", "Other"),
        ("iowa", "Other", "Other"),
        (None, "Other", "Other"),
    ],
)
def test_state_groups(spark, region, five, three):
    rows = spark.createDataFrame([(region,)], "region string")
    assert rows.select(rules.state_group(), rules.state_group("region", rules.PAGE_STATE_GROUPS)).first() == (five, three)


def test_traffic_source(spark):
    cases = {
        None: None,
        "": "",
        "?source=a": "a",
        "?source=a&b=1": "a",
        "?x=1&source=b": "b",
        "?source=&a=1&source=x": "x",
        "?source=": "",
        "?resource=z": "",
        "?source=a?source=b": "ab",
        "?SOURCE=a": "",
        "?source=a#frag": "a#frag",
        "?x=1&source=a&source=b": "a",
        "x?source=a=b%20c": "a=b%20c",
        "?x=?source=a": "a",
        "&source=é&y": "é",
    }
    rows = spark.createDataFrame([(q, s) for q, s in cases.items()], "query string, expected string")
    wrong = rows.filter(~traffic_source(F.col("query")).eqNullSafe(F.col("expected")))
    assert wrong.collect() == []


def test_url_host(spark):
    cases = {"https://www.google.com/x": "www.google.com", "http://a.b:80?x": "a.b", "nothing": "", "": ""}
    rows = spark.createDataFrame(list(cases.items()), "url string, host string")
    assert rows.filter(url_host(F.col("url")) != F.col("host")).count() == 0


def test_channel_rules(spark):
    # query, utm_medium, utm_source, referrer, publisher, expected
    cases = [
        (None, "CPC", None, None, None, "Paid Search"),
        (None, None, None, None, "Google", "Paid Search"),
        (None, "display", None, None, "google", "Paid Search"),
        (None, "display", None, None, None, "Display"),
        ("?source=ads-x", None, None, None, None, "Paid Direct Buy"),
        (None, "direct-buy", None, None, None, "Paid Direct Buy"),
        (None, None, None, None, "Instagram", "Paid Social"),
        ("?source=EM-x", None, None, None, None, "Email"),
        (None, "email", None, None, None, "Email"),
        (None, "affiliate", None, None, None, "Affiliate"),
        (None, None, None, "https://www.GOOGLE.com/", None, "Organic Search"),
        (None, None, None, "https://bing.com/?q", None, "Organic Search"),
        (None, None, None, "https://notgoogle.com/", None, "Other"),
        (None, None, None, "https://t.co/a", None, "Organic Social"),
        (None, None, None, "https://m.facebook.com/a", None, "Organic Social"),
        (None, None, None, "https://xfacebook.com/a", None, "Other"),
        ("?source=soc-a", None, None, None, None, "Organic Social"),
        ("?source=sms-a", None, None, None, None, "SMS"),
        ("?source=zz", None, None, None, None, "Unknown Channel"),
        (None, None, None, None, None, "Direct"),
        ("", "", "", "", None, "Direct"),
        (None, None, None, "https://secure.actblue.com/donate", None, "Internal Transfer"),
        (None, None, None, "https://shop.elizabethwarren.com/", None, "Internal Transfer"),
        (None, None, "twitter", None, None, "Other"),
    ]
    rows = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(cases)],
        "i int, query string, utm_medium string, utm_source string, referrer string, publisher string, expected string",
    )
    got = with_channel(rows, publisher=F.col("publisher")).filter("channel <> expected").collect()
    assert got == []


def test_reporting_calendar(spark):
    days = {
        "2017-12-30": ("52", "12", "2018"),
        "2018-12-29": ("52", "12", "2018"),
        "2018-12-30": ("1", "12", "2019"),
        "2019-12-28": ("52", "12", "2019"),
        "2019-12-29": ("1", "12", "2020"),
        "2021-01-02": ("53", "1", "2020"),
        "2021-01-03": ("1", "1", "2021"),
        "2024-01-30": ("5", "1", "2021"),
    }
    rows = spark.createDataFrame([(date.fromisoformat(d),) for d in days], "d date")
    got = {str(r[0]): tuple(r[1:]) for r in rows.select("d", *calendar_columns(F.col("d"), Years(2018, 2021)).values()).collect()}
    assert got == days
    open_ended = rows.select(reporting_year(F.col("d")).alias("y")).collect()
    assert [r.y for r in open_ended] == [2017, 2018, 2019, 2019, 2020, 2020, 2021, 2024]


def test_window_is_inclusive():
    window = DateWindow.relative(date(2024, 1, 30), -2, 0)
    assert (window.first, window.last) == (date(2024, 1, 28), date(2024, 1, 30))
    assert len(window.days()) == 3


def test_p_value_against_erfc(spark):
    z = [i / 50 for i in range(-500, 501)] + [37.0, 38.0, 100.0]
    rows = spark.createDataFrame([(v,) for v in z], "z double")
    for r in rows.select("z", stats.two_sided_p("z").alias("p")).collect():
        assert math.isclose(r.p, math.erfc(abs(r.z) / math.sqrt(2)), rel_tol=2e-8, abs_tol=1e-15)


def test_p_value_of_special_values(spark):
    rows = spark.createDataFrame([(0, float("nan")), (1, float("inf")), (2, float("-inf")), (3, None)], "i int, z double")
    p = [r.p for r in rows.select("i", stats.two_sided_p("z").alias("p")).orderBy("i").collect()]
    assert math.isnan(p[0]) and p[1:] == [0.0, 0.0, None]
