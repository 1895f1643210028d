"""Operators against plain Python on small inputs with dominant and missing keys."""

import math
import random
from collections import Counter
from dataclasses import replace
from datetime import date, datetime, timedelta
from statistics import variance

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.functions.dates import DateWindow, Years
from footfall.operators import classify, experiments, inference, page_insights, reports, rollup
from tests.conftest import DATA
from workload import derive

WINDOW = DateWindow(date(2021, 1, 1), date(2021, 1, 5))
EVENTS = (
    "user_id string, session_id string, date date, device_type string, region string, state_group string, "
    "page_name string, page_job string, channel string"
)


def skewed_events():
    """A third of the rows belong to one user and session, a tenth have no ids or no region."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        session = "hot" if i % 3 == 0 else None if i % 10 == 1 else f"s{rng.randrange(200)}"
        user = "bot" if i % 3 == 0 else None if i % 10 == 2 else f"u{rng.randrange(80)}"
        region = rng.choice(["Iowa", "Ohio", None])
        day = date(2020, 12, 1) + timedelta(days=rng.randrange(60))
        page = rng.choice(["Home", "Shop", "FAQ"])
        rows.append(
            (user, session, day, rng.choice(["Mobile", "Desktop"]), region, {"Iowa": "Early"}.get(region, "Other"),
             page, {"Home": "Gateway"}.get(page, page), rng.choice(["Email", "Direct"]))
        )
    return rows


def expected_rollups(rows):
    names = [c.split()[0] for c in EVENTS.split(", ")]
    groups = {}
    for row in rows:
        r = dict(zip(names, row))
        day = r["date"]
        iso = (day + timedelta(days=1)).isocalendar()
        week, year = str(iso.week), str(min(max(iso.year, 2018), 2021))
        periods = {"Weekly": (None, week, None, year), "Monthly": (None, None, str(day.month), None)}
        if WINDOW.first <= day <= WINDOW.last:
            periods["Daily"] = (day, week, str(day.month), year)
        for grain, period in periods.items():
            for summary, kept in rollup.SUMMARIES.items():
                key = (f"{grain} {summary}", *period, *[r[c] if c in kept else None for c in classify.SEGMENTS])
                g = groups.setdefault(key, [0, set(), set()])
                g[0] += 1
                g[1].add(r["session_id"])
                g[2].add(r["user_id"])
    return {k: (n, len(s - {None}), len(u - {None})) for k, (n, s, u) in groups.items()}


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(skewed_events(), EVENTS).repartition(6).cache()


def test_rollups_with_dominant_keys(events):
    expected = expected_rollups(skewed_events())
    got = {tuple(r[:-3]): tuple(r[-3:]) for r in rollup.summarize(events, WINDOW).collect()}
    assert got == expected


def test_rollup_properties(events):
    rows = rollup.summarize(events, WINDOW).filter("analysis like 'Daily%'").collect()
    per_day = {}
    for r in rows:
        per_day.setdefault((r.date, r.analysis), Counter())["pv"] += r.pv_ct
    for day in {d for d, _ in per_day}:
        assert len({c["pv"] for (d, _), c in per_day.items() if d == day}) == 1


def test_summary_with_segmented_rows(events):
    summary = rollup.reach_overview_summary(events, WINDOW)
    assert tuple(summary.columns) == rollup.SUMMARY_COLUMNS
    finest = summary.filter("analysis = 'Fully Segmented PVs'")
    assert finest.agg(F.sum("pv_ct")).first()[0] == events.filter(WINDOW.has_date(F.col("date"))).count()
    assert finest.filter("session_ct is not null or user_ct is not null").count() == 0


def page_view_rows():
    rng = random.Random(3)
    start = datetime(2021, 1, 1, 22)
    rows = []
    for i in range(600):
        session = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"s{rng.randrange(90)}"
        time = start + timedelta(minutes=rng.randrange(60 * 50), seconds=rng.randrange(2))
        rows.append(("u", session, time, time.date(), "Mobile", "Iowa", "Early", "Email", "/", i))
    return rows


VIEWS = (
    "user_id string, session_id string, time timestamp_ntz, date date, device_type string, region string, "
    "state_group string, channel string, landing_page string, event_id int"
)


@pytest.fixture(scope="module")
def views(spark):
    return spark.createDataFrame(page_view_rows(), VIEWS).repartition(5).cache()


def expected_sequence():
    sessions = {}
    for r in page_view_rows():
        sessions.setdefault(r[1], []).append((r[2], r[9]))
    return {(s, e): n for s, seen in sessions.items() for n, (_, e) in enumerate(sorted(seen), start=1)}


def test_session_sequence_over_hours(views):
    numbered = page_insights.with_session_sequence(views, ["event_id"])
    got = {(r.session_id, r.event_id): r.session_pv_seq for r in numbered.collect()}
    assert got == expected_sequence()


def test_first_views(views):
    got = {(r.session_id, r.event_id) for r in page_insights.first_views(views, ["event_id"]).collect()}
    assert got == {k for k, n in expected_sequence().items() if n == 1}


@pytest.mark.parametrize("combined", [False, True])
@pytest.mark.parametrize("after_view", [True, False])
def test_attached_events_equal_a_left_join(spark, views, after_view, combined):
    rng = random.Random(5)
    start = datetime(2021, 1, 1, 20)
    rows = [
        ("hot" if i % 3 == 0 else None if i % 40 == 1 else f"s{rng.randrange(140)}",
         start + timedelta(minutes=rng.randrange(60 * 55)), "Core", rng.choice(["Donate", "Sign Up"]), "N/A")
        for i in range(300)
    ]
    events = spark.createDataFrame(
        rows, "session_id string, time timestamp_ntz, event_type string, event_name string, event_description string"
    )
    first = page_insights.first_views(views, ["event_id"])
    got = Counter(
        (r.session_id, r.pv_time, r.event_name)
        for r in page_insights.attach_events(first, events, after_view=after_view, combined=combined).collect()
    )
    expected = Counter()
    for view in first.collect():
        hits = [e[3] for e in rows
                if e[0] is not None and e[0] == view.session_id and (not after_view or view.time <= e[1])]
        for name in hits or [None]:
            expected[(view.session_id, view.time, name)] += 1
    assert got == expected


def test_conversion_rate(spark):
    rows = [
        (date(2021, 1, 1), "a", "T", "Donate"), (date(2021, 1, 1), "a", "T", "Donate"),
        (date(2021, 1, 1), "b", None, None), (date(2021, 1, 2), "c", None, None),
    ]
    funnel = spark.createDataFrame(rows, "date date, session_id string, event_type string, event_name string")
    got = page_insights.session_conversion_rate(funnel).collect()
    assert [tuple(r) for r in got] == [(date(2021, 1, 1), "T", "Donate", 2, 1, 0.5)]


def test_latest_events_give_the_same_rates(spark, views):
    rng = random.Random(9)
    start = datetime(2021, 1, 1, 20)
    rows = [
        ("hot" if i % 3 == 0 else f"s{rng.randrange(140)}", start + timedelta(minutes=rng.randrange(3300)), "Core",
         rng.choice(["Donate", "Sign Up"]), "N/A")
        for i in range(300)
    ]
    events = spark.createDataFrame(
        rows, "session_id string, time timestamp_ntz, event_type string, event_name string, event_description string"
    )
    first = page_insights.first_views(views, ["event_id"])
    rates = [
        sorted(page_insights.session_conversion_rate(page_insights.conversion(first, e)).collect(), key=str)
        for e in (events, page_insights.latest_per_session(events))
    ]
    assert rates[0] == rates[1] and rates[0]


def test_several_publishers_multiply_events(spark):
    events = spark.createDataFrame([(1, "m"), (2, "x"), (3, None), (4, "")], "i int, source string")
    ads = spark.createDataFrame([("m", "F"), ("m", "G"), ("m", "G")], "source string, publisher string")
    got = sorted((r.i, r.publisher or "") for r in classify.join_publishers(events, ads).collect())
    assert got == [(1, "F"), (1, "G"), (2, ""), (3, ""), (4, "")]


# --- experiments -------------------------------------------------------------------------------------------------

TEST = experiments.Experiment("t", "control", date(2021, 1, 2), date(2021, 1, 6), ("/", "/p"))
AS_OF = date(2021, 1, 5)


def experiment_logs():
    """Sessions change users, users sit in two variants, one user dominates, some views have no user."""
    rng = random.Random(11)
    start = datetime(2021, 1, 1)

    def moment():
        return start + timedelta(minutes=rng.randrange(60 * 24 * 8))

    views, logs, metrics = [], [], []
    for i in range(900):
        user = "bot" if i % 3 == 0 else None if i % 25 == 1 else f"u{rng.randrange(60)}"
        views.append((user, f"s{rng.randrange(120)}", moment(), rng.choice(["/", "/p", "/other"])))
        logs.append((f"s{rng.randrange(120)}", moment(), rng.choice(["t", "t", "t2"]), rng.choice(["control", "a", "b"])))
    for i in range(700):
        user = "bot" if i % 3 == 0 else None if i % 25 == 1 else f"u{rng.randrange(60)}"
        metrics.append((user, moment(), rng.choice(["D", "C", "unlisted"])))
    return views, logs, metrics


def expected_results(views, logs, metrics, names):
    inside = lambda t: TEST.start <= t.date() <= TEST.end
    first_log = {}
    for s, t, name, variation in logs:
        if name == "t" and inside(t):
            key = (s, variation)
            first_log[key] = min(t, first_log.get(key, t))
    exposed = {}
    for user, s, t, path in views:
        for (session, variation), logged in first_log.items():
            if session == s and t >= logged and path in TEST.exposure_paths:
                key = (user, variation)
                exposed[key] = min(t, exposed.get(key, t))
    last = min(TEST.end, AS_OF)
    cells = {}
    for (user, variation), seen in exposed.items():
        day = seen.date()
        while day <= last:
            for name in names:
                flag = user is not None and any(
                    m[0] == user and m[2] == name and inside(m[1]) and seen <= m[1] and m[1].date() <= day for m in metrics
                )
                cells.setdefault((variation, day, name), []).append((user, int(flag)))
            day += timedelta(days=1)
    stats = {}
    for key, flags in cells.items():
        values = [f for _, f in flags]
        stats[key] = (sum(u is not None for u, _ in flags), sum(values), variance(values) if len(values) > 1 else None)
    results = {}
    for (variation, day, name), (n, x, var) in stats.items():
        if variation != "control" and ("control", day, name) in stats:
            n_con, x_con, var_con = stats[("control", day, name)]
            results[(variation, day, f"{name} Rate")] = (n, n_con, x, x_con, var, var_con)
    return results


def test_ab_results_against_full_expansion(spark):
    views, logs, metrics = experiment_logs()
    results = experiments.ab_variant_results(
        spark.createDataFrame(views, "user_id string, session_id string, time timestamp_ntz, path string").repartition(4),
        spark.createDataFrame(logs, "session_id string, time timestamp_ntz, testname string, variation string"),
        spark.createDataFrame(metrics, "user_id string, metric_time timestamp_ntz, metric_event_name string"),
        ["D", "C"],
        TEST,
        AS_OF,
    )
    expected = expected_results(views, logs, metrics, ["D", "C"])
    got = {
        (r.variation, r.reporting_date, r.metric_name): (
            r.n_tre, r.n_con, r.metric_total_tre, r.metric_total_con, r.variance_tre, r.variance_con
        )
        for r in results.collect()
    }
    assert got.keys() == expected.keys() and got
    for key, want in expected.items():
        assert got[key][:4] == want[:4]
        for have, exact in zip(got[key][4:], want[4:]):
            assert (have is None) == (exact is None) and (exact is None or math.isclose(have, exact, abs_tol=1e-12))


def test_no_report_before_the_test_starts(spark):
    assert experiments.experiment_dates(spark, TEST, date(2021, 1, 1)).count() == 0
    assert experiments.experiment_dates(spark, TEST, AS_OF).count() == 4
    long_test = experiments.Experiment("t", "c", date(2020, 1, 1), date(2021, 12, 31), ("/",))
    assert experiments.experiment_dates(spark, long_test, date(2022, 1, 1)).count() == 731
    limited = replace(long_test, max_days=128)
    assert experiments.experiment_dates(spark, limited, date(2022, 1, 1)).count() == 128


def test_session_numbers_equal_a_plain_window(spark):
    logs = derive.Logs(spark, DATA)
    views = page_insights.page_views(logs.partly_anonymous_views(), derive.WINDOW, derive.home_page(), keep=["event_id"])
    in_session = Window.partitionBy("session_id").orderBy("time", "event_id")
    plain = {r.event_id: r.n for r in views.select("event_id", F.row_number().over(in_session).alias("n")).collect()}
    numbered = {r.event_id: r.session_pv_seq for r in page_insights.with_session_sequence(views, ["event_id"]).collect()}
    assert plain == numbered and max(plain.values()) > 10


def test_session_numbers_with_a_hot_second(spark):
    views = spark.range(0, 30_000, 1, 6).selectExpr(
        "if(id % 3 = 0, 'hot', if(id % 7 = 0, null, string(id % 400))) as session_id", "id as event_id",
        "timestamp_ntz'2021-01-02 23:59:50' + make_dt_interval(0, 0, 0, if(id % 2 = 0, 0, (id * 7919) % 40) + (id % 5) / 10) as time",
    )
    in_session = Window.partitionBy("session_id").orderBy("time", "event_id")
    both = page_insights.with_session_sequence(views, ["event_id"]).withColumn("plain", F.row_number().over(in_session))
    assert both.filter("session_pv_seq <> plain").count() == 0 and both.count() == 30_000


def test_years_are_not_merged_unless_asked(spark):
    rows = [("u", "s", d, *["x"] * 6) for d in (date(2023, 3, 15), date(2024, 3, 13))]
    events = spark.createDataFrame(rows, "user_id string, session_id string, date date, device_type string, region string, "
                                   "state_group string, page_name string, page_job string, channel string")
    window = DateWindow(date(2024, 3, 13), date(2024, 3, 13))
    weekly = [rollup.Analysis("Weekly", "Grand Total")]
    assert {(r.week, r.reporting_wk_yr, r.pv_ct) for r in rollup.summarize(events, window, weekly).collect()} == {("11", "2023", 1), ("11", "2024", 1)}
    clamped = rollup.summarize(events, window, weekly, years=Years(2018, 2021)).collect()
    assert [(r.week, r.reporting_wk_yr, r.pv_ct) for r in clamped] == [("11", "2021", 2)]
    monthly = [rollup.Analysis("Monthly", "Grand Total")]
    assert {(r.month, r.pv_ct) for r in rollup.summarize(events, window, monthly).collect()} == {("3", 2)}
    assert {r.month for r in rollup.summarize(events, window, monthly, month_years=True).collect()} == {"2023-03", "2024-03"}


def test_undefined_tests_are_neither_significant_nor_not(spark):
    rows = spark.createDataFrame([(float("nan"), 0.0), (0.01, -1.0), (0.5, 1.0), (None, 1.0)], "p_value double, diff double")
    got = [(r.is_significant, r.color_class) for r in reports.with_significance(rows).collect()]
    assert got == [(None, "neither"), (True, "negative"), (False, "neither"), (None, "neither")]


RESULTS = (
    "testname string, variation string, control_description string, reporting_date date, metric_name string, "
    "n_tre bigint, n_con bigint, metric_total_tre double, metric_total_con double, metric_normalized_tre double, "
    "metric_normalized_con double, variance_tre double, variance_con double, diff double, diff_pct double"
)


def result(var_tre, var_con, diff, diff_pct=0.5):
    return ("t", "a", "control", AS_OF, "D Rate", 10, 20, 1.0, 1.0, 0.1, 0.05, var_tre, var_con, diff, diff_pct)


def test_inference_of_degenerate_results(spark):
    rows = [result(0.0, 0.0, 0.0), result(0.0, 0.0, 0.5), result(0.0, 0.0, -0.5), result(None, 0.1, 0.1)]
    got = [
        inference.ab_variant_inference(spark.createDataFrame([r], RESULTS)).select("test_statistic", "p_value").first()
        for r in rows
    ]
    assert math.isnan(got[0][0]) and math.isnan(got[0][1])
    assert tuple(got[1]) == (math.inf, 0.0) and tuple(got[2]) == (-math.inf, 0.0)
    assert tuple(got[3]) == (None, None)


def test_inference_values(spark):
    r = inference.ab_variant_inference(spark.createDataFrame([result(0.09, 0.05, 0.05)], RESULTS)).first()
    error = math.sqrt(0.09 / 10 + 0.05 / 20)
    assert math.isclose(r.standard_error, error)
    assert math.isclose(r.margin_of_error, 1.959963984540054 * error)
    assert math.isclose(r.confidence_interval_lower, 0.05 - r.margin_of_error)
    assert math.isclose(r.confidence_interval_upper, 0.05 + r.margin_of_error)
    assert math.isclose(r.p_value, math.erfc(0.05 / error / math.sqrt(2)), rel_tol=1e-9)
    assert math.isclose(r.mde_80, error * (1.959963984540054 + 0.8416212335729143))
    assert math.isclose(r.mde_90, error * (1.959963984540054 + 1.2815515655446004))
    assert math.isclose(r.mde_95, error * (1.959963984540054 + 1.6448536269514722))


def test_interpretation_texts(spark):
    strong = inference.ab_variant_inference(spark.createDataFrame([result(0.0001, 0.0001, 0.05, 1.0)], RESULTS))
    weak = inference.ab_variant_inference(spark.createDataFrame([result(0.09, 0.05, 0.0001, -0.1234567)], RESULTS))
    unknown = inference.ab_variant_inference(spark.createDataFrame([result(None, 0.05, 0.0001)], RESULTS))
    strong, weak, unknown = (reports.with_interpretation(d).first() for d in (strong, weak, unknown))
    assert strong.is_significant and strong.color_class == "positive"
    assert strong.interpretation == (
        "SIGNIFICANT: The Treatment performed significantly better/worse than the Control.  We are 95% confident that "
        "the size of this effect is between 0.0424 and 0.0576.  The difference observed was 0.05, or 100% more/less "
        "than Control."
    )
    assert weak.color_class == "neither" and weak.interpretation.startswith("NOT SIGNIFICANT: We cannot conclude")
    assert "between -0.2101 and 0.2103.  This doesn't mean" in weak.interpretation
    assert "greater than +/- 0.3004 (MDE)." in weak.interpretation
    assert unknown.is_significant is None and unknown.interpretation is None
