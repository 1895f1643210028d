"""Sum and count per user against full expansion in plain Python, with a user who owns a third of the events."""

import math
import random
from datetime import datetime, timedelta
from statistics import variance

import pytest

from footfall.operators import experiments, user_totals
from footfall.operators.user_totals import UserMetric
from tests.conftest import DATA
from tests.test_operators import AS_OF, TEST, experiment_logs
from workload import derive

METRICS = (UserMetric("D"), UserMetric("D", "Count"), UserMetric("C"), UserMetric("Never"))


def amounts(seed=3):
    rng = random.Random(seed)
    start = datetime(2021, 1, 1)
    rows = []
    for i in range(900):
        user = "bot" if i % 3 == 0 else None if i % 25 == 1 else f"u{rng.randrange(60)}"
        value = None if i % 40 == 2 else rng.choice([0.0, -3.5, 1e6, 12.25, 0.1])
        rows.append((user, start + timedelta(minutes=rng.randrange(60 * 24 * 8)), rng.choice(["D", "C", "unlisted"]), value))
    return rows


def expected(views, logs, events, metrics):
    inside = lambda t: TEST.start <= t.date() <= TEST.end
    first_log = {}
    for s, t, name, variation in logs:
        if name == "t" and inside(t):
            first_log[s, variation] = min(t, first_log.get((s, variation), t))
    exposed = {}
    for user, s, t, path in views:
        for (session, variation), logged in first_log.items():
            if session == s and t >= logged and path in TEST.exposure_paths:
                exposed[user, variation] = min(t, exposed.get((user, variation), t))
    last = min(TEST.end, AS_OF)
    values = {}
    for (user, variation), seen in exposed.items():
        day = seen.date()
        while day <= last:
            for m in metrics:
                mine = [
                    1 if m.kind == "Count" else value or 0.0
                    for u, t, name, value in events
                    if u is not None and u == user and name == m.event_name and inside(t) and seen <= t and t.date() <= day
                ]
                values.setdefault((variation, day, m.name), []).append((user, sum(mine)))
            day += timedelta(days=1)
    return {
        key: (sum(u is not None for u, _ in v), sum(x for _, x in v), variance([x for _, x in v]) if len(v) > 1 else None) for key, v in values.items()
    }


def frames(spark, views, logs, events):
    return (
        spark.createDataFrame(views, "user_id string, session_id string, time timestamp_ntz, path string").repartition(4),
        spark.createDataFrame(logs, "session_id string, time timestamp_ntz, testname string, variation string"),
        spark.createDataFrame(events, "user_id string, metric_time timestamp_ntz, metric_event_name string, metric_value double").repartition(5),
    )


@pytest.mark.parametrize("seed", [3, 4])
def test_moments_equal_full_expansion(spark, seed):
    views, logs, _ = experiment_logs()
    events = amounts(seed)
    pageviews, assigned, log = frames(spark, views, logs, events)
    exposed = experiments.exposed_users(pageviews, experiments.first_variant_logs(assigned, TEST), TEST, through=AS_OF)
    got = {(r.variation, r.reporting_date, r.metric_name): (r.n, r.x, r.variance) for r in user_totals.user_total_stats(exposed, log, METRICS, TEST, AS_OF).collect()}
    want = expected(views, logs, events, METRICS)
    assert got.keys() == want.keys() and len({k[2] for k in got}) == 4
    for key, (n, total, var) in want.items():
        assert got[key][0] == n and math.isclose(got[key][1], total, rel_tol=1e-9, abs_tol=1e-6)
        assert (got[key][2] is None) == (var is None) and (var is None or math.isclose(got[key][2], var, rel_tol=1e-9, abs_tol=1e-9))


def test_results_compare_with_control(spark):
    views, logs, _ = experiment_logs()
    events = amounts()
    rows = user_totals.ab_user_total_results(*frames(spark, views, logs, events), METRICS, TEST, AS_OF).collect()
    stats = expected(views, logs, events, METRICS)
    assert rows and tuple(rows[0].asDict()) == experiments.RESULT_COLUMNS
    for r in rows:
        n, x, var = stats[r.variation, r.reporting_date, r.metric_name]
        n_con, x_con, var_con = stats["control", r.reporting_date, r.metric_name]
        assert (r.n_tre, r.n_con) == (n, n_con)
        assert math.isclose(r.metric_normalized_tre - r.metric_normalized_con, x / n - x_con / n_con, rel_tol=1e-9, abs_tol=1e-9)


def test_exposure_day_is_split_at_the_exposure(spark):
    day = datetime(2021, 1, 3)
    views = [("u", "s", day.replace(hour=12), "/")]
    logs = [("s", day.replace(hour=1), "t", "a"), ("s", day.replace(hour=1), "t", "control")]
    events = [("u", day.replace(hour=h), "D", float(h)) for h in (11, 12, 13)] + [("u", day + timedelta(days=1), "D", 100.0)]
    pageviews, assigned, log = frames(spark, views, logs, events)
    rows = user_totals.ab_user_total_results(pageviews, assigned, log, METRICS[:2], TEST, AS_OF).orderBy("reporting_date").collect()
    sums = [(r.reporting_date.day, r.metric_total_tre) for r in rows if r.metric_name == "D Sum per User"]
    counts = [(r.reporting_date.day, r.metric_total_tre) for r in rows if r.metric_name == "D Count per User"]
    assert sums == [(3, 25.0), (4, 125.0), (5, 125.0)] and counts == [(3, 2.0), (4, 3.0), (5, 3.0)]


def test_no_events_and_no_users(spark):
    views, logs, _ = experiment_logs()
    pageviews, assigned, log = frames(spark, views, logs, amounts())
    none = user_totals.ab_user_total_results(pageviews, assigned, log.limit(0), METRICS, TEST, AS_OF).collect()
    assert none and {(r.metric_total_tre, r.variance_con) for r in none} == {(0.0, 0.0)}
    assert user_totals.ab_user_total_results(pageviews.limit(0), assigned, log, METRICS, TEST, AS_OF).collect() == []


def test_each_log_is_read_once_and_users_are_not_expanded(spark):
    results = derive.Logs(spark, DATA).total_results("Sum")
    results.collect()
    plan = results._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    # Page views, variant log and metric log; the exposed users are computed once and reused.
    assert final.count("FileScan") == 3 and "ReusedExchange" in final


def test_dominant_user_is_split_over_tasks(spark):
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
        events = spark.range(0, 90000, 1, 8).selectExpr(
            "if(id % 3 = 0, 'hot', string(id % 500)) as user_id",
            "timestamp_ntz'2021-01-03 00:00:00' + make_dt_interval(0, 0, 0, id) as metric_time",
            "'D' as metric_event_name", "double(id % 7) as metric_value",
        )
        exposed = spark.range(0, 501).selectExpr(
            "if(id = 500, 'hot', string(id)) as user_id", "'t' as testname", "'a' as variation", "timestamp_ntz'2021-01-02 00:00:00' as first_exposure_time"
        ).groupBy("user_id", "testname", "variation").agg({"first_exposure_time": "min"}).withColumnRenamed("min(first_exposure_time)", "first_exposure_time")
        days = user_totals.user_day_amounts(exposed, events, TEST, METRICS[1:2])
        rows = days.collect()
        assert sum(r.today for r in rows if r.user_id == "hot") == 30000
        assert "skew=true" in days._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("identities", [("user_id",), ("user_id", "session_id"), ("session_id",)])
def test_exposure_by_identities(spark, identities):
    views, logs, _ = experiment_logs()
    rng = random.Random(2)
    logs = [(None if rng.random() < 0.1 else s, None if rng.random() < 0.2 else f"u{rng.randrange(60)}" if rng.random() < 0.7 else "bot", t, n, v) for s, t, n, v in logs]
    want = {}
    for user, session, t, path in views:
        for s, u, logged, name, variation in logs:
            same = ("user_id" in identities and u is not None and u == user) or ("session_id" in identities and s is not None and s == session)
            if same and name == "t" and TEST.start <= logged.date() <= TEST.end and logged <= t and path in TEST.exposure_paths:
                want[user, variation] = min(t, want.get((user, variation), t))
    pageviews = spark.createDataFrame(views, "user_id string, session_id string, time timestamp_ntz, path string").repartition(4)
    assigned = spark.createDataFrame(logs, "session_id string, user_id string, time timestamp_ntz, testname string, variation string")
    exposed = experiments.exposed_by_identity(pageviews, assigned, TEST, identities)
    assert {(r.user_id, r.variation): r.first_exposure_time for r in exposed.collect()} == want and want
    if identities == ("session_id",):
        by_session = experiments.exposed_users(pageviews, experiments.first_variant_logs(assigned.filter("session_id is not null"), TEST), TEST)
        assert sorted(map(str, by_session.collect())) == sorted(map(str, exposed.collect()))
    results = experiments.ab_variant_results(pageviews, assigned, spark.createDataFrame([], "user_id string, metric_time timestamp_ntz, metric_event_name string"), ["D"], TEST, AS_OF, identities=identities)
    assert results.count() > 0


def test_exposure_by_identity_reads_each_log_once(spark):
    for identities in (("user_id",), ("user_id", "session_id")):
        plan = derive.Logs(spark, DATA).exposed_by(*identities)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 2 and plan.count("Join") == 1
