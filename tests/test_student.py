"""Student's t distribution against numeric integration and closed forms, and Welch's test on top of it."""

import math
from datetime import date
from statistics import NormalDist

import numpy as np
import pytest

from footfall.functions import student
from footfall.operators import inference

DEGREES = (1.0, 1.5, 2.0, 3.0, 4.7, 10.0, 30.0, 99.5, 999.0, 1000.0, 1001.0, 12_345.6, 1e5, 1e6)
STATISTICS = (0.0, 1e-6, 0.01, 0.3, 1.0, 1.7, 2.0, 3.5, 6.0, 15.0, 60.0)


def tail_by_integration(t, n):
    """1 - the integral of cos^(n-1) from 0 to atan(t / sqrt(n)), over that from 0 to pi / 2 (Gauss-Legendre, 400 pieces)."""
    x, w = np.polynomial.legendre.leggauss(30)

    def area(end):
        edges = np.linspace(0.0, end, 401)
        half, middle = np.diff(edges) / 2, (edges[1:] + edges[:-1]) / 2
        points = middle[:, None] + half[:, None] * x
        return float((np.exp((n - 1) * np.log(np.cos(points))) * w).sum(1) @ half)

    whole = min(math.pi / 2 - 1e-15, 40 / math.sqrt(n))
    return 1 - area(math.atan(t / math.sqrt(n))) / area(whole)


def test_p_values(spark):
    rows = [(t, n) for t in STATISTICS for n in DEGREES]
    df = spark.createDataFrame(rows, "t double, n double").select("t", "n", student.two_sided_p("t", "n").alias("p"))
    for r in df.collect():
        assert abs(r.p - tail_by_integration(r.t, r.n)) < 1e-9
        if r.n == 1:
            assert math.isclose(r.p, 1 - 2 / math.pi * math.atan(r.t), abs_tol=1e-11)
        if r.n == 2:
            assert math.isclose(r.p, 1 - r.t / math.sqrt(2 + r.t**2), abs_tol=1e-11)


def test_far_tails_keep_their_digits(spark):
    df = spark.createDataFrame([(1e6, 1.0), (1e4, 2.0), (50.0, 40.0)], "t double, n double")
    far = [r.p for r in df.select(student.two_sided_p("t", "n").alias("p")).collect()]
    assert math.isclose(far[0], 2 / math.pi * 1e-6, rel_tol=1e-9) and math.isclose(far[1], 1 / 1e8, rel_tol=1e-6)
    assert 0 < far[2] < 1e-30


def test_special_values(spark):
    rows = [(float("nan"), 3.0), (math.inf, 3.0), (-math.inf, None), (None, 3.0), (1.0, None), (-1.0, 1.0)]
    got = [r.p for r in spark.createDataFrame(rows, "t double, n double").select(student.two_sided_p("t", "n").alias("p")).collect()]
    assert math.isnan(got[0]) and got[1:5] == [0.0, 0.0, None, None] and math.isclose(got[5], 0.5, abs_tol=1e-11)


def test_quantiles_round_trip(spark):
    wanted = [(p, NormalDist().inv_cdf(p)) for p in (0.975, 0.8, 0.9, 0.95, 0.9995)]
    df = spark.createDataFrame([(n,) for n in DEGREES], "n double").select("n", student.quantiles(wanted, "n").alias("q"))
    back = df.selectExpr("n", "posexplode(q) as (i, t)").select("n", "i", "t", student.two_sided_p("t", "n").alias("p"))
    rows = back.collect()
    assert len(rows) == len(DEGREES) * len(wanted)
    for r in rows:
        assert math.isclose(r.p, 2 * (1 - wanted[r.i][0]), rel_tol=1e-9)
        assert math.isclose(tail_by_integration(r.t, r.n), r.p, abs_tol=1e-9)
        assert r.t >= wanted[r.i][1]
    known = {(r.n, r.i): r.t for r in rows}
    assert math.isclose(known[1.0, 0], 12.706204736432095, rel_tol=1e-10)
    assert math.isclose(known[10.0, 0], 2.2281388519649385, rel_tol=1e-10)


RESULTS = (
    "testname string, variation string, control_description string, reporting_date date, metric_name string, "
    "n_tre bigint, n_con bigint, metric_total_tre double, metric_total_con double, metric_normalized_tre double, "
    "metric_normalized_con double, variance_tre double, variance_con double, diff double, diff_pct double"
)


def result(var_tre, var_con, diff, n_tre=10, n_con=20):
    return ("t", "a", "control", date(2021, 1, 2), "D Sum per User", n_tre, n_con, 1.0, 1.0, 0.1, 0.05, var_tre, var_con, diff, 0.5)


def test_welch(spark):
    (r,) = inference.ab_t_inference(spark.createDataFrame([result(4.0, 9.0, 1.5)], RESULTS)).collect()
    a, b = 4.0 / 10, 9.0 / 20
    df = (a + b) ** 2 / (a**2 / 9 + b**2 / 19)
    assert math.isclose(r.degrees_of_freedom, df) and math.isclose(r.standard_error, math.sqrt(a + b))
    assert math.isclose(r.p_value, tail_by_integration(1.5 / math.sqrt(a + b), df), abs_tol=1e-10)
    margin = r.margin_of_error / r.standard_error
    assert math.isclose(tail_by_integration(margin, df), 0.05, abs_tol=1e-10)
    assert math.isclose(r.confidence_interval_upper - r.confidence_interval_lower, 2 * r.margin_of_error)
    for power in (80, 90, 95):
        rest = r[f"mde_{power}"] / r.standard_error - margin
        assert math.isclose(tail_by_integration(rest, df), 2 * (1 - power / 100), abs_tol=1e-9)


def test_t_comes_close_to_z_for_large_samples(spark):
    rows = spark.createDataFrame([result(4.0, 9.0, 0.004, 5_000_000, 4_000_000)], RESULTS)
    t, z = inference.ab_t_inference(rows).first(), inference.ab_variant_inference(rows).first()
    for column in ("p_value", "margin_of_error", "mde_80", "mde_95"):
        assert math.isclose(t[column], z[column], rel_tol=1e-5)
    assert t.p_value > z.p_value


@pytest.mark.parametrize(
    ("row", "statistic", "p", "margin"),
    [
        (result(0.0, 0.0, 0.0), math.nan, math.nan, 0.0),
        (result(0.0, 0.0, 0.5), math.inf, 0.0, 0.0),
        (result(0.0, 0.0, -0.5), -math.inf, 0.0, 0.0),
        (result(None, 0.1, 0.1, 1), None, None, None),
        (result(0.2, 0.1, 0.1, 0), None, None, None),
    ],
)
def test_degenerate_results(spark, row, statistic, p, margin):
    (r,) = inference.ab_t_inference(spark.createDataFrame([row], RESULTS)).collect()
    same = lambda a, b: a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))
    assert same(r.test_statistic, statistic) and same(r.p_value, p) and same(r.margin_of_error, margin) and r.degrees_of_freedom is None
    assert same(r.mde_90, margin)


def test_one_arm_without_variance_has_the_degrees_of_the_other(spark):
    (r,) = inference.ab_t_inference(spark.createDataFrame([result(0.0, 0.3, 0.1)], RESULTS)).collect()
    assert math.isclose(r.degrees_of_freedom, 19.0)
