"""Two-tailed tests for the difference between treatment and control: z, and Welch's t for small samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import student
from footfall.functions.stats import Z_975, Z_POWER, two_sided_p

SHARE = "if(n_{0} = 0, variance_{0} * double('Infinity'), variance_{0} / n_{0})"
STANDARD_ERROR = f"sqrt({SHARE.format('tre')} + {SHARE.format('con')}) as standard_error"
TEST_STATISTIC = """case
    when standard_error <> 0 then diff / standard_error
    when standard_error = 0 and diff = 0 then double('NaN')
    when standard_error = 0 then sign(diff) * double('Infinity') end as test_statistic"""


def ab_variant_inference(results: DataFrame) -> DataFrame:
    """Add standard error, 95% interval, z statistic, p-value and minimum detectable effects.

    A zero standard error gives what floating point division gives: NaN for no difference, else a
    signed infinity. A NULL variance leaves every statistic NULL. An arm without users divides as floating point does.
    """
    with_error = results.selectExpr("*", STANDARD_ERROR)
    with_statistic = with_error.selectExpr("*", f"{Z_975}D * standard_error as margin_of_error", TEST_STATISTIC)
    return with_statistic.select(
        *results.columns,
        "standard_error",
        "margin_of_error",
        (with_statistic.diff - with_statistic.margin_of_error).alias("confidence_interval_lower"),
        (with_statistic.diff + with_statistic.margin_of_error).alias("confidence_interval_upper"),
        "test_statistic",
        two_sided_p("test_statistic").alias("p_value"),
        *[(with_statistic.standard_error * (Z_975 + z)).alias(f"mde_{power}") for power, z in Z_POWER.items()],
    )


# Of the variance of each arm's mean, with the degrees of freedom that the arm has.
WELCH = """case when standard_error > 0 then
    power(standard_error, 4) / (power(variance_tre / n_tre, 2) / (n_tre - 1) + power(variance_con / n_con, 2) / (n_con - 1))
    end as degrees_of_freedom"""


def ab_t_inference(results: DataFrame) -> DataFrame:
    """The columns of ``ab_variant_inference`` by Welch's t-test, with its ``degrees_of_freedom``.

    Meant for samples that are too small for the normal approximation; the interval and the minimum detectable effects
    use quantiles of the same t distribution as the p-value. Arms without a variance leave every statistic NULL. Without
    a standard error the degrees of freedom are undefined (NULL): the statistic is NaN or infinite, as in the z-test,
    and margin and minimum detectable effects are 0. An arm with at most one user has no test.
    """
    tested = "if(n_tre > 1 and n_con > 1, {0}, null)"
    with_error = results.selectExpr("*", tested.format(STANDARD_ERROR.removesuffix(" as standard_error")) + " as standard_error")
    wanted = [(0.975, Z_975), *((power / 100, z) for power, z in Z_POWER.items())]
    with_statistic = with_error.selectExpr("*", TEST_STATISTIC, WELCH).withColumn(
        "quantiles", student.quantiles(wanted, "degrees_of_freedom")
    )
    times = "if(standard_error = 0, 0D, standard_error * ({0}))"
    with_margin = with_statistic.selectExpr("*", times.format("quantiles[0]") + " as margin_of_error")
    return with_margin.select(
        *results.columns,
        "standard_error",
        "degrees_of_freedom",
        "margin_of_error",
        (with_margin.diff - with_margin.margin_of_error).alias("confidence_interval_lower"),
        (with_margin.diff + with_margin.margin_of_error).alias("confidence_interval_upper"),
        "test_statistic",
        student.two_sided_p("test_statistic", "degrees_of_freedom").alias("p_value"),
        *[
            F.expr(times.format(f"quantiles[0] + quantiles[{i}]")).alias(f"mde_{power}")
            for i, power in enumerate(Z_POWER, start=1)
        ],
    )
