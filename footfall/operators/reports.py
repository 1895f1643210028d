"""Data sets behind the experiment report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.rules import sql_text

SIGNIFICANCE_LEVEL = 0.05

# --- Fixed values: wording of the interpretation -----------------------------------------------------------------
SIGNIFICANT_TEXT = (
    "SIGNIFICANT: The Treatment performed significantly better/worse than the Control.  "
    "We are 95% confident that the size of this effect is between {lower} and {upper}.  "
    "The difference observed was {diff}, or {percent}% more/less than Control."
)
NOT_SIGNIFICANT_TEXT = (
    "NOT SIGNIFICANT: We cannot conclude that the Treatment is better/worse than the Control.  "
    "We are 95% confident that the size of this effect is between {lower} and {upper}.  "
    "This doesn't mean there is NO effect: at this sample size, we only have enough data to detect effect sizes "
    "greater than +/- {mde} (MDE).  In other words, a smaller +/- effect could exist, we just don't see it yet."
)
# --- End of fixed values -----------------------------------------------------------------------------------------

RESULT_KEY = ("testname", "variation", "control_description", "reporting_date", "metric_name")


def with_significance(inference: DataFrame) -> DataFrame:
    """``is_significant`` at 95%, and the colour class of the cumulative table.

    NULL where the test is undefined: no p-value, or NaN because neither arm varies.
    """
    return inference.selectExpr(
        "*",
        f"if(isnan(p_value), null, p_value < {SIGNIFICANCE_LEVEL}D) as is_significant",
        f"""case
            when isnan(p_value) then 'neither'
            when p_value < {SIGNIFICANCE_LEVEL}D and diff > 0 then 'positive'
            when p_value < {SIGNIFICANCE_LEVEL}D and diff < 0 then 'negative'
            else 'neither' end as color_class""",
    )


def plain_number(value: str, places: int) -> str:
    """SQL for a rounded number without exponent or trailing zeros."""
    digits = f"string(cast(round({value}, {places}) as decimal(18, {places})))"
    return f"regexp_replace({digits}, '[.]?0+$', '')"


def _sentence(template: str, values: dict[str, str]) -> str:
    """SQL that fills the template; NULL when a value is NULL."""
    pieces, rest = [], template
    while "{" in rest:
        text, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [sql_text(text), values[name]]
    return f"concat({', '.join([*pieces, sql_text(rest)])})"


def with_interpretation(inference: DataFrame) -> DataFrame:
    """Sentence that explains each result; NULL when significance is unknown.

    The numbers are written once, before the sentence is chosen: both sentences name the interval, and a method that
    formats all numbers twice would outgrow what the JVM compiles.
    """
    four = ("confidence_interval_lower", "confidence_interval_upper", "diff", "mde_80")
    judged = with_significance(inference)
    written = judged.selectExpr(
        "*",
        f"transform(array({', '.join(four)}), number -> {plain_number('number', 4)}) as said_",
        f"{plain_number('diff_pct * 100', 2)} as percent_",
    )
    values = {name: f"said_[{i}]" for i, name in enumerate(("lower", "upper", "diff", "mde"))} | {"percent": "percent_"}
    return written.selectExpr(
        *judged.columns,
        f"""case
            when is_significant then {_sentence(SIGNIFICANT_TEXT, values)}
            when not is_significant then {_sentence(NOT_SIGNIFICANT_TEXT, values)} end as interpretation""",
    )


def report_slice(
    inference: DataFrame, testname: str, reporting_date: date, metrics: Sequence[str] | None = None
) -> DataFrame:
    """Cumulative table of one test as of one date: one row per metric and treatment."""
    rows = inference.filter((F.col("testname") == testname) & (F.col("reporting_date") == F.lit(reporting_date)))
    if metrics is not None:
        rows = rows.filter(F.col("metric_name").isin(*metrics))
    return with_interpretation(rows).select(
        *RESULT_KEY, "p_value", "diff", "diff_pct", "confidence_interval_lower", "confidence_interval_upper", "mde_80",
        "metric_normalized_tre", "metric_normalized_con", "is_significant", "color_class", "interpretation",
    )


def variant_counts(inference: DataFrame) -> DataFrame:
    """Treatments with their exposed users, and the control's beside them."""
    return inference.select("testname", "variation", "control_description", "reporting_date", "n_tre", "n_con").distinct()


def daily_series(inference: DataFrame) -> DataFrame:
    """Daily graphs in long form: p-value, cumulative users and cumulative value of both arms."""
    return inference.selectExpr(
        *RESULT_KEY,
        """stack(5,
            'p_value', p_value,
            'users_treatment', double(n_tre),
            'users_control', double(n_con),
            'value_treatment', metric_normalized_tre,
            'value_control', metric_normalized_con) as (series, value)""",
    )
