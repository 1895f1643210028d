"""Student's t distribution as SQL expressions: two-sided p-values and quantiles, for real degrees of freedom from 1 on.

Up to ``MANY`` degrees of freedom the tail is a regularised incomplete beta function, evaluated by the continued fraction
(modified Lentz steps) on the side where it converges fast; beyond, the statistic is turned into a normal one by Hill's
expansion (1970). Quantiles come from Newton steps on the upper tail: it is convex there, so the steps from the normal
quantile, which never lies beyond, only approach the root. Both loops are ``aggregate`` over a fixed sequence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions.stats import lower_tail

# --- Fixed values -----------------------------------------------------------------------------------------------

# Gamma(a + 1/2) / Gamma(a) = sqrt(a) * series in 1 / a (numerators and denominators from the power 0 on).
GAMMA_RATIO = ((1, 1), (-1, 8), (1, 128), (5, 1024), (-21, 32768), (-399, 262144), (869, 4194304))

# --- End of fixed values ----------------------------------------------------------------------------------------

SHIFT = 16  # the series is used at a + SHIFT
STEPS = 60
NEWTON_STEPS = 12
MANY = 1000


def _gamma_ratio(a: str) -> str:
    """Gamma(a + 1/2) / Gamma(a)."""
    z = f"({a} + {SHIFT})"
    series = "0D"
    for numerator, denominator in reversed(GAMMA_RATIO):
        series = f"({numerator}D / {denominator} + {series} / {z})"
    shifted = " * ".join(f"(({a} + {k}) / ({a} + {k}.5D))" for k in range(SHIFT))
    return f"(sqrt({z}) * {series} * {shifted})"


def _fraction(a: str, b: str, x: str) -> str:
    """Continued fraction of the incomplete beta function: two steps a turn, c and d kept as in Lentz's method."""
    even = f"k * ({b} - k) * {x} / (({a} + 2 * k - 1) * ({a} + 2 * k))"
    odd = f"-({a} + k) * ({a} + {b} + k) * {x} / (({a} + 2 * k) * ({a} + 2 * k + 1))"
    start = f"1 / (1 - ({a} + {b}) * {x} / ({a} + 1))"
    # After the even step: d = 1 / (1 + even * d), c = 1 + even / c, h = h * d * c; then the same with odd.
    step = f"""aggregate(array({even}, {odd}), s, (r, f) -> named_struct(
        'c', 1 + f / r.c, 'd', 1 / (1 + f * r.d), 'h', r.h * (1 + f / r.c) / (1 + f * r.d)))"""
    return f"aggregate(sequence(1, {STEPS}), named_struct('c', 1D, 'd', {start}, 'h', {start}), (s, k) -> {step}).h"


def two_sided_tail(t: str, df: str) -> str:
    """P(|T| >= t) for finite t >= 0."""
    beta = f"""aggregate(array({t} * {t} / {df}), 0D, (unused, q) -> aggregate(
        array({_gamma_ratio(f"({df} / 2)")} / sqrt(pi()) * exp(-{df} / 2 * log1p(q)) * sqrt(q / (1 + q))), 0D, (none, front) -> case
            when 1 / (1 + q) < ({df} / 2 + 1) / ({df} / 2 + 2.5D)
                then front * {_fraction(f"({df} / 2)", "0.5D", "(1 / (1 + q))")} * 2 / {df}
            else 1 - 2 * front * {_fraction("0.5D", f"({df} / 2)", "(q / (1 + q))")} end))"""
    b = f"(48 * ({df} - 0.5D) * ({df} - 0.5D))"
    z = f"""((((((-0.4D * y - 3.3D) * y - 24) * y - 85.5D) / (0.8D * y * y + 100 + {b}) + y + 3) / {b} + 1) * sqrt(y))"""
    normal = f"""aggregate(array(({df} - 0.5D) * log1p({t} * {t} / {df})), 0D, (unused, y) ->
        aggregate(array({z}), 0D, (none, z) -> 2 * {lower_tail("z")}))"""
    return f"case when {t} = 0 then 1D when {df} > {MANY} then {normal} else {beta} end"


def _density(t: str, df: str) -> str:
    return f"({_gamma_ratio(f'({df} / 2)')} / sqrt({df} * pi()) * exp(-({df} + 1) / 2 * log1p({t} * {t} / {df})))"


def two_sided_p(statistic: str, df: str) -> Column:
    """Two-tailed p-value. NaN stays NaN, infinity gives 0; NULL where the statistic or the degrees are missing."""
    return F.expr(f"""case
        when isnan({statistic}) then {statistic}
        when abs({statistic}) = double('Infinity') then 0D
        when {statistic} is not null and {df} is not null then {two_sided_tail(f"abs({statistic})", df)} end""")


def quantiles(probabilities: Sequence[tuple[float, float]], df: str) -> Column:
    """Array of the quantiles of upper probabilities (above one half); each comes with its normal quantile.

    One expression for all of them: the loop takes the normal quantile and the tail as data.
    """
    tail = two_sided_tail("u", df)
    step = f"u + ({tail} / 2 - g.tail) / {_density('u', df)}"
    wanted = ", ".join(f"named_struct('normal', {normal!r}D, 'tail', {1 - p!r}D)" for p, normal in probabilities)
    return F.expr(f"""case when {df} is not null then transform(array({wanted}), g ->
        aggregate(sequence(1, {NEWTON_STEPS}), g.normal, (u, turn) -> {step})) end""")
