"""Normal distribution as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------------------------------------------

# Standard normal quantiles.
Z_975 = 1.959963984540054
Z_POWER = {80: 0.8416212335729143, 90: 1.2815515655446004, 95: 1.6448536269514722}

# Rational approximation of the lower normal tail (Hart 1968, as given by West 2005), highest power first.
TAIL_NUMERATOR = (
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
)
TAIL_DENOMINATOR = (
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)
TAIL_SWITCH = 7.07106781186547
SQRT_TWO_PI = 2.506628274631

# --- End of fixed values ----------------------------------------------------------------------------------------


def _polynomial(z: str, coefficients: Sequence[float]) -> str:
    return reduce(lambda total, c: f"({total} * {z} + {c!r}D)", coefficients[1:], f"{coefficients[0]!r}D")


def lower_tail(z: str) -> str:
    """P(Z <= -z) for z >= 0; exactly 0 beyond 37, where it is below 1e-299."""
    density = f"exp(-{z} * {z} / 2)"
    fraction = reduce(lambda below, k: f"({z} + {k} / {below})", (4, 3, 2, 1), f"({z} + 0.65D)")
    return f"""case
        when {z} > 37 then 0D
        when {z} < {TAIL_SWITCH}D
            then {density} * {_polynomial(z, TAIL_NUMERATOR)} / {_polynomial(z, TAIL_DENOMINATOR)}
        else {density} / {fraction} / {SQRT_TWO_PI}D end"""


def two_sided_p(statistic: str) -> Column:
    """Two-tailed p-value of a z statistic column. NaN stays NaN, infinity gives 0, NULL stays NULL."""
    return F.expr(f"""case
        when isnan({statistic}) then {statistic}
        when {statistic} is not null then 2 * {lower_tail(f"abs({statistic})")} end""")
