"""Numeric expressions for information estimates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EULER_GAMMA = 0.57721566490153286061
_SERIES_FROM = 20


def digamma(n: Column) -> Column:
    """Digamma of a positive whole number.

    Below 20 it is the harmonic sum minus Euler's constant; from 20 on the asymptotic
    series, whose first dropped term is below 1e-15 there.
    """
    harmonic = [0.0]
    for i in range(1, _SERIES_FROM):
        harmonic.append(harmonic[-1] + 1.0 / i)
    small = F.array(*[F.lit(h - EULER_GAMMA) for h in harmonic[: _SERIES_FROM - 1]])
    x = n.cast("double")
    inv2 = F.lit(1.0) / (x * x)
    series = (
        F.ln(x)
        - F.lit(0.5) / x
        - inv2
        * (F.lit(1 / 12) - inv2 * (F.lit(1 / 120) - inv2 * (F.lit(1 / 252) - inv2 / F.lit(240.0))))
    )
    return F.when(n < _SERIES_FROM, F.get(small, (n - 1).cast("int"))).otherwise(series)
