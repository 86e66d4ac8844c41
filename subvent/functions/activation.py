"""The convex activation and its slope, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def check_power(power: float) -> float:
    if not power > 1:
        raise ValueError(f"power must be above 1 to give a convex function, got {power}")
    return float(power)


def _raise(col: Column, power: float) -> Column:
    # a product stays cheaper than pow() for the default power
    if power == 1:
        return col
    return col * col if power == 2 else F.pow(col, F.lit(power))


def recu(col: Column, power: float = 2) -> Column:
    """``greatest(col, 0) ** power``; NULL stays NULL, which greatest() alone would turn into 0."""
    power = check_power(power)
    col = col.cast("double")
    return F.when(col > 0, _raise(col, power)).when(col.isNotNull(), F.lit(0.0))


def recu_growth(col: Column, step: Column, power: float = 2) -> Column:
    """``recu(col + step) - recu(col)``, exact to the last digits also where the two are large and close."""
    power = check_power(power)
    col, step = col.cast("double"), step.cast("double")
    to = col + step
    if power == 2:
        both = step * (col + to)
    else:
        both = F.pow(col, F.lit(power)) * F.expm1(F.lit(power) * F.log1p(step / col))
    return F.when((col > 0) & (to > 0), both).when((col > 0) & (to <= 0), -recu(col, power)).otherwise(recu(to, power))


def recu_slope(col: Column, power: float = 2) -> Column:
    """Derivative of :func:`recu` in its argument."""
    power = check_power(power)
    col = col.cast("double")
    return F.when(col > 0, F.lit(power) * _raise(col, power - 1)).when(col.isNotNull(), F.lit(0.0))
