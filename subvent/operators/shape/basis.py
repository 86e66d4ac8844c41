"""Terms of a curve whose shape depends only on the signs of its coefficients."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subvent.functions.activation import check_power, recu, recu_slope
from subvent.functions.checks import require

# shape -> (terms grow to the left, sign of the slope term, sign of the curved terms); 0 leaves a term free
SHAPES = {
    "free": (False, 0, 0),
    "convex": (False, 0, 1),
    "convex_increasing": (False, 1, 1),
    "convex_decreasing": (True, -1, 1),
    "concave": (True, 0, -1),
    "concave_increasing": (True, 1, -1),
    "concave_decreasing": (False, -1, -1),
}


@dataclass(frozen=True)
class CurveBasis:
    """Terms 1, x and one activation per knot: ``recu(x - t)``, or mirrored ``recu(t - x)``."""

    knots: tuple[float, ...]
    power: float = 2
    shape: str = "free"

    def __post_init__(self):
        check_power(self.power)
        if self.shape not in SHAPES:
            raise ValueError(f"shape must be one of {sorted(SHAPES)}, not '{self.shape}'")

    @property
    def mirrored(self) -> bool:
        return SHAPES[self.shape][0]

    @property
    def size(self) -> int:
        return 2 + len(self.knots)

    @property
    def signs(self) -> list[int]:
        """Required sign per coefficient, 0 for none."""
        _, slope, curve = SHAPES[self.shape]
        return [0, slope] + [curve] * len(self.knots)

    def _reach(self, x: Column, knot: float) -> Column:
        return F.lit(knot) - x if self.mirrored else x - F.lit(knot)

    def terms(self, x: Column) -> list[Column]:
        one = F.when(x.isNotNull(), F.lit(1.0))
        return [one, x, *[recu(self._reach(x, t), self.power) for t in self.knots]]

    def slopes(self, x: Column) -> list[Column]:
        one = F.when(x.isNotNull(), F.lit(1.0))
        turn = -1.0 if self.mirrored else 1.0
        return [one * 0.0, one, *[F.lit(turn) * recu_slope(self._reach(x, t), self.power) for t in self.knots]]

    def value(self, x: Column, coef: Column) -> Column:
        return dot(self.terms(x), coef)

    def slope(self, x: Column, coef: Column) -> Column:
        return dot(self.slopes(x), coef)


def dot(terms: Sequence[Column], coef: Column) -> Column:
    """Sum of the terms times the entries of an array column."""
    total = terms[0] * F.get(coef, F.lit(0))
    for i, term in enumerate(terms[1:], start=1):
        total = total + term * F.get(coef, F.lit(i))
    return total


def recu_basis(df: DataFrame, x: str, knots: Sequence[float], power: float = 2, shape: str = "convex") -> DataFrame:
    """``df`` with one column per term: ``term_0`` (1), ``term_1`` (x), ``term_2`` on (one per knot)."""
    require(df, [], [x])
    basis = CurveBasis(tuple(float(t) for t in knots), power, shape)
    terms = basis.terms(F.col(x).cast("double"))
    return df.select("*", *[t.alias(f"term_{i}") for i, t in enumerate(terms)])
