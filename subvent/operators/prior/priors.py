"""Prior business assumptions as linear statements about a fitted function."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subvent.functions.checks import require

RELATIONS = ("=", ">=", "<=")


@dataclass(frozen=True)
class Prior:
    """``sum(coef * f(x + offset)) <relation> target``, with a weight of its own."""

    name: str
    stencil: tuple[tuple[float, float], ...]
    relation: str = "="
    target: float = 0.0
    weight: float = 1.0

    def __post_init__(self):
        if self.relation not in RELATIONS:
            raise ValueError(f"relation must be one of {RELATIONS}, not '{self.relation}'")
        if not self.stencil:
            raise ValueError("a prior needs at least one stencil point")

    def combine(self, at: Callable[[float], Column]) -> Column:
        """The left side, given the function's value at an offset."""
        return reduce(lambda a, b: a + b, [F.lit(float(coef)) * at(float(offset)) for offset, coef in self.stencil])

    def breach(self, value: Column) -> Column:
        """Amount by which the left side misses the target; 0 where an inequality holds."""
        miss = value - F.lit(float(self.target))
        if self.relation == "=":
            return miss
        zero = F.when(miss.isNotNull(), F.lit(0.0))
        return F.when((miss < 0) if self.relation == ">=" else (miss > 0), miss).otherwise(zero)

    def inside(self, x: Column, lo: Column, hi: Column) -> Column:
        """True when every stencil point lies in ``[lo, hi]``, up to rounding."""
        slack = F.lit(1e-9) * (hi - lo)
        first, last = min(o for o, _ in self.stencil), max(o for o, _ in self.stencil)
        return (x + F.lit(float(first)) >= lo - slack) & (x + F.lit(float(last)) <= hi + slack)


def increasing(h: float, name: str = "increasing", weight: float = 1.0) -> Prior:
    return Prior(name, ((h, 1.0), (0.0, -1.0)), ">=", 0.0, weight)


def convex(h: float, name: str = "convex", weight: float = 1.0) -> Prior:
    return Prior(name, ((h, 1.0), (0.0, -2.0), (-h, 1.0)), ">=", 0.0, weight)


def upper_bound(hi: float, name: str = "upper_bound", weight: float = 1.0) -> Prior:
    return Prior(name, ((0.0, 1.0),), "<=", hi, weight)


def lower_bound(lo: float, name: str = "lower_bound", weight: float = 1.0) -> Prior:
    return Prior(name, ((0.0, 1.0),), ">=", lo, weight)


def third_difference(h: float, name: str = "third_difference", weight: float = 1.0) -> Prior:
    """The curve bends at a constant rate."""
    return Prior(name, ((3 * h, 1.0), (2 * h, -3.0), (h, 3.0), (0.0, -1.0)), "=", 0.0, weight)


def collocation_points(
    df: DataFrame,
    x: str,
    by: Sequence[str] = (),
    n: int = 41,
    lo: float | None = None,
    hi: float | None = None,
) -> DataFrame:
    """``n`` even points per segment between ``lo`` and ``hi`` (by default the observed range of x).

    Returns by..., ``point_id``, x, ``lo`` and ``hi``. Nothing here is observed data; the range may
    reach past it.
    """
    by = list(by)
    require(df, by, [x])
    if n < 2:
        raise ValueError("n must be at least 2")
    if lo is not None and hi is not None:
        ends = df.select(*by).distinct() if by else df.limit(1).select()
        ends = ends.select(*by, F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"))
    else:
        low = F.min(F.col(x).cast("double")) if lo is None else F.lit(float(lo))
        high = F.max(F.col(x).cast("double")) if hi is None else F.lit(float(hi))
        ends = df.groupBy(*by).agg(low.alias("lo"), high.alias("hi")).filter("lo IS NOT NULL AND hi IS NOT NULL")
    at = F.col("lo") + F.col("point_id") * ((F.col("hi") - F.col("lo")) / (n - 1))
    return ends.withColumn("point_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(
        *by, "point_id", at.alias(x), "lo", "hi"
    )


def _per_prior(points: DataFrame, x: str, priors: Sequence[Prior], make: Callable[[Prior], list[Column]]) -> DataFrame:
    """One row per (point, prior) whose stencil stays inside the point's range."""
    at = F.col(x).cast("double")
    parts = [
        points.filter(p.inside(at, F.col("lo"), F.col("hi"))).select("*", F.lit(p.name).alias("prior"), *make(p))
        for p in priors
    ]
    return reduce(DataFrame.unionByName, parts)


def check_priors(priors: Sequence[Prior]) -> None:
    names = [p.name for p in priors]
    if not names or len(set(names)) < len(names):
        raise ValueError("give at least one prior, each with a name of its own")


def prior_residuals(
    points: DataFrame, predict: Callable[[Column], Column], priors: Sequence[Prior], x: str = "x"
) -> DataFrame:
    """Left side and residual of each assumption at each point, without a shuffle.

    ``predict(x)`` gives the fitted function as a column, from columns already on ``points``
    (see ``ShapeCurves.attach_to`` and ``RecuNet.value``). A point whose stencil leaves ``[lo, hi]``
    has no residual for that prior.
    """
    check_priors(priors)
    require(points, [], [x, "lo", "hi"])
    at = F.col(x).cast("double")

    def columns(p: Prior) -> list[Column]:
        value = p.combine(lambda offset: predict(at + offset))
        return [value.alias("value"), p.breach(value).alias("residual")]

    return _per_prior(points, x, priors, columns)
