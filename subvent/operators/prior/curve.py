"""Curves fitted to data and to prior assumptions at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subvent.functions.checks import require, weighted
from subvent.operators.prior.priors import Prior, _per_prior, check_priors
from subvent.operators.shape.basis import CurveBasis
from subvent.operators.shape.curve import ShapeCurves, solve_curves
from subvent.operators.shape.gram import COUNTS, gram
from subvent.operators.shape.solve import Penalties, solve_penalised, unpack
from subvent.sources.staging import stage


def prior_rows(points: DataFrame, x: str, basis: CurveBasis, priors: Sequence[Prior]) -> DataFrame:
    """The assumptions as regression rows: one column ``term_i`` per term, and ``target``."""
    at = F.col(x).cast("double")

    def columns(p: Prior) -> list[Column]:
        terms_at = {float(o): basis.terms(at + F.lit(float(o))) for o, _ in p.stencil}
        terms = [p.combine(lambda o, i=i: terms_at[o][i]) for i in range(basis.size)]
        return [
            *[t.alias(f"term_{i}") for i, t in enumerate(terms)],
            F.lit(float(p.target)).alias("target"),
            F.lit(float(p.weight)).alias("prior_weight"),
            F.lit(p.relation).alias("relation"),
        ]

    return _per_prior(points, x, priors, columns)


def combined_gram(
    data_gram: DataFrame, rows: DataFrame, by: Sequence[str], basis: CurveBasis, lam: float, active: Column | None = None
) -> DataFrame:
    """Mean cross products of the data plus ``lam`` times the mean of each prior's.

    ``data_gram`` is a Gram table per row. ``active`` marks the rows that count; the mean is still over all of a prior's points.
    """
    by = list(by)
    terms = [f"term_{i}" for i in range(basis.size)]
    weight = F.col("prior_weight") if active is None else F.when(active, F.col("prior_weight")).otherwise(0.0)
    priors = gram(rows, terms, "target", [*by, "prior"], weight, per_row=True).filter(F.col("i") != COUNTS)
    priors = priors.select(*by, "i", "j", (F.col("value") * float(lam)).alias("value"))
    return data_gram.unionByName(priors).groupBy(*by, "i", "j").agg(F.sum("value").alias("value"))


def _weighted_means(sums: DataFrame, by: list[str]) -> DataFrame:
    """A Gram table with its products divided by the sum of the weights: that of the first term, which is 1, with itself."""
    size = F.max(F.when((F.col("i") == 0) & (F.col("j") == 0), F.col("value"))).over(Window.partitionBy(*by))
    mean = F.when(F.col("i") == COUNTS, F.col("value")).otherwise(F.coalesce(F.try_divide(F.col("value"), size), F.lit(0.0)))
    return sums.withColumn("value", mean)


def prior_curve_fit(
    df: DataFrame,
    x: str,
    y: str,
    by: Sequence[str],
    knots: Sequence[float],
    priors: Sequence[Prior],
    lam: float,
    points: DataFrame,
    power: float = 2,
    shape: str = "free",
    weight: str | None = None,
) -> ShapeCurves:
    """Minimise mean squared error plus ``lam`` times the mean squared residual of each prior.

    A row with a ``weight`` counts as that many rows of the mean; one without a positive weight is left out.

    The data are read once, into a Gram table. Each segment is then solved on its own from its sums and points: once
    with equalities alone, over the set of points in breach with inequalities. A segment whose set does not settle has
    the status ``not_converged`` and the best curve found; the others do not notice.
    """
    by = list(by)
    if not by:
        raise ValueError("give at least one segment column; add a constant one for a single curve")
    check_priors(priors)
    require(df, by, [x, y] + ([weight] if weight else []))
    require(points, [*by, "point_id"], [x, "lo", "hi"])
    if lam < 0:
        raise ValueError("lam must not be negative")
    basis = CurveBasis(tuple(float(t) for t in knots), power, shape)
    at = basis.terms(F.col(x).cast("double"))
    data = _weighted_means(gram(df, at, y, by, F.when(weighted(weight), F.col(weight))), by) if weight else gram(df, at, y, by, per_row=True)
    rows = prior_rows(points.select(*by, "point_id", x, "lo", "hi"), x, basis, priors)
    if all(p.relation == "=" for p in priors):
        return _solve(combined_gram(data, rows, by, basis, lam), by, basis, x)
    return ShapeCurves(stage(_solve_with_inequalities(data, rows, by, basis, lam), "curves"), basis, x, tuple(by))


def _solve_with_inequalities(data: DataFrame, rows: DataFrame, by: list[str], basis: CurveBasis, lam: float) -> DataFrame:
    """One row per segment, from its Gram rows and its own points; a segment that does not settle says so in its status."""
    k, signs = basis.size, basis.signs
    terms = [f"term_{i}" for i in range(k)]
    sides = {"=": 0, ">=": 1, "<=": -1}
    fields = [data.schema[c] for c in by] + [
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("n", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]

    def solve(sums: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        g, b, yy, n, dropped = unpack(sums, k) if len(sums) else (None, None, 0.0, 0, 0)
        some = sums if len(sums) else points
        out = some.loc[some.index[:1], by].reset_index(drop=True)
        if n == 0:
            coef, loss, status = None, None, "no_rows"
        else:
            values = points[[*terms, "target", "prior_weight"]].to_numpy(dtype=float)
            points = points[np.isfinite(values).all(axis=1)]
            size = points.groupby("prior")["target"].transform("size").to_numpy(dtype=float)
            penalties = Penalties(
                points[terms].to_numpy(dtype=float),
                points["target"].to_numpy(dtype=float),
                lam * points["prior_weight"].to_numpy(dtype=float) / size,
                points["relation"].map(sides).to_numpy(dtype=int),
            )
            c, done = solve_penalised(g, b, signs, penalties)
            active = penalties.active(c)
            miss = (penalties.terms @ c - penalties.target)[active]
            loss = max(float(yy - 2 * b @ c + c @ g @ c), 0.0) + float((penalties.weight[active] * miss * miss).sum())
            coef, status = c.tolist(), "not_converged" if not done else "few_rows" if n < k else "ok"
        out["coef"] = [coef]
        out["n"], out["n_dropped"], out["loss"], out["status"] = int(n), int(dropped), loss, status
        return out

    return data.groupBy(*by).cogroup(rows.groupBy(*by)).applyInPandas(solve, T.StructType(fields))


def _solve(grams: DataFrame, by: list[str], basis: CurveBasis, x: str) -> ShapeCurves:
    return ShapeCurves(stage(solve_curves(grams, by, basis, means=True), "curves"), basis, x, tuple(by))
