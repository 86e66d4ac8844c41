"""A net fitted to data and to prior assumptions, starting from existing weights."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subvent.functions.checks import require
from subvent.operators.prior.priors import Prior, check_priors
from subvent.operators.shape.net import RecuNet, Stencils, descend, first_weights, scaled_rows
from subvent.operators.shape.nets import RecuNets, fit_segments
from subvent.sources.staging import stage


def _scaled_points(
    points: DataFrame, priors: Sequence[Prior], x_shape: str, x_free: str | None, scales: Sequence[float], lam: float
) -> tuple[DataFrame, Stencils]:
    """The points as rows of the normal equations: each prior weighs ``lam * weight`` in all."""
    s_low, s_width, t_low, t_width, y_mean, y_sd = scales
    s = F.col(x_shape).cast("double")
    t = F.col(x_free).cast("double") if x_free else F.lit(0.0)
    parts = [
        points.filter(p.inside(s, F.col("lo"), F.col("hi"))).select(
            F.lit(i).alias("kind"), ((s - s_low) / s_width).alias("s"), ((t - t_low) / t_width).alias("t")
        )
        for i, p in enumerate(priors)
    ]
    rows = stage(reduce(DataFrame.unionByName, parts), "net_points")
    counts = dict(rows.groupBy("kind").count().collect())
    weight = F.lit(0.0)
    for i, p in enumerate(priors):
        weight = F.when(F.col("kind") == i, float(lam) * p.weight / counts.get(i, 1)).otherwise(weight)
    rows = rows.select(
        "kind", "s", "t", weight.alias("weight"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q")
    )
    stencils = Stencils(
        tuple(tuple(o / s_width for o, _ in p.stencil) for p in priors),
        tuple(tuple(c for _, c in p.stencil) for p in priors),
        tuple(p.relation for p in priors),
        # a constant cancels when the coefficients sum to zero; otherwise the target moves with y's mean
        tuple((p.target - y_mean * sum(c for _, c in p.stencil)) / y_sd for p in priors),
    )
    return rows, stencils


def prior_net_fit(
    df: DataFrame,
    points: DataFrame,
    x_shape: str,
    x_free: str | None,
    y: str,
    priors: Sequence[Prior],
    lam: float,
    init: RecuNet | RecuNets | None = None,
    hidden: int = 8,
    power: float = 2,
    iters: int = 30,
    seed: int = 0,
    by: Sequence[str] = (),
    weight: str | None = None,
) -> RecuNet | RecuNets:
    """Mean squared error plus ``lam`` times the mean squared residual of each prior.

    ``points`` are unlabelled (see ``collocation_points``) and carry ``lo`` and ``hi``. ``init`` is the
    existing model; its weights, power and scales are kept as the start. Data and points are
    summed in the same pass. With ``by``, which the points carry too, there is a net per segment (see ``recu_net_fit``), and a prior's mean
    is over its segment's points. A row with a ``weight`` counts as that many rows.
    """
    check_priors(priors)
    require(points, [], [x_shape, *([x_free] if x_free else []), "lo", "hi"])
    if lam < 0:
        raise ValueError("lam must not be negative")
    if by:
        return fit_segments(df, x_shape, x_free, y, by, hidden, power, iters, init, seed, weight, points, priors, lam)
    rows, scales, n, dropped = scaled_rows(df, x_shape, x_free, y, init, weight)
    power = init.power if init else float(power)
    at_points, stencils = _scaled_points(points, priors, x_shape, x_free, scales, lam)
    theta = np.asarray(init.theta) if init else first_weights(hidden, seed, x_free is not None)
    theta, loss, passes, status = descend(rows.unionByName(at_points), theta, power, iters, stencils)
    return RecuNet(
        tuple(theta.tolist()), power, x_shape, x_free, tuple(scales), n, dropped, loss * scales[5] ** 2, passes, status
    )
