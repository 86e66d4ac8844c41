"""Out-of-fold residuals: what is left of z, w and y once the covariates are used."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subvent.functions.checks import as_double, complete, refuse, require, weighted
from subvent.operators.causal.bins import learn_bins_and
from subvent.operators.causal.draws import Draws
from subvent.operators.causal.regression import grow
from subvent.plans.lookup import BROADCAST_ROWS, attach
from subvent.sources.staging import scratch, stage


def cross_fit_residuals(
    panel: DataFrame,
    cols: Sequence[str],
    x: Sequence[str],
    k: int = 5,
    method: str = "cell_mean",
    unit: str = "unit_id",
    fold: Column | None = None,
    seed: int = 0,
    n_bins: int = 32,
    trees: int = 20,
    depth: int = 5,
    broadcast_rows: int = BROADCAST_ROWS,
    weight: str | None = None,
    edges: Mapping[str, Sequence[float]] | None = None,
    draws: Draws | None = None,
    min_leaf: int = 1,
) -> DataFrame:
    """``panel`` with ``fold`` and one ``<col>_res`` per column.

    ``cell_mean`` predicts by the mean of the other folds in the same covariate cell; ``rf`` by the mean of ``trees`` regression trees per
    fold, grown on the other folds. A tree sees the units it drew (half of them, or as ``draws`` say), predicts all ``cols``, and splits where their
    variances, each as a share of the column's own, fall most, with ``min_leaf`` rows on either side. A row without a unit, or with a NULL, NaN or infinity
    in ``cols``, takes part in no mean and gets NULL, as does a row whose cell (for ``rf``: whose fold's
    trees) has no row in another fold, and one of a fold that is not 0 to ``k`` - 1 for ``rf``. A row with
    a ``weight`` counts as that many rows; one without a positive weight takes no part.
    """
    if k < 2:
        raise ValueError("k must be at least 2")
    require(panel, [unit, *x], [*cols, *([weight] if weight else [])])
    refuse(panel, ["fold", *[f"{c}_res" for c in cols]])
    if fold is None:
        fold = F.pmod(F.xxhash64(F.lit(seed), F.col(unit)), F.lit(k))
    rows = panel.withColumn("fold", F.when(F.col(unit).isNotNull(), fold.cast("int")))
    if method == "cell_mean":
        return _cell_means(rows, list(cols), list(x), broadcast_rows, weight)
    if method == "rf":
        return _forests(rows, list(cols), list(x), k, n_bins, edges, draws or Draws(trees, seed=seed), depth, min_leaf, unit, weight)
    raise ValueError(f"method must be 'cell_mean' or 'rf', not '{method}'")


def _cell_means(rows: DataFrame, cols: list[str], x: list[str], broadcast_rows: int, weight: str | None) -> DataFrame:
    ok = complete(cols) & F.col("fold").isNotNull() & weighted(weight)
    own = F.lit(1.0) if weight is None else as_double(rows, weight)
    sums = rows.groupBy(*x, "fold").agg(
        F.count(F.lit(1)).alias("_rows"),
        (F.count(F.when(ok, 1)) if weight is None else F.coalesce(F.sum(F.when(ok, own)), F.lit(0.0))).alias("_n"),
        *[F.coalesce(F.sum(F.when(ok, as_double(rows, c) * own)), F.lit(0.0)).alias(f"_s_{c}") for c in cols],
    )
    cell = Window.partitionBy(*x)
    others = F.sum("_n").over(cell) - F.col("_n")
    means = sums.select(
        *x,
        "fold",
        "_rows",
        *[F.try_divide(F.sum(f"_s_{c}").over(cell) - F.col(f"_s_{c}"), others).alias(f"_m_{c}") for c in cols],
    )
    attached = attach(rows, stage(means, "cell_means"), [*x, "fold"], "_rows", broadcast_rows)
    return attached.select(
        *rows.columns,
        *[F.when(ok, as_double(rows, c) - F.col(f"_m_{c}")).alias(f"{c}_res") for c in cols],
    )


def _forests(
    rows: DataFrame,
    cols: list[str],
    x: list[str],
    k: int,
    n_bins: int,
    edges: Mapping[str, Sequence[float]] | None,
    draws: Draws,
    depth: int,
    min_leaf: int,
    unit: str,
    weight: str | None,
) -> DataFrame:
    if depth < 1 or min_leaf < 1 or not x:
        raise ValueError("forests need a covariate, and depth and min_leaf of at least 1")
    ok = complete(cols) & F.col("fold").isNotNull() & weighted(weight)
    own = F.lit(1.0) if weight is None else as_double(rows, weight)
    sums = [F.sum(F.when(ok, own)), *[F.sum(F.when(ok, as_double(rows, c) * own)) for c in cols]]
    bins, (n, *totals) = learn_bins_and(rows, x, n_bins, edges, sums)
    means = [total / n if n else 0.0 for total in totals]
    with scratch(rows.sparkSession):
        compact = stage(
            rows.filter(ok).select(
                bins.packed().alias("bins"),
                draws.packed(F.col(unit)).alias("words"),
                "fold",
                own.alias("weight"),
                F.array(*[as_double(rows, c) - m for c, m in zip(cols, means)]).alias("values"),
            ),
            "rf_rows",
            spread=True,
        )
        squares = [F.sum(F.col("weight") * F.get("values", F.lit(i)) ** 2) for i in range(len(cols))]
        variances = [(s or 0.0) / (n or 1.0) for s in compact.agg(*[s.alias(f"s{i}") for i, s in enumerate(squares)]).first()]
        forest = grow(compact, [f.n_bins() for f in bins.features], variances, k, draws.trees, depth, min_leaf)
    guessed = rows.withColumn("_guess", forest.predictor()(bins.packed(), F.col("fold")))
    guess = [F.get("_guess", F.lit(i)) + m for i, m in enumerate(means)]
    return guessed.select(*rows.columns, *[F.when(ok, as_double(rows, c) - g).alias(f"{c}_res") for c, g in zip(cols, guess)])
