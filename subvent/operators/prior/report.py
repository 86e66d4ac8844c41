"""Held-out comparison of models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subvent.functions.checks import as_double, finite, require, weighted


def holdout_fold(unit: str, k: int = 5, fold: int = 0, seed: int = 0) -> Column:
    """A repeatable 1/k of the units."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(unit)), F.lit(k)) == fold


def holdout_segments(by: str, values: Sequence) -> Column:
    return F.col(by).isin(list(values))


def holdout_from(ts: str, start) -> Column:
    return F.col(ts) >= F.lit(start)


def holdout_range(x: str, lo: float, hi: float) -> Column:
    return F.col(x).between(lo, hi)


def generalization_report(
    df: DataFrame, models: Mapping[str, str], y: str, holdout: Column, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Per model: n, rmse, mae and bias on held-out rows, the training rmse and the gap.

    ``models`` maps a model's name to its prediction column. A row counts for a model when its
    outcome and prediction are finite numbers and ``holdout`` is not NULL; the rest is in ``n_dropped``.
    All models are scored in one pass of conditional sums. A row with a ``weight`` counts as that many rows, also in ``n``; one without a
    positive weight is left out, and is one row of ``n_dropped``.
    """
    by = list(by)
    require(df, by, [y, *models.values()] + ([weight] if weight else []))
    names = list(models)
    gaps = [as_double(df, models[m]) - as_double(df, y) for m in names]
    size = as_double(df, weight) if weight else F.lit(1.0)
    errors = df.select(
        *by, holdout.alias("_out"), size.alias("_size"), *[F.when(finite(e) & weighted(weight), e).alias(f"_e{i}") for i, e in enumerate(gaps)]
    )

    def count(e: Column) -> Column:
        return F.coalesce(F.round(F.sum(F.when(e.isNotNull(), F.col("_size")))).cast("bigint"), F.lit(0)) if weight else F.count(e)

    def mean(e: Column) -> Column:
        return F.try_divide(F.sum(F.col("_size") * e), F.sum(F.when(e.isNotNull(), F.col("_size")))) if weight else F.avg(e)

    sums = []
    for i in range(len(names)):
        e = F.col(f"_e{i}")
        out, train = F.when(F.col("_out"), e), F.when(~F.col("_out"), e)
        sums += [
            count(out).alias(f"n{i}"),
            (F.count(F.lit(1)) - F.count(out) - F.count(train)).alias(f"d{i}"),
            F.sqrt(mean(out * out)).alias(f"r{i}"),
            mean(F.abs(out)).alias(f"a{i}"),
            mean(out).alias(f"b{i}"),
            count(train).alias(f"t{i}"),
            F.sqrt(mean(train * train)).alias(f"s{i}"),
        ]
    entries = [
        F.struct(
            F.lit(m).alias("model"),
            F.col(f"n{i}").alias("n"),
            F.col(f"d{i}").alias("n_dropped"),
            F.col(f"r{i}").alias("rmse"),
            F.col(f"a{i}").alias("mae"),
            F.col(f"b{i}").alias("bias"),
            F.col(f"t{i}").alias("n_train"),
            F.col(f"s{i}").alias("rmse_train"),
            (F.col(f"r{i}") - F.col(f"s{i}")).alias("gap"),
        )
        for i, m in enumerate(names)
    ]
    return errors.groupBy(*by).agg(*sums).select(*by, F.inline(F.array(*entries)))
