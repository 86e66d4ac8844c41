"""Cross products of regression terms per segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subvent.functions.checks import complete, require

# Row (COUNTS, 0) of a Gram table holds the number of rows used, (COUNTS, 1) the number left out.
COUNTS = -1


def gram(
    df: DataFrame,
    terms: Sequence[str | Column],
    y: str | Column,
    by: Sequence[str] = (),
    weight: str | Column | None = None,
    per_row: bool = False,
) -> DataFrame:
    """X'X, X'y, y'y and row counts per segment in long form (by..., i, j, value) with i <= j.

    Index k = len(terms) stands for y. A row with a NULL, NaN or infinite number is left out. One pass; every sum is partial before the shuffle, so
    a segment costs one row per task however many rows it has. ``per_row`` divides the products
    by the number of rows used.
    """
    by = list(by)
    require(df, by)
    k = len(terms)

    def column(c: str | Column) -> Column:
        return (F.col(c) if isinstance(c, str) else c).cast("double")

    wide = df.select(
        *by,
        *[column(t).alias(f"_x{i}") for i, t in enumerate([*terms, y])],
        (F.lit(1.0) if weight is None else column(weight)).alias("_weight"),
    )
    names = [f"_x{i}" for i in range(k + 1)]
    wide = wide.withColumn("_ok", complete(["_weight", *names]))
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]

    def product(i: int, j: int) -> Column:
        both = F.col(f"_x{i}") * F.col(f"_x{j}")
        return both if weight is None else F.col("_weight") * both

    sums = wide.groupBy(*by).agg(
        F.count(F.when(F.col("_ok"), 1)).cast("double").alias("_n"),
        F.count(F.when(~F.col("_ok"), 1)).cast("double").alias("_dropped"),
        *[F.sum(F.when(F.col("_ok"), product(i, j))).alias(f"_s{i}_{j}") for i, j in pairs],
    )

    def entry(i: int, j: int, value: Column) -> Column:
        return F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), value.alias("value"))

    entries = [entry(COUNTS, 0, F.col("_n")), entry(COUNTS, 1, F.col("_dropped"))]
    for i, j in pairs:
        value = F.coalesce(F.col(f"_s{i}_{j}"), F.lit(0.0))
        entries.append(entry(i, j, F.try_divide(value, F.col("_n")) if per_row else value))
    return sums.select(*by, F.inline(F.array(*entries)))
