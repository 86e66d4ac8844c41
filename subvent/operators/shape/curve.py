"""Outcome-by-subsidy curves per segment whose shape holds by construction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subvent.functions.checks import refuse, require
from subvent.operators.shape.basis import CurveBasis
from subvent.operators.shape.gram import gram
from subvent.operators.shape.solve import solve_signed_status, unpack
from subvent.plans.lookup import BROADCAST_ROWS, attach
from subvent.sources.staging import stage


@dataclass(frozen=True)
class ShapeCurves:
    """Curves of one basis: a table with ``by``, ``coef``, ``n``, ``n_dropped``, ``loss``, ``status``."""

    table: DataFrame
    basis: CurveBasis
    x: str
    by: tuple[str, ...]

    def value(self, x: Column) -> Column:
        return self.basis.value(x, F.col("coef"))

    def save(self, path: str) -> None:
        self.table.write.parquet(f"{path}/curves")
        row = (self.x, list(self.by), list(self.basis.knots), float(self.basis.power), self.basis.shape)
        schema = "x string, by array<string>, knots array<double>, power double, shape string"
        self.table.sparkSession.createDataFrame([row], schema).write.parquet(f"{path}/basis")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ShapeCurves:
        b = spark.read.parquet(f"{path}/basis").first()
        basis = CurveBasis(tuple(b["knots"]), b["power"], b["shape"])
        return ShapeCurves(spark.read.parquet(f"{path}/curves"), basis, b["x"], tuple(b["by"]))

    def attach_to(self, df: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
        """``df`` with the ``coef`` of each row's segment."""
        if not self.by:
            # one curve: fetch its numbers
            row = self.table.first()
            coef = F.array(*[F.lit(float(c)) for c in row["coef"]]) if row else F.lit(None).cast("array<double>")
            return df.withColumn("coef", coef)
        return attach(df, self.table.select(*self.by, "coef", "n"), list(self.by), "n", broadcast_rows)


def solve_curves(grams: DataFrame, by: Sequence[str], basis: CurveBasis, means: bool = False) -> DataFrame:
    """One row per segment from its Gram rows; the solve is over terms, never over data rows.

    ``means`` says that the products are already per row.
    """
    by = list(by)
    k, signs = basis.size, basis.signs
    keys = by or ["_all"]
    if not by:
        grams = grams.withColumn("_all", F.lit(1))
    fields = [grams.schema[c] for c in by] + [
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("n", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        g, b, yy, n, dropped = unpack(rows, k)
        out = rows.loc[rows.index[:1], by].reset_index(drop=True)
        if n == 0:
            coef, loss, status = None, None, "no_rows"
        else:
            c, done = solve_signed_status(g, b, signs)
            coef, loss = c.tolist(), max(float(yy - 2 * b @ c + c @ g @ c), 0.0) / (1 if means else n)
            status = "not_converged" if not done else "few_rows" if n < k else "ok"
        out = out.reindex(range(1))
        out["coef"] = [coef]
        out["n"], out["n_dropped"], out["loss"], out["status"] = int(n), int(dropped), loss, status
        return out

    return grams.groupBy(*keys).applyInPandas(solve, T.StructType(fields))


def shape_curve_fit(
    df: DataFrame,
    x: str,
    y: str,
    by: Sequence[str] = (),
    knots: Sequence[float] = (),
    shape: str = "convex_increasing",
    power: float = 2,
    weight: str | None = None,
) -> ShapeCurves:
    """Least-squares curve per segment that obeys ``shape`` for every x, not only where data lie."""
    by = list(by)
    require(df, by, [x, y] + ([weight] if weight else []))
    basis = CurveBasis(tuple(float(t) for t in knots), power, shape)
    grams = gram(df, basis.terms(F.col(x).cast("double")), y, by, weight)
    return ShapeCurves(stage(solve_curves(grams, by, basis), "curves"), basis, x, tuple(by))


def curve_predict(
    df: DataFrame,
    curves: ShapeCurves,
    x: str | None = None,
    pred: str = "pred",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``df`` with the fitted value ``pred`` and its ``slope``; NULL for an unknown segment."""
    x = x or curves.x
    slope = "slope" if pred == "pred" else f"{pred}_slope"
    require(df, curves.by, [x])
    refuse(df, [pred, slope, "coef"])
    at = F.col(x).cast("double")
    return curves.attach_to(df, broadcast_rows).select(
        *df.columns, curves.value(at).alias(pred), curves.basis.slope(at, F.col("coef")).alias(slope)
    )
