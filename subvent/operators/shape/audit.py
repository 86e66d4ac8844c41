"""Checking that predictions keep a promised shape."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subvent.functions.checks import complete, require
from subvent.functions.steps import edges_passed
from subvent.operators.shape.basis import SHAPES
from subvent.plans.lookup import shuffle_partitions
from subvent.sources.staging import stage

# fixed value: predictions of size p are taken as exact to this share of p
ROUNDING = 4e-15
# points of a slice: what one task sorts
SLICE_POINTS = 1_000_000


def _slice_of(points: DataFrame, slices: int) -> Column:
    """Number of the even-sized slice along x a point falls in; one narrow pass finds the edges.

    The edges stand in the plan as one sorted array, whatever their number, and a point's slice is the number of
    edges that it has passed.
    """
    if slices < 2:
        return F.lit(0)
    shares = F.lit([i / slices for i in range(1, slices)])
    edges = points.agg(F.percentile_approx("_x", shares, max(1_000, 20 * slices))).first()[0] or []
    edges = sorted(set(edges))
    if len(edges) <= 64:
        return edges_passed(F.col("_x"), edges)
    # edges in blocks: first the block, then the edge in it
    size = math.isqrt(len(edges))
    blocks = [edges[i : i + size] for i in range(0, len(edges), size)]
    block = edges_passed(F.col("_x"), [b[0] for b in blocks])
    inside = F.size(F.filter(F.get(F.lit(blocks), F.greatest(block - 1, F.lit(0))), lambda e: e <= F.col("_x")))
    return F.when(block == 0, 0).otherwise((block - 1) * size + inside)


def shape_audit(
    df: DataFrame,
    pred: str,
    x: str,
    by: Sequence[str] = (),
    shape: str = "convex_increasing",
    tol: float = 1e-9,
    slices: int | None = None,
) -> DataFrame:
    """Per segment: points, breaches of the shape along x and the worst one.

    Rows are first averaged to one point per (segment, x). A breach is a first divided
    difference of the wrong sign, or a second one for the bend, by more than ``tol`` and more than
    the rounding of the predictions can cause. Points are compared within
    slices of x, each preceded by copies of the two points before it, so a long segment is
    spread over ``slices`` tasks (by default one per shuffle partition, and more beyond SLICE_POINTS points each) and no
    neighbour is missed. A row whose x or prediction is NULL, NaN or infinite is no point.
    """
    by = list(by)
    require(df, by, [pred, x])
    _, slope_sign, bend_sign = SHAPES[shape]
    # equal predictions are taken as they are: their average could differ in the last digit
    point = F.when(F.min(pred) == F.max(pred), F.min(pred)).otherwise(F.avg(pred)).cast("double")
    points = stage(
        df.filter(complete([pred, x]))
        .groupBy(*by, F.col(x).cast("double").alias("_x"))
        .agg(point.alias("_p")),
        "audit_points",
    )
    slices = slices or max(shuffle_partitions(df), points.count() // SLICE_POINTS)
    points = points.withColumn("_slice", _slice_of(points, slices)).withColumn("_copy", F.lit(False))

    # the last two points of each slice, in order of x
    backwards = Window.partitionBy(*by, "_slice").orderBy(F.desc("_x"))
    tails = (
        points.withColumn("_rank", F.row_number().over(backwards))
        .filter("_rank <= 2")
        .groupBy(*by, "_slice")
        .agg(F.sort_array(F.collect_list(F.struct("_x", "_p"))).alias("_tail"))
    )
    slices_in_order = Window.partitionBy(*by).orderBy("_slice")
    nothing = F.array().cast(tails.schema["_tail"].dataType)
    before = F.concat(
        F.coalesce(F.lag("_tail", 2).over(slices_in_order), nothing),
        F.coalesce(F.lag("_tail", 1).over(slices_in_order), nothing),
    )
    copies = (
        tails.withColumn("_before", before)
        .filter(F.size("_before") > 0)
        .withColumn("_before", F.slice("_before", -F.least(F.size("_before"), F.lit(2)), F.lit(2)))
        .select(*by, "_slice", F.inline("_before"), F.lit(True).alias("_copy"))
    )

    along = Window.partitionBy(*by, "_slice").orderBy("_x")
    last_three = along.rowsBetween(-2, Window.currentRow)
    steps = (
        points.unionByName(copies)
        .withColumn("_gap", F.col("_x") - F.lag("_x").over(along))
        .withColumn("_span", F.col("_x") - F.lag("_x", 2).over(along))
        .withColumn("_d1", (F.col("_p") - F.lag("_p").over(along)) / F.col("_gap"))
        .withColumn("_d2", (F.col("_d1") - F.lag("_d1").over(along)) / F.col("_span"))
        .withColumn("_fuzz", F.lit(ROUNDING) * F.max(F.abs("_p")).over(last_three) / F.min("_gap").over(last_three))
        .filter(~F.col("_copy"))
    )

    def breach(amount: Column, rounding: Column) -> Column:
        return F.when(amount > F.lit(tol) + rounding, amount)

    slope = breach(-slope_sign * F.col("_d1"), F.col("_fuzz"))
    bend = breach(-bend_sign * F.col("_d2"), F.col("_fuzz") / F.col("_span"))
    return steps.groupBy(*by).agg(
        F.count(F.lit(1)).alias("points"),
        F.count(slope).alias("slope_breaches"),
        F.count(bend).alias("bend_breaches"),
        F.coalesce(F.greatest(F.max(slope), F.max(bend)), F.lit(0.0)).alias("worst"),
    )
