"""Best split per tree node by the instrumental gradient criterion, in one grouped pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subvent.functions.checks import as_double, complete, finite, require, weighted
from subvent.plans.lookup import BROADCAST_ROWS, attach
from subvent.sources.staging import stage

SUMS = ("n", "high", "sz", "sw", "sy", "szy", "szw")
# fixed value: a product sum that cancels to below this share of its parts counts as zero
CANCELLED = 1e-10


def row_sums(z: Column, w: Column, y: Column, high: Column, weight: Column | None = None) -> list[Column]:
    """The sums a single row contributes; ``high`` is 1 when the instrument is above the node's mean.

    A row with a ``weight`` contributes as that many rows.
    """
    if weight is not None:
        return [
            weight.alias("n"),
            (high.cast("double") * weight).alias("high"),
            (weight * z).alias("sz"),
            (weight * w).alias("sw"),
            (weight * y).alias("sy"),
            (weight * z * y).alias("szy"),
            (weight * z * w).alias("szw"),
        ]
    return [
        F.lit(1).cast("bigint").alias("n"),
        high.cast("bigint").alias("high"),
        z.alias("sz"),
        w.alias("sw"),
        y.alias("sy"),
        (z * y).alias("szy"),
        (z * w).alias("szw"),
    ]


def histogram(rows: DataFrame, bins: str = "bins") -> DataFrame:
    """Sums per (tree, node, feature, bin). Rows fan out over features only until the partial sums."""
    return (
        rows.select("tree", "node", *SUMS, F.posexplode(bins).alias("feature", "bin"))
        .groupBy("tree", "node", "feature", "bin")
        .agg(*[F.sum(c).alias(c) for c in SUMS])
    )


def best_splits(hist: DataFrame, min_leaf: int) -> DataFrame:
    """The winning (feature, bin) per node; rows with bin <= the winner go left.

    Gains are compared at float precision, and ties go to the first (feature, bin): sums of
    doubles depend on task order in their last digits.
    """
    side = max(min_leaf, 1)
    half = f"{min_leaf / 2}D"
    both = hist.selectExpr(
        "tree",
        "node",
        "feature",
        "bin",
        *[f"sum({c}) OVER (PARTITION BY tree, node, feature) AS t_{c}" for c in SUMS],
        *[
            f"sum({c}) OVER (PARTITION BY tree, node, feature ORDER BY bin"
            f" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l_{c}"
            for c in SUMS
        ],
    )
    allowed = both.filter(
        f"""l_n >= {side} AND t_n - l_n >= {side}
        AND l_high >= {half} AND l_n - l_high >= {half}
        AND t_high - l_high >= {half} AND (t_n - l_n) - (t_high - l_high) >= {half}"""
    )
    centred = allowed.selectExpr("*", "t_sz / t_n AS mz", "t_sw / t_n AS mw", "t_sy / t_n AS my")
    effects = centred.selectExpr(
        "*",
        f"""CASE WHEN abs(t_szw - mz * t_sw) > {CANCELLED}D * (abs(t_szw) + abs(mz * t_sw))
            THEN try_divide(t_szy - mz * t_sy, t_szw - mz * t_sw) END AS tau""",
    )
    scores = effects.selectExpr(
        "*",
        """l_szy - mz * l_sy - my * l_sz + l_n * mz * my
            - tau * (l_szw - mz * l_sw - mw * l_sz + l_n * mz * mw) AS rho""",
    )
    gains = scores.selectExpr("*", "rho * rho * (1D / l_n + 1D / (t_n - l_n)) AS gain").filter(finite(F.col("gain")))
    return (
        gains.selectExpr(
            "tree",
            "node",
            "struct(float(gain) AS rank, -feature AS first_feature, -bin AS first_bin, feature, bin, gain,"
            " t_n AS n, l_n AS n_left) AS candidate",
        )
        .groupBy("tree", "node")
        .agg(F.max("candidate").alias("best"))
        .select("tree", "node", *[f"best.{c}" for c in ("feature", "bin", "gain", "n", "n_left")])
    )


def iv_split(
    rows: DataFrame,
    z: str,
    w: str,
    y: str,
    bins: str = "bins",
    min_leaf: int = 50,
    broadcast_rows: int = BROADCAST_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Best split per (tree, node) of ``rows``, which carry ``tree``, ``node`` and a bins array.

    Each side must hold ``min_leaf`` rows, half of it on either side of the node's mean z. A row with a ``weight`` counts
    as that many rows; one without a positive weight is left out.
    """
    require(rows, ["tree", "node", bins], [z, w, y] + ([weight] if weight else []))
    extra = [as_double(rows, weight).alias("_weight")] if weight else []
    rows = rows.filter(complete([z, w, y]) & weighted(weight)).select(
        "tree", "node", bins, *[as_double(rows, c).alias(a) for c, a in ((z, "_z"), (w, "_w"), (y, "_y"))], *extra
    )
    own = F.col("_weight") if weight else None
    mean = (lambda c: F.sum(own * F.col(c)) / F.sum(own)) if weight else F.avg
    means = rows.groupBy("tree", "node").agg(
        F.count(F.lit(1)).alias("_rows"), *[mean(c).alias(f"_m{c}") for c in ("_z", "_w", "_y")]
    )
    rows = attach(rows, stage(means, "node_means"), ["tree", "node"], "_rows", broadcast_rows)
    # centred sums lose fewer digits
    z, w, y = (F.col(c) - F.col(f"_m{c}") for c in ("_z", "_w", "_y"))
    sums = rows.select("tree", "node", F.col(bins).alias("bins"), *row_sums(z, w, y, z > 0, own))
    return best_splits(histogram(sums), min_leaf)
