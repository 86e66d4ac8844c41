"""Effect of issuance per group by instrumental variables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subvent.functions.checks import as_double, complete, require, weighted
from subvent.plans.lookup import BROADCAST_ROWS, attach
from subvent.sources.staging import stage

# fixed values: below this share of its largest possible size a covariance counts as zero;
# above 1 minus it, issuance follows assignment without exception
ZERO_SHARE = 1e-12
WEAK_F = 10.0
# fixed value: the square sum of a group's scores is taken from its moments while rounding costs it no more than some nine digits
MOST_CANCELLED = 1e6
# exponents of z, y and w in the products that the score's square sum needs
SCORE_MOMENTS = (
    (1, 0, 0), (0, 1, 0), (0, 0, 1), (2, 0, 0), (0, 2, 0), (0, 0, 2), (1, 1, 0), (1, 0, 1), (0, 1, 1),
    (2, 1, 0), (2, 0, 1), (1, 2, 0), (1, 0, 2), (1, 1, 1), (2, 2, 0), (2, 0, 2), (2, 1, 1),
)
# fixed value: an F as near as this to its bound counts as on it, whatever the order of the sums
ROUNDING = 1e-9


def _weighted_moments(rows: DataFrame, by: list[str], counts: list[Column]) -> DataFrame:
    """Moments of rows that stand for ``_weight`` rows each, from sums about the means of all rows."""
    names = ("_z", "_w", "_y")
    centre = rows.agg(*[F.avg(c).alias(c) for c in names]).first()
    away = {c: F.col(c) - F.lit(centre[c] or 0.0) for c in names}
    pairs = {"_cyz": ("_y", "_z"), "_cwz": ("_w", "_z"), "_cyw": ("_y", "_w"), "_vz": ("_z", "_z"), "_vw": ("_w", "_w")}
    weight = F.col("_weight")
    sums = rows.groupBy(*by).agg(
        F.coalesce(F.sum(weight), F.lit(0.0)).alias("_total"),
        *counts,
        *[F.sum(weight * away[c]).alias(f"_s{c}") for c in names],
        *[F.sum(weight * away[a] * away[b]).alias(name) for name, (a, b) in pairs.items()],
    )
    total = F.col("_total")

    def spread(name: str, a: str, b: str) -> Column:
        found = F.col(name) - F.col(f"_s{a}") * F.col(f"_s{b}") / total
        if a == b:  # equal values leave only rounding
            found = F.when(found > F.lit(ZERO_SHARE) * F.col(name), found).otherwise(0.0)
        return F.when(total > 1, found / (total - 1)).alias(name)

    return sums.select(
        *by,
        F.round(total).cast("bigint").alias("n"),
        "n_dropped",
        "_rows",
        "_size",
        *["_m%d%d%d" % m for m in SCORE_MOMENTS],
        *[(F.try_divide(F.col(f"_s{c}"), total) + F.lit(centre[c] or 0.0)).alias(f"_m{c[1:]}") for c in names],
        *[spread(name, a, b) for name, (a, b) in pairs.items()],
    )


def _score_moments(centre: dict[str, float], weight: Column | None) -> list[Column]:
    """Sums of the products of ``SCORE_MOMENTS``, about ``centre``, and of the weights."""
    away = [F.col(c) - F.lit(centre[c]) for c in ("_z", "_y", "_w")]

    def product(powers: tuple[int, int, int]) -> Column:
        factors = [a for a, k in zip(away, powers, strict=True) for _ in range(k)] + ([weight] if weight is not None else [])
        out = factors[0]
        for f in factors[1:]:
            out = out * f
        return out

    size = F.count("_z").cast("double") if weight is None else F.sum(weight)
    return [size.alias("_size"), *[F.sum(product(m)).alias("_m%d%d%d" % m) for m in SCORE_MOMENTS]]


def _score_square() -> tuple[Column, Column]:
    """Sum of ((z - mean) * residual)^2 over a group, and a bound on the numbers that it is the difference of.

    With a, b and c the means of z, y and w, the fourth moments about the means follow from those about any centre.
    """
    m = {k: F.col("_m%d%d%d" % k) / F.col("_size") for k in SCORE_MOMENTS}
    a, b, c = m[1, 0, 0], m[0, 1, 0], m[0, 0, 1]

    def fourth(first: int, second: int) -> Column:
        """E (z - a)^2 (x - p) (v - q) for x and v among y (1) and w (2)."""
        unit = {1: (0, 1, 0), 2: (0, 0, 1)}
        x, v, p, q = unit[first], unit[second], (b, c)[first - 1], (b, c)[second - 1]
        at = lambda k, *parts: m[(k, *(sum(u[i] for u in parts) for i in (1, 2)))]
        none = at(2, x, v) - q * at(2, x) - p * at(2, v) + p * q * m[2, 0, 0]
        one = at(1, x, v) - q * at(1, x) - p * at(1, v) + p * q * a
        two = at(0, x, v) - p * q
        return none - 2 * a * one + a * a * two

    tau = F.col("effect")
    square = F.col("_size") * (fourth(1, 1) - 2 * tau * fourth(1, 2) + tau * tau * fourth(2, 2))
    whole = lambda k, p: m[(2, *k)] + a * a * m[(0, *k)] + p * p * (m[2, 0, 0] + a * a)
    return square, F.col("_size") * (whole((2, 0), b) + tau * tau * whole((0, 2), c))


def _summed_again(rows: DataFrame, moments: DataFrame, keys: list[str], by_weight: bool, broadcast_rows: int) -> DataFrame:
    """``moments`` with ``_score2``, from the rows again for the groups that are not ``_sound``."""
    centres = moments.filter("NOT _sound").select(*keys, "_mz", "_mw", "_my", "effect", "_rows")
    attached = attach(rows, centres, keys, "_rows", broadcast_rows).filter("_mz IS NOT NULL")
    residual = (F.col("_y") - F.col("_my")) - F.col("effect") * (F.col("_w") - F.col("_mw"))
    score = (F.col("_z") - F.col("_mz")) * residual
    square = score * score * F.col("_weight") if by_weight else score * score
    scores = attached.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.sum(square).alias("_again"))
    matched = F.lit(True)
    for k in keys:
        matched = matched & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    # both tables have one row per group; the scores are broadcast wherever the moments were for the second pass
    scores = F.broadcast(scores) if moments.count() <= broadcast_rows else scores
    return moments.join(scores, matched, "left").withColumn("_score2", F.when(F.col("_sound"), F.col("_square")).otherwise(F.col("_again")))


def iv_effect(
    panel: DataFrame,
    z: str,
    w: str,
    y: str,
    by: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Per group: n, naive difference, intent-to-treat, first stage, IV effect, s.e., F, status.

    One pass: all that is asked for follows from moments per group, up to products of four numbers for the standard error, which
    are summed before the shuffle, so a hot group costs one row per task and no row moves, however many groups there are. The moments
    are taken about a row of the panel; where a group lies so far from it that too many digits would cancel, or nothing is left, that
    group's residuals are summed about its own means in a second pass. ``weight`` says how many equal rows a row
    stands for: a weight of 2 counts as the row twice, in ``n`` too. A row without a positive weight is left out.
    """
    by = list(by)
    require(panel, by, [z, w, y] + ([weight] if weight else []))
    ok = complete([z, w, y]) & weighted(weight)
    keys = by or ["_all"]
    rows = panel.select(
        *(by or [F.lit(1).alias("_all")]),
        *[F.when(ok, as_double(panel, c)).alias(a) for c, a in ((z, "_z"), (w, "_w"), (y, "_y"))],
        *([F.when(ok, as_double(panel, weight)).alias("_weight")] if weight else []),
    )
    centre = rows.filter("_z IS NOT NULL").select("_z", "_w", "_y").first()
    centre = centre.asDict() if centre else {"_z": 0.0, "_w": 0.0, "_y": 0.0}
    counts = [(F.count(F.lit(1)) - F.count("_z")).alias("n_dropped"), F.count(F.lit(1)).alias("_rows")]
    fourth = _score_moments(centre, F.col("_weight") if weight else None)
    moments = _weighted_moments(rows, by, [*counts, *fourth]) if weight else rows.groupBy(*by).agg(
        F.count("_z").alias("n"),
        *counts,
        F.avg("_z").alias("_mz"),
        F.avg("_w").alias("_mw"),
        F.avg("_y").alias("_my"),
        F.covar_samp("_y", "_z").alias("_cyz"),
        F.covar_samp("_w", "_z").alias("_cwz"),
        F.covar_samp("_y", "_w").alias("_cyw"),
        F.var_samp("_z").alias("_vz"),
        F.var_samp("_w").alias("_vw"),
        *fourth,
    )
    scale = F.sqrt(F.col("_vw") * F.col("_vz"))
    usable = (F.col("n") >= 3) & (F.col("_vz") > 0) & (F.abs("_cwz") > F.lit(ZERO_SHARE) * scale)
    moments = moments.withColumn("effect", F.when(usable, F.try_divide("_cyz", "_cwz")))
    if not by:
        moments = moments.withColumn("_all", F.lit(1))
    square, bound = _score_square()
    sound = F.col("effect").isNull() | (square * MOST_CANCELLED > bound)
    moments = moments.withColumn("_square", square).withColumn("_sound", F.coalesce(sound, F.lit(False)))
    moments = stage(moments.drop(*["_m%d%d%d" % m for m in SCORE_MOMENTS]), "iv_moments")
    groups = moments.withColumn("_score2", F.col("_square"))
    if not moments.filter("NOT _sound").isEmpty():
        groups = _summed_again(rows, moments, keys, bool(weight), broadcast_rows)

    r2 = F.try_divide(F.col("_cwz") * F.col("_cwz"), F.col("_vw") * F.col("_vz"))
    f_stat = F.when(r2 < 1 - ZERO_SHARE, F.try_divide(r2 * (F.col("n") - 2), 1 - r2))
    status = (
        F.when(F.col("n") < 3, "too_few")
        .when(F.col("_vz") == 0, "no_instrument_variation")
        .when(F.abs("_cwz") <= F.lit(ZERO_SHARE) * scale, "no_first_stage")
        .when(F.col("f_stat") < WEAK_F * (1 - ROUNDING), "weak")
        .otherwise("ok")
    )
    return (
        groups
        .withColumn("f_stat", F.when(F.col("n") >= 3, f_stat))
        .select(
            *by,
            "n",
            "n_dropped",
            F.try_divide("_cyw", "_vw").alias("naive"),
            F.try_divide("_cyz", "_vz").alias("itt"),
            F.try_divide("_cwz", "_vz").alias("first_stage"),
            "effect",
            F.try_divide(F.sqrt("_score2"), F.abs("_cwz") * (F.col("n") - 1)).alias("std_error"),
            "f_stat",
            status.alias("status"),
        )
    )
