"""The registered queries: every operator over the whole given tables.

Doubles are rounded where a result is compared with another engine, whose sums run in another order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subvent.functions.activation import recu
from subvent.operators.causal.bins import bin_features
from subvent.operators.causal.draws import Draws, honest_draws
from subvent.operators.causal.effect import iv_effect
from subvent.operators.causal.forest import (
    IVForest,
    causal_forest_fit,
    iv_forest_fit,
    iv_forest_predict,
    iv_forest_variance,
)
from subvent.operators.causal.panel import experiment_panel
from subvent.operators.causal.residuals import cross_fit_residuals
from subvent.operators.causal.split import iv_split
from subvent.operators.prior.curve import combined_gram, prior_curve_fit, prior_rows
from subvent.operators.prior.net import prior_net_fit
from subvent.operators.prior.priors import (
    collocation_points,
    convex,
    increasing,
    prior_residuals,
    third_difference,
    upper_bound,
)
from subvent.operators.prior.report import generalization_report, holdout_range
from subvent.operators.shape.audit import shape_audit
from subvent.operators.shape.basis import CurveBasis, recu_basis
from subvent.operators.shape.curve import ShapeCurves, curve_predict, shape_curve_fit
from subvent.operators.shape.gram import gram
from subvent.operators.shape.net import RecuNet, recu_net_fit, recu_net_predict
from subvent.operators.shape.nets import RecuNets
from subvent.sources import fixtures
from subvent.sources.tables import read_table

# Settings shared with the SQL of the same queries.
ACCTBAL_EDGES = [-500.0 + 500.0 * i for i in range(21)]
PRICE_EDGES = [25_000.0 * i for i in range(1, 20)]
EDGES = {"acctbal": ACCTBAL_EDGES, "price": PRICE_EDGES}
COVARIATES = ["acctbal", "price", "priority"]
TREES, DEPTH, MIN_LEAF = 50, 4, 50
DRAW_TREES = 10
RESIDUAL_FOLDS, RESIDUAL_TREES, RESIDUAL_DEPTH = 3, 4, 3
ORDERED_BINS = 32
SPLIT_MIN_LEAF = 100
GROUP_UNITS = 12
BOUND, BOUND_LAMBDA = 25.0, 100.0
QUANTITY_KNOTS = (10.0, 20.0, 30.0, 40.0)
REPORT_KNOTS = (0.0, 0.03)
REPORT_CUT = 0.08
GRID_STEP = 0.0025
LAMBDA = 10_000.0
# c, then v, a, u and b of two hidden units: a start for a few steps of the fit, which SQL repeats
STEPS_THETA = (-1.0, 0.1, -0.3, 0.6, 0.4, 0.0, 0.0, 0.3, -0.2)
STEPS_SCALES = (0.0, 0.1, 0.0, 1.0, 34.0, 10.0)
NET_STEPS = 4
STEPS_LAMBDA = 5.0
# c, then v, a, u and b of four hidden units
NET_THETA = (-1.2, -0.7, 0.1, 0.4, -1.5, 0.6, 0.9, 1.4, 0.2, 0.3, -0.2, 0.5, 0.1, 0.4, -0.1, -0.6, 0.8)
NET_SCALES = (0.0, 0.1, 1.0, 49.0, 34.0, 10.0)

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Doubles rounded to ``digits``, or to a column's own number of digits."""
    return df.select(
        *[F.round(c, special.get(c, digits)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _draws(bag_size: int = 1, fraction: float = 0.5) -> Draws:
    return Draws(
        TREES, fraction, bag_size=bag_size, formula=fixtures.fixture_draw, draw_range=fixtures.DRAW_RANGE
    )


def _forest(panel: DataFrame, bag_size: int = 1, fraction: float = 0.5) -> IVForest:
    return iv_forest_fit(
        panel, "z", "w", "y", COVARIATES, depth=DEPTH, min_leaf=MIN_LEAF, edges=EDGES, draws=_draws(bag_size, fraction), values="each"
    )


def _curves(spark: SparkSession, folder: str) -> tuple[DataFrame, ShapeCurves]:
    panel = fixtures.dose_panel(spark, folder)
    return panel, shape_curve_fit(panel, "dose", "y", ["segment"], fixtures.KNOTS, "convex_increasing")


def q_experiment_panel(spark: SparkSession, folder: str) -> DataFrame:
    panel = experiment_panel(
        fixtures.assignment(spark, folder),
        fixtures.issuance(spark, folder),
        fixtures.outcome(spark, folder),
        "unit_id",
        "ts",
        F.expr("INTERVAL '2' DAY"),
    )
    return _rounded(panel)


def q_experiment_panel_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Days for times and a window of hours: records of the next day count."""
    day = F.col("ts").cast("date").alias("ts")
    panel = experiment_panel(
        fixtures.assignment(spark, folder).select("unit_id", "z", day),
        fixtures.issuance(spark, folder).select("unit_id", day, "amount"),
        fixtures.outcome(spark, folder).select("unit_id", day, "value"),
        "unit_id",
        "ts",
        F.expr("INTERVAL '36' HOUR"),
    )
    return _rounded(panel.withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def q_iv_effect(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(iv_effect(fixtures.iv_panel(spark, folder), "z", "w", "y", ["segment"]))


def q_iv_effect_overall(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(iv_effect(fixtures.iv_panel(spark, folder), "z", "w", "y"))


def q_iv_effect_by_band(spark: SparkSession, folder: str) -> DataFrame:
    """By the true break, priority and segment: fifty groups of very different size."""
    panel = fixtures.iv_panel(spark, folder).withColumn("high_balance", F.col("acctbal") >= 4500)
    return _rounded(iv_effect(panel, "z", "w", "y", ["high_balance", "priority", "segment"]))


def q_iv_effect_incomplete(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with NULL, NaN or an infinity are left out and counted."""
    unit = F.col("unit_id")
    panel = fixtures.iv_panel(spark, folder).select(
        "segment",
        F.when(unit % 17 != 0, F.col("z")).alias("z"),
        F.when(unit % 13 == 0, float("inf")).otherwise(F.col("w").cast("double")).alias("w"),
        F.when(unit % 7 == 0, float("nan")).when(unit % 11 != 0, F.col("y")).alias("y"),
    )
    return _rounded(iv_effect(panel, "z", "w", "y", ["segment"]))


def _weights() -> Column:
    return (1 + F.col("unit_id") % 3).alias("weight")


def q_iv_effect_weighted(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.iv_panel(spark, folder).select("*", _weights())
    return _rounded(iv_effect(panel, "z", "w", "y", ["segment"], weight="weight"))


def q_iv_forest_weighted(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.iv_panel(spark, folder).select("*", _weights())
    model = iv_forest_fit(
        panel, "z", "w", "y", COVARIATES, depth=DEPTH, min_leaf=MIN_LEAF, edges=EDGES, draws=_draws(), weight="weight", values="each"
    )
    return _rounded(model.splits, gain=2)


def q_iv_effect_many(spark: SparkSession, folder: str) -> DataFrame:
    """Many small groups, with every status."""
    panel = fixtures.iv_panel(spark, folder).withColumn("batch", F.floor(F.col("unit_id") / GROUP_UNITS))
    return _rounded(iv_effect(panel, "z", "w", "y", ["batch"]))


def q_cross_fit_residuals(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.iv_panel(spark, folder).select("unit_id", "segment", "priority", "z", "w", "y")
    found = cross_fit_residuals(
        panel, ["z", "w", "y"], ["segment", "priority"], k=5, fold=F.col("unit_id") % 5
    )
    return _rounded(found.select("unit_id", "fold", "z_res", "w_res", "y_res"))


def q_cross_fit_residuals_rf(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.iv_panel(spark, folder).select("unit_id", "acctbal", "price", "priority", "z", "w", "y")
    found = cross_fit_residuals(panel, ["z", "w", "y"], COVARIATES, method="rf")
    return found.select("unit_id", "fold", "z_res", "w_res", "y_res")


def q_cross_fit_residuals_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Trees per fold with given folds, edges and draws: the residuals that SQL grows again."""
    draws = Draws(RESIDUAL_TREES, formula=fixtures.fixture_draw, draw_range=fixtures.DRAW_RANGE)
    found = cross_fit_residuals(
        fixtures.iv_panel(spark, folder), ["z", "w", "y"], COVARIATES, k=RESIDUAL_FOLDS, method="rf",
        fold=F.col("unit_id") % RESIDUAL_FOLDS, depth=RESIDUAL_DEPTH, edges=EDGES, draws=draws, min_leaf=MIN_LEAF,
    )
    return _rounded(found.select("unit_id", "fold", "z_res", "w_res", "y_res"))


def q_honest_draws(spark: SparkSession, folder: str) -> DataFrame:
    draws = Draws(DRAW_TREES, formula=fixtures.fixture_draw, draw_range=fixtures.DRAW_RANGE)
    return honest_draws(fixtures.iv_panel(spark, folder), "unit_id", DRAW_TREES, draws=draws)


def q_bin_features(spark: SparkSession, folder: str) -> DataFrame:
    binned, bins = bin_features(fixtures.iv_panel(spark, folder), COVARIATES, edges=EDGES)
    names = [f"bin_{f.name}" if f.level is None else f"bin_{f.name}_{f.level[0]}" for f in bins.features]
    return binned.select("unit_id", *[F.get("bins", F.lit(i)).alias(n) for i, n in enumerate(names)])


def q_iv_split(spark: SparkSession, folder: str) -> DataFrame:
    """The best split of the root and, for contrast, of the five segments taken as nodes."""
    binned, _ = bin_features(fixtures.iv_panel(spark, folder), COVARIATES, edges=EDGES)
    segments = F.when(F.col("segment") < "F", 2).when(F.col("segment") < "I", 3).otherwise(4)
    nodes = F.array(F.lit(1), segments).cast("array<bigint>")
    rows = binned.withColumn("tree", F.lit(1)).withColumn("node", F.explode(nodes))
    return _rounded(iv_split(rows, "z", "w", "y", min_leaf=SPLIT_MIN_LEAF), gain=2)


def q_iv_forest_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_forest(fixtures.iv_panel(spark, folder)).splits, gain=2)


def q_iv_forest_leaves(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_forest(fixtures.iv_panel(spark, folder)).leaves, 7)


def q_iv_forest_predict(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.iv_panel(spark, folder)
    scored = iv_forest_predict(panel, _forest(panel))
    return _rounded(scored.select("unit_id", "effect", "n_trees", "effect_status"))


def q_iv_forest_predict_oob(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.iv_panel(spark, folder)
    scored = iv_forest_predict(panel, _forest(panel), oob=True)
    return _rounded(scored.select("unit_id", "effect", "n_trees", "effect_status"))


def q_iv_forest_centred(spark: SparkSession, folder: str) -> DataFrame:
    """Residuals, forest and out-of-bag effects in one go: the job as an analyst runs it."""
    panel = cross_fit_residuals(
        fixtures.iv_panel(spark, folder), ["z", "w", "y"], ["segment", "priority"], k=5, fold=F.col("unit_id") % 5
    )
    model = iv_forest_fit(
        panel, "z_res", "w_res", "y_res", COVARIATES, depth=DEPTH, min_leaf=MIN_LEAF, edges=EDGES, draws=_draws(), raw_z="z", values="each"
    )
    scored = iv_forest_predict(panel, model, oob=True)
    return _rounded(scored.select("unit_id", "effect", "n_trees", "effect_status"))


def q_iv_forest_learned(spark: SparkSession, folder: str) -> DataFrame:
    """With the defaults: quantile bins and hashed draws, which only Spark can repeat."""
    panel = fixtures.iv_panel(spark, folder)
    scored = iv_forest_predict(panel, iv_forest_fit(panel, "z", "w", "y", ["acctbal", "price"]), oob=True)
    return scored.select("unit_id", "tau", "effect", "n_trees", "effect_status")


def _ordered_forest(panel: DataFrame) -> IVForest:
    """Customers, of which there are thousands, as a text covariate."""
    return iv_forest_fit(
        panel, "z", "w", "y", ["price", "customer"], depth=DEPTH, min_leaf=MIN_LEAF, edges=EDGES, draws=_draws(), n_bins=ORDERED_BINS
    )


def q_iv_forest_ordered(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_ordered_forest(fixtures.iv_panel(spark, folder)).splits, gain=2)


def q_iv_forest_ordered_predict(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.iv_panel(spark, folder)
    scored = iv_forest_predict(panel, _ordered_forest(panel))
    return _rounded(scored.select("unit_id", "effect", "n_trees", "effect_status"))


def q_causal_forest_fit(spark: SparkSession, folder: str) -> DataFrame:
    model = causal_forest_fit(
        fixtures.iv_panel(spark, folder), "z", "y", COVARIATES, depth=DEPTH, min_leaf=MIN_LEAF, edges=EDGES, draws=_draws(), values="each"
    )
    return _rounded(model.splits, gain=2)


def q_iv_forest_variance(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.iv_panel(spark, folder)
    scored = iv_forest_variance(panel, _forest(panel, bag_size=2, fraction=0.25))
    return _rounded(scored.select("unit_id", "effect", "std_error", "n_trees", "effect_status"))


def q_recu(spark: SparkSession, folder: str) -> DataFrame:
    over = F.col("l_quantity") - 25.0
    return _rounded(
        read_table(spark, folder, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            recu(over).alias("recu_2"),
            recu(over, 1.5).alias("recu_1_5"),
            recu(F.when(over > -20, over), 3).alias("recu_3"),
        )
    )


def q_recu_basis(spark: SparkSession, folder: str) -> DataFrame:
    items = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    rising = recu_basis(items, "l_quantity", QUANTITY_KNOTS, 2, "convex")
    rising = rising.withColumnsRenamed({f"term_{i}": f"convex_{i}" for i in range(6)})
    both = recu_basis(rising, "l_quantity", QUANTITY_KNOTS, 2, "concave")
    return both.withColumnsRenamed({f"term_{i}": f"concave_{i}" for i in range(6)})


def q_gram(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.dose_panel(spark, folder)
    terms = CurveBasis(fixtures.KNOTS).terms(F.col("dose"))
    return _rounded(gram(panel, terms, "y", ["segment"], per_row=True), 6)


def q_gram_weighted(spark: SparkSession, folder: str) -> DataFrame:
    items = read_table(spark, folder, "lineitem")
    items = recu_basis(items, "l_discount", (0.02, 0.05))
    return _rounded(
        gram(items, [f"term_{i}" for i in range(4)], "l_quantity", ["l_returnflag", "l_linestatus"], "l_tax", per_row=True), 6
    )


def q_shape_curve_fit(spark: SparkSession, folder: str) -> DataFrame:
    _, curves = _curves(spark, folder)
    return _rounded(
        curves.table.select("segment", "n", "n_dropped", "loss", "status", F.posexplode("coef").alias("term", "coef")),
        coef=2,
    )


def q_curve_predict(spark: SparkSession, folder: str) -> DataFrame:
    panel, curves = _curves(spark, folder)
    scored = curve_predict(panel, curves)
    return _rounded(scored.select("order_key", "line_no", "segment", "pred", "slope"), slope=2)


def q_shape_audit(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.dose_panel(spark, folder)
    return _rounded(shape_audit(panel, "y", "dose", ["segment"], "convex_increasing"), worst=2)


def q_shape_audit_prices(spark: SparkSession, folder: str) -> DataFrame:
    """A long curve: the mean quantity along every price, per return flag."""
    items = read_table(spark, folder, "lineitem")
    return _rounded(shape_audit(items, "l_quantity", "l_extendedprice", ["l_returnflag"], "concave_decreasing"), worst=2)


def q_shape_audit_fitted(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted curves audited on a grid that reaches past the data: no breach may show."""
    panel, curves = _curves(spark, folder)
    grid = collocation_points(panel, "dose", ["segment"], 81, -0.05, 0.2)
    found = shape_audit(curve_predict(grid, curves), "pred", "dose", ["segment"], "convex_increasing")
    return _rounded(found, worst=2)


def _fitted(spark: SparkSession, net: RecuNet) -> DataFrame:
    """A net's weights, with what its fit says of itself in every row."""
    about = [F.lit(net.n).cast("bigint").alias("n"), F.lit(net.passes).alias("passes"), F.lit(net.status).alias("status")]
    return net.to_df(spark).select("*", *about)


def q_recu_net_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted(spark, recu_net_fit(fixtures.dose_panel(spark, folder), "dose", None, "y"))


def _first_net() -> RecuNet:
    return RecuNet(STEPS_THETA, 2, "dose", None, STEPS_SCALES)


def q_recu_net_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The first steps of a fit from a given start."""
    net = recu_net_fit(fixtures.dose_panel(spark, folder), "dose", None, "y", iters=NET_STEPS, init=_first_net())
    return _rounded(net.to_df(spark))


def q_recu_net_steps_by(spark: SparkSession, folder: str) -> DataFrame:
    """The same steps of a net per segment, all segments together."""
    panel = fixtures.dose_panel(spark, folder)
    nets = recu_net_fit(panel, "dose", None, "y", iters=NET_STEPS, init=_first_net(), by=["segment"])
    return _rounded(nets.weights())


def q_recu_net_steps_weighted(spark: SparkSession, folder: str) -> DataFrame:
    """A line of an order counts as often as its number says."""
    panel = fixtures.dose_panel(spark, folder)
    net = recu_net_fit(panel, "dose", None, "y", iters=NET_STEPS, init=_first_net(), weight="line_no")
    return _rounded(net.to_df(spark))


def _near_truth(panel: DataFrame, nets: RecuNets) -> DataFrame:
    """Per segment: how its net ended, breaches of its shape on a grid past the data, and whether it comes near the truth."""
    grid = collocation_points(panel, "dose", ["segment"], 81, -0.05, 0.2)
    shape = shape_audit(recu_net_predict(grid, nets), "pred", "dose", ["segment"])
    truth = panel.groupBy("segment", "dose").agg(F.avg("truth").alias("truth"), F.count("*").alias("cell"))
    squares = F.sum(F.col("cell") * (F.col("pred") - F.col("truth")) ** 2) / F.sum("cell")
    miss = recu_net_predict(truth, nets).groupBy("segment").agg((F.sqrt(squares) < 0.6).alias("near_truth"))
    ended = nets.table.select("segment", "n", "n_dropped", F.col("status").isin("converged", "not_converged").alias("ended"))
    return ended.join(shape, "segment").join(miss, "segment").drop("worst")


def q_recu_net_claims_by(spark: SparkSession, folder: str) -> DataFrame:
    """What whole fits with the defaults promise, per segment."""
    panel = fixtures.dose_panel(spark, folder)
    return _near_truth(panel, recu_net_fit(panel, "dose", None, "y", by=["segment"]))


def q_recu_net_claims(spark: SparkSession, folder: str) -> DataFrame:
    """What a whole fit with the defaults promises: it converges, keeps its shape past the data, and comes near the truth."""
    panel = fixtures.dose_panel(spark, folder)
    net = recu_net_fit(panel, "dose", None, "y")
    shape = shape_audit(recu_net_predict(collocation_points(panel, "dose", [], 81, -0.05, 0.2), net), "pred", "dose")
    truth = panel.groupBy("dose").agg(F.avg("truth").alias("truth"), F.count("*").alias("n"))
    miss = recu_net_predict(truth, net).agg(
        F.sum("n").alias("n"), F.sqrt(F.sum(F.col("n") * (F.col("pred") - F.col("truth")) ** 2) / F.sum("n")).alias("error")
    )
    return shape.join(miss).select(
        "n", F.lit(net.status).alias("status"), "points", "slope_breaches", "bend_breaches", (F.col("error") < 0.6).alias("near_truth")
    )


def q_recu_net_predict(spark: SparkSession, folder: str) -> DataFrame:
    net = RecuNet(NET_THETA, 2, "l_discount", "l_quantity", NET_SCALES)
    items = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_quantity")
    return _rounded(recu_net_predict(items, net).drop("l_discount", "l_quantity"))


def q_collocation_points(spark: SparkSession, folder: str) -> DataFrame:
    items = read_table(spark, folder, "lineitem")
    points = collocation_points(items, "l_extendedprice", ["l_returnflag", "l_linestatus"], 41)
    return _rounded(points, 6)


def q_prior_residuals(spark: SparkSession, folder: str) -> DataFrame:
    panel, curves = _curves(spark, folder)
    points = curves.attach_to(collocation_points(panel, "dose", ["segment"], 41, 0.0, 0.12))
    priors = [increasing(GRID_STEP), convex(GRID_STEP), upper_bound(45.0), third_difference(GRID_STEP)]
    found = prior_residuals(points, curves.value, priors, "dose")
    return _rounded(found.select("segment", "point_id", "prior", "value", "residual"))


def q_prior_gram(spark: SparkSession, folder: str) -> DataFrame:
    """The combined cross products that the soft-prior curve solves."""
    panel = fixtures.dose_panel(spark, folder)
    basis = CurveBasis(fixtures.KNOTS)
    data = gram(panel, basis.terms(F.col("dose")), "y", ["segment"], per_row=True)
    points = collocation_points(panel, "dose", ["segment"], 41, 0.0, 0.1)
    priors = [third_difference(GRID_STEP), upper_bound(25.0, weight=0.5)]
    rows = prior_rows(points, "dose", basis, priors)
    return _rounded(combined_gram(data, rows, ["segment"], basis, 100.0), 6)


def q_prior_curve_fit(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.dose_panel(spark, folder)
    points = collocation_points(panel, "dose", ["segment"], 41, 0.0, 0.1)
    curves = prior_curve_fit(
        panel, "dose", "y", ["segment"], fixtures.KNOTS, [third_difference(GRID_STEP)], LAMBDA, points
    )
    return _rounded(curve_predict(points, curves).select("segment", "point_id", "pred", "slope"), slope=2)


def q_prior_curve_fit_weighted(spark: SparkSession, folder: str) -> DataFrame:
    """A line of an order counts as often as its number says."""
    panel = fixtures.dose_panel(spark, folder)
    points = collocation_points(panel, "dose", ["segment"], 41, 0.0, 0.1)
    priors = [third_difference(GRID_STEP)]
    curves = prior_curve_fit(panel, "dose", "y", ["segment"], fixtures.KNOTS, priors, LAMBDA, points, weight="line_no")
    return _rounded(curve_predict(points, curves).select("segment", "point_id", "pred", "slope"), slope=2)


def q_prior_curve_fit_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Inequalities: the points in breach are found by repeating the solve."""
    panel = fixtures.dose_panel(spark, folder)
    points = collocation_points(panel, "dose", ["segment"], 41, 0.0, 0.1)
    priors = [upper_bound(BOUND), increasing(GRID_STEP)]
    curves = prior_curve_fit(panel, "dose", "y", ["segment"], fixtures.KNOTS, priors, BOUND_LAMBDA, points)
    return _rounded(curve_predict(points, curves).select("segment", "point_id", "pred", "slope"), slope=2)


def q_prior_net_fit(spark: SparkSession, folder: str) -> DataFrame:
    panel = fixtures.dose_panel(spark, folder)
    points = collocation_points(panel, "dose", ["segment"], 41, 0.0, 0.1)
    start = recu_net_fit(panel, "dose", None, "y")
    net = prior_net_fit(panel, points, "dose", None, "y", [third_difference(GRID_STEP)], LAMBDA, init=start)
    return _fitted(spark, net)


def q_prior_net_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The first steps of a fit to data and to an assumption, from a given start."""
    panel = fixtures.dose_panel(spark, folder)
    points = collocation_points(panel, "dose", [], 41, 0.0, 0.1)
    net = prior_net_fit(
        panel, points, "dose", None, "y", [third_difference(GRID_STEP)], STEPS_LAMBDA, init=_first_net(), iters=NET_STEPS
    )
    return _rounded(net.to_df(spark))


def q_prior_net_steps_by(spark: SparkSession, folder: str) -> DataFrame:
    """The same steps per segment, each with the points of its own."""
    panel = fixtures.dose_panel(spark, folder)
    points = collocation_points(panel, "dose", ["segment"], 41, 0.0, 0.1)
    nets = prior_net_fit(
        panel, points, "dose", None, "y", [third_difference(GRID_STEP)], STEPS_LAMBDA, init=_first_net(), iters=NET_STEPS, by=["segment"]
    )
    return _rounded(nets.weights())


def q_prior_net_claims_by(spark: SparkSession, folder: str) -> DataFrame:
    """Whole fits with a true assumption, started from fits without it: near the truth in every segment, and of the same shape."""
    panel = fixtures.dose_panel(spark, folder)
    points = collocation_points(panel, "dose", ["segment"], 41, 0.0, 0.1)
    start = recu_net_fit(panel, "dose", None, "y", by=["segment"])
    return _near_truth(panel, prior_net_fit(panel, points, "dose", None, "y", [third_difference(GRID_STEP)], 1.0, init=start, by=["segment"]))


def _reported(spark: SparkSession, folder: str, weight: str | None) -> DataFrame:
    panel = fixtures.dose_panel(spark, folder)
    beyond = holdout_range("dose", REPORT_CUT, 1.0)
    train = panel.filter(~beyond)
    points = collocation_points(panel, "dose", ["segment"], 41, 0.0, 0.1)
    scored = panel
    for name, shape in (("free", "free"), ("shape", "convex_increasing")):
        scored = curve_predict(scored, shape_curve_fit(train, "dose", "y", ["segment"], REPORT_KNOTS, shape), pred=name)
    soft = prior_curve_fit(
        train, "dose", "y", ["segment"], REPORT_KNOTS, [third_difference(GRID_STEP)], LAMBDA, points
    )
    scored = curve_predict(scored, soft, pred="soft")
    return _rounded(
        generalization_report(scored, {m: m for m in ("free", "shape", "soft")}, "truth", beyond, ["segment"], weight)
    )


def q_generalization_report(spark: SparkSession, folder: str) -> DataFrame:
    """Curves fitted below a dose and judged above it, with and without assumptions."""
    return _reported(spark, folder, None)


def q_generalization_report_weighted(spark: SparkSession, folder: str) -> DataFrame:
    """The same judged with weights: a line of an order counts as often as its number says."""
    return _reported(spark, folder, "line_no")


REGISTERED: dict[str, Query] = {
    name.removeprefix("q_"): value for name, value in list(globals().items()) if name.startswith("q_")
}
