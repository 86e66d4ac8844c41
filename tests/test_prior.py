import numpy as np
import pytest
from pyspark.sql import functions as F

from subvent.operators.prior.curve import prior_curve_fit
from subvent.operators.prior.net import prior_net_fit
from subvent.operators.prior.priors import (
    Prior,
    collocation_points,
    convex,
    increasing,
    lower_bound,
    prior_residuals,
    third_difference,
    upper_bound,
)
from subvent.operators.prior.report import (
    generalization_report,
    holdout_fold,
    holdout_from,
    holdout_range,
    holdout_segments,
)
from subvent.operators.shape.curve import curve_predict, shape_curve_fit
from subvent.operators.shape.net import recu_net_fit, recu_net_predict
from subvent.sources.fixtures import KNOTS

H = 0.0025


@pytest.fixture(scope="module")
def train(dose_panel):
    return dose_panel.filter("order_key % 50 = 0")


@pytest.fixture(scope="module")
def points(dose_panel):
    return collocation_points(dose_panel, "dose", ["segment"], 41, 0.0, 0.1)


def soft(train, points, priors, lam, **kwargs):
    return prior_curve_fit(train, "dose", "y", ["segment"], KNOTS, priors, lam, points, **kwargs)


def test_published_held_out_errors(dose_panel, train, points):
    """Free, shaped and soft-prior fits on a small sample, and a false assumption that must show as worse."""
    models = {
        "free": shape_curve_fit(train, "dose", "y", ["segment"], KNOTS, "free"),
        "shape": shape_curve_fit(train, "dose", "y", ["segment"], KNOTS),
        "soft0": soft(train, points, [third_difference(H)], 0),
        "soft1": soft(train, points, [third_difference(H)], 1),
        "soft100": soft(train, points, [third_difference(H)], 100),
        "soft10000": soft(train, points, [third_difference(H)], 10_000),
        "false": soft(train, points, [upper_bound(25.0)], 100),
    }
    scored = dose_panel
    for name, curves in models.items():
        scored = curve_predict(scored, curves, pred=name)
    held = F.col("order_key") % 50 != 0
    report = generalization_report(scored, {m: m for m in models}, "truth", held, ["segment"]).collect()
    found = {(r["model"], r["segment"]): round(r["rmse"], 3) for r in report}
    published = {
        "free": (0.697, 0.654, 0.531),
        "shape": (0.319, 0.494, 0.117),
        "soft0": (0.697, 0.654, 0.531),
        "soft1": (0.697, 0.654, 0.528),
        "soft100": (0.673, 0.602, 0.361),
        "soft10000": (0.448, 0.516, 0.094),
        "false": (19.588, 5.637, 13.089),
    }
    for name, errors in published.items():
        assert tuple(found[name, s] for s in "ANR") == errors
    trained = {r["segment"]: r["n_train"] for r in report}
    assert trained == {"A": 398, "N": 378, "R": 400}


def test_inequality_matches_direct_descent(dose_panel, train, points):
    """The settled set gives the minimum of the convex loss: no small step improves it."""
    curves = soft(train, points, [upper_bound(25.0), increasing(H)], 100)
    basis = curves.basis
    grid = np.arange(41) * H

    def terms(x):
        return np.column_stack([np.ones_like(x), x] + [np.maximum(x - t, 0) ** 2 for t in KNOTS])

    for segment in "ANR":
        rows = train.filter(F.col("segment") == segment).select("dose", "y").toPandas()
        a, y = terms(rows["dose"].to_numpy()), rows["y"].to_numpy()
        coef = np.asarray(curves.table.filter(F.col("segment") == segment).first()["coef"])

        def loss(c):
            f = terms(grid) @ c
            rise = np.minimum(np.diff(f), 0)
            return ((y - a @ c) ** 2).mean() + 100 * (np.maximum(f - 25, 0) ** 2).mean() + 100 * (rise**2).mean()

        base = loss(coef)
        rng = np.random.default_rng(0)
        for _ in range(200):
            step = rng.normal(size=len(coef)) * 1e-3 * np.maximum(np.abs(coef), 1)
            assert loss(coef + step) >= base - 1e-9
    assert basis.size == 7


def test_shape_and_prior_together(train, points):
    curves = soft(train, points, [upper_bound(30.0)], 10, shape="convex_increasing")
    for row in curves.table.collect():
        assert all(c >= 0 for c in row["coef"][1:])


def test_collocation_points(spark, dose_panel):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("c", None)], "s string, x double")
    rows = collocation_points(df, "x", ["s"], 5).orderBy("s", "point_id").collect()
    assert [r["x"] for r in rows] == [1.0, 1.5, 2.0, 2.5, 3.0] + [5.0] * 5
    reach = collocation_points(df, "x", ["s"], 3, hi=9.0).filter("s = 'a'").orderBy("x").collect()
    assert [r["x"] for r in reach] == [1.0, 5.0, 9.0]
    assert collocation_points(df, "x", [], 3, 0.0, 1.0).count() == 3
    assert collocation_points(df.limit(0), "x", ["s"], 3, 0.0, 1.0).count() == 0


def test_residuals_of_each_relation(spark):
    points = spark.createDataFrame([(i, float(i), 0.0, 4.0) for i in range(5)], "point_id int, x double, lo double, hi double")
    priors = [
        Prior("sum", ((0.0, 1.0), (1.0, 1.0)), "=", 5.0),
        increasing(1.0),
        convex(1.0),
        upper_bound(8.0),
        lower_bound(2.0),
    ]
    rows = prior_residuals(points, lambda x: x * x - 2 * x, priors).collect()
    found = {(r["prior"], r["point_id"]): r["residual"] for r in rows}
    assert found["sum", 1] == -6.0 and ("sum", 4) not in found  # its stencil leaves the range
    assert (found["increasing", 0], found["increasing", 2]) == (-1.0, 0.0)
    assert sorted(i for n, i in found if n == "convex") == [1, 2, 3]
    assert set(v for (n, _), v in found.items() if n == "convex") == {0.0}
    assert (found["upper_bound", 4], found["lower_bound", 0]) == (0.0, -2.0)
    with pytest.raises(ValueError, match="relation"):
        Prior("bad", ((0.0, 1.0),), "<")
    with pytest.raises(ValueError, match="name"):
        prior_residuals(points, lambda x: x, [convex(1.0), convex(2.0)])


def test_report_against_pandas(spark):
    rows = [(1.0, 1.5, 2.0, 0), (2.0, 1.0, None, 0), (3.0, 5.0, 3.0, 1), (None, 1.0, 1.0, 1), (4.0, 4.0, 5.0, None)]
    df = spark.createDataFrame(rows, "y double, a double, b double, h int")
    found = {r["model"]: r for r in generalization_report(df, {"A": "a", "B": "b"}, "y", F.col("h") == 0).collect()}
    a = found["A"]
    assert (a["n"], a["n_train"], a["n_dropped"]) == (2, 1, 2)
    assert (a["rmse"], a["mae"], a["bias"]) == (pytest.approx(np.sqrt((0.25 + 1) / 2)), 0.75, -0.25)
    assert a["rmse_train"] == 2.0 and a["gap"] == pytest.approx(a["rmse"] - 2.0)
    assert (found["B"]["n"], found["B"]["n_dropped"]) == (1, 3)


def test_holdouts(iv_panel):
    share = iv_panel.agg(F.avg(holdout_fold("unit_id", 5, 2).cast("int"))).first()[0]
    assert 0.18 < share < 0.22
    folds = [holdout_fold("unit_id", 3, i).cast("int") for i in range(3)]
    assert iv_panel.filter(sum(folds[1:], folds[0]) != 1).count() == 0
    n = iv_panel.filter(holdout_segments("segment", ["FURNITURE"])).select("segment").distinct().count()
    assert n == 1
    assert iv_panel.filter(holdout_from("assign_ts", "1998-01-01")).agg(F.min("assign_ts")).first()[0].year == 1998
    assert iv_panel.filter(holdout_range("acctbal", 0, 10)).agg(F.max("acctbal")).first()[0] <= 10


def test_net_prior(dose_panel, train, points):
    """From existing weights: a true assumption does no harm, a false one must show as worse."""
    panel, sample = (d.filter("segment = 'N'") for d in (dose_panel, train))
    at = points.filter("segment = 'N'")
    start = recu_net_fit(sample, "dose", None, "y")

    def error(net):
        held = recu_net_predict(panel.filter("order_key % 50 <> 0"), net)
        return held.agg(F.sqrt(F.avg((F.col("pred") - F.col("truth")) ** 2))).first()[0]

    same = prior_net_fit(sample, at, "dose", None, "y", [third_difference(H)], 0.0, init=start)
    assert error(same) == pytest.approx(error(start), rel=0.05)
    true = prior_net_fit(sample, at, "dose", None, "y", [third_difference(H)], 1e5, init=start)
    assert error(true) < error(start) * 1.1
    false = prior_net_fit(sample, at, "dose", None, "y", [upper_bound(25.0)], 100.0, init=start)
    assert error(false) > 5 * error(start)
    worst = recu_net_predict(at, false).agg(F.max("pred")).first()[0]
    assert worst < 27


def test_net_prior_on_a_scaled_start(spark, dose_panel, points):
    """Weights learned on one table stay in their scale on another."""
    panel = dose_panel.filter("segment = 'A'")
    start = recu_net_fit(panel.filter("dose < 0.05"), "dose", None, "y", iters=10)
    net = prior_net_fit(panel, points.filter("segment = 'A'"), "dose", None, "y", [convex(H)], 1.0, init=start, iters=10)
    assert net.scales == start.scales and net.loss < 40
