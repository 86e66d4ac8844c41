import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subvent.functions.activation import recu, recu_slope
from subvent.operators.prior.priors import collocation_points
from subvent.operators.shape.audit import shape_audit
from subvent.operators.shape.basis import SHAPES, CurveBasis, recu_basis
from subvent.operators.shape.curve import curve_predict, shape_curve_fit
from subvent.operators.shape.gram import COUNTS, gram
from subvent.operators.shape.net import RecuNet, forward, recu_net_fit, recu_net_predict
from subvent.operators.shape.solve import solve_signed
from subvent.sources.fixtures import KNOTS


def worst_to_truth(scored):
    rows = scored.groupBy("segment").agg(F.max(F.abs(F.col("pred") - F.col("truth"))).alias("e")).collect()
    return {r["segment"]: r["e"] for r in rows}


def held_out_rmse(scored, pred="pred"):
    held = scored.filter("order_key % 50 <> 0")
    rows = held.groupBy("segment").agg(F.sqrt(F.avg((F.col(pred) - F.col("truth")) ** 2)).alias("e")).collect()
    return {r["segment"]: r["e"] for r in rows}


def test_recu(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (3.0,), (None,)], "x double")
    rows = df.select(recu(F.col("x")), recu(F.col("x"), 1.5), recu_slope(F.col("x"), 3)).collect()
    assert [r[0] for r in rows] == [0.0, 0.0, 9.0, None]
    assert rows[2][1] == pytest.approx(3**1.5) and rows[3][1] is None
    assert [r[2] for r in rows] == [0.0, 0.0, 27.0, None]
    for power in (1, 0.5):
        with pytest.raises(ValueError, match="power"):
            recu(F.col("x"), power)


def test_basis_mirrors_for_concave(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (None,)], "x double")
    up = recu_basis(df, "x", [2.0, 3.0]).collect()
    down = recu_basis(df, "x", [2.0, 3.0], shape="concave").collect()
    assert [tuple(r)[1:] for r in up] == [(1, 1, 0, 0), (1, 4, 4, 1), (None,) * 4]
    assert [tuple(r)[1:] for r in down[:2]] == [(1, 1, 1, 4), (1, 4, 0, 0)]
    with pytest.raises(ValueError, match="shape"):
        CurveBasis((1.0,), 2, "round")


@pytest.mark.parametrize("weighted", [False, True])
def test_gram_against_numpy(spark, weighted):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 3))
    rows = [("a", *map(float, r[:2]), float(r[2]), float(abs(r[0]))) for r in x] + [("a", None, 1.0, 1.0, 1.0), ("b", 1.0, 2.0, None, 1.0)]
    df = spark.createDataFrame(rows, "g string, p double, q double, y double, w double")
    found = gram(df, ["p", "q"], "y", ["g"], "w" if weighted else None)
    values = {(r["g"], r["i"], r["j"]): r["value"] for r in found.collect()}
    full = x.T @ (x * np.abs(x[:, :1])) if weighted else x.T @ x
    for i in range(3):
        for j in range(i, 3):
            assert values["a", i, j] == pytest.approx(full[i, j])
    assert (values["a", COUNTS, 0], values["a", COUNTS, 1]) == (50, 1)
    assert (values["b", COUNTS, 0], values["b", COUNTS, 1], values["b", 0, 0]) == (0, 1, 0)


def test_signed_solve_against_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(60):
        k = rng.integers(2, 6)
        x = rng.normal(size=(12, k)) + rng.normal(size=(12, 1))
        y = rng.normal(size=12)
        signs = rng.choice([-1, 0, 1], size=k).tolist()
        best = np.inf
        for mask in range(2**k):
            on = [i for i in range(k) if signs[i] == 0 or mask >> i & 1]
            c = np.zeros(k)
            if on:
                c[on] = np.linalg.lstsq(x[:, on], y, rcond=None)[0]
            if all(s * v >= 0 for s, v in zip(signs, c)):
                best = min(best, ((y - x @ c) ** 2).sum())
        c = solve_signed(x.T @ x, x.T @ y, signs)
        assert all(s * v >= 0 for s, v in zip(signs, c))
        assert ((y - x @ c) ** 2).sum() == pytest.approx(best, rel=1e-8)


def test_published_errors_of_the_shape_fit(dose_panel):
    curves = shape_curve_fit(dose_panel, "dose", "y", ["segment"], KNOTS)
    found = worst_to_truth(curve_predict(dose_panel, curves))
    assert {s: round(e, 3) for s, e in found.items()} == {"A": 0.175, "N": 0.217, "R": 0.012}


@pytest.mark.parametrize("shape", sorted(set(SHAPES) - {"free"}))
@pytest.mark.parametrize("power", [2, 1.5, 3])
def test_every_shape_holds_beyond_the_data(dose_panel, shape, power):
    train = dose_panel.filter("order_key % 50 = 0")
    curves = shape_curve_fit(train, "dose", "y", ["segment"], KNOTS, shape, power)
    grid = collocation_points(dose_panel, "dose", ["segment"], 101, -0.1, 0.3)
    for row in shape_audit(curve_predict(grid, curves), "pred", "dose", ["segment"], shape).collect():
        assert (row["points"], row["slope_breaches"], row["bend_breaches"]) == (101, 0, 0)


def test_the_free_fit_breaks_the_shape(dose_panel):
    train = dose_panel.filter("order_key % 50 = 0")
    curves = shape_curve_fit(train, "dose", "y", ["segment"], KNOTS, "free")
    audit = shape_audit(curve_predict(dose_panel, curves), "pred", "dose", ["segment"]).collect()
    assert sum(r["bend_breaches"] for r in audit) > 0


def test_doubled_rows_and_weights(dose_panel):
    one = shape_curve_fit(dose_panel, "dose", "y", ["segment"], KNOTS).table.orderBy("segment").collect()
    two = shape_curve_fit(dose_panel.union(dose_panel), "dose", "y", ["segment"], KNOTS).table.orderBy("segment").collect()
    weighted = dose_panel.withColumn("weight", F.lit(2.0))
    three = shape_curve_fit(weighted, "dose", "y", ["segment"], KNOTS, weight="weight").table.orderBy("segment").collect()
    for a, b, c in zip(one, two, three):
        assert a["coef"] == pytest.approx(b["coef"], abs=1e-4) and a["coef"] == pytest.approx(c["coef"], abs=1e-4)


def test_curve_edges(spark, dose_panel):
    rows = [("a", 0.01, 1.0), ("a", 0.02, 2.0), ("b", 0.05, None)]
    df = spark.createDataFrame(rows, "segment string, dose double, y double")
    curves = shape_curve_fit(df, "dose", "y", ["segment"], [0.0, 5.0])
    status = {r["segment"]: (r["status"], r["n"], r["n_dropped"]) for r in curves.table.collect()}
    assert status == {"a": ("few_rows", 2, 0), "b": ("no_rows", 0, 1)}
    coef = curves.table.filter("segment = 'a'").first()["coef"]
    assert coef[3] == 0.0  # no data beyond that knot
    scored = curve_predict(spark.createDataFrame([("a", 0.02), ("zzz", 0.02), (None, 0.1)], "segment string, dose double"), curves)
    preds = {r["segment"]: r["pred"] for r in scored.collect()}
    assert preds["a"] is not None and preds["zzz"] is None and preds[None] is None
    empty = shape_curve_fit(df.limit(0), "dose", "y", ["segment"], [0.0])
    assert empty.table.count() == 0
    single = shape_curve_fit(dose_panel, "dose", "y", [], KNOTS)
    assert curve_predict(dose_panel, single).filter("pred IS NULL").count() == 0


def test_curves_attach_without_broadcast(dose_panel):
    curves = shape_curve_fit(dose_panel, "dose", "y", ["segment"], KNOTS)
    sums = [
        curve_predict(dose_panel, curves, broadcast_rows=limit).agg(F.count("pred"), F.sum("pred")).first()
        for limit in (100, 0)
    ]
    assert sums[0][0] == sums[1][0] and sums[0][1] == pytest.approx(sums[1][1])


def brute_audit(points, slope_sign, bend_sign, tol=1e-9):
    xs = sorted(points)
    d1 = [(points[b] - points[a]) / (b - a) for a, b in zip(xs, xs[1:])]
    d2 = [(d1[i + 1] - d1[i]) / (xs[i + 2] - xs[i]) for i in range(len(d1) - 1)]
    slope, bend = [-slope_sign * d for d in d1], [-bend_sign * d for d in d2]
    return len(xs), sum(s > tol for s in slope), sum(b > tol for b in bend), max([0.0, *slope, *bend])


@pytest.mark.parametrize("slices", [1, 7, 60, None])
def test_audit_against_brute_force(spark, slices):
    """A segment with a third of the points in a narrow range, and tiny segments."""
    rng = random.Random(5)
    segments = {"wide": 200, "narrow": 120, "two": 2, "one": 1}
    data = {s: {(rng.random() if s != "narrow" else 0.5 + rng.random() / 1e3): rng.random() for _ in range(n)} for s, n in segments.items()}
    df = spark.createDataFrame([(s, x, p) for s, d in data.items() for x, p in d.items()], "s string, x double, p double")
    found = {r["s"]: tuple(r)[1:] for r in shape_audit(df, "p", "x", ["s"], "concave_increasing", slices=slices).collect()}
    for s, points in data.items():
        expected = brute_audit(points, 1, -1)
        assert found[s][:3] == expected[:3] and found[s][3] == pytest.approx(expected[3])
    whole = shape_audit(df, "p", "x", [], "convex", slices=slices).first()
    merged = {x: p for d in data.values() for x, p in d.items()}
    assert tuple(whole)[:3] == brute_audit(merged, 0, 1)[:3]


def test_audit_averages_first(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 3.0), (1.0, 2.5), (2.0, None), (None, 1.0)], "x double, p double")
    row = shape_audit(df, "p", "x", [], "convex_increasing").first()
    assert (row["points"], row["slope_breaches"], row["worst"]) == (2, 0, 0.0)


def test_net_jacobian_against_differences():
    rng = np.random.default_rng(2)
    theta = rng.normal(size=13)
    s, t = rng.random(5), rng.random(5)
    _, jacobian = forward(theta, 2, s, t)
    for i in range(13):
        step = np.zeros(13)
        step[i] = 1e-6
        slope = (forward(theta + step, 2, s, t)[0] - forward(theta - step, 2, s, t)[0]) / 2e-6
        assert jacobian[:, i] == pytest.approx(slope, abs=1e-6)


@pytest.mark.parametrize("segment", ["A", "N", "R"])
def test_net_fits_and_keeps_its_shape(spark, dose_panel, segment):
    panel = dose_panel.filter(F.col("segment") == segment)
    net = recu_net_fit(panel, "dose", None, "y")
    scored = recu_net_predict(panel, net)
    assert worst_to_truth(scored)[segment] < 0.5
    grid = collocation_points(panel, "dose", [], 81, -0.05, 0.2)
    audit = shape_audit(recu_net_predict(grid, net), "pred", "dose").first()
    assert (audit["slope_breaches"], audit["bend_breaches"]) == (0, 0)
    again = RecuNet.from_df(net.to_df(spark), net.power, "dose", None, net.scales)
    assert recu_net_predict(panel, again).agg(F.sum("pred")).first()[0] == pytest.approx(
        scored.agg(F.sum("pred")).first()[0], rel=1e-12
    )


def test_net_with_a_free_input_and_without_merging(spark):
    rng = np.random.default_rng(3)
    x, t = rng.random(400), rng.random(400)
    y = 3 * x**2 + (t - 0.5) ** 2 + x
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(x, t, y)] + [(None, 0.1, 1.0)], "x double, t double, y double")
    net = recu_net_fit(df, "x", "t", "y", iters=60)
    assert (net.n, net.n_dropped) == (400, 1)
    assert net.loss < 0.01 * y.var()
    scored = recu_net_predict(df, net).collect()
    assert scored[-1]["pred"] is None or any(r["x"] is None and r["pred"] is None for r in scored)
    python, _ = forward(np.asarray(net.theta), 2, (x - net.scales[0]) / net.scales[1], (t - net.scales[2]) / net.scales[3])
    spark_values = sorted(r["pred"] for r in scored if r["x"] is not None)
    assert spark_values == pytest.approx(sorted(python * net.scales[5] + net.scales[4]))
    # more passes from where it stopped do not make it worse
    assert recu_net_fit(df, "x", "t", "y", iters=3, init=net).loss <= net.loss * (1 + 1e-9)


def test_net_needs_rows(spark):
    with pytest.raises(ValueError, match="no row"):
        recu_net_fit(spark.createDataFrame([], "x double, y double"), "x", None, "y")


def test_saved_models_score_the_same(spark, dose_panel, tmp_path):
    from subvent.operators.shape.curve import ShapeCurves

    curves = shape_curve_fit(dose_panel, "dose", "y", ["segment"], KNOTS, "convex", 1.5)
    curves.save(str(tmp_path / "curves"))
    net = recu_net_fit(dose_panel, "dose", None, "y", iters=3)
    net.save(str(tmp_path / "net"))
    pairs = [
        (curve_predict(dose_panel, m), curve_predict(dose_panel, ShapeCurves.load(spark, str(tmp_path / "curves"))))
        for m in [curves]
    ] + [(recu_net_predict(dose_panel, net), recu_net_predict(dose_panel, RecuNet.load(spark, str(tmp_path / "net"))))]
    for a, b in pairs:
        assert a.agg(F.sum("pred")).first()[0] == pytest.approx(b.agg(F.sum("pred")).first()[0], rel=1e-12)
