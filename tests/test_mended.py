"""Incomplete numbers, odd times, many values, and what a fit leaves behind."""

import datetime as dt
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from subvent.functions.checks import complete
from subvent.operators.causal import bins
from subvent.operators.causal.draws import Draws, honest_draws
from subvent.operators.causal.effect import iv_effect
from subvent.operators.causal.forest import IVForest, iv_forest_fit, iv_forest_predict
from subvent.operators.causal.panel import assignment_report, experiment_panel
from subvent.operators.causal.residuals import cross_fit_residuals
from subvent.operators.causal.split import iv_split
from subvent.operators.prior.curve import prior_curve_fit
from subvent.operators.prior.priors import collocation_points, increasing, upper_bound
from subvent.operators.prior.report import generalization_report
from subvent.operators.shape import audit
from subvent.operators.shape.basis import CurveBasis
from subvent.operators.shape.curve import shape_curve_fit
from subvent.operators.shape.gram import COUNTS, gram
from subvent.operators.shape.net import RecuNet, recu_net_fit
from subvent.operators.shape.solve import Penalties, solve_penalised, solve_signed_status
from subvent.sources import staging
from subvent.sources.fixtures import KNOTS, fixture_draw

ODD = [None, float("nan"), float("inf"), float("-inf")]


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(0)
    n = 3000
    z, u, x = rng.integers(0, 2, n), rng.random(n), rng.random(n)
    w = ((z == 1) & (u > 0.3) | (z == 0) & (u > 0.8)).astype(float)
    y = w * np.where(x > 0.5, 30, 10) + 20 * u
    rows = [(i, float(z[i]), float(w[i]), float(y[i]), float(x[i]), f"v{i % 700}") for i in range(n)]
    return spark.createDataFrame(rows, "unit_id bigint, z double, w double, y double, x double, city string")


def spoilt(spark, panel, column):
    """The panel with a row for each odd value of one column added."""
    rows = [tuple(v if c == column else {"unit_id": 10_000 + i, "city": "v0"}.get(c, 1.0) for c in panel.columns) for i, v in enumerate(ODD)]
    return panel.unionByName(spark.createDataFrame(rows, panel.schema))


def test_complete(spark):
    rows = spark.createDataFrame([(v, 1, True) for v in [0.0, *ODD]], "a double, b int, c boolean")
    assert [r[0] for r in rows.select(complete(["a", "b", "c"])).collect()] == [True, False, False, False, False]


@pytest.mark.parametrize("column", ["z", "w", "y"])
def test_odd_numbers_change_nothing(spark, panel, column):
    odd = spoilt(spark, panel, column)
    clean, found = iv_effect(panel, "z", "w", "y").first().asDict(), iv_effect(odd, "z", "w", "y").first().asDict()
    assert found.pop("n_dropped") == 4 and clean.pop("n_dropped") == 0
    assert {k: v for k, v in found.items() if k != "status"} == pytest.approx({k: v for k, v in clean.items() if k != "status"})
    a, b = (iv_forest_fit(p, "z", "w", "y", ["x"], trees=4, depth=2) for p in (panel, odd))
    assert (b.n_rows, b.n_dropped) == (3000, 4)
    assert [tuple(r)[:4] for r in a.splits.collect()] == [tuple(r)[:4] for r in b.splits.collect()]
    effects = iv_forest_predict(odd, b).select("effect", "effect_status").collect()
    assert {r["effect_status"] for r in effects} == {"ok"} and all(np.isfinite(r["effect"]) for r in effects)
    sums = {(r["i"], r["j"]): r["value"] for r in gram(odd, ["z", "w"], "y").collect()}
    assert (sums[COUNTS, 0], sums[COUNTS, 1]) == (3000, 4) and all(np.isfinite(v) for v in sums.values())
    if column == "y":
        report = generalization_report(odd, {"m": "w"}, "y", F.col("unit_id") % 2 == 0).first()
        assert report["n_dropped"] == 4 and np.isfinite(report["rmse"])


def test_rows_without_a_unit(spark, panel):
    half = panel.withColumn("unit_id", F.when(F.col("unit_id") % 2 == 0, F.col("unit_id")))
    for draws in (Draws(4), Draws(4, formula=fixture_draw, draw_range=65536)):
        model = iv_forest_fit(half, "z", "w", "y", ["x"], depth=2, draws=draws)
        assert (model.n_rows, model.n_dropped) == (1500, 1500)
        scored = iv_forest_predict(half, model, oob=True)
        assert {tuple(r) for r in scored.filter("unit_id IS NULL").select("n_trees", "effect_status").collect()} == {(0, "no_tree")}
        roles = honest_draws(half, "unit_id", 4, draws=draws)
        assert {r["role"] for r in roles.filter("unit_id IS NULL").collect()} == {None}
        assert {r["role"] for r in roles.filter("unit_id IS NOT NULL").collect()} == {"out", "split", "leaf"}
    found = cross_fit_residuals(half, ["y"], ["z"], k=2)
    assert found.filter("unit_id IS NULL AND (fold IS NOT NULL OR y_res IS NOT NULL)").isEmpty()
    assert found.filter("unit_id IS NOT NULL AND y_res IS NULL").isEmpty() and found.count() == 3000


def test_loading_without_the_formula(spark, panel, tmp_path):
    draws = Draws(4, formula=fixture_draw, draw_range=65536)
    model = iv_forest_fit(panel, "z", "w", "y", ["x", "city"], depth=2, draws=draws)
    model.save(str(tmp_path / "forest"))
    blind = IVForest.load(spark, str(tmp_path / "forest"))
    assert iv_forest_predict(panel, blind).count() == 3000
    with pytest.raises(ValueError, match="formula"):
        iv_forest_predict(panel, blind, oob=True)
    blind.save(str(tmp_path / "again"))
    assert not IVForest.load(spark, str(tmp_path / "again")).draws_known
    known = IVForest.load(spark, str(tmp_path / "forest"), fixture_draw)
    assert known.bins == model.bins
    columns = ["unit_id", "effect", "n_trees"]
    a, b = (sorted(map(tuple, iv_forest_predict(panel, m, oob=True).select(*columns).collect())) for m in (model, known))
    assert a == b


def test_a_fit_leaves_no_tables(spark, panel):
    before = {p: len(v) for p, v in staging._written.items()}
    folder = staging.shared_folder(spark).removeprefix("file:")
    there = set(os.listdir(folder))
    model = iv_forest_fit(panel, "z", "w", "y", ["x", "city"], trees=4, depth=2, merge=True)
    assert {p: len(v) for p, v in staging._written.items()} == before
    assert set(os.listdir(folder)) == there
    assert model.splits.count() and iv_forest_predict(panel, model).filter("effect IS NULL").isEmpty()


def test_scoring_out_of_bag_with_many_trees(spark, panel):
    model = iv_forest_fit(panel, "z", "w", "y", ["x"], trees=500, depth=3)
    rows = panel.repartition(8).cache()
    rows.count()

    def seconds(oob):
        out = []
        for _ in range(3):
            start = time.perf_counter()
            iv_forest_predict(rows, model, oob=oob).write.format("noop").mode("overwrite").save()
            out.append(time.perf_counter() - start)
        return min(out)

    assert seconds(True) < 3 * seconds(False) + 1.0
    r = iv_forest_predict(rows, model, oob=True).agg(F.avg("n_trees")).first()[0]
    assert 225 < r < 275


def test_many_values_of_a_text_column(spark, panel):
    binned, found = bins.bin_features(panel, ["city", "x"], n_bins=8)
    assert [f.hashed for f in found.features] == [True, False]
    per_city = binned.groupBy("city").agg(F.count_distinct(F.get("bins", F.lit(0))).alias("n"))
    assert per_city.filter("n > 1").isEmpty()
    shares = [r["count"] for r in binned.groupBy(F.get("bins", F.lit(0))).count().collect()]
    assert len(shares) == 8 and min(shares) > 3000 / 16
    assert bins.FeatureBins.from_df(found.to_df(spark)) == found
    _, few = bins.bin_features(panel.filter("unit_id < 5"), ["city", "x"])
    assert [f.level for f in few.features] == ["v0", "v1", "v2", "v3", "v4", None]


def test_split_rule_goes_by_the_nodes_own_mean(spark):
    """One tree on an instrument of many values is what splitting node by node gives."""
    rng = np.random.default_rng(2)
    n = 4000
    x1, x2 = rng.random(n), rng.random(n)
    z = rng.normal(size=n) + 4 * (x1 > 0.5)  # in each child, all z on one side of the overall mean
    w = 0.5 * z + rng.normal(size=n)
    y = w * np.where(x2 > 0.3, 5, 1) * np.where(x1 > 0.5, 2, 1) + rng.normal(size=n)
    rows = [(i, *map(float, (z[i], w[i], y[i], x1[i], x2[i]))) for i in range(n)]
    panel = spark.createDataFrame(rows, "unit_id bigint, z double, w double, y double, x1 double, x2 double")
    even = Draws(1, 1.0, formula=lambda unit, tree: unit * 0, draw_range=2)  # all units find splits
    edges = {"x1": [0.25, 0.5, 0.75], "x2": [0.15, 0.3, 0.6]}
    model = iv_forest_fit(panel, "z", "w", "y", ["x1", "x2"], depth=3, min_leaf=50, edges=edges, draws=even)
    rows, _ = bins.bin_features(panel, ["x1", "x2"], edges=edges)
    rows = rows.withColumn("tree", F.lit(1)).withColumn("node", F.lit(1).cast("bigint"))
    expected = []
    for _ in range(3):
        best = iv_split(rows, "z", "w", "y", min_leaf=50).collect()
        expected += [(r["node"], r["feature"], r["bin"]) for r in best]
        at = {r["node"]: (r["feature"], r["bin"]) for r in best}
        node = F.lit(None).cast("bigint")
        for k, (feature, cut) in at.items():
            child = F.col("node") * 2 + (F.get("bins", F.lit(feature)) > cut).cast("bigint")
            node = F.when(F.col("node") == k, child).otherwise(node)
        rows = rows.withColumn("node", node).filter("node IS NOT NULL")
    found = sorted((r["node"], r["feature"], r["bin"]) for r in model.splits.collect())
    assert found == sorted(expected) and len(found) > 3
    with pytest.raises(ValueError, match="merged"):
        iv_forest_fit(panel, "z", "w", "y", ["x1"], trees=2, merge=True)


# times


def panel_of(spark, kind, assignment, records, window):
    a = spark.createDataFrame(assignment, f"unit long, ts {kind}, z int")
    i = spark.createDataFrame(records, f"unit long, ts {kind}, amount double")
    found = experiment_panel(a, i, i.withColumnRenamed("amount", "value"), "unit", "ts", F.expr(window))
    return {r["unit"]: (r["w"], r["y"]) for r in found.collect()}


def test_days_and_a_window_of_hours(spark):
    day = dt.date(2024, 3, 1)
    records = [(1, day + dt.timedelta(days=1), 7.0), (1, day + dt.timedelta(days=2), 9.0)]
    assert panel_of(spark, "date", [(1, day, 1)], records, "INTERVAL '36' HOUR") == {1: (1, 7.0)}


@pytest.fixture
def new_york(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_a_window_that_ends_in_the_repeated_hour(spark, new_york):
    """Clocks go back at 06:00Z on 3 November 2024: 05:30Z and 06:30Z are both half past one."""
    at = lambda text: F.to_timestamp(F.lit(text))
    a = spark.range(1).select(F.lit(1).alias("unit"), at("2024-11-03T05:30:00Z").alias("ts"), F.lit(1).alias("z"))
    i = spark.range(1).select(F.lit(1).alias("unit"), at("2024-11-03T06:00:00Z").alias("ts"), F.lit(7.0).alias("amount"))
    found = experiment_panel(a, i, i.withColumnRenamed("amount", "value"), "unit", "ts", F.expr("INTERVAL '1' HOUR")).first()
    assert (found["w"], found["y"]) == (1, 7.0)


def test_assignment_report(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(1, day, 0), (1, day, 1), (2, day, 1), (2, day, 1), (3, day, 1), (4, day + dt.timedelta(1), 0), (4, day, 1), (None, day, 1), (5, None, 1)]
    a = spark.createDataFrame(rows, "unit long, ts timestamp_ntz, z int")
    assert assignment_report(a, "unit", "ts").first().asDict() == {"n_rows": 9, "n_dropped": 2, "n_units": 4, "n_repeated": 3, "n_conflicts": 1}
    assert assignment_report(a.filter("false"), "unit", "ts").first().asDict() == {"n_rows": 0, "n_dropped": 0, "n_units": 0, "n_repeated": 0, "n_conflicts": 0}


# curves and nets


def test_curves_scale_with_the_outcome(spark):
    rng = np.random.default_rng(1)
    x = rng.random(400)
    y = 20 + 300 * np.maximum(x - 0.3, 0) ** 2 + rng.normal(size=400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y, strict=True)], "x double, y double")
    base = None
    for scale in (1.0, 1e-15, 1e-12, 1e9):
        row = shape_curve_fit(df.withColumn("y", F.col("y") * scale), "x", "y", knots=(0.0, 0.3, 0.6)).table.first()
        coef = np.asarray(row["coef"]) / scale
        base = coef if base is None else base
        assert row["status"] == "ok" and np.allclose(coef, base, rtol=1e-6, atol=1e-6 * np.abs(base).max())


def test_random_segments_settle():
    """The minimum of the convex loss, found by descent along its own gradient from the answer: nothing is left."""
    grid = np.arange(41) * 0.0025
    terms = lambda x: np.column_stack([np.ones_like(x), x] + [np.maximum(x - t, 0) ** 2 for t in KNOTS])
    rng = np.random.default_rng(3)
    for k in range(300):
        x = rng.random(400) * 0.1
        y = 20 + rng.normal() * 300 * x + rng.normal() * 4000 * x * x + 6 * rng.normal(size=400)
        a = terms(x)
        g, b = a.T @ a / 400, a.T @ y / 400
        at, rise = terms(grid), terms(grid[1:]) - terms(grid[:-1])
        lam = 1e4 if k % 2 else 1e6
        both = np.vstack([at, rise]) if k % 3 == 0 else at
        side = np.concatenate([np.full(41, -1), np.ones(40, int)])[: len(both)]
        target = np.where(side < 0, 25.0, 0.0)
        penalties = Penalties(both, target, lam * np.where(side < 0, 1 / 41, 1 / 40), side)
        signs = CurveBasis(KNOTS, 2, "free").signs
        c, done = solve_penalised(g, b, signs, penalties)
        assert done
        miss = both @ c - target
        some = side * miss < 0
        slope = g @ c - b + both[some].T @ (penalties.weight[some] * miss[some])
        size = np.abs(g) @ np.abs(c) + np.abs(b) + np.abs(both[some]).T @ (penalties.weight[some] * (np.abs(both[some]) @ np.abs(c) + np.abs(target[some])))
        assert (np.abs(slope) <= 1e-9 * size).all()


def test_a_search_that_cannot_end_says_so():
    g = np.eye(2)
    assert solve_signed_status(g, np.zeros(2), [1, 1])[1]
    c, done = solve_signed_status(g, np.array([-1.0, 2.0]), [1, 1])
    assert done and c.tolist() == [0.0, 2.0]


def test_one_bad_segment_harms_no_other(spark, dose_panel):
    train = dose_panel.filter("order_key % 50 = 0").select("segment", "dose", "y")
    odd = spark.createDataFrame([("none", 0.01, None)], train.schema)
    points = collocation_points(dose_panel.select("segment", "dose").unionByName(odd.select("segment", "dose")), "dose", ["segment"], 41, 0.0, 0.1)
    found = prior_curve_fit(train.unionByName(odd), "dose", "y", ["segment"], KNOTS, [upper_bound(25.0), increasing(0.0025)], 1e6, points)
    status = {r["segment"]: r["status"] for r in found.table.collect()}
    assert status == {"A": "ok", "N": "ok", "R": "ok", "none": "no_rows"}


def test_audit_of_many_slices(spark):
    n = 3000
    rng = np.random.default_rng(4)
    x = np.sort(rng.random(n))
    p = x * x
    p[1500] -= 1e-3
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, p, strict=True)] + [(0.5, float("nan")), (float("nan"), 1.0)], "x double, p double")
    few, many = (audit.shape_audit(df, "p", "x", slices=s).first() for s in (2, 700))
    assert few == many and few["points"] == n and few["bend_breaches"] > 0


def test_net_says_whether_it_converged_and_keeps_it(spark, dose_panel, tmp_path):
    short = recu_net_fit(dose_panel, "dose", None, "y", hidden=2, iters=1)
    assert short.status == "not_converged"
    net = recu_net_fit(dose_panel, "dose", None, "y", hidden=2, iters=200)
    assert net.status == "converged"
    net.save(str(tmp_path / "net"))
    assert RecuNet.load(spark, str(tmp_path / "net")) == net


# weights


def test_a_weight_counts_as_so_many_rows(spark, panel):
    weighted = panel.withColumn("n", 1 + F.col("unit_id") % 3)
    repeated = weighted.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    none = [weighted.limit(3).withColumn("n", F.lit(v).cast("bigint")) for v in (None, 0, -1)]
    for more in none:
        weighted = weighted.unionByName(more.withColumn("unit_id", F.col("unit_id") + 50_000))
    for by in ([], ["z"]):
        a = iv_effect(weighted, "z", "w", "y", by, weight="n").drop("n_dropped").orderBy("n").collect()
        b = iv_effect(repeated, "z", "w", "y", by).drop("n_dropped").orderBy("n").collect()
        for x, y in zip(a, b, strict=True):
            assert x.asDict() == pytest.approx(y.asDict())
    assert iv_effect(weighted, "z", "w", "y", weight="n").first()["n_dropped"] == 9
    settings = dict(trees=3, depth=3, edges={"x": [0.2, 0.4, 0.6, 0.8]}, min_leaf=40)
    for merge in (False, True):
        a = iv_forest_fit(weighted, "z", "w", "y", ["x"], weight="n", merge=merge, **settings)
        b = iv_forest_fit(repeated, "z", "w", "y", ["x"], merge=merge, **settings)
        assert [tuple(r)[:4] for r in a.splits.collect()] == [tuple(r)[:4] for r in b.splits.collect()]
        for x, y in zip(a.leaves.orderBy("tree", "node").collect(), b.leaves.orderBy("tree", "node").collect(), strict=True):
            assert x["n"] == y["n"]
        assert a.n_dropped == 9
    a, b = (
        {r["unit_id"]: r["y_res"] for r in cross_fit_residuals(p, ["y"], ["z"], k=3, **({"weight": "n"} if p is weighted else {})).collect()}
        for p in (weighted, repeated)
    )
    for unit, value in b.items():
        assert a[unit] == pytest.approx(value)
    assert sum(v is None for v in a.values()) == 3  # three rows each share an id
    rf = cross_fit_residuals(weighted, ["y"], ["x"], k=2, method="rf", trees=2, depth=2, weight="n")
    assert rf.filter("y_res IS NULL").count() == 9


def test_weighted_split(spark, panel):
    rows, _ = bins.bin_features(panel, ["x"], edges={"x": [0.2, 0.4, 0.6, 0.8]})
    rows = rows.withColumn("tree", F.lit(1)).withColumn("node", F.col("unit_id") % 2).withColumn("n", 1 + F.col("unit_id") % 3)
    a = iv_split(rows, "z", "w", "y", weight="n").orderBy("node").collect()
    b = iv_split(rows.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))), "z", "w", "y").orderBy("node").collect()
    assert [tuple(r)[:4] + tuple(r)[5:] for r in a] == [tuple(r)[:4] + tuple(r)[5:] for r in b]
    assert [r["gain"] for r in a] == pytest.approx([r["gain"] for r in b])
