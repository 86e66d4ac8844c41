"""Nets per segment and weighted nets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from subvent import RecuNet, RecuNets, collocation_points, prior_net_fit, recu_net_fit, recu_net_predict, shape_audit
from subvent.functions.activation import recu_growth
from subvent.operators.prior.priors import third_difference, upper_bound
from subvent.operators.shape import nets
from subvent.operators.shape.net import forward
from subvent.sources.staging import stage


def same(one, two, tolerance=1e-6):
    return np.allclose(one, two, rtol=tolerance, atol=tolerance)


@pytest.mark.parametrize("block, numbers", [(4096, 5_000_000), (4, 0)])
def test_each_segment_is_fitted_as_if_alone(spark, dose_panel, monkeypatch, block, numbers):
    monkeypatch.setattr(nets, "BLOCK", block)
    monkeypatch.setattr(nets, "BROADCAST_NUMBERS", max(numbers, 1))
    found = recu_net_fit(dose_panel, "dose", None, "y", hidden=3, iters=6, by=["segment"])
    rows = {r["segment"]: r for r in found.table.collect()}
    assert set(rows) == {"A", "N", "R"}
    for segment, r in rows.items():
        alone = recu_net_fit(dose_panel.filter(F.col("segment") == segment), "dose", None, "y", hidden=3, iters=6)
        assert same(r["theta"], alone.theta) and same(r["scales"], alone.scales)
        assert (r["n"], r["n_dropped"], r["passes"], r["status"]) == (alone.n, alone.n_dropped, alone.passes, alone.status)
        assert r["loss"] == pytest.approx(alone.loss)
        a = recu_net_predict(dose_panel.filter(F.col("segment") == segment), found).agg(F.sum("pred")).first()[0]
        assert a == pytest.approx(recu_net_predict(dose_panel.filter(F.col("segment") == segment), alone).agg(F.sum("pred")).first()[0])


def test_priors_per_segment_as_if_alone(spark, dose_panel):
    points = collocation_points(dose_panel, "dose", ["segment"], 21, 0.0, 0.1)
    priors = [third_difference(0.005), upper_bound(40.0, weight=0.5)]
    settings = {"hidden": 2, "iters": 5}
    found = prior_net_fit(dose_panel, points, "dose", None, "y", priors, 10.0, by=["segment"], **settings)
    for r in found.table.collect():
        own = F.col("segment") == r["segment"]
        alone = prior_net_fit(dose_panel.filter(own), points.filter(own), "dose", None, "y", priors, 10.0, **settings)
        assert same(r["theta"], alone.theta) and r["loss"] == pytest.approx(alone.loss)


def test_warm_starts_save_and_load(spark, dose_panel, tmp_path):
    first = recu_net_fit(dose_panel, "dose", None, "y", hidden=2, iters=2, by=["segment"])
    first.save(str(tmp_path / "nets"))
    again = RecuNets.load(spark, str(tmp_path / "nets"))
    assert again.by == ("segment",) and again.hidden == 2
    more = recu_net_fit(dose_panel, "dose", None, "y", iters=3, init=again, by=["segment"])
    before = {r["segment"]: r for r in first.table.collect()}
    for r in more.table.collect():
        assert r["loss"] <= before[r["segment"]]["loss"] * (1 + 1e-9) and r["scales"] == before[r["segment"]]["scales"]
    one = recu_net_fit(dose_panel, "dose", None, "y", hidden=2, iters=2)
    shared = recu_net_fit(dose_panel, "dose", None, "y", iters=0, init=one, by=["segment"])
    assert all(same(r["theta"], one.theta) for r in shared.table.collect())
    weights = {(r["segment"], r["unit"]): r for r in first.weights().collect()}
    assert len(weights) == 9
    theta = before["A"]["theta"]
    assert [weights["A", 2][c] for c in "vaub"] == [theta[2], theta[4], theta[6], theta[8]] and weights["A", 0]["b"] == theta[0]


def test_thousands_of_segments_in_the_passes_of_one(spark):
    segments = 2000
    df = spark.range(segments * 24).select(
        (F.col("id") % segments).alias("segment"), ((F.col("id") / segments).cast("int") / 23.0).alias("x")
    )
    noise = F.pmod(F.xxhash64("segment", "x"), F.lit(1000)) / 1000.0 - 0.5
    df = stage(df.withColumn("y", 1.0 + (F.col("segment") % 7 + 1) * F.col("x") * F.col("x") + (F.col("segment") % 3) * F.col("x") + noise), "many")
    found = recu_net_fit(df, "x", None, "y", hidden=2, iters=8, by=["segment"])
    rows = {r["segment"]: r for r in found.table.collect()}
    assert len(rows) == segments and {r["status"] for r in rows.values()} <= {"converged", "not_converged"}
    assert max(r["passes"] for r in rows.values()) == 9 and max(r["loss"] for r in rows.values()) < 1.0
    for segment in (3, 1999):
        alone = recu_net_fit(df.filter(F.col("segment") == segment), "x", None, "y", hidden=2, iters=8)
        assert rows[segment]["loss"] == pytest.approx(alone.loss)
    sample = collocation_points(df.filter("segment < 40"), "x", ["segment"], 21, -0.5, 2.0)
    audit = shape_audit(recu_net_predict(sample, found), "pred", "x", ["segment"], tol=1e-7)
    assert audit.filter("slope_breaches > 0 OR bend_breaches > 0").isEmpty()


def test_a_free_input_hot_segments_nulls_and_segments_without_rows(spark):
    rng = np.random.default_rng(1)
    rows = [("hot" if i % 3 else f"s{i % 4}", float(x), float(t), float(x * x + t)) for i, (x, t) in enumerate(rng.random((600, 2)))]
    rows += [(None, 0.5, 0.1, 1.0), (None, 0.7, 0.2, None), ("none", None, 1.0, 1.0), ("none", float("nan"), 1.0, 1.0), ("flat", 2.0, 3.0, 4.0)]
    df = spark.createDataFrame(rows, "segment string, x double, t double, y double").repartition(5)
    found = recu_net_fit(df, "x", "t", "y", hidden=4, iters=25, by=["segment"])
    ended = {r["segment"]: r for r in found.table.collect()}
    assert (ended["none"]["status"], ended["none"]["n"], ended["none"]["n_dropped"], ended["none"]["theta"]) == ("no_rows", 0, 2, None)
    assert (ended[None]["n"], ended[None]["n_dropped"]) == (1, 1)
    assert ended["hot"]["n"] == 400 and ended["hot"]["loss"] < 0.01
    scored = {r["segment"]: r["pred"] for r in recu_net_predict(df.filter("segment IN ('none', 'flat') OR segment IS NULL").na.drop(subset=["y"]), found).collect()}
    assert scored["none"] is None and scored["flat"] == pytest.approx(4.0, abs=1e-3)
    nothing = recu_net_fit(df.limit(0), "x", "t", "y", by=["segment"])
    assert nothing.table.count() == 0


@pytest.mark.parametrize("by", [(), ("segment",)])
@pytest.mark.parametrize("merged", [True, False])
def test_a_weight_is_that_many_rows(spark, dose_panel, by, merged):
    rows = dose_panel.filter("order_key % 9 = 0").withColumn("n", 1 + F.col("order_key") % 3)
    if not merged:
        rows = rows.withColumn("dose", F.col("dose") + F.col("order_key") / 1e7)
    rows = stage(rows, "weighted")
    repeated = rows.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    odd = rows.unionByName(rows.limit(3).withColumn("n", F.lit(0).cast("bigint"))).unionByName(rows.limit(2).withColumn("n", F.lit(None).cast("bigint")))
    one = recu_net_fit(odd, "dose", None, "y", hidden=2, iters=4, by=by, weight="n")
    two = recu_net_fit(repeated, "dose", None, "y", hidden=2, iters=4, by=by)
    if not by:
        assert one.n_dropped == 5 and same(one.theta, two.theta) and one.loss == pytest.approx(two.loss)
    else:
        a, b = ({r["segment"]: r for r in x.table.collect()} for x in (one, two))
        for k in b:
            assert same(a[k]["theta"], b[k]["theta"]) and a[k]["loss"] == pytest.approx(b[k]["loss"])


#: A fit of the doses of sf0.001: c and the units cancel to a tenth of a percent at low doses.
CANCELLING = [
    -17.894277434517946, -0.5755299236929164, -6.040301401258782, -2.765432776055934, -3.04916064848415, 2.6199649155311198,
    0.3368700198365565, -5.074979961917795, 3.404891301685469, -18.32869418042536, -5.630972393377268, 0.8744719757025567,
    1.2278556855245633, 0.3864746985645857, 1.4618493215139001, -0.45173146459399327, 0.023624204143896432, 0.0, 0.0, 0.0, 0.0, 0.0,
    0.0, 0.0, 0.0, 6.10955754937653, -3.45139766548162, -1.6053122783689648, -2.953335114402911, -0.9596359059991277,
    0.2496017061456638, -1.1251576279123623, -1.3331533287984179,
]
CANCELLING_SCALES = [0.0, 0.1, 0.0, 1.0, 38.61979059009179, 15.412168337599535]


@pytest.mark.parametrize("power", [2.0, 2.5])
def test_predictions_keep_their_shape_to_the_last_digits(spark, power):
    grid = spark.range(2001).select(F.lit("A").alias("segment"), (F.col("id") / 8000 - 0.05).alias("dose"))
    table = spark.createDataFrame(
        [("A", CANCELLING, CANCELLING_SCALES, 1)], "segment string, theta array<double>, scales array<double>, n bigint"
    )
    for net in (
        RecuNet(tuple(CANCELLING), power, "dose", None, tuple(CANCELLING_SCALES)),
        nets.RecuNets(table, ("segment",), power, "dose", None, 8),
    ):
        scored = recu_net_predict(grid, net)
        audit = shape_audit(scored, "pred", "dose").first()
        assert (audit["points"], audit["slope_breaches"], audit["bend_breaches"]) == (2001, 0, 0)
        rows = scored.orderBy("dose").collect()
        x = np.asarray([r["dose"] for r in rows])
        plain, _ = forward(np.asarray(CANCELLING), power, x / 0.1, np.zeros(len(x)))
        assert np.allclose([r["pred"] for r in rows], plain * CANCELLING_SCALES[5] + CANCELLING_SCALES[4], rtol=1e-11)


def test_growth_of_the_activation(spark):
    rows = [(2.0, 1e-9), (2.0, -3.0), (-1.0, 3.0), (-2.0, 1.0), (2.0, None), (1.5, -0.5)]
    df = spark.createDataFrame(rows, "z double, d double")
    for power in (2.0, 3.0):
        found = [r[0] for r in df.select(recu_growth(F.col("z"), F.col("d"), power)).collect()]
        slope = power * 2.0 ** (power - 1) * 1e-9
        assert found[0] == pytest.approx(slope, rel=1e-8) and found[4] is None
        plain = [max(z + d, 0.0) ** power - max(z, 0.0) ** power for z, d in (rows[1], rows[2], rows[3], rows[5])]
        assert [found[1], found[2], found[3], found[5]] == pytest.approx(plain)
