import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subvent.operators.causal.bins import FeatureBins, bin_features
from subvent.operators.causal.draws import Draws, honest_draws
from subvent.operators.causal.residuals import cross_fit_residuals
from subvent.sources.fixtures import DRAW_RANGE, fixture_draw


def test_bins_against_numpy(spark):
    rng = random.Random(1)
    values = [None if rng.random() < 0.1 else rng.randrange(100) / 10 for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x double")
    edges = [1.0, 2.5, 2.6, 7.0]
    binned, _ = bin_features(df, ["x"], edges={"x": edges})
    for r in binned.collect():
        expected = 0 if r["x"] is None else 1 + int(np.searchsorted(edges, r["x"], side="right"))
        assert r["bins"] == [expected]


def test_learned_bins_are_even_and_reusable(spark, iv_panel):
    binned, bins = bin_features(iv_panel, ["acctbal", "priority"], n_bins=8)
    counts = binned.groupBy(F.get("bins", F.lit(0))).count().toPandas()["count"]
    assert len(counts) == 8 and counts.min() > 0.9 * 15000 / 8
    again = FeatureBins.from_df(bins.to_df(spark))
    assert again == bins
    assert [f.level for f in bins.features[1:]] == ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    # each row has exactly one level
    levels = F.size(F.filter(F.slice("bins", 2, 5), lambda b: b == 2))
    assert binned.filter(levels != 1).count() == 0


def test_text_nulls_and_too_many_values(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "g string")
    binned, _ = bin_features(df, ["g"])
    assert {r["g"]: r["bins"] for r in binned.collect()} == {"a": [2, 1], "b": [1, 2], None: [0, 0]}
    many = spark.range(300).select(F.col("id").cast("string").alias("g"))
    binned, found = bin_features(many, ["g"], n_bins=8)  # one feature of sets of values
    assert [(f.name, f.hashed, f.n_bins()) for f in found.features] == [("g", True, 9)]
    assert {r["bins"][0] for r in binned.collect()} == set(range(1, 9))


def test_all_null_covariate(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    binned, bins = bin_features(df, ["x"])
    assert [r["bins"] for r in binned.collect()] == [[0], [0]]
    assert bins.features[0].edges == ()


def test_fixture_draws(iv_panel):
    draws = Draws(50, formula=fixture_draw, draw_range=DRAW_RANGE)
    roles = honest_draws(iv_panel, "unit_id", 50, draws=draws)
    share = roles.groupBy("tree").agg(
        F.avg((F.col("role") != "out").cast("int")).alias("inside"), F.avg((F.col("role") == "split").cast("int")).alias("s")
    ).toPandas()
    # the published ranges have three decimals
    assert share["inside"].round(3).between(0.493, 0.514).all()
    assert (share["s"] / share["inside"]).round(3).between(0.490, 0.515).all()


def test_hashed_draws_are_repeatable_and_independent(iv_panel):
    draws = honest_draws(iv_panel, "unit_id", 6, fraction=0.4, seed=5)
    first = draws.groupBy("unit_id").pivot("tree", list(range(1, 7))).agg(F.first("role")).toPandas().set_index("unit_id")
    moved = honest_draws(iv_panel.repartition(17, "price"), "unit_id", 6, fraction=0.4, seed=5)
    second = moved.groupBy("unit_id").pivot("tree", list(range(1, 7))).agg(F.first("role")).toPandas().set_index("unit_id")
    assert first.sort_index().equals(second.sort_index())
    inside = (first != "out").astype(float)
    assert inside.mean().between(0.38, 0.42).all()
    off = inside.corr().to_numpy()[~np.eye(6, dtype=bool)]
    assert np.abs(off).max() < 0.04


def test_bags_share_a_half(iv_panel):
    d = Draws(4, 0.25, bag_size=2)
    u = F.col("unit_id")
    sets = iv_panel.select(*[d.in_sample(u, F.lit(t)).cast("int").alias(f"t{t}") for t in range(1, 5)]).toPandas()
    assert sets.mean().between(0.23, 0.27).all()
    corr = sets.corr()
    assert corr.loc["t1", "t2"] > 0.2 and corr.loc["t3", "t4"] > 0.2 and abs(corr.loc["t1", "t3"]) < 0.04


def brute_residuals(rows, k):
    out = {}
    for i, g, w, y in rows:
        others = [r for r in rows if r[1] == g and r[0] % k != i % k and r[2] is not None and r[3] is not None]
        if w is None or y is None or not others:
            out[i] = (None, None)
        else:
            out[i] = (w - np.mean([r[2] for r in others]), y - np.mean([r[3] for r in others]))
    return out


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_cell_means_against_brute_force(spark, broadcast_rows):
    rng = random.Random(2)
    groups = ["a", None, "c", "d"]
    rows = [
        (i, "a" if rng.random() < 0.4 else rng.choice(groups), None if rng.random() < 0.1 else rng.random(), rng.random())
        for i in range(300)
    ] + [(1000, "alone", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "unit_id long, g string, w double, y double")
    found = cross_fit_residuals(df, ["w", "y"], ["g"], k=3, fold=F.col("unit_id") % 3, broadcast_rows=broadcast_rows)
    got = {r["unit_id"]: (r["w_res"], r["y_res"]) for r in found.collect()}
    expected = brute_residuals(rows, 3)
    assert got.keys() == expected.keys() and got[1000] == (None, None)
    for i, pair in expected.items():
        assert got[i] == (None, None) if pair == (None, None) else got[i] == pytest.approx(pair, abs=1e-12)


def test_forest_residuals_take_the_covariates_out(iv_panel):
    panel = iv_panel.withColumn("y2", F.col("y") + F.col("acctbal") / 50)
    found = cross_fit_residuals(panel, ["y2"], ["acctbal"], k=2, method="rf", trees=5)
    row = found.agg(F.corr("y2", "acctbal"), F.corr("y2_res", "acctbal"), F.count("y2_res")).first()
    assert row[0] > 0.8 and abs(row[1]) < 0.1 and row[2] == 15000


def test_unknown_method(iv_panel):
    with pytest.raises(ValueError, match="method"):
        cross_fit_residuals(iv_panel, ["y"], ["segment"], method="mean")
