import numpy as np
import pytest
from pyspark.sql import functions as F

from subvent.operators.causal.bins import bin_features
from subvent.operators.causal.draws import Draws
from subvent.operators.causal.forest import (
    IVForest,
    causal_forest_fit,
    iv_forest_fit,
    iv_forest_predict,
    iv_forest_variance,
)
from subvent.operators.causal.split import iv_split

EDGES = {"acctbal": [-500.0 + 500 * i for i in range(21)], "price": [25_000.0 * i for i in range(1, 20)]}


def brute_split(bins, z, w, y, min_leaf):
    """Best split by pseudo-outcomes computed row by row."""
    tau = np.cov(z, y)[0, 1] / np.cov(z, w)[0, 1]
    rho = (z - z.mean()) * (y - y.mean() - tau * (w - w.mean()))
    best = (-1.0, None, None)
    high = z > z.mean()
    for feature in range(bins.shape[1]):
        for cut in np.unique(bins[:, feature])[:-1]:
            left = bins[:, feature] <= cut
            sides = [left, ~left]
            if min(s.sum() for s in sides) < min_leaf:
                continue
            if min(min((high & s).sum(), (~high & s).sum()) for s in sides) < min_leaf / 2:
                continue
            gain = sum(rho[s].sum() ** 2 / s.sum() for s in sides)
            if gain > best[0] * (1 + 1e-9):
                best = (gain, feature, cut)
    return best


@pytest.mark.parametrize("continuous", [False, True])
def test_split_against_row_level_pseudo_outcomes(spark, continuous):
    rng = np.random.default_rng(4)
    n = 600
    bins = rng.integers(0, 9, size=(n, 3))
    z = rng.normal(size=n) if continuous else rng.integers(0, 2, n).astype(float)
    w = (z + rng.normal(size=n) > 0.5).astype(float)
    y = w * np.where(bins[:, 1] > 4, 9.0, 1.0) + rng.normal(size=n)
    rows = [(1, 1, [int(b) for b in bins[i]], float(z[i]), float(w[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "tree int, node bigint, bins array<int>, z double, w double, y double")
    gain, feature, cut = brute_split(bins, z, w, y, 30)
    # without broadcast the node means take the salted way
    for limit in (100, 0):
        found = iv_split(df, "z", "w", "y", min_leaf=30, broadcast_rows=limit).first()
        assert (found["feature"], found["bin"]) == (feature, cut)
        assert found["gain"] == pytest.approx(gain)
        assert found["n_left"] == (bins[:, feature] <= cut).sum()


def test_first_split_of_the_fixture(iv_panel):
    binned, bins = bin_features(iv_panel, ["acctbal", "price"], edges=EDGES)
    rows = binned.withColumn("tree", F.lit(1)).withColumn("node", F.lit(1).cast("bigint"))
    found = iv_split(rows, "z", "w", "y", min_leaf=750).first()
    assert (found["feature"], found["n_left"]) == (0, 7790)
    assert found["gain"] == pytest.approx(22805.04, abs=0.005)
    assert bins.features[0].edges[found["bin"] - 1] == 4500.0


@pytest.fixture(scope="module")
def forest(iv_panel):
    return iv_forest_fit(iv_panel, "z", "w", "y", ["acctbal", "price"])


def by_truth(df):
    return {r["tau"]: r["e"] for r in df.groupBy("tau").agg(F.avg("effect").alias("e")).collect()}


def test_forest_finds_the_two_groups(iv_panel, forest):
    scored = iv_forest_predict(iv_panel, forest)
    means = by_truth(scored)
    assert means[10.0] == pytest.approx(10, abs=2) and means[30.0] == pytest.approx(30, abs=2)
    assert scored.stat.corr("effect", "tau") > 0.95
    assert {r["feature"] for r in forest.splits.filter("node = 1").collect()} == {0}
    oob = iv_forest_predict(iv_panel, forest, oob=True)
    assert by_truth(oob)[30.0] == pytest.approx(30, abs=2)
    assert 20 < oob.agg(F.avg("n_trees")).first()[0] < 30


def test_merging_equal_bins_changes_nothing(spark, iv_panel):
    kwargs = dict(trees=8, depth=3, edges=EDGES)
    one = iv_forest_fit(iv_panel, "z", "w", "y", ["acctbal", "price"], merge=True, **kwargs)
    two = iv_forest_fit(iv_panel, "z", "w", "y", ["acctbal", "price"], merge=False, **kwargs)
    columns = ["tree", "node", "feature", "bin"]
    assert one.splits.select(columns).exceptAll(two.splits.select(columns)).count() == 0
    assert one.leaves.count() == two.leaves.count()
    gap = iv_forest_predict(iv_panel, one).select("unit_id", F.col("effect").alias("a")).join(
        iv_forest_predict(iv_panel, two).select("unit_id", "effect"), "unit_id"
    )
    assert gap.agg(F.max(F.abs(F.col("a") - F.col("effect")))).first()[0] < 1e-6


def test_many_small_passes_equal_one(iv_panel, monkeypatch):
    from subvent.operators.causal import forest as module

    kwargs = dict(trees=5, depth=2, edges=EDGES)
    one = iv_forest_fit(iv_panel, "z", "w", "y", ["acctbal", "price"], **kwargs).splits.toPandas()
    monkeypatch.setattr(module, "GROUPS_PER_PASS", 100)
    two = iv_forest_fit(iv_panel, "z", "w", "y", ["acctbal", "price"], **kwargs).splits.toPandas()
    order = ["tree", "node"]
    a, b = (f.sort_values(order)[["tree", "node", "feature", "bin"]].to_numpy() for f in (one, two))
    assert np.array_equal(a, b)


def test_save_and_load(spark, iv_panel, forest, tmp_path):
    forest.save(str(tmp_path / "model"))
    again = IVForest.load(spark, str(tmp_path / "model"))
    a = iv_forest_predict(iv_panel, forest, oob=True).agg(F.sum("effect")).first()[0]
    b = iv_forest_predict(iv_panel, again, oob=True).agg(F.sum("effect")).first()[0]
    assert a == pytest.approx(b, rel=1e-12)


def test_incomplete_rows_and_null_covariates(iv_panel):
    holes = iv_panel.withColumn("w", F.when(F.col("unit_id") % 10 != 0, F.col("w"))).withColumn(
        "price", F.when(F.col("unit_id") % 3 != 0, F.col("price"))
    ).withColumn("nothing", F.lit(None).cast("double"))
    model = iv_forest_fit(holes, "z", "w", "y", ["acctbal", "price", "nothing"], trees=10, depth=2)
    assert (model.n_rows, model.n_dropped) == (13500, 1500)
    scored = iv_forest_predict(holes, model)
    assert scored.filter("effect IS NULL").count() == 0 and scored.count() == 15000


def test_empty_panel_and_constant_instrument(iv_panel):
    empty = iv_forest_fit(iv_panel.limit(0), "z", "w", "y", ["acctbal"], trees=3, depth=2)
    assert (empty.splits.count(), empty.leaves.count(), empty.n_rows) == (0, 0, 0)
    row = iv_forest_predict(iv_panel, empty).first()
    assert (row["effect"], row["effect_status"]) == (None, "no_tree")
    flat = iv_forest_fit(iv_panel.withColumn("z", F.lit(1)), "z", "w", "y", ["acctbal"], trees=3, depth=2)
    assert flat.splits.count() == 0 and flat.leaves.count() == 3
    row = iv_forest_predict(iv_panel, flat).first()
    assert (row["effect"], row["effect_status"]) == (None, "no_first_stage")


def test_residual_instrument_keeps_the_leaf_rule(iv_panel):
    """A centred z is not 0/1; the rule then counts the raw one."""
    centred = iv_panel.withColumn("zc", F.col("z") - 0.5 + F.col("u3") / 1e6)
    a = iv_forest_fit(iv_panel, "z", "w", "y", ["acctbal"], trees=5, depth=3, min_leaf=400, edges=EDGES)
    b = iv_forest_fit(centred, "zc", "w", "y", ["acctbal"], trees=5, depth=3, min_leaf=400, edges=EDGES, raw_z="z")
    assert np.array_equal(
        *(m.splits.toPandas().sort_values(["tree", "node"])[["tree", "node", "bin"]].to_numpy() for m in (a, b))
    )


def test_causal_forest(iv_panel):
    """z itself is random, so its effect on y is found without an instrument."""
    model = causal_forest_fit(iv_panel, "z", "y", ["acctbal"], trees=20, depth=2)
    means = by_truth(iv_forest_predict(iv_panel, model))
    assert means[10.0] == pytest.approx(5, abs=2) and means[30.0] == pytest.approx(15, abs=2)


def test_variance_matches_the_spread_over_refits(spark, iv_panel):
    """Mean s.e. within a factor 2 of the spread over refits with other noise and seeds."""
    effects, errors = [], []
    points = iv_panel.filter((F.col("acctbal") % 1000).between(400, 600))
    for seed, (m1, m2, m3) in enumerate([(7919, 104729, 1299709), (7907, 104723, 1299721), (7901, 104717, 1299689), (7883, 104711, 1299673), (7879, 104707, 1299653)]):
        key = F.col("unit_id")
        u1, u2, u3 = ((key * m % p) / float(p) for m, p in ((m1, 1009), (m2, 997), (m3, 991)))
        again = iv_panel.withColumn("z", (u1 < 0.5).cast("int"))
        again = again.withColumn("w", F.when(u1 < 0.5, u2 > 0.3).otherwise(u2 > 0.8).cast("int"))
        again = again.withColumn("y", 100.0 + F.col("tau") * F.col("w") + 60.0 * u2 + 10.0 * (u3 - 0.5))
        model = iv_forest_fit(
            again, "z", "w", "y", ["acctbal"], depth=3, edges=EDGES, draws=Draws(100, 0.25, seed=seed, bag_size=2)
        )
        found = iv_forest_variance(points, model).select("unit_id", "effect", "std_error").toPandas().sort_values("unit_id")
        effects.append(found["effect"].to_numpy())
        errors.append(found["std_error"].to_numpy())
    spread = np.std(effects, axis=0, ddof=1).mean()
    assert 0.5 < np.mean(errors) / spread < 2


def test_variance_needs_bags(iv_panel, forest):
    with pytest.raises(ValueError, match="bag"):
        iv_forest_variance(iv_panel, forest)


def test_groups_of_trees_equal_one_forest(spark, iv_panel, monkeypatch, tmp_path):
    """Trees grown and scored in groups, as large forests are, are those of one go, with their effects and errors to the last digit."""
    from subvent.operators.causal import forest as module

    x = ["acctbal", "price", "kind"]
    panel = iv_panel.withColumn("kind", F.concat(F.lit("k"), F.col("unit_id") % 300))
    kwargs = dict(depth=2, edges=EDGES, merge=False, draws=Draws(6, 0.4, seed=3, bag_size=2))

    def scores(model):
        found = [iv_forest_predict(panel, model), iv_forest_variance(panel, model, oob=True)]
        return [f.toPandas().sort_values("unit_id", ignore_index=True) for f in found]

    whole = iv_forest_fit(panel, "z", "w", "y", x, **kwargs)
    want = scores(whole)
    monkeypatch.setattr(module, "MOST_NODES", 12)
    monkeypatch.setattr(module, "MOST_SCORED", 16)
    parts = iv_forest_fit(panel, "z", "w", "y", x, **kwargs)
    assert parts.in_passes() == [(1, 4), (5, 6)]
    columns = ["tree", "node", "feature", "bin"]
    assert sorted(map(tuple, parts.splits.select(columns).collect())) == sorted(map(tuple, whole.splits.select(columns).collect()))
    a, b = (f.leaves.toPandas().sort_values(["tree", "node"], ignore_index=True) for f in (whole, parts))
    assert np.allclose(a, b, rtol=1e-12)
    for one, two in zip(want, scores(parts)):
        assert list(one.columns) == list(two.columns)
        assert (one["n_trees"] == two["n_trees"]).all() and (one["effect_status"] == two["effect_status"]).all()
        for c in {"effect", "std_error"} & set(one.columns):
            assert np.allclose(one[c], two[c], rtol=1e-9, equal_nan=True)
    parts.save(str(tmp_path / "large"))
    again = IVForest.load(spark, str(tmp_path / "large"))
    assert again.leaves.count() == parts.leaves.count()
    with pytest.raises(ValueError, match="depth"):
        iv_forest_fit(panel, "z", "w", "y", x, trees=1, depth=4)


def test_passes_on_no_rows(iv_panel, monkeypatch):
    from subvent.operators.causal import forest as module

    monkeypatch.setattr(module, "MOST_SCORED", 4)
    model = iv_forest_fit(iv_panel, "z", "w", "y", ["acctbal"], trees=3, depth=2, edges=EDGES)
    assert len(model.in_passes()) == 3
    scored = iv_forest_predict(iv_panel.limit(0), model)
    assert scored.count() == 0 and scored.columns[-3:] == ["effect", "n_trees", "effect_status"]
