"""Text covariates of any number of values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from subvent import IVForest, iv_forest_fit, iv_forest_predict, iv_forest_variance
from subvent.operators.causal import levels
from subvent.operators.causal.draws import Draws
from subvent.sources.staging import stage


def hot_city(spark, cities, rows=24_000):
    """A third of the rows in one city, where the effect is 50; 10 everywhere else. No noise: leaves are exact."""
    unit = F.col("unit_id")
    other = F.concat(F.lit("c"), (F.xxhash64(unit) % cities).cast("string"))
    base = spark.range(rows).select(
        F.col("id").alias("unit_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.when(F.col("id") % 101 != 1, F.lit("x"))).alias("kind")
    )
    base = base.withColumn("city", F.when(F.col("kind") == "hot", "hot").when(F.col("kind") == "x", other))
    z = F.pmod(F.xxhash64(unit, F.lit(1)), F.lit(2)).cast("int")
    tau = F.when(F.col("kind") == "hot", 50.0).otherwise(10.0)
    return stage(base.withColumn("z", z).withColumn("w", z).withColumn("tau", tau).withColumn("y", 100 + tau * F.col("w")), "cities")


@pytest.mark.parametrize("cities", [200, 300, 8000])
def test_a_hot_value_stands_alone_among_any_number(spark, cities):
    panel = hot_city(spark, cities)
    model = iv_forest_fit(panel, "z", "w", "y", ["city"], trees=20, depth=3, min_leaf=20)
    for oob in (False, True):
        found = iv_forest_predict(panel, model, oob=oob).groupBy("kind").agg(F.min("effect").alias("low"), F.max("effect").alias("high"), F.min("tau").alias("tau"))
        for r in found.collect():
            assert r["low"] == pytest.approx(r["tau"], abs=0.1) and r["high"] == pytest.approx(r["tau"], abs=0.1)


def test_values_meet_their_bins_alike_by_broadcast_and_by_shuffle(spark):
    panel = hot_city(spark, 300)
    model = iv_forest_fit(panel, "z", "w", "y", ["city"], trees=6, depth=2)
    new = panel.select("unit_id", F.when(F.col("unit_id") % 5 == 0, "never seen").otherwise(F.col("city")).alias("city")).unionByName(panel.select("unit_id", "city"))
    one, two = (levels.tree_bins(new, model.levels, 0, "city", "b", limit).groupBy("city", "b").count() for limit in (10**9, 0))
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)
    assert {tuple(r["b"]) for r in one.filter("city IS NULL").collect()} == {(0,) * 6}
    unseen = model.levels.filter("unseen").first()["bins"]
    assert {tuple(r["b"]) for r in one.filter("city = 'never seen'").collect()} == {tuple(unseen)}


def test_bins_against_brute_force(spark):
    rng = np.random.default_rng(4)
    n = 3000
    z = rng.integers(0, 2, n)
    w = np.where(rng.random(n) < 0.8, z, 1 - z)
    names = np.asarray([f"v{i}" for i in range(40)] + [None], dtype=object)
    at = np.where(rng.random(n) < 0.3, 7, rng.integers(0, 41, n))
    y = w * (at % 5) + rng.random(n)
    weight = rng.integers(1, 4, n)
    rows = [(int(i), str(names[a]) if names[a] is not None else None, float(q), float(r), float(s), float(t)) for i, a, q, r, s, t in zip(range(n), at, z, w, y, weight)]
    df = spark.createDataFrame(rows, "unit long, city string, z double, w double, y double, weight double")
    draws = Draws(3, formula=lambda u, t: F.pmod(u * 7919 + t * 104729, F.lit(1 << 16)), draw_range=1 << 16)
    table = levels.learn_levels(df.repartition(5), {2: "city"}, draws, 8)
    found = {r["level"]: r["bins"] for r in table.filter("NOT unseen").collect()}
    unseen = table.filter("unseen").first()["bins"]
    assert found.pop(None) == [0, 0, 0]
    for tree in (1, 2, 3):
        own = [r for r in rows if (d := (r[0] * 7919 + tree * 104729) % (1 << 16)) < 1 << 15 and d % 2 == 0]
        a = np.asarray([r[2:] for r in own])
        total = a[:, 3].sum()
        mz, mw, my = (a[:, 3] @ a[:, k] / total for k in range(3))
        tau = (a[:, 3] @ ((a[:, 0] - mz) * (a[:, 2] - my))) / (a[:, 3] @ ((a[:, 0] - mz) * (a[:, 1] - mw)))
        rho = (a[:, 0] - mz) * ((a[:, 2] - my) - tau * (a[:, 1] - mw))
        cities = sorted({r[1] for r in own if r[1] is not None})
        size = {c: sum(r[5] for r in own if r[1] == c) for c in cities}
        mean = {c: sum(x * r[5] for x, r in zip(rho, own) if r[1] == c) / size[c] for c in cities}
        known, before = sum(size.values()), 0
        for c in sorted(cities, key=lambda c: (mean[c], c)):
            assert found[c][tree - 1] == 1 + int(8 * (2 * before + size[c]) // known)
            before += size[c]
        middle = 1 + int(16 * sum(size[c] for c in cities if mean[c] <= 0) // known)
        assert unseen[tree - 1] == middle
        for c in set(found) - set(cities):
            assert found[c][tree - 1] == middle


def test_mixed_covariates_saved_weighted_and_merged(spark, tmp_path):
    panel = hot_city(spark, 30, 9000).withColumn("x", (F.col("unit_id") % 2).cast("double")).withColumn("y", F.col("y") + 40 * F.col("x") * F.col("w"))
    settings = {"depth": 3, "min_leaf": 10, "draws": Draws(8, 0.5, bag_size=2)}
    one, two = (iv_forest_fit(panel, "z", "w", "y", ["x", "city", "kind"], merge=merge, **settings) for merge in (True, False))
    # the same splits; where two are equally good, sums in another order may tell them apart
    a, b = (iv_forest_predict(panel, m).select("unit_id", "effect") for m in (one, two))
    gap = a.join(b.withColumnRenamed("effect", "other"), "unit_id").agg(F.max(F.abs(F.col("effect") - F.col("other")))).first()[0]
    assert gap < 1e-6
    found = iv_forest_predict(panel, one).agg(F.max(F.abs(F.col("effect") - F.col("tau") - 40 * F.col("x")))).first()[0]
    assert found < 0.5
    one.save(str(tmp_path / "m"))
    again = IVForest.load(spark, str(tmp_path / "m"))
    assert again.bins == one.bins
    score = lambda m: iv_forest_variance(panel, m, oob=True).agg(F.sum("effect"), F.sum("std_error"), F.count("effect")).first()
    assert score(again) == pytest.approx(score(one))
    doubled = iv_forest_fit(panel.withColumn("n", F.lit(2)), "z", "w", "y", ["x", "city", "kind"], merge=False, weight="n", **(settings | {"min_leaf": 20}))
    c = iv_forest_predict(panel, doubled).agg(F.max(F.abs(F.col("effect") - F.col("tau") - 40 * F.col("x")))).first()[0]
    assert c < 0.5


def test_a_feature_per_value_is_refused_beyond_its_bound(spark):
    with pytest.raises(ValueError, match="city: more than 256"):
        iv_forest_fit(hot_city(spark, 300, 3000), "z", "w", "y", ["city"], trees=2, values="each")
    with pytest.raises(ValueError, match="values"):
        iv_forest_fit(hot_city(spark, 300, 3000), "z", "w", "y", ["city"], trees=2, values="some")


def test_no_rows_and_one_value(spark):
    panel = hot_city(spark, 3, 600)
    empty = iv_forest_fit(panel.limit(0), "z", "w", "y", ["city"], trees=2, depth=2)
    assert empty.splits.count() == 0
    assert {r["effect_status"] for r in iv_forest_predict(panel, empty).collect()} == {"no_tree"}
    one = iv_forest_fit(panel.withColumn("city", F.lit("a")), "z", "w", "y", ["city"], trees=2, depth=2)
    assert one.splits.count() == 0
    gone = iv_forest_fit(panel.withColumn("city", F.lit(None).cast("string")), "z", "w", "y", ["city"], trees=2, depth=2)
    assert gone.splits.count() == 0
