"""Residuals from trees per fold: against trees grown by hand, by any buffer, and packed draws against plain ones."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from subvent.operators.causal import regression
from subvent.operators.causal.draws import Draws, bits_of
from subvent.operators.causal.residuals import cross_fit_residuals
from subvent.sources import fixtures

CUTS = [0.25, 0.5, 0.75]


def table(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.random(), rng.choice("abc"), rng.random(), float(rng.randint(1, 3))) for i in range(n)]
    rows = [(i, x, g, v + 3 * (x > 0.5), 5 * v - (g == "a"), n) for i, x, g, v, n in rows]
    rows += [(None, 0.5, "a", 1.0, 1.0, 1.0), (n, 0.5, "a", None, 1.0, 1.0), (n + 1, None, None, 2.0, float("nan"), 1.0), (n + 2, None, None, 2.0, 2.0, 0.0)]
    return rows, spark.createDataFrame(rows, "unit_id long, x double, g string, a double, b double, n double")


def bins_of(row):
    _, x, g, *_ = row
    return [0 if x is None else 1 + sum(x >= c for c in CUTS), *[0 if g is None else 1 + (g == v) for v in "abc"]]


def draw(unit, tree):
    h = (unit * 40503 + tree * 30011) % 65537
    h = (h * h + unit * 7 + tree * 13) % 65537
    return (h * h + h * 31 + tree) % 65537


def brute(rows, k, trees, depth, min_leaf):
    """Residuals by growing each tree on its own, over lists; every row counts ``n`` times."""
    usable = [r for r in rows if r[0] is not None and r[3] is not None and r[4] == r[4] and r[5] > 0]
    whole = sum(r[5] for r in usable)
    means = [sum(r[c] * r[5] for r in usable) / whole for c in (3, 4)]
    spread = [sum((r[c] - m) ** 2 * r[5] for r in usable) / whole for c, m in zip((3, 4), means)]

    def sums(part):
        return [sum(r[5] for r in part), *[sum((r[c] - m) * r[5] for r in part) for c, m in zip((3, 4), means)]]

    def grow(part, level):
        t = sums(part)
        best = None
        for feature in range(4) if level < depth else ():
            for cut in sorted({bins_of(r)[feature] for r in part}):
                left = sums([r for r in part if bins_of(r)[feature] <= cut])
                right = [a - b for a, b in zip(t, left)]
                if left[0] < min_leaf or right[0] < min_leaf:
                    continue
                gain = sum((left[i] ** 2 / left[0] + right[i] ** 2 / right[0] - t[i] ** 2 / t[0]) / spread[i - 1] for i in (1, 2))
                if gain > 1e-9 * t[0] and (best is None or gain > best[0] * (1 + 1e-6)):
                    best = gain, feature, cut
        if best is None:
            return [t[1] / t[0], t[2] / t[0]]
        _, feature, cut = best
        sides = [r for r in part if bins_of(r)[feature] <= cut], [r for r in part if bins_of(r)[feature] > cut]
        return feature, cut, grow(sides[0], level + 1), grow(sides[1], level + 1)

    def guess(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2 + (bins_of(row)[tree[0]] > tree[1])]
        return tree

    grown = {
        (f, t): grow(part, 0)
        for f in range(k)
        for t in range(1, trees + 1)
        if (part := [r for r in usable if r[0] % k != f and draw(r[0], t) < 32768])
    }
    out = {}
    for r in rows:
        if r[0] is not None:
            found = [guess(tree, r) for (f, _), tree in grown.items() if f == r[0] % k]
            fit = [sum(g[i] for g in found) / len(found) + means[i] for i in (0, 1)]
            out[r[0]] = (r[3] - fit[0], r[4] - fit[1]) if r in usable else (None, None)
    return out


@pytest.mark.parametrize("buffer_rows", [regression.BUFFER_ROWS, 50])
def test_trees_against_brute_force(spark, monkeypatch, buffer_rows):
    monkeypatch.setattr(regression.grow, "__defaults__", (buffer_rows,))
    rows, df = table(spark)
    draws = Draws(3, formula=fixtures.fixture_draw, draw_range=fixtures.DRAW_RANGE)
    found = cross_fit_residuals(
        df, ["a", "b"], ["x", "g"], k=3, method="rf", fold=F.col("unit_id") % 3, depth=3, edges={"x": CUTS}, draws=draws, min_leaf=20, weight="n"
    ).collect()
    expected = brute(rows, 3, 3, 3, 20)
    assert len(found) == len(rows)
    for r in found:
        if r["unit_id"] is None:
            assert (r["fold"], r["a_res"], r["b_res"]) == (None, None, None)
        elif expected[r["unit_id"]] == (None, None):
            assert (r["a_res"], r["b_res"]) == (None, None)
        else:
            assert (r["a_res"], r["b_res"]) == pytest.approx(expected[r["unit_id"]], abs=1e-9)


def test_no_rows_and_no_other_fold(spark):
    _, df = table(spark)
    empty = cross_fit_residuals(df.limit(0), ["a"], ["x", "g"], k=2, method="rf", trees=2, depth=2)
    assert empty.collect() == [] and empty.columns[-2:] == ["fold", "a_res"]
    alone = cross_fit_residuals(df, ["a"], ["x"], k=2, method="rf", fold=F.lit(0), trees=2, depth=2)
    assert alone.filter("a_res IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="covariate"):
        cross_fit_residuals(df, ["a"], [], method="rf")


@pytest.mark.parametrize("draws", [Draws(1), Draws(64, seed=5), Draws(130, 0.25, bag_size=2)])
def test_packed_draws_are_the_draws(spark, draws):
    import numpy as np

    df = spark.range(50).withColumn("unit", F.when(F.col("id") > 0, F.col("id")))
    plain = F.transform(F.sequence(F.lit(1), F.lit(draws.trees)), lambda t: draws.in_sample(F.col("unit"), t))
    rows = df.select("unit", plain.alias("plain"), draws.packed(F.col("unit")).alias("ins"), draws.packed(F.col("unit"), inside=False).alias("out")).collect()
    ins, out = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("ins", "out"))
    for t in range(draws.trees):
        a, b = bits_of(ins, t), bits_of(out, t)
        for i, r in enumerate(rows):
            assert (a[i], b[i]) == ((False, False) if r["unit"] is None else (r["plain"][t], not r["plain"][t]))
