import numpy as np
import pytest
from pyspark.sql import functions as F

from subvent.operators.causal.effect import iv_effect

SCHEMA = "g string, z double, w double, y double"


def one(df, **kwargs):
    return iv_effect(df, "z", "w", "y", **kwargs).first()


def test_known_truth(iv_panel):
    row = one(iv_panel)
    assert row["naive"] == pytest.approx(42.0155, abs=1e-4)
    assert row["itt"] == pytest.approx(9.7717, abs=1e-4)
    assert row["first_stage"] == pytest.approx(0.4991, abs=1e-4)
    assert row["effect"] == pytest.approx(19.5778, abs=1e-4)
    assert abs(row["effect"] - 19.6133) < 2 * row["std_error"]
    assert (row["status"], row["n"], row["n_dropped"]) == ("ok", 15000, 0)


def test_effect_by_true_group(iv_panel):
    panel = iv_panel.withColumn("high", F.col("acctbal") >= 4500)
    found = {r["high"]: r["effect"] for r in iv_effect(panel, "z", "w", "y", ["high"]).collect()}
    assert found[False] == pytest.approx(10.0617, abs=1e-4)
    assert found[True] == pytest.approx(29.8380, abs=1e-4)


def test_invariance(iv_panel):
    base = one(iv_panel)["effect"]
    assert one(iv_panel.withColumn("y", F.col("y") + 1000))["effect"] == pytest.approx(base)
    assert one(iv_panel.withColumn("z", 1 - F.col("z")))["effect"] == pytest.approx(base)
    assert one(iv_panel.withColumn("y", 3 * F.col("y")))["effect"] == pytest.approx(3 * base)
    assert one(iv_panel.union(iv_panel))["effect"] == pytest.approx(base)
    assert one(iv_panel.repartition(13, "price"))["effect"] == pytest.approx(base)


def test_only_complete_cases_count(spark):
    rows = [("a", 0.0, 0.0, 3.0), ("a", 0.0, 1.0, 2.0), ("a", 1.0, 1.0, 1.0), ("a", 1.0, None, 9.0), ("a", 1.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    full = one(df.filter("w IS NOT NULL"))
    row = one(df)
    assert row["effect"] == pytest.approx(full["effect"])
    assert (row["n"], row["n_dropped"]) == (4, 1)


@pytest.mark.parametrize(
    "rows, status",
    [
        ([("a", 0.0, 0.0, 1.0)], "too_few"),
        ([("a", None, 0.0, 1.0)] * 4, "too_few"),
        ([("a", 1.0, 0.0, 1.0), ("a", 1.0, 1.0, 2.0), ("a", 1.0, 1.0, 3.0)], "no_instrument_variation"),
        ([("a", 0.0, 1.0, 1.0), ("a", 1.0, 1.0, 2.0), ("a", 1.0, 1.0, 3.0)], "no_first_stage"),
        ([("a", 0.1, 0.7, 1.0), ("a", 0.3, 0.7, 2.0), ("a", 0.7, 0.7, 3.0)], "no_first_stage"),
    ],
)
def test_undefined_effects(spark, rows, status):
    row = iv_effect(spark.createDataFrame(rows, SCHEMA), "z", "w", "y", ["g"]).first()
    assert (row["status"], row["effect"], row["std_error"]) == (status, None, None)


def test_full_compliance_has_no_f(spark):
    rows = [("a", float(i % 2), float(i % 2), float(i)) for i in range(10)]
    row = one(spark.createDataFrame(rows, SCHEMA))
    assert (row["f_stat"], row["status"], row["effect"]) == (None, "ok", pytest.approx(1.0))


def test_weak_instrument(spark):
    rows = [("a", float(i % 2), float((i // 3) % 2), float(i % 7)) for i in range(13)]
    row = one(spark.createDataFrame(rows, SCHEMA))
    assert row["status"] == "weak" and row["effect"] is not None


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert one(empty)["status"] == "too_few"
    assert iv_effect(empty, "z", "w", "y", ["g"]).count() == 0


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="'q'"):
        iv_effect(spark.createDataFrame([], SCHEMA), "q", "w", "y")


def test_salted_groups_give_the_same_result(iv_panel):
    """A third of the rows in one group, a NULL group, and no broadcast."""
    group = F.when(F.col("unit_id") % 3 == 0, F.lit(-1)).when(F.col("unit_id") % 7 == 0, None).otherwise(F.col("unit_id") % 200)
    panel = iv_panel.withColumn("g", group)
    expected = {r["g"]: r for r in iv_effect(panel, "z", "w", "y", ["g"]).collect()}
    found = {r["g"]: r for r in iv_effect(panel, "z", "w", "y", ["g"], broadcast_rows=10).collect()}
    assert expected.keys() == found.keys() and None in found
    for g, row in expected.items():
        assert found[g]["n"] == row["n"] and found[g]["status"] == row["status"]
        assert found[g]["std_error"] == pytest.approx(row["std_error"], rel=1e-9)


def test_moments_about_a_far_centre_are_summed_again(spark):
    """Groups far from each other, of exact and of noisy fits: the same as about the groups' own means."""
    rng = np.random.default_rng(8)
    rows = []
    for g, (offset, noise) in enumerate([(0.0, 1.0), (1e3, 1.0), (1e7, 1.0), (-1e9, 10.0), (5.0, 0.0)]):
        z = rng.integers(0, 2, 80)
        w = np.where(rng.random(80) < 0.8, z, 1 - z)
        y = offset + 3 * w + noise * rng.random(80)
        rows += [(g, float(a) + offset / 7, float(b) - offset / 3, float(c)) for a, b, c in zip(z, w, y, strict=True)]
    found = {r["g"]: r for r in iv_effect(spark.createDataFrame(rows, "g int, z double, w double, y double"), "z", "w", "y", ["g"]).collect()}
    for g in range(5):
        own = np.asarray([r[1:] for r in rows if r[0] == g])
        z, w, y = (own - own.mean(axis=0)).T
        residual = y - (z @ y) / (z @ w) * w
        expected = np.sqrt(((z * residual) ** 2).sum()) / abs(z @ w)
        assert found[g]["std_error"] == pytest.approx(expected, rel=1e-5, abs=1e-6)


def test_one_pass_without_a_row_shuffle(spark, iv_panel, monkeypatch):
    from subvent.operators.causal import effect

    def refuse(*args):
        raise AssertionError("rows were read again")

    monkeypatch.setattr(effect, "_summed_again", refuse)
    assert iv_effect(iv_panel.withColumn("g", F.floor(F.col("unit_id") / 40)), "z", "w", "y", ["g"], broadcast_rows=1).count() > 300
