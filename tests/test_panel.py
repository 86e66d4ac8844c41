import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from subvent.operators.causal.panel import _hot_units, experiment_panel
from subvent.sources import fixtures

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 8)


def build(spark, assignment, issuance, outcome, partitions=None):
    a = spark.createDataFrame(assignment, "unit long, ts timestamp_ntz, z int")
    i = spark.createDataFrame(issuance, "unit long, ts timestamp_ntz, amount double")
    o = spark.createDataFrame(outcome, "unit long, ts timestamp_ntz, value double")
    panel = experiment_panel(a, i, o, "unit", "ts", F.expr("INTERVAL '2' DAY"), partitions=partitions)
    return {r["unit"]: r for r in panel.collect()}


def test_window_ends_and_missing_records(spark):
    rows = build(
        spark,
        [(1, START, 1), (2, START, 0), (3, START, 1)],
        [(1, START, 5.0), (1, START + 2 * DAY, 7.0), (2, START - DAY, 3.0), (9, START, 1.0)],
        [(1, START + DAY, 2.0), (1, START + DAY, 4.0), (3, START + 3 * DAY, 8.0)],
    )
    assert sorted(rows) == [1, 2, 3]
    assert (rows[1]["w"], rows[1]["amount"], rows[1]["y"]) == (1, 5.0, 6.0)
    assert (rows[2]["w"], rows[2]["amount"], rows[2]["y"]) == (0, 0.0, 0.0)
    assert (rows[3]["w"], rows[3]["y"]) == (0, 0.0)


def test_records_do_not_multiply(spark):
    rows = build(spark, [(1, START, 1)], [(1, START, 1.0)] * 3, [(1, START, 10.0)] * 4)
    assert (rows[1]["amount"], rows[1]["y"]) == (3.0, 40.0)


def test_first_assignment_counts(spark):
    rows = build(spark, [(1, START + DAY, 0), (1, START, 1)], [], [(1, START, 2.0)])
    assert (rows[1]["z"], rows[1]["ts"], rows[1]["y"]) == (1, START, 2.0)


def test_empty_inputs(spark):
    assert build(spark, [], [(1, START, 1.0)], []) == {}
    assert build(spark, [(1, START, 1)], [], [])[1]["w"] == 0


@pytest.mark.parametrize("partitions", [1, 50])
def test_hot_units_against_brute_force(spark, partitions):
    rng = random.Random(3)
    units = range(40)
    assignment = [(u, START + DAY * (u % 5), u % 2) for u in units]

    def records(n):
        return [
            # unit 7 holds a third of the records, many of them alike
            (7 if rng.random() < 0.33 else rng.choice(units), START + DAY * rng.randrange(10), float(rng.randrange(4)))
            for _ in range(n)
        ]

    issuance, outcome = records(3000), records(2000)
    rows = build(spark, assignment, issuance, outcome, partitions)
    for u, start, z in assignment:
        within = [a for v, t, a in issuance if v == u and start <= t < start + 2 * DAY]
        earned = [a for v, t, a in outcome if v == u and start <= t < start + 2 * DAY]
        assert (rows[u]["z"], rows[u]["w"]) == (z, int(bool(within)))
        assert (rows[u]["amount"], rows[u]["y"]) == (sum(within), sum(earned))
    hot = dict(_hot_units(spark.createDataFrame(issuance, "unit long, ts timestamp_ntz, a double"), "unit", 50))
    assert hot[7] >= 15


def test_fixture_counts(spark, medium):
    panel = experiment_panel(
        fixtures.assignment(spark, medium),
        fixtures.issuance(spark, medium),
        fixtures.outcome(spark, medium),
        "unit_id",
        "ts",
        F.expr("INTERVAL '2' DAY"),
    )
    row = panel.agg(F.count("*"), F.sum("z"), F.sum(1 - F.col("w")), F.sum((F.col("y") == 0).cast("int"))).first()
    assert tuple(row) == (150, 75, 60, 77)
