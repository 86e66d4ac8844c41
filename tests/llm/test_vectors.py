"""Exact top-k and the prefix forest against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest

from subvent.llm import prefix_forest, topk

SCHEMA = "vec_id bigint, embedding array<float>, rank int, score string"


def rows_of(n, dims, seed, nulls=True):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dims)).astype(np.float32)
    base[n // 2 :: 3] = base[1]  # one common vector
    rows = [(i, v.tolist(), 0, "x") for i, v in enumerate(base)]
    if nulls:
        rows += [
            (n, None, 0, "x"), (n + 1, [None] * dims, 0, "x"), (n + 2, [float("nan")] * dims, 0, "x"), (n + 3, [float("inf")] + [0.0] * (dims - 1), 0, "x"),
            (n + 4, [0.0] * dims, 0, "x"), (None, base[0].tolist(), 0, "x"), (7, base[7].tolist(), 0, "x"), (n + 5, [], 0, "x"),
        ]
    return rows


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def exact_inner(rows, every, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if i is not None and whole(v)]
    out = []
    for i, v in usable:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in usable if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(4096, 4096), (16, 3)])
def test_top_k(spark, sizes):
    rows = rows_of(60, 5, 1)
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = topk.top_k(table, table.filter("vec_id % 3 = 0"), k=4, candidate_rows=sizes[0], query_rows=sizes[1])
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == exact_inner(rows, 3, 4)


def test_top_k_with_few_candidates_and_none(spark):
    table = spark.createDataFrame([(0, [1.0], 0, ""), (1, [2.0], 0, "")], SCHEMA)
    assert [tuple(r) for r in topk.top_k(table, table.filter("vec_id = 0")).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(table.filter("false"), table).collect() == []
    assert topk.top_k(table, table.filter("false")).collect() == []


def test_top_k_beyond_64_bits(spark):
    rows = [(0, [1e18, 1.0]), (1, [3e18, 0.0]), (2, [2e18, 0.0]), (3, [-1e18, 5.0]), (4, [0.5, 0.25])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = topk.top_k(table, table.filter("vec_id = 0"), k=4).collect()
    assert [(r["rank"], r["vec_id"]) for r in found] == [(1, 1), (2, 2), (3, 4), (4, 3)]
    assert found[0]["score"] == 2**63 - 1 and found[3]["score"] == -(2**63)


def cosines(rows, every, k):
    usable = [(i, np.asarray(v, np.float64)) for i, v, *_ in rows if i is not None and whole(v) and any(v)]
    out = {}
    for i, v in usable:
        if i % every == 0:
            scored = sorted((-round(float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w))), 12), j) for j, w in usable if j != i)
            out[i] = scored[:k]
    return out


@pytest.mark.parametrize("shard_rows", [4096, 20])
def test_forest_of_all_prefixes_is_exact(spark, shard_rows):
    rows = rows_of(60, 5, 2)
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    index = prefix_forest.build_index(table, k=4, shard_rows=shard_rows)
    found = {}
    for r in prefix_forest.search(index, table.filter("vec_id % 3 = 0"), k=4, query_rows=7).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    expected = cosines(rows, 3, 4)
    assert set(found) == set(expected)
    for i, best in expected.items():
        assert [found[i][r][0] for r in range(1, 5)] == [j for _, j in best]
        assert np.allclose([found[i][r][1] for r in range(1, 5)], [-s for s, _ in best], atol=1e-12)


def test_forest_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "LEAST", 50)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 24))
    vectors = centres[rng.integers(0, 40, 3000)] + 0.6 * rng.standard_normal((3000, 24))
    rows = [(i, v.tolist(), 0, "") for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank int, score string")
    index = prefix_forest.build_index(table, shard_rows=1000)
    found = prefix_forest.search(index, table.filter("vec_id % 50 = 0"), gather=0.3)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    exact = []
    for i in range(0, 3000, 50):
        s = unit @ unit[i]
        s[i] = -9
        exact += [(i, int(j)) for j in np.argsort(-s)[:5]]
    truth = spark.createDataFrame(exact, "query_id bigint, vec_id bigint")
    assert prefix_forest.recall(found, truth) >= 0.9
    for r in found.limit(20).collect():
        assert abs(r["score"] - unit[r["query_id"]] @ unit[r["vec_id"]]) < 1e-12


def test_forest_of_nothing(spark):
    table = spark.createDataFrame(rows_of(9, 3, 4), SCHEMA)
    none = table.filter("false")
    assert prefix_forest.search(prefix_forest.build_index(none), table).collect() == []
    assert prefix_forest.search(prefix_forest.build_index(table), none).collect() == []
    assert prefix_forest.recall(none.selectExpr("vec_id AS query_id", "vec_id"), none.selectExpr("vec_id AS query_id", "vec_id")) == 1.0


def test_forest_scales_far_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 1e-200]), (2, [1.0, 0.0]), (3, [-1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = prefix_forest.search(prefix_forest.build_index(table), table.filter("vec_id = 0")).collect()
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"])] == [1, 2, 3]
    assert np.allclose(sorted(r["score"] for r in found), [-math.sqrt(0.5), math.sqrt(0.5), 1.0])


def test_components_are_quantised_alone():
    """One huge component changes nothing in the others of its block."""
    others = [5000.5, -(2.0**-41), -5000.25, 0.3, 4096.001, -7.0]
    for huge in (2.0**45, -(2.0**60), 1.5e308):
        rows, terms, weights = topk.quantised(pa.array([others, [huge]], pa.list_(pa.float64())), 256)
        assert rows.tolist() == [0] * 6 + [1] and terms.tolist() == [*range(6), 0]
        assert weights.tolist() == [1280128, -1, -1280064, 76, 1048576, -1792, int(huge) * 256]
        alone = topk.quantised(pa.array([others], pa.list_(pa.float64())), 256)[2]
        assert alone.tolist() == weights.tolist()[:6]
