"""Approximate nearest neighbours by cosine: a forest of sorted hash strings, searched by longest prefix.

Rows are dealt out evenly into shards. In each shard, every tree writes a vector as a long string of bits, the sides
of the tree's random hyperplanes it lies on, and keeps the strings as a sorted array: all strings with a common
prefix are a range of it. A query descends each tree to its longest matching prefix, then all trees ascend in step,
one bit shorter at a time, until they have gathered enough candidates, which are scored exactly. Prefixes are as long as
the data are dense. Equal vectors are one entry of a shard with its smallest ids, so copies never crowd out others.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subvent.llm.common import column, staged
from subvent.llm.topk import merged, usable

#: Trees of a shard and bits of a string, at most 32.
TREES, BITS = 96, 24
#: Rows of a shard and of a block of queries.
SHARD_ROWS, QUERY_ROWS = 4096, 4096
#: Trees ascend until what they have gathered, a vector as often as trees have found it, is this share of the shard's vectors.
GATHER = 1.0
#: But at least so many; the k nearest of few vectors are less near, and found by shorter prefixes.
LEAST = 2048


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    counts = np.asarray(lists.value_lengths(), np.int64)
    flat = np.asarray(lists.flatten(), np.float64)
    rows = np.repeat(np.arange(len(counts)), counts)
    out = np.zeros((len(counts), dims))
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)] = flat
    return out


def _scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and their lengths; one whose squares leave the range of doubles is scaled by a power of two first."""
    most = np.abs(vectors).max(axis=1, initial=0)
    far = (most > 1e150) | (most < 1e-150)
    if far.any():
        vectors = vectors.copy()
        vectors[far] = np.ldexp(vectors[far], -np.frexp(most[far])[1][:, None])
    return vectors, np.sqrt((vectors * vectors).sum(axis=1))


def _planes(dims: int, trees: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dims, trees * bits))


def _strings(vectors: np.ndarray, planes: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """The bit strings of each vector as integers, one column per tree."""
    places = np.int64(1) << np.arange(bits - 1, -1, -1)
    out = np.empty((len(vectors), trees), np.int64)
    for i in range(0, len(vectors), 1024):
        sides = (vectors[i : i + 1024] @ planes > 0).reshape(-1, trees, bits)
        out[i : i + 1024] = sides @ places
    return out


def _numbers(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return rows.filter(usable(F.col("vector")) & F.col("id").isNotNull() & F.exists("vector", lambda x: x != 0))


def build_index(
    vectors: DataFrame,
    k: int = 5,
    vector: str = "embedding",
    id_col: str = "vec_id",
    trees: int = TREES,
    bits: int = BITS,
    shard_rows: int = SHARD_ROWS,
    seed: int = 5,
) -> DataFrame:
    """A row per shard, written to the shared folder: its distinct vectors, the k + 1 smallest ids of each, and the trees.

    Every row with an id and a vector that is not NULL, zero, or with NULL or non-finite components is indexed; vectors of
    different lengths are filled up with zeros. Hyperplanes come from ``seed`` alone; nothing is fitted.
    """
    rows = _numbers(vectors, id_col, vector)
    counted = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    shards, dims = max(1, math.ceil(counted[0] / shard_rows)), counted[1] or 1

    def build(group: pa.Table) -> pa.Table:
        ids = column(group, "id").to_numpy()
        every = _matrix(column(group, "vector"), dims) + 0.0  # -0 becomes 0
        distinct, which = np.unique(every, axis=0, return_inverse=True)
        order = np.lexsort((ids, which.ravel()))
        ids, which = ids[order], which.ravel()[order]
        place = np.arange(len(ids)) - np.searchsorted(which, which)
        some = place <= k
        scaled, _ = _scaled(distinct)
        strings = _strings(scaled, _planes(dims, trees, bits, seed), trees, bits)
        sorts = np.argsort(strings, axis=0, kind="stable")
        ordered = np.take_along_axis(strings, sorts, 0)
        return pa.table(
            {
                "shard": column(group, "shard").slice(0, 1),
                "n": pa.array([len(distinct)], pa.int32()),
                "dims": pa.array([dims], pa.int32()),
                "vectors": pa.array([distinct.astype("<f8").tobytes()], pa.binary()),
                "ids": pa.array([ids[some].astype("<i8").tobytes()], pa.binary()),
                "of": pa.array([which[some].astype("<i4").tobytes()], pa.binary()),
                "strings": pa.array([np.ascontiguousarray(ordered.T).astype("<u4").tobytes()], pa.binary()),
                "places": pa.array([np.ascontiguousarray(sorts.T).astype("<i4").tobytes()], pa.binary()),
            }
        )

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    index = dealt.groupBy("shard").applyInArrow(
        build, "shard bigint, n int, dims int, vectors binary, ids binary, of binary, strings binary, places binary"
    )
    return staged(index, "prefix_forest")


def _ranges(strings: np.ndarray, asked: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each tree's strings share the first b bits of each query, by tree, b and query."""
    trees, n = len(strings), asked.shape[0]
    low, high = np.empty((trees, bits + 1, n), np.int32), np.empty((trees, bits + 1, n), np.int32)
    shifts = np.arange(bits, -1, -1)[:, None]
    for t in range(trees):
        prefix = asked[:, t][None, :] >> shifts
        low[t] = np.searchsorted(strings[t], (prefix << shifts).ravel()).reshape(bits + 1, n)
        high[t] = np.searchsorted(strings[t], ((prefix + 1) << shifts).ravel()).reshape(bits + 1, n)
    return low, high


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vector: str = "embedding",
    id_col: str = "vec_id",
    trees: int = TREES,
    bits: int = BITS,
    query_rows: int = QUERY_ROWS,
    gather: float = GATHER,
    seed: int = 5,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row of ``queries`` its k nearest found by cosine, ties to the smaller id.

    ``trees``, ``bits``, ``seed`` and a ``k`` not above are those of the index. A query does not find rows with its own id.
    A shard gathers at least k + 1 vectors, so a query has k results whenever there are k candidates. NULL, zero and
    incomplete vectors ask nothing. Scores are computed from the original vectors in double precision. Each pair of a
    shard and a block of queries is one task's work.
    """
    asked = _numbers(queries, id_col, vector).withColumn("_query", F.monotonically_increasing_id())
    shards, blocks = max(1, index.count()), max(1, math.ceil(asked.count() / query_rows))
    left = index.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    left = left.withColumn("_cell", F.col("shard") * blocks + F.col("_block"))
    right = (
        asked.withColumn("_block", F.pmod(F.xxhash64("_query"), F.lit(blocks)))
        .withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .select("id", "vector", "_query", (F.col("_shard") * blocks + F.col("_block")).cast("bigint").alias("_cell"))
    )

    def find(forest: pa.Table, block: pa.Table) -> pa.Table:
        names = ("_query", "query_id", "vec_id", "score")
        out: list[list] = [[], [], [], []]
        if len(forest) and len(block):
            shard = forest.slice(0, 1).to_pylist()[0]
            n, dims = shard["n"], shard["dims"]
            widest = max(dims, int(np.asarray(column(block, "vector").value_lengths()).max()))
            vectors = np.frombuffer(shard["vectors"], "<f8").reshape(n, dims)
            vectors, norms = _scaled(np.pad(vectors, ((0, 0), (0, widest - dims))))
            ids, of = np.frombuffer(shard["ids"], "<i8"), np.frombuffer(shard["of"], "<i4")
            firsts = np.searchsorted(of, np.arange(n + 1))
            strings = np.frombuffer(shard["strings"], "<u4").reshape(trees, n).astype(np.int64)
            places = np.frombuffer(shard["places"], "<i4").reshape(trees, n)
            query, query_norms = _scaled(_matrix(column(block, "vector"), widest))
            query_ids, numbers = column(block, "id").to_numpy(), column(block, "_query").to_numpy()
            keys = _strings(query[:, :dims], _planes(dims, trees, bits, seed), trees, bits)
            enough = max(LEAST, math.ceil(gather * n))
            for at in range(0, len(query), 256):
                low, high = _ranges(strings, keys[at : at + 256], bits)
                width = high - low
                totals = width.sum(axis=0, dtype=np.int64)
                for q in range(low.shape[2]):
                    b = int(np.flatnonzero(totals[:, q] >= enough).max(initial=0))  # the longest that give enough; 0 gives all
                    longer = min(b + 1, bits)
                    # the last step up goes tree by tree, and ends once there is enough
                    gains = np.cumsum(width[:, b, q] - width[:, longer, q]) + totals[longer, q]
                    last = int(np.searchsorted(gains, enough)) if longer > b else trees
                    mark = np.zeros(n, bool)
                    for t in range(trees):
                        level = b if t <= last else longer
                        mark[places[t, low[t, level, q] : high[t, level, q]]] = True
                    some = np.flatnonzero(mark)
                    if len(some) <= k:  # only when trees agree on very few: take the whole shard
                        some = np.arange(n)
                    one = query[at + q]
                    scores = (vectors[some] * one).sum(axis=1) / (norms[some] * query_norms[at + q])
                    if len(some) > k + 1:
                        some_best = scores >= np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                        some, scores = some[some_best], scores[some_best]
                    counts = firsts[some + 1] - firsts[some]
                    every = np.concatenate([ids[firsts[s] : firsts[s + 1]] for s in some])
                    scores = np.repeat(scores, counts)
                    other = every != query_ids[at + q]
                    every, scores = every[other], scores[other]
                    order = np.lexsort((every, -scores))[:k]
                    out[0] += [numbers[at + q]] * len(order)
                    out[1] += [query_ids[at + q]] * len(order)
                    out[2] += every[order].tolist()
                    out[3] += scores[order].tolist()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table({name: pa.array(v, t) for name, v, t in zip(names, out, kinds, strict=True)})

    found = left.groupBy("_cell").cogroup(right.groupBy("_cell")).applyInArrow(
        find, "_query bigint, query_id bigint, vec_id bigint, score double"
    )
    return merged(found, k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the rows of ``exact`` (query_id, vec_id) that ``found`` has too; 1 for an empty ``exact``."""
    keys = ["query_id", "vec_id"]
    row = exact.select(*keys).join(found.select(*keys).withColumn("hit", F.lit(1)), keys, "left").agg(F.count("*"), F.count("hit")).first()
    return row[1] / row[0] if row[0] else 1.0
