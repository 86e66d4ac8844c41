"""Exact top-k by integer inner product: term-at-a-time accumulation over blocks.

Candidates are dealt out evenly into blocks, queries too, and each pair of blocks is one task's work: the candidates'
block becomes posting lists, every term of a sparse query scatters its weighted postings into a dense array of
scores, a partition of that array gives the block's best, and the blocks' bests are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subvent.llm.common import column

#: Rows of a block of candidates and of queries.
CANDIDATES, QUERIES = 4096, 4096


def usable(vector: Column) -> Column:
    """Whether the vector and all its components are there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def grid(candidates: DataFrame, queries: DataFrame, candidate_rows: int, query_rows: int):
    """Both tables with ``_cell``, the pair of a block of candidates and a block of queries, ready for a cogroup.

    Rows are dealt out by their place in the scan, so neither equal rows nor equal ids gather in a block. A candidate is
    sent once per block of queries, a query once per block of candidates.
    """
    n_candidates = max(1, math.ceil(candidates.count() / candidate_rows))
    n_queries = max(1, math.ceil(queries.count() / query_rows))
    dealt = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n))
    left = candidates.withColumn("_block", dealt(n_candidates)).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    right = queries.withColumn("_block", dealt(n_queries)).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(n_candidates - 1))))
    left = left.withColumn("_cell", F.col("_block") * n_queries + F.col("_other")).drop("_block", "_other")
    right = right.withColumn("_cell", F.col("_other") * n_queries + F.col("_block")).drop("_block", "_other")
    return left.groupBy("_cell"), right.groupBy("_cell")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id; a partition, then a sort of what reaches its threshold."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    order = np.lexsort((ids[some], -scores[some]))
    return some[order[:k]]


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each ``_query`` over all blocks, ranked; only k of a block and task reach the shuffle."""
    order = Window.partitionBy("_query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def quantised(lists: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight floor(scale * x) of every weight other than 0; Python's integers where 64 bits are too few."""
    counts = np.asarray(lists.value_lengths(), np.int64)
    flat = np.asarray(lists.flatten(), np.float64)
    rows = np.repeat(np.arange(len(counts)), counts)
    terms = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        weights = np.floor(flat * scale)
    if len(weights) and not np.abs(weights).max() < 2**53:
        weights = np.asarray([int(w) if math.isfinite(w) else int(x) * scale for x, w in zip(flat.tolist(), weights.tolist(), strict=True)], object)
    else:
        weights = weights.astype(np.int64)
    some = np.flatnonzero(weights)
    return rows[some], terms[some], weights[some]


def accumulate(queries: tuple, postings: tuple, n_queries: int, n_rows: int):
    """Yields each query's dense scores over all rows of the block, one term after the other."""
    rows, terms, weights = postings
    order = np.argsort(terms, kind="stable")
    rows, terms, weights = rows[order], terms[order], weights[order]
    q_rows, q_terms, q_weights = queries
    limit = 0
    if len(weights) and len(q_weights):
        limit = int(abs(weights).max()) * int(abs(q_weights).max()) * int(np.bincount(q_rows).max())
    kind = np.int64 if limit < 2**62 else object
    weights, q_weights = weights.astype(kind), q_weights.astype(kind)
    lists = {}
    if len(terms):
        cuts = np.flatnonzero(np.diff(terms)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(terms)], strict=True):
            lists[int(terms[a])] = (rows[a:b] if b - a < n_rows else slice(None), weights[a:b])
    ends = np.searchsorted(q_rows, np.arange(n_queries + 1))
    for q in range(n_queries):
        scores = np.zeros(n_rows, kind)
        for at in range(ends[q], ends[q + 1]):
            if found := lists.get(int(q_terms[at])):
                scores[found[0]] += q_weights[at] * found[1]
        yield scores


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: int = 256,
    vector: str = "embedding",
    id_col: str = "vec_id",
    candidate_rows: int = CANDIDATES,
    query_rows: int = QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k rows of ``vectors`` with the highest inner product with each row of
    ``queries``, components taken as floor(scale * x); ties to the smaller id; fewer rows if there are fewer.

    A query does not find rows with its own id. Vectors that are NULL or hold a NULL or non-finite component take no part,
    nor do rows without an id; an empty vector scores 0. Vectors may differ in length. Repeated rows count each, also as
    queries. Sums beyond 64 bits are ranked exactly and returned as the nearest long. Other columns are not carried.
    """
    pick = [F.col(id_col).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector")]
    some = lambda df: df.select(*pick).filter(usable(F.col("vector")) & F.col("id").isNotNull())
    left, right = grid(
        some(vectors), some(queries).withColumn("_query", F.monotonically_increasing_id()), candidate_rows, query_rows
    )

    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, query_ids = column(rows, "id").to_numpy(), column(asked, "id").to_numpy()
        numbers = column(asked, "_query").to_numpy()
        every = accumulate(quantised(column(asked, "vector"), scale), quantised(column(rows, "vector"), scale), len(asked), len(rows))
        out: list[tuple] = []
        for q, scores in enumerate(every):
            own = ids == query_ids[q]
            if own.any():
                others = np.flatnonzero(~own)
                at = others[best(scores[others], ids[others], k)]
            else:
                at = best(scores, ids, k)
            kept = [max(-(2**63), min(2**63 - 1, int(s))) for s in scores[at]]
            out += zip([numbers[q]] * len(at), [query_ids[q]] * len(at), ids[at].tolist(), kept, strict=True)
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(("_query", "query_id", "vec_id", "score"), columns, strict=True)})

    found = left.cogroup(right).applyInArrow(search, "_query bigint, query_id bigint, vec_id bigint, score bigint")
    return merged(found, k)
