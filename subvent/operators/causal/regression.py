"""Forests of regression trees for residuals: all folds and all outcomes grown together, level by level.

A tree predicts several columns by the means of its leaves, and splits where their variances, each as a share of the column's
own, fall most. Every fold has its own trees; tree t of each fold draws the same units and leaves out the rows of its fold, so one
word of packed draws per row serves all folds.

A level is one scan of a compact table. A task holds a buffer of rows, walks them through one tree after another, and sends that
tree's sums per (node, feature, bin); they are added up by a grouped sum. What a task holds does not depend on the number of
trees, and what is shuffled does not depend on the number of rows beyond one set of sums per buffer. The driver sees the winning
splits only: folds x trees x 2^depth rows at most, a matter of settings. The means of a leaf are those of the side of the split that made
it, so they need no pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subvent.functions.checks import finite
from subvent.operators.causal.draws import bits_of

# Rows that a task holds while it walks them through the trees.
BUFFER_ROWS = 1 << 18
# fixed value: a gain below this share of the rows in a node is no gain, sums of doubles differ in their last digits
NO_GAIN = 1e-9


@dataclass
class RegressionForest:
    """Splits and means of ``folds`` x ``trees`` trees as (tree, node) arrays; fold f has the trees f * trees to (f + 1) * trees - 1."""

    folds: int
    trees: int
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    means: np.ndarray
    filled: np.ndarray

    @staticmethod
    def empty(folds: int, trees: int, depth: int, columns: int) -> RegressionForest:
        nodes = (folds * trees, 1 << (depth + 1))
        return RegressionForest(
            folds, trees, depth,
            np.full(nodes, -1, dtype=np.int32), np.zeros(nodes, dtype=np.int32), np.zeros((*nodes, columns)), np.zeros(nodes, dtype=bool),
        )

    def add(self, splits: list, columns: int) -> None:
        """Take the winning ``splits`` of a level: their nodes part, and the sums of both sides become means."""
        for r in splits:
            tree, node = r["tree"], r["node"]
            self.feature[tree, node], self.cut[tree, node] = r["feature"], r["bin"]
            left = np.array([r[f"l_s{i}"] for i in range(columns)])
            whole = np.array([r[f"t_s{i}"] for i in range(columns)])
            self.means[tree, 2 * node] = left / r["l_n"]
            self.means[tree, 2 * node + 1] = (whole - left) / (r["t_n"] - r["l_n"])
            self.filled[tree, 2 * node : 2 * node + 2] = True

    def predictor(self):
        """An Arrow function of bins and fold: the means over the fold's trees per column, NULL where no tree of the fold has a row."""
        columns = self.means.shape[2]

        @F.arrow_udf("array<double>")
        def guesses(bins: pa.Array, fold: pa.Array) -> pa.Array:
            rows = len(bins)
            matrix = _matrix(bins)
            own = fold.fill_null(-1).to_numpy(zero_copy_only=False)
            total, count = np.zeros((rows, columns)), np.zeros(rows)
            for f in range(self.folds):
                mine = np.flatnonzero(own == f)
                part = matrix[mine]
                for tree in range(f * self.trees, (f + 1) * self.trees) if len(mine) else ():
                    if self.filled[tree, 1]:
                        total[mine] += self.means[tree].take(_walk(self.feature[tree], self.cut[tree], part, self.depth), axis=0)
                        count[mine] += 1
            mean = total / np.maximum(count, 1)[:, None]
            values = pa.array(mean.ravel(), mask=np.repeat(count == 0, columns))
            return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * columns), values)

        return guesses


def _walk(feature: np.ndarray, cut: np.ndarray, bins: np.ndarray, steps: int) -> np.ndarray:
    """The node of a tree that each row of ``bins`` reaches in ``steps`` splits; a row stays where a node has none."""
    flat, start = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    node = np.ones(len(bins), dtype=np.int64)
    for _ in range(steps):
        f = feature.take(node)
        child = 2 * node + (flat.take(start + np.maximum(f, 0)) > cut.take(node))
        node = np.where(f < 0, node, child)
    return node


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), -1))


def _level_sums(forest: RegressionForest, level: int, sizes: Sequence[int], columns: int, buffer_rows: int):
    """The function of a task: Arrow batches of (bins, words, fold, weight, values) to sums per (tree, node, feature, bin)."""
    names = ["tree", "node", "feature", "bin", "n", *[f"s{i}" for i in range(columns)]]
    folds, trees, least = forest.folds, forest.trees, 1 << level
    parted, cut = forest.feature[:, :least].copy(), forest.cut[:, :least].copy()

    def sums(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        column = {name: table.column(name).combine_chunks() for name in table.column_names}
        bins, words, values = _matrix(column["bins"]), _matrix(column["words"]), _matrix(column["values"])
        fold, weight = column["fold"].to_numpy(), column["weight"].to_numpy()
        times = values * weight[:, None]
        for tree in range(folds * trees):
            if level and not (parted[tree, least >> 1 :] >= 0).any():
                continue  # no node parted one level up
            drawn = np.flatnonzero(bits_of(words, tree % trees) & (fold != tree // trees))
            node = _walk(parted[tree], cut[tree], bins.take(drawn, axis=0), level)
            drawn, node = drawn[node >= least], node[node >= least] - least
            if not len(drawn):
                continue
            parts = []
            for feature, size in enumerate(sizes):
                key = node * size + bins[drawn, feature]
                n = np.bincount(key, weight[drawn], minlength=least * size)
                at = np.flatnonzero(n)
                found = [np.bincount(key, times[drawn, i], minlength=least * size)[at] for i in range(columns)]
                parts.append((at // size + least, np.full(len(at), feature, np.int32), (at % size).astype(np.int32), n[at], *found))
            arrays = [np.concatenate(c) for c in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (np.full(len(arrays[0]), tree, np.int32), *arrays)], names=names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= buffer_rows:
                yield from sums(held)
                held, rows = [], 0
        if rows:
            yield from sums(held)

    return task


def _winners(rows: DataFrame, variances: Sequence[float], min_leaf: int) -> DataFrame:
    """The best split per (tree, node) with the sums of the node and of its left side; ties go to the first (feature, bin)."""
    summed = ["n", *[f"s{i}" for i in range(len(variances))]]
    hist = rows.groupBy("tree", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in summed])
    node = "PARTITION BY tree, node, feature"
    both = hist.selectExpr(
        "tree", "node", "feature", "bin",
        *[f"sum({c}) OVER ({node}) AS t_{c}" for c in summed],
        *[f"sum({c}) OVER ({node} ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l_{c}" for c in summed],
    )
    allowed = both.filter(f"l_n >= {min_leaf} AND t_n - l_n >= {min_leaf}")
    fall = " + ".join(
        f"(l_s{i} * l_s{i} / l_n + (t_s{i} - l_s{i}) * (t_s{i} - l_s{i}) / (t_n - l_n) - t_s{i} * t_s{i} / t_n) / {v!r}D"
        for i, v in enumerate(variances)
        if v > 0
    )
    gains = allowed.withColumn("gain", F.expr(fall or "0D")).filter(finite(F.col("gain")) & F.expr(f"gain > {NO_GAIN}D * t_n"))
    kept = ", ".join(f"t_{c}, l_{c}" for c in summed)
    best = gains.selectExpr(
        "tree", "node", f"struct(float(gain) AS rank, -feature AS first_feature, -bin AS first_bin, feature, bin, gain, {kept}) AS candidate"
    )
    return best.groupBy("tree", "node").agg(F.max("candidate").alias("best")).select("tree", "node", "best.*")


def grow(
    rows: DataFrame, sizes: Sequence[int], variances: Sequence[float], folds: int, trees: int, depth: int, min_leaf: int,
    buffer_rows: int = BUFFER_ROWS,
) -> RegressionForest:
    """Grow the trees of all folds on ``rows``, a written table of bins, words (packed draws), fold, weight and values.

    ``sizes`` are the numbers of bins by feature, ``variances`` those of the value columns; a column without any is not split for.
    """
    columns = len(variances)
    forest = RegressionForest.empty(folds, trees, depth, columns)
    schema = "tree int, node bigint, feature int, bin int, n double" + "".join(f", s{i} double" for i in range(columns))
    for level in range(depth):
        found = rows.mapInArrow(_level_sums(forest, level, sizes, columns, buffer_rows), schema)
        if level == 0:
            _take_roots(forest, found.filter("feature = 0"), columns)
        splits = _winners(found, variances, min_leaf).collect()
        forest.add(splits, columns)
        if not splits:
            break
    return forest


def _take_roots(forest: RegressionForest, found: DataFrame, columns: int) -> None:
    sums = found.groupBy("tree").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(columns)])
    for r in sums.collect():
        forest.means[r["tree"], 1] = [r[f"s{i}"] / r["n"] for i in range(columns)]
        forest.filled[r["tree"], 1] = True
