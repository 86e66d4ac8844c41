"""Row-local scoring of a forest on Arrow batches.

The same walk written with higher-order functions stays in the JVM but is interpreted per
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from subvent.operators.causal.draws import bits_of

LEAF_MEANS = ("mz", "mw", "my", "mzy", "mzw")
# fixed value: a first stage that cancels to below this share of its parts counts as zero
CANCELLED = 1e-10


@dataclass(frozen=True)
class PackedForest:
    """Splits and leaves as (tree, node) arrays; a node without a split passes rows to its left child."""

    feature: np.ndarray
    cut: np.ndarray
    means: np.ndarray
    filled: np.ndarray
    depth: int
    bag_size: int

    @staticmethod
    def build(splits: pd.DataFrame, leaves: pd.DataFrame, trees: int, depth: int, bag_size: int, first: int = 1) -> PackedForest:
        width = 1 << depth
        feature = np.zeros((trees, width), dtype=np.int32)
        cut = np.full((trees, width), np.iinfo(np.int32).max, dtype=np.int32)
        at = splits["tree"].to_numpy() - first, splits["node"].to_numpy()
        feature[at] = splits["feature"].to_numpy()
        cut[at] = splits["bin"].to_numpy()
        # a leaf above the full depth is found at its leftmost descendant
        node = leaves["node"].to_numpy().astype(np.int64)
        level = np.floor(np.log2(np.maximum(node, 1))).astype(np.int64)
        at = leaves["tree"].to_numpy() - first, (node << (depth - level)) - width
        means = np.zeros((trees, width, len(LEAF_MEANS)))
        filled = np.zeros((trees, width), dtype=bool)
        means[at] = leaves[list(LEAF_MEANS)].to_numpy(dtype=float)
        filled[at] = True
        return PackedForest(feature, cut, means, filled, depth, bag_size)

    def leaf(self, tree: int, flat: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Leaf of each row; ``flat`` holds the rows' bins end to end and ``start`` each row's first."""
        feature, cut = self.feature[tree], self.cut[tree]
        node = np.ones(len(start), dtype=np.int64)
        for _ in range(self.depth):
            right = flat.take(start + feature.take(node)) > cut.take(node)
            node = 2 * node + right
        return node - (1 << self.depth)


def _totals(
    forest: PackedForest, bins: np.ndarray, allowed: np.ndarray | None, own: dict[int, np.ndarray], first: int, total: np.ndarray, count: np.ndarray,
    keep: bool = False,
):
    """Adds the leaf means of usable trees to ``total`` and their number to ``count``; with ``keep``, each tree's leaf and usability.

    ``allowed`` holds each row's packed bits of the trees it may use, ``own``, for features whose bins each tree has for itself, the bins by
    row and tree; the forest's trees come after ``first`` others in both.
    """
    trees = len(forest.feature)
    leaf = np.empty((trees, len(bins)), dtype=np.int32) if keep else None
    usable = np.empty((trees, len(bins)), dtype=bool) if keep else None
    bins = bins.copy() if own else np.ascontiguousarray(bins)
    flat, start = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    for t in range(trees):
        for feature, in_trees in own.items():
            bins[:, feature] = in_trees[:, first + t]
        at = forest.leaf(t, flat, start)
        used = forest.filled[t].take(at)
        if allowed is not None:
            used &= bits_of(allowed, first + t)
        found = forest.means[t].take(at, axis=0)
        # means of an empty leaf are 0, so only trees that are not allowed need masking
        total += found if allowed is None else found * used[:, None]
        count += used
        if keep:
            leaf[t], usable[t] = at, used
    return leaf, usable


def _effects(total: np.ndarray, count: np.ndarray):
    """Mean of the leaf means, effect, its first stage (1 where there is none), and whether there is one."""
    mean = total / np.maximum(count, 1)[:, None]
    mz, mw, my, mzy, mzw = mean.T
    spread = mzw - mz * mw
    real = (count > 0) & (np.abs(spread) > CANCELLED * (np.abs(mzw) + np.abs(mz * mw)))
    safe = np.where(real, spread, 1.0)
    return mean, (mzy - mz * my) / safe, safe, real


def _add_bags(forest: PackedForest, effect, spread, mean, leaf, used, sums: np.ndarray) -> None:
    """Adds to ``sums``: full bags, squares of their mean scores, and the scores' variances within them."""
    mz, mw, my = mean[:, 0], mean[:, 1], mean[:, 2]
    size, rows = forest.bag_size, len(effect)
    for first in range(0, len(forest.feature), size):
        scores = np.empty((size, rows))
        for i in range(size):
            m = forest.means[first + i, leaf[first + i]]
            level = m[:, 2] - my - effect * (m[:, 1] - mw)
            cross = m[:, 3] - effect * m[:, 4] - (my - effect * mw) * m[:, 0]
            scores[i] = (cross - mz * level) / spread
        full = used[first : first + size].all(axis=0)
        centre = scores.mean(axis=0)
        sums[0] += full
        sums[1] += np.where(full, centre**2, 0.0)
        sums[2] += np.where(full, ((scores - centre) ** 2).mean(axis=0), 0.0)


def _error(sums: np.ndarray, size: int) -> np.ndarray:
    """Little-bags standard error of the score, over the first stage."""
    bags, between, within = sums
    value = np.maximum(between - within / (size - 1), 0.0) / np.maximum(bags, 1)
    return np.where(bags >= 2, np.sqrt(value), np.nan)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _read(bins: pa.Array, more: tuple[pa.Array, ...], oob: bool, ordered: tuple[int, ...]):
    """The packed bins, the bits of the allowed trees, and the ordered features' bins per tree, of a batch."""

    def matrix(a: pa.Array) -> np.ndarray:
        return _matrix(a, len(a.flatten()) // len(a) if len(a) else 1)

    usable = matrix(more[0]) if oob else None
    return matrix(bins), usable, {i: matrix(a) for i, a in zip(ordered, more[1:] if oob else more, strict=True)}


def _fields(variance: bool) -> list[str]:
    return ["effect double", *(["std_error double"] if variance else []), "n_trees int", "effect_status string"]


def _scores(effect: np.ndarray, real: np.ndarray, count: np.ndarray, error: np.ndarray | None) -> pa.Array:
    out = [pa.array(effect, mask=~real)]
    if error is not None:
        out.append(pa.array(error, mask=~real | np.isnan(error)))
    status = np.where(real, "ok", np.where(count > 0, "no_first_stage", "no_tree"))
    out += [pa.array(count.astype(np.int32)), pa.array(status.astype(str), type=pa.string())]
    return pa.StructArray.from_arrays(out, names=[f.split()[0] for f in _fields(error is not None)])


def leaf_scorer(forest: PackedForest, oob: bool, variance: bool, ordered: tuple[int, ...] = ()):
    """An Arrow function of the packed bins (the packed bits of the allowed trees, and the ``ordered`` features' bins per tree) giving a struct per row."""

    @F.arrow_udf(", ".join(_fields(variance)))
    def scorer(bins: pa.Array, *more: pa.Array) -> pa.Array:
        at, usable, own = _read(bins, more, oob, ordered)
        total, count = np.zeros((len(bins), len(LEAF_MEANS))), np.zeros(len(bins), np.int64)
        leaf, used = _totals(forest, at, usable, own, 0, total, count, keep=variance)
        mean, effect, safe, real = _effects(total, count)
        if not variance:
            return _scores(effect, real, count, None)
        bags = np.zeros((3, len(bins)))
        _add_bags(forest, effect, safe, mean, leaf, used, bags)
        return _scores(effect, real, count, _error(bags, forest.bag_size))

    return scorer


def _rows_of(sums: pa.Array, width: int) -> np.ndarray:
    """Sums so far, a row per row; zeros before the first group of trees."""
    return np.zeros((len(sums), width)) if sums.null_count else _matrix(sums, width).copy()


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))


def leaf_summer(forest: PackedForest, first: int, oob: bool, ordered: tuple[int, ...]):
    """An Arrow function of the sums so far and the inputs of a scorer: five sums of leaf means and the number of trees, with these trees."""
    width = len(LEAF_MEANS) + 1

    @F.arrow_udf("array<double>")
    def summer(before: pa.Array, bins: pa.Array, *more: pa.Array) -> pa.Array:
        at, usable, own = _read(bins, more, oob, ordered)
        rows = _rows_of(before, width)
        total, count = rows[:, :-1].copy(), rows[:, -1].astype(np.int64)
        _totals(forest, at, usable, own, first, total, count)
        return _lists(np.column_stack([total, count]))

    return summer


def bag_summer(forest: PackedForest, first: int, oob: bool, ordered: tuple[int, ...]):
    """The same for the sums of little bags, given the sums of all trees."""

    @F.arrow_udf("array<double>")
    def summer(sums: pa.Array, before: pa.Array, bins: pa.Array, *more: pa.Array) -> pa.Array:
        at, usable, own = _read(bins, more, oob, ordered)
        whole = _rows_of(sums, len(LEAF_MEANS) + 1)
        mean, effect, safe, _ = _effects(whole[:, :-1], whole[:, -1])
        leaf, used = _totals(forest, at, usable, own, first, np.zeros_like(mean), np.zeros(len(bins), np.int64), keep=True)
        bags = np.ascontiguousarray(_rows_of(before, 3).T)
        _add_bags(forest, effect, safe, mean, leaf, used, bags)
        return _lists(np.ascontiguousarray(bags.T))

    return summer


def summed_scorer(bag_size: int, variance: bool):
    """An Arrow function of all trees' sums (and bags') giving a scorer's struct."""

    @F.arrow_udf(", ".join(_fields(variance)))
    def scorer(sums: pa.Array, *bags: pa.Array) -> pa.Array:
        whole = _rows_of(sums, len(LEAF_MEANS) + 1)
        _, effect, _, real = _effects(whole[:, :-1], whole[:, -1])
        return _scores(effect, real, whole[:, -1].astype(np.int64), _error(_rows_of(bags[0], 3).T, bag_size) if variance else None)

    return scorer
