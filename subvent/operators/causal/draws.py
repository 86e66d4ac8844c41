"""Repeatable subsampling of units per tree, split into two honest halves."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subvent.functions.checks import require

# Trees whose bits are packed in one number.
WORD = 64


def bits_of(words: np.ndarray, tree: int) -> np.ndarray:
    """Whether each row's packed bits hold that of ``tree``, counted from 0; ``words`` has a row of words per row."""
    return (words[:, tree // WORD] >> (tree % WORD)) & 1 != 0


@dataclass(frozen=True)
class Draws:
    """Which units each tree sees.

    ``formula(unit, tree)`` gives an integer in ``[0, draw_range)``; by default a hash, so a
    retried task draws the same. A unit is in a tree's sample when its draw is below
    ``fraction * draw_range``; even draws find the splits, odd draws fill the leaves. With
    ``bag_size`` above 1, each run of that many trees first shares one half of the units.
    """

    trees: int
    fraction: float = 0.5
    seed: int = 0
    bag_size: int = 1
    formula: Callable[[Column, Column], Column] | None = None
    draw_range: int = 1 << 30

    def __post_init__(self):
        if self.trees < 1 or not 0 < self.fraction <= 1:
            raise ValueError("trees must be at least 1 and fraction in (0, 1]")
        if self.bag_size < 1 or self.trees % self.bag_size:
            raise ValueError("bag_size must divide trees")
        if self.bag_size > 1 and self.fraction > 0.5:
            raise ValueError("bags share half of the units, so fraction can be at most 0.5")

    def draw(self, unit: Column, tree: Column) -> Column:
        if self.formula is not None:
            return self.formula(unit, tree)
        return F.pmod(F.xxhash64(F.lit(self.seed), tree.cast("int"), unit), F.lit(self.draw_range))

    def in_sample(self, unit: Column, tree: Column) -> Column:
        if self.bag_size == 1:
            return self.draw(unit, tree) < F.lit(int(self.fraction * self.draw_range))
        bag = (F.floor((tree - 1) / self.bag_size) + self.trees + 1).cast("int")
        half = self.draw(unit, bag) < F.lit(self.draw_range // 2)
        return half & (self.draw(unit, tree) < F.lit(int(2 * self.fraction * self.draw_range)))

    def in_split_half(self, unit: Column, tree: Column) -> Column:
        return self.draw(unit, tree) % 2 == 0

    def packed(self, unit: Column, inside: bool = True) -> Column:
        """An array of words with a bit per tree: is the unit in its sample, or outside of it; NULL is neither."""
        known = unit.isNotNull()

        def with_bit(word: Column, tree: Column) -> Column:
            there = self.in_sample(unit, tree)
            there = F.coalesce(known & (there if inside else ~there), F.lit(False))
            return word.bitwiseOR(F.call_function("shiftleft", there.cast("bigint"), F.pmod(tree - 1, F.lit(WORD))))

        def word(first: Column) -> Column:
            own = F.sequence(first, F.least(first + (WORD - 1), F.lit(self.trees)))
            return F.aggregate(own, F.lit(0).cast("bigint"), with_bit)

        # a loop of the plan, not a plan per tree: hundreds of expressions take longer to compile than most tables to score
        return F.transform(F.sequence(F.lit(1), F.lit(self.trees), F.lit(WORD)), word)


def honest_draws(
    panel: DataFrame,
    unit: str,
    trees: int,
    fraction: float = 0.5,
    seed: int = 0,
    draws: Draws | None = None,
) -> DataFrame:
    """One row per (unit, tree) with role ``out``, ``split`` or ``leaf``; NULL for a row without a unit."""
    require(panel, [unit])
    draws = draws or Draws(trees, fraction, seed)
    u, t = F.col(unit), F.col("tree")
    role = F.when(draws.in_split_half(u, t), "split").otherwise("leaf")
    role = F.when(u.isNotNull(), F.when(draws.in_sample(u, t), role).otherwise("out"))
    tree = F.explode(F.sequence(F.lit(1), F.lit(draws.trees))).alias("tree")
    return panel.select(unit, tree).withColumn("role", role)
