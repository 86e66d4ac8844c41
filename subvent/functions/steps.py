"""Finding the step of a value among sorted edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def edges_passed(value: Column, edges: Sequence[float]) -> Column:
    """Number of ``edges`` (sorted) that are <= value, by halving: few comparisons, all in generated code."""

    def halve(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < edges[mid], halve(lo, mid)).otherwise(halve(mid + 1, hi))

    return halve(0, len(edges))
