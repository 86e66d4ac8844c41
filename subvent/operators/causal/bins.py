"""Covariates as small integer bins packed in one array."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subvent.functions.checks import finite, require
from subvent.functions.steps import edges_passed
from subvent.sources.staging import scratch, stage

# A text column with more values than this is one feature: its values in the order of their hashes, cut evenly.
MAX_LEVELS = 256
EDGES_SCHEMA = "feature int, name string, edges array<double>, level string, hashed boolean, ordered int"
# How a forest takes a text covariate: its values in the order of their effects, or a feature per value.
ORDERED, EACH = "ordered", "each"


@dataclass(frozen=True)
class Feature:
    """A numeric column with its edges, one value of a text column, a text column by the hashes of its many values, or one whose
    values each tree puts in order, in ``ordered`` bins at most (``operators/causal/levels.py``)."""

    name: str
    edges: tuple[float, ...] | None = None
    level: str | None = None
    hashed: bool = False
    ordered: int = 0

    def n_bins(self) -> int:
        if self.ordered:
            return self.ordered + 2
        return 3 if self.edges is None else len(self.edges) + 2

    def bin(self) -> Column:
        """0 for NULL; else 1 + the number of edges not above the value, or 2/1 for equal or not."""
        if self.ordered:
            return F.lit(0)  # only a tree knows
        col = F.col(self.name)
        if self.edges is None:
            found = F.when(col.cast("string") == self.level, 2).otherwise(1)
        else:
            found = 1 + edges_passed((F.xxhash64(col.cast("string")) if self.hashed else col).cast("double"), self.edges)
        return F.when(col.isNull(), 0).otherwise(found)


@dataclass(frozen=True)
class FeatureBins:
    """How to bin covariates; made from training rows and reused for scoring."""

    features: tuple[Feature, ...]

    def ordered(self) -> dict[int, str]:
        """Columns of the features that each tree orders by itself, by number."""
        return {i: f.name for i, f in enumerate(self.features) if f.ordered}

    def packed(self) -> Column:
        return F.array(*[f.bin() for f in self.features])

    def possible_cells(self) -> int:
        """Upper bound on the distinct arrays of bins; the levels of a text column exclude each other."""
        levels = Counter(f.name for f in self.features if f.level is not None)
        sizes = [f.n_bins() for f in self.features if f.level is None] + [n + 1 for n in levels.values()]
        return prod(sizes)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, f.name, None if f.edges is None else list(f.edges), f.level, f.hashed, f.ordered) for i, f in enumerate(self.features)]
        return spark.createDataFrame(rows, EDGES_SCHEMA)

    @staticmethod
    def from_df(df: DataFrame) -> FeatureBins:
        rows = sorted(df.collect(), key=lambda r: r["feature"])
        return FeatureBins(
            tuple(
                Feature(
                    r["name"], None if r["edges"] is None else tuple(r["edges"]), r["level"], "hashed" in r and r["hashed"],
                    r["ordered"] if "ordered" in r else 0,
                )
                for r in rows
            )
        )


def _levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The values of each text column that has at most MAX_LEVELS, all columns in one pass over the rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("level")) for c in columns])
    with scratch(df.sparkSession):
        found = stage(df.select(F.inline(pairs)).filter("level IS NOT NULL").distinct(), "levels")
        counts = dict(found.groupBy("name").count().collect())
        few = [c for c in columns if counts.get(c, 0) <= MAX_LEVELS]
        rows = found.filter(F.col("name").isin(few)).collect() if few else []
    return {c: sorted(r["level"] for r in rows if r["name"] == c) for c in few}


def learn_bins(
    df: DataFrame, columns: Sequence[str], n_bins: int = 32, edges: Mapping[str, Sequence[float]] | None = None
) -> FeatureBins:
    """Edges at even quantiles (one pass for all columns) and levels of text columns.

    A text column of more than MAX_LEVELS values is one feature with ``n_bins`` bins of values, dealt out by hash.
    """
    return learn_bins_and(df, columns, n_bins, edges, [])[0]


def learn_bins_and(
    df: DataFrame,
    columns: Sequence[str],
    n_bins: int,
    edges: Mapping[str, Sequence[float]] | None,
    also: Sequence[Column],
    values: str | None = None,
) -> tuple[FeatureBins, tuple]:
    """:func:`learn_bins`, with further aggregates taken in the same pass over the rows.

    ``values`` is ORDERED for one feature per text column that trees order, or EACH for a feature per value and no other way.
    """
    require(df, columns)
    if n_bins < 2:
        raise ValueError("n_bins must be at least 2")
    edges = dict(edges or {})
    types = {f.name: f.dataType for f in df.schema.fields}
    text = [c for c in columns if not isinstance(types[c], T.NumericType)]
    learn = [c for c in columns if c not in text and c not in edges]
    shares = F.array(*[F.lit(i / n_bins) for i in range(n_bins)])
    wanted = [F.percentile_approx(F.when(finite(F.col(c)), F.col(c).cast("double")), shares, 10_000) for c in learn] + list(also)
    results = tuple(df.agg(*[w.alias(f"a{i}") for i, w in enumerate(wanted)]).first()) if wanted else ()
    for c, found in zip(learn, results):
        # the lowest quantile is the smallest value: no row lies below it
        edges[c] = sorted(set(found) - {min(found)}) if found else []
    levels = _levels(df, text) if text and values != ORDERED else {}
    if values == EACH and len(levels) < len(text):
        many = ", ".join(c for c in text if c not in levels)
        raise ValueError(f"{many}: more than {MAX_LEVELS} values are too many for a feature each; use values='{ORDERED}'")
    features = []
    for c in columns:
        if c in levels:
            features += [Feature(c, level=v) for v in levels[c]]
        elif c in text and values == ORDERED:
            features.append(Feature(c, ordered=2 * n_bins))
        elif c in text:
            even = tuple((2 * i / n_bins - 1) * 2.0**63 for i in range(1, n_bins))
            features.append(Feature(c, edges=even, hashed=True))
        else:
            features.append(Feature(c, edges=tuple(sorted(float(e) for e in edges[c]))))
    return FeatureBins(tuple(features)), results[len(learn) :]


def bin_features(
    df: DataFrame,
    features: Sequence[str],
    n_bins: int = 32,
    edges: Mapping[str, Sequence[float]] | None = None,
    output: str = "bins",
) -> tuple[DataFrame, FeatureBins]:
    """``df`` with an ``array<int>`` of bins, one per feature, and the edges for scoring."""
    found = learn_bins(df, features, n_bins, edges)
    return df.withColumn(output, found.packed()), found
