"""Instrumental-variable forest: growing, storing and scoring.

Growing is one grouped aggregation per level over a compact binned table; only the winning
splits (at most trees x 2^level rows) travel to the driver and back as a broadcast table.
Scoring is row-local.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subvent.functions.checks import as_double, complete, refuse, require, weighted
from subvent.operators.causal.bins import EACH, ORDERED, FeatureBins, learn_bins_and
from subvent.operators.causal.draws import Draws
from subvent.operators.causal.levels import LEVELS_SCHEMA, in_tree, learn_levels, tree_bins
from subvent.operators.causal.scoring import LEAF_MEANS, PackedForest, bag_summer, leaf_scorer, leaf_summer, summed_scorer
from subvent.operators.causal.split import SUMS, best_splits, histogram, row_sums
from subvent.sources.staging import drop_paths, kept_path, new_path, scratch, stage

SPLITS_SCHEMA = "tree int, node bigint, feature int, bin int, gain double"
LEAVES_SCHEMA = "tree int, node bigint, n bigint, mz double, mw double, my double, mzy double, mzw double"
# Partial sums a task may hold at a time; more trees than fit are grown in further passes.
GROUPS_PER_PASS = 4_000_000
# Bound on the broadcast tree tables, some 20 MB; a forest of more nodes is grown in groups of trees.
MOST_NODES = 1_000_000
# Nodes that a Python worker holds when it scores, some 200 MB; a forest of more is scored in passes over groups of trees.
MOST_SCORED = 4_000_000
# Units are merged into cells of equal bins when that leaves at least this many rows per cell.
ROWS_PER_CELL = 8


@dataclass(frozen=True)
class IVForest:
    """A grown forest as small tables, with what is needed to score new rows."""

    splits: DataFrame
    leaves: DataFrame
    bins: FeatureBins
    draws: Draws
    depth: int
    n_rows: int
    n_dropped: int
    # False after loading a forest grown with a draw formula without it: who was in which sample is not known
    draws_known: bool = True
    # bins per tree of the values of text covariates that trees order
    levels: DataFrame | None = None

    def save(self, path: str) -> None:
        spark = self.splits.sparkSession
        self.splits.write.parquet(f"{path}/splits")
        self.leaves.write.parquet(f"{path}/leaves")
        self.bins.to_df(spark).write.parquet(f"{path}/edges")
        if self.levels is not None:
            self.levels.write.parquet(f"{path}/levels")
        d = self.draws
        by_formula = d.formula is not None or not self.draws_known
        row = (self.depth, self.n_rows, self.n_dropped, d.trees, d.fraction, d.seed, d.bag_size, d.draw_range, by_formula)
        schema = (
            "depth int, n_rows bigint, n_dropped bigint, trees int, fraction double, seed bigint, "
            "bag_size int, draw_range bigint, by_formula boolean"
        )
        spark.createDataFrame([row], schema).write.parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str, formula: Callable[[Column, Column], Column] | None = None) -> IVForest:
        """Read a saved forest; pass the draw ``formula`` again if it was grown with one, or it cannot score out of bag."""
        s = spark.read.parquet(f"{path}/settings").first().asDict()
        known = formula is not None or not s.get("by_formula", False)
        bins = FeatureBins.from_df(spark.read.parquet(f"{path}/edges"))
        return IVForest(
            spark.read.parquet(f"{path}/splits"),
            spark.read.parquet(f"{path}/leaves"),
            bins,
            Draws(s["trees"], s["fraction"], s["seed"], s["bag_size"], formula, s["draw_range"]),
            s["depth"],
            s["n_rows"],
            s["n_dropped"],
            known,
            spark.read.schema(LEVELS_SCHEMA).parquet(f"{path}/levels") if bins.ordered() else None,
        )

    def packed(self, first: int = 1, last: int | None = None) -> PackedForest:
        """Both tables as arrays for scoring by trees ``first`` to ``last``: 2^depth entries per tree."""
        last = last or self.draws.trees
        splits, leaves = self.splits, self.leaves
        if (first, last) != (1, self.draws.trees):
            splits, leaves = (t.filter(F.col("tree").between(first, last)) for t in (splits, leaves))
        return PackedForest.build(splits.toPandas(), leaves.toPandas(), last - first + 1, self.depth, self.draws.bag_size, first)

    def in_passes(self) -> list[tuple[int, int]]:
        """First and last trees of groups whose nodes a worker can hold; bags stay whole, and a forest within the bound is one group."""
        bag = self.draws.bag_size
        size = max(1, MOST_SCORED // (2**self.depth * bag)) * bag
        return [(a, min(a + size - 1, self.draws.trees)) for a in range(1, self.draws.trees + 1, size)]


def _slot(node: str, tree: str, trees: int) -> Column:
    """One dense number per (node, tree): a single integer key makes the broadcast lookup an array access."""
    return F.col(node) * trees + F.col(tree)


def _descend(rows: DataFrame, splits: DataFrame, trees: int, steps: int, stay: bool) -> DataFrame:
    """``rows`` with the ``node`` reached after ``steps`` splits from the root.

    A row whose node did not split stays there, or is left out when ``stay`` is False. Each step is a
    lookup in the same small broadcast table.
    """
    rows = rows.withColumn("node", F.lit(1).cast("bigint"))
    table = F.broadcast(
        splits.select(_slot("node", "tree", trees).alias("_slot"), F.col("feature").alias("_f"), F.col("bin").alias("_b"))
    )
    for _ in range(steps):
        rows = rows.join(table, _slot("node", "tree", trees) == F.col("_slot"), "left" if stay else "inner")
        child = F.col("node") * 2 + (F.get("bins", F.col("_f")) > F.col("_b")).cast("bigint")
        node = F.when(F.col("_f").isNull(), F.col("node")).otherwise(child) if stay else child
        rows = rows.withColumn("node", node).drop("_slot", "_f", "_b")
    return rows


def _above_own_mean(rows: DataFrame, trees: int) -> DataFrame:
    """``rows`` with ``high`` taken against the mean of ``raw`` in the row's own node; at most MOST_NODES means."""
    means = rows.groupBy("tree", "node").agg((F.sum(F.col("n") * F.col("raw")) / F.sum("n")).alias("_mean"))
    table = F.broadcast(means.select(_slot("node", "tree", trees).alias("_slot"), "_mean"))
    rows = rows.join(table, _slot("node", "tree", trees) == F.col("_slot"))
    high = F.when(F.col("raw") > F.col("_mean"), F.col("n")).otherwise(0)
    return rows.withColumn("high", high).drop("_slot", "_mean", "raw")


def _sums(binned: DataFrame) -> list[Column]:
    weight = F.col("weight") if "weight" in binned.columns else None
    return row_sums(F.col("z"), F.col("w"), F.col("y"), F.col("high"), weight)


def _array(feature: int) -> str:
    """The column of a binned table that holds an ordered feature's bin in each tree."""
    return f"in_trees_{feature}"


def _tree_bins(bins: FeatureBins) -> Column:
    """The bins of a row in the tree of column ``tree``."""
    ordered = {i: _array(i) for i in bins.ordered()}
    return (in_tree(len(bins.features), ordered, F.col("tree")) if ordered else F.col("bins")).alias("bins")


def _expand(binned: DataFrame, bins: FeatureBins, draws: Draws, first: int, last: int, half: bool, raw: bool = False) -> DataFrame:
    """One row per (unit, tree) in the wanted half, for trees ``first`` to ``last``."""
    u, t = F.col("unit"), F.col("tree")
    wanted = draws.in_split_half(u, t) if half else ~draws.in_split_half(u, t)
    return (
        binned.withColumn("tree", F.explode(F.sequence(F.lit(first), F.lit(last))))
        .filter(draws.in_sample(u, t) & wanted)
        .select("tree", _tree_bins(bins), *_sums(binned), *(["raw"] if raw else []))
    )


def _merge_cells(binned: DataFrame, bins: FeatureBins, draws: Draws) -> DataFrame:
    """Sums per (tree, half, bins): units with equal bins always share their node."""
    u, t = F.col("unit"), F.col("tree")
    return stage(
        binned.withColumn("tree", F.explode(F.sequence(F.lit(1), F.lit(draws.trees))))
        .filter(draws.in_sample(u, t))
        .select(
            "tree",
            draws.in_split_half(u, t).alias("half"),
            _tree_bins(bins),
            *_sums(binned),
        )
        .groupBy("tree", "half", "bins")
        .agg(*[F.sum(c).alias(c) for c in SUMS]),
        "forest_cells",
    )


def iv_forest_fit(
    panel: DataFrame,
    z: str,
    w: str,
    y: str,
    x: Sequence[str],
    unit: str = "unit_id",
    trees: int = 50,
    depth: int = 4,
    min_leaf: int = 50,
    fraction: float = 0.5,
    n_bins: int = 32,
    seed: int = 0,
    edges: Mapping[str, Sequence[float]] | None = None,
    draws: Draws | None = None,
    raw_z: str | None = None,
    merge: bool | None = None,
    weight: str | None = None,
    values: str = ORDERED,
) -> IVForest:
    """Grow ``trees`` honest trees of at most ``depth`` splits.

    A text covariate is one feature, of any number of values: each tree puts them in the order of their effects on its split half and
    cuts that order (``values="ordered"``), so a split parts them into two sets. With ``values="each"`` every value is a feature of its
    own, equal or not; more than 256 values are refused. A large table of a forest's values stays staged until ``drop_staged``; ``save`` keeps it.
    ``raw_z`` names the instrument before centring, when ``z`` is a residual: the ``min_leaf``
    rule counts its high and low values (above or not above its mean in the node that is split). ``merge`` forces
    or forbids merging units with equal bins; by default the data decide, and an instrument of more than two values
    forbids it. A row without a unit, or with a NULL, NaN or infinity in z, w, y or ``raw_z``, is left out and counted
    in ``n_dropped``. A row with a ``weight`` counts as that many rows of its unit, also for ``min_leaf``; one without a
    positive weight is left out. Learned edges, and the shift of z, w and y, take each row once. Tables written on the way are deleted before the forest is returned.
    A forest of more than ``MOST_NODES`` nodes is grown in groups of trees, by the same rules; its own tables then stay staged until
    ``drop_staged``, and ``save`` keeps them. A single tree has at most that many, so ``depth`` is at most 19.
    """
    raw_z = raw_z or z
    require(panel, [unit, *x], [z, w, y, raw_z] + ([weight] if weight else []))
    if depth < 1 or min_leaf < 1:
        raise ValueError("depth and min_leaf must be at least 1")
    if values not in (ORDERED, EACH):
        raise ValueError(f"values must be '{ORDERED}' or '{EACH}', not {values!r}")
    draws = draws or Draws(trees, fraction, seed)
    if 2**depth > MOST_NODES:
        raise ValueError(f"2^depth may be at most {MOST_NODES}: a tree's table is broadcast")
    spark = panel.sparkSession
    ok = complete([z, w, y, raw_z]) & F.col(unit).isNotNull() & weighted(weight)
    rows = panel.filter(ok)
    # shifting z, w and y by their means changes no effect but saves digits in the sums
    masked = panel.select(
        *[F.when(ok, F.col(c)).alias(c) for c in x],
        *[F.when(ok, as_double(panel, c)).alias(f"_m{i}") for i, c in enumerate((z, w, y, raw_z))],
    )
    counts = [F.count("_m0"), F.count(F.lit(1)) - F.count("_m0")]
    ends = [F.min("_m3"), F.max("_m3")]
    bins, about = learn_bins_and(masked, x, n_bins, edges, counts + [F.avg(f"_m{i}") for i in range(4)] + ends, values)
    n, n_dropped = about[:2]
    mz, mw, my, high = (m or 0.0 for m in about[2:6])
    low_z, high_z = about[6:]
    with scratch(spark):
        return _grow(rows, bins, draws, z, w, y, raw_z, unit, depth, min_leaf, merge, weight, (mz, mw, my, high, low_z, high_z), n, n_dropped)


def _grow(
    rows: DataFrame,
    bins: FeatureBins,
    draws: Draws,
    z: str,
    w: str,
    y: str,
    raw_z: str,
    unit: str,
    depth: int,
    min_leaf: int,
    merge: bool | None,
    weight: str | None,
    about: tuple,
    n: int,
    n_dropped: int,
) -> IVForest:
    spark = rows.sparkSession
    mz, mw, my, high, low_z, high_z = about
    ordered = {i: f"level_{i}" for i in bins.ordered()}
    compact = rows.select(
        F.col(unit).alias("unit"),
        bins.packed().alias("bins"),
        *[F.col(bins.features[i].name).cast("string").alias(c) for i, c in ordered.items()],
        (as_double(rows, z) - mz).alias("z"),
        (as_double(rows, w) - mw).alias("w"),
        (as_double(rows, y) - my).alias("y"),
        (as_double(rows, raw_z) > high).alias("high"),
        as_double(rows, raw_z).alias("raw"),
        *([as_double(rows, weight).alias("weight")] if weight else []),
    )
    levels = None
    if ordered:
        compact = stage(compact, "forest_rows")
        levels = learn_levels(compact, ordered, draws, max(f.ordered for f in bins.features) // 2)
        for i, c in ordered.items():
            compact = tree_bins(compact, levels, i, c, _array(i)).drop(c)
    binned = stage(compact, "forest_panel", spread=True)
    # an instrument of two values is above the mean of any node that has both, or above no mean; else nodes need their own
    two_values = n == 0 or binned.filter((F.col("raw") != low_z) & (F.col("raw") != high_z)).isEmpty()
    if not two_values:
        if merge:
            raise ValueError("units can be merged only if the instrument has two values: min_leaf goes by each node's mean")
        merge = False
    if merge is None:
        most_cells = n * draws.fraction / 2 / ROWS_PER_CELL
        merge = n > 0 and (
            bins.possible_cells() <= most_cells
            or binned.agg(F.approx_count_distinct(F.struct("bins", *[_array(i) for i in ordered]))).first()[0] <= most_cells
        )
    merged = _merge_cells(binned, bins, draws) if merge else None

    def half_rows(first: int, last: int, half: bool) -> DataFrame:
        if merged is None:
            return _expand(binned, bins, draws, first, last, half, not two_values and half)
        return merged.filter((F.col("half") == half) & F.col("tree").between(first, last)).drop("half")

    sums_per_node = sum(f.n_bins() for f in bins.features)

    def grown(first: int, last: int) -> tuple[DataFrame, DataFrame]:
        """Splits, as local data, and leaves of some trees whose nodes are few enough to broadcast."""
        found: list[tuple] = []
        for level in range(depth):
            per_pass = max(1, GROUPS_PER_PASS // (2**level * max(sums_per_node, 1)))
            splits = _small_table(spark, sorted(found), SPLITS_SCHEMA)
            new = []
            for a in range(first, last + 1, per_pass):
                b = min(a + per_pass - 1, last)
                at_level = _descend(half_rows(a, b, True), splits, draws.trees, level, stay=False)
                if not two_values:
                    at_level = _above_own_mean(at_level, draws.trees)
                new += [
                    (r["tree"], r["node"], r["feature"], r["bin"], r["gain"])
                    for r in best_splits(histogram(at_level), min_leaf).collect()
                ]
            found += new
            if not new:
                break
        splits = _small_table(spark, sorted(found), SPLITS_SCHEMA)
        in_leaf = _descend(half_rows(first, last, False), splits, draws.trees, depth, stay=True)
        leaves = in_leaf.groupBy("tree", "node").agg(
            F.round(F.sum("n")).cast("bigint").alias("n"),
            *[(F.sum(s) / F.sum("n")).alias(m) for s, m in zip(("sz", "sw", "sy", "szy", "szw"), LEAF_MEANS)],
        )
        return splits, leaves

    at_once = MOST_NODES // 2**depth
    if draws.trees <= at_once:
        splits, leaves = grown(1, draws.trees)
        leaves = _small_table(spark, sorted(tuple(r) for r in leaves.collect()), LEAVES_SCHEMA)
    else:
        split_path, leaf_path = kept_path(spark, "forest_splits"), kept_path(spark, "forest_leaves")
        for first in range(1, draws.trees + 1, at_once):
            splits, leaves = grown(first, min(first + at_once - 1, draws.trees))
            splits.write.parquet(split_path, mode="append")
            leaves.write.parquet(leaf_path, mode="append")
        splits = spark.read.schema(SPLITS_SCHEMA).parquet(split_path)
        leaves = spark.read.schema(LEAVES_SCHEMA).parquet(leaf_path)
    return IVForest(splits, leaves, bins, draws, depth, n, n_dropped, levels=levels)


def _small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A tree table, at most MOST_NODES rows, as local data of the plan."""
    columns = [field.split()[0] for field in schema.split(", ")]
    return spark.createDataFrame(pd.DataFrame(rows, columns=columns), schema)


def causal_forest_fit(panel: DataFrame, w: str, y: str, x: Sequence[str], **settings) -> IVForest:
    """The forest for experiments that randomised the subsidy itself: the instrument is ``w``."""
    return iv_forest_fit(panel, w, w, y, x, **settings)


def _score(df: DataFrame, model: IVForest, oob: bool, unit: str, variance: bool) -> DataFrame:
    require(df, [f.name for f in model.bins.features])
    outputs = ["effect", "std_error", "n_trees", "effect_status"] if variance else ["effect", "n_trees", "effect_status"]
    refuse(df, outputs)
    columns = df.columns
    for i, c in model.bins.ordered().items():
        df = tree_bins(df, model.levels, i, c, f"_{_array(i)}")
    inputs = [model.bins.packed()]
    if oob:
        require(df, [unit])
        if not model.draws_known:
            raise ValueError("the forest was grown with a draw formula; pass it to IVForest.load to score out of bag")
        inputs.append(model.draws.packed(F.col(unit), inside=False))
    inputs += [F.col(f"_{_array(i)}") for i in model.bins.ordered()]
    passes = model.in_passes()
    if len(passes) > 1:
        return _score_in_passes(df, columns, inputs, model, passes, oob, variance, outputs)
    score = leaf_scorer(model.packed(), oob, variance, tuple(model.bins.ordered()))
    return df.withColumn("_score", score(*inputs)).select(*columns, *[F.col(f"_score.{c}") for c in outputs])


def _score_in_passes(
    df: DataFrame, columns: list[str], inputs: list[Column], model: IVForest, passes: list[tuple[int, int]], oob: bool, variance: bool, outputs: list[str]
) -> DataFrame:
    """Scores by a forest that no worker holds whole: sums per row are written after each group of trees and go on with the next.

    Rows stay in their places; the last pass's table is staged until ``drop_staged``.
    """
    spark, ordered = df.sparkSession, tuple(model.bins.ordered())
    given = [f"in{i}" for i in range(len(inputs))]
    rows = df.select(F.struct(*columns).alias("row"), *[c.alias(g) for c, g in zip(inputs, given)])
    written: list[str] = []

    def add(name: str, summer: Callable, *more: str) -> None:
        """Write the rows with sums ``name`` of all groups so far, in place of those before."""
        nonlocal rows
        for first, last in passes:
            if name not in rows.columns:
                rows = rows.withColumn(name, F.lit(None).cast("array<double>"))
            found = summer(model.packed(first, last), first - 1, oob, ordered)(*more, name, *given)
            path = new_path(spark, "forest_scores")
            rows.withColumn(name, found).write.parquet(path)
            rows = spark.read.schema(rows.schema).parquet(path)
            drop_paths(spark, written)
            written[:] = [path]

    add("sums", leaf_summer)
    if variance:
        add("bags", bag_summer, "sums")
    score = summed_scorer(model.draws.bag_size, variance)(*(["sums", "bags"] if variance else ["sums"]))
    return rows.withColumn("score", score).select(*[F.col(f"row.`{c}`").alias(c) for c in columns], *[F.col(f"score.{c}") for c in outputs])


def iv_forest_predict(df: DataFrame, model: IVForest, oob: bool = False, unit: str = "unit_id") -> DataFrame:
    """``df`` with ``effect``, ``n_trees`` and ``effect_status`` per row.

    Leaf means are averaged over the trees first and divided once. ``oob`` uses only trees whose
    sample left the unit out, so a row without a unit has none.
    """
    return _score(df, model, oob, unit, variance=False)


def iv_forest_variance(df: DataFrame, model: IVForest, oob: bool = False, unit: str = "unit_id") -> DataFrame:
    """Adds ``std_error``: spread of the bags' scores less the noise within bags, floored at 0."""
    if model.draws.bag_size < 2 or model.draws.trees < 2 * model.draws.bag_size:
        raise ValueError("grow the forest with Draws(bag_size >= 2) and at least two bags")
    return _score(df, model, oob, unit, variance=True)
