"""Text covariates of any number of values: per tree, values in the order of their effects, binned like a number.

A tree that drew its units takes the sums of its split half per value in one grouped pass. Their mean pseudo-outcomes, the same
that its root's splits are judged by, put the values in order, and runs of that order become bins: a split of the bins is a split of the
values into two sets, the best such of its kind. The leaf half has no part in the order, so trees stay honest.

The result is one table with a row per value, whose array holds its bin in each tree. Rows meet it once, by value, however deep
or many the trees; only a table of a checked size is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subvent.operators.causal.draws import Draws
from subvent.operators.causal.split import CANCELLED, SUMS, row_sums
from subvent.plans.lookup import attach
from subvent.sources.staging import kept_path, release, scratch, stage

LEVELS_SCHEMA = "feature int, level string, rows double, bins array<smallint>, unseen boolean"
# Bins (values times trees) of a broadcast level table, a few tens of MB.
BROADCAST_BINS = 4_000_000
# Those of a table that a forest holds as local data, like its trees, and not as a staged table.
LOCAL_BINS = 200_000


def learn_levels(rows: DataFrame, columns: Mapping[int, str], draws: Draws, n_bins: int) -> DataFrame:
    """The level table of text ``columns`` (by number of their feature), a staged table as ``LEVELS_SCHEMA`` says.

    ``rows`` holds unit, z, w, y, an optional weight, and the columns. In a tree, with values in order of their mean pseudo-outcome and
    then by name, the bin of a value is 1 + floor(n_bins * (rows before it + rows up to it) / all rows): a value with one
    row in ``n_bins`` or more shares its bin with no other. NULL has bin 0. A value that a tree's split half has not seen counts as
    one of mean zero; row ``unseen`` of a feature holds these bins, for values that no tree has seen.
    """
    u, t = F.col("unit"), F.col("tree")
    weight = F.col("weight") if "weight" in rows.columns else None
    values = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("string").alias("level")) for i, c in columns.items()])
    summed = [c for c in SUMS if c != "high"]
    drawn = (
        rows.withColumn("tree", F.explode(F.sequence(F.lit(1), F.lit(draws.trees))))
        .filter(draws.in_sample(u, t) & draws.in_split_half(u, t))
        .select("tree", *row_sums(F.col("z"), F.col("w"), F.col("y"), F.lit(0), weight), F.inline(values))
    )
    spark = rows.sparkSession
    with scratch(spark):
        sums = stage(drawn.groupBy("tree", "feature", "level").agg(*[F.sum(c).alias(c) for c in summed]), "level_sums")
        # one row per tree and feature
        whole = sums.groupBy("tree", "feature").agg(
            *[F.sum(c).alias(f"t_{c}") for c in summed], F.sum(F.when(F.col("level").isNotNull(), F.col("n"))).alias("known")
        )
        whole = whole.selectExpr("*", "t_sz / t_n AS mz", "t_sw / t_n AS mw", "t_sy / t_n AS my").selectExpr(
            "*",
            f"""CASE WHEN abs(t_szw - mz * t_sw) > {CANCELLED}D * (abs(t_szw) + abs(mz * t_sw))
                THEN try_divide(t_szy - mz * t_sy, t_szw - mz * t_sw) END AS tau""",
        )
        judged = sums.join(F.broadcast(whole), ["tree", "feature"]).selectExpr(
            "tree", "feature", "level", "n", "known",
            """coalesce((szy - mz * sy - my * sz + n * mz * my - tau * (szw - mz * sw - mw * sz + n * mz * mw)) / n, 0D) AS mean""",
        )
        order = Window.partitionBy("tree", "feature").orderBy("mean", "level").rowsBetween(Window.unboundedPreceding, 0)
        placed = judged.filter("level IS NOT NULL").withColumn("until", F.sum("n").over(order))
        bin_at = lambda twice: F.floor(n_bins * twice / F.col("known")) + 1
        binned = stage(placed.select("tree", "feature", "level", "n", "mean", "known", bin_at(2 * F.col("until") - F.col("n")).cast("smallint").alias("bin")), "level_bins")
        below = F.sum(F.when(F.col("mean") <= 0, F.col("n")).otherwise(0))
        middle = binned.groupBy("tree", "feature", "known").agg(below.alias("below")).select(
            "tree", "feature", bin_at(2 * F.col("below")).cast("int").alias("bin")
        )
        # features x trees numbers
        unseen = {i: [0] * draws.trees for i in columns}
        for r in middle.collect():
            unseen[r["feature"]][r["tree"] - 1] = r["bin"]
        default = F.lit(None)
        for i, bins in unseen.items():
            default = F.when(F.col("feature") == i, F.array(*[F.lit(b).cast("smallint") for b in bins])).otherwise(default)
        found = binned.groupBy("feature", "level").agg(
            F.sum("n").cast("double").alias("rows"), F.map_from_entries(F.collect_list(F.struct("tree", "bin"))).alias("_own")
        )
        found = found.withColumn("_unseen", default).select(
            "feature",
            "level",
            "rows",
            F.transform("_unseen", lambda b, k: F.coalesce(F.try_element_at("_own", k + 1), b)).alias("bins"),
            F.lit(False).alias("unseen"),
        )
        nulls = sums.filter("level IS NULL").groupBy("feature").agg(F.sum("n").cast("double").alias("rows")).collect()
        missing = {r["feature"]: r["rows"] for r in nulls}
        other = [(i, None, missing.get(i, 0.0), [0] * draws.trees, False) for i in columns]
        other += [(i, None, 0.0, bins, True) for i, bins in unseen.items()]
        return _written(found.unionByName(spark.createDataFrame(other, LEVELS_SCHEMA)), draws.trees)


def _written(table: DataFrame, trees: int) -> DataFrame:
    """``table`` as local data if it is small, else staged so that the scratch it is made in leaves it alone."""
    spark = table.sparkSession
    path = kept_path(spark, "levels")
    table.write.parquet(path)
    table = spark.read.schema(LEVELS_SCHEMA).parquet(path)
    if table.count() * trees > LOCAL_BINS:
        return table
    rows = [tuple(r) for r in table.collect()]
    release(path)
    return spark.createDataFrame(rows, LEVELS_SCHEMA)


def tree_bins(rows: DataFrame, levels: DataFrame, feature: int, column: str, output: str, broadcast_bins: int = BROADCAST_BINS) -> DataFrame:
    """``rows`` with ``output``, the bins of the value of ``column`` in each tree."""
    own = levels.filter(F.col("feature") == feature)
    unseen = own.filter("unseen").first()["bins"]
    values = own.filter("NOT unseen").select(F.col("level").alias("_level"), F.col("bins").alias(output), F.col("rows").alias("_rows"))
    found = attach(rows.withColumn("_level", F.col(column).cast("string")), values, ["_level"], "_rows", broadcast_bins // len(unseen))
    default = F.array(*[F.lit(b).cast("smallint") for b in unseen])
    return found.withColumn(output, F.coalesce(output, default)).drop("_level")


def in_tree(features: int, ordered: Mapping[int, str], tree: Column) -> Column:
    """The bins of all features in a tree: those of ``bins``, and of ordered ones their arrays' entry."""
    return F.array(*[
        F.get(F.col(ordered[i]), tree - 1).cast("int") if i in ordered else F.get("bins", F.lit(i)) for i in range(features)
    ])
