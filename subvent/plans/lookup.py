"""Attaching one-row-per-key values to many rows without a hot task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A table of this many keys with a dozen numbers each stays in the tens of MB.
BROADCAST_ROWS = 100_000


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _matching(rows: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys where NULL equals NULL, as in groupBy."""
    renamed = values.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in values.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & rows[k].eqNullSafe(renamed[f"_k_{k}"])
    return rows.join(renamed, cond, "left").drop(*[f"_k_{k}" for k in keys])


def attach(
    rows: DataFrame,
    values: DataFrame,
    keys: list[str],
    size: str,
    broadcast_rows: int = BROADCAST_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Left join ``rows`` to ``values``, which is a written table with one row per key.

    ``size`` is the column of ``values`` that holds the number of rows behind each key.
    Up to ``broadcast_rows`` keys the values are broadcast and no row moves. Beyond that
    both sides are shuffled, and a key with more than an even share of the rows is spread
    over as many salts as it has shares. At most ``partitions`` keys can exceed a share, so
    the list of hot keys is small whatever the data.
    """
    if values.count() <= broadcast_rows:
        return _matching(rows, F.broadcast(values.drop(size)), keys)
    parts = partitions or shuffle_partitions(rows)
    total = values.agg(F.sum(size)).first()[0] or 0
    share = max(total / parts, 1.0)
    hot = F.broadcast(
        values.filter(F.col(size) > share).select(*keys, F.ceil(F.col(size) / share).cast("int").alias("_salts"))
    )
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in rows.columns]), F.col("_salts"))
    salted_rows = (
        _matching(rows, hot, keys)
        .withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(spread).cast("int"))
        .drop("_salts")
    )
    salted_values = (
        _matching(values.drop(size), hot, keys)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
        .drop("_salts")
    )
    return _matching(salted_rows, salted_values, [*keys, "_salt"]).drop("_salt")
