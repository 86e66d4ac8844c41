"""Experiment panel: one row per assigned unit with what it got and what it did."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subvent.functions.checks import require
from subvent.plans.lookup import shuffle_partitions
from subvent.sources.staging import stage

# The heavy-hitter sketch tracks 10,000 units; a unit above a 1/1000 share is always among the 1,000 reported.
HOT_UNITS = 1_000
TRACKED_UNITS = 10_000


def _hot_units(records: DataFrame, unit: str, partitions: int) -> list[tuple]:
    """(unit, salts) of the units that hold more than an even share of the records.

    One narrow scan without a shuffle. The sketch only balances the join: a missed or
    needless unit changes no result.
    """
    total, top = records.agg(
        F.count(unit), F.expr(f"approx_top_k(`{unit}`, {HOT_UNITS}, {TRACKED_UNITS})")
    ).first()
    share = max((total or 0) / partitions, 1.0)
    return [(row["item"], -(-row["count"] // max(int(share), 1))) for row in top or [] if row["count"] > share]


def _window_sums(
    assigned: DataFrame, records: DataFrame, unit: str, ts: str, value: str, window: Column, partitions: int
) -> DataFrame:
    """Count and sum per unit of the records inside the unit's own window."""
    left = assigned.select(F.col(unit).alias("_u"), F.col("_start"))
    right = records.select(unit, F.col(ts).alias("_ts"), F.col(value).cast("double").alias("_value"))
    cond = F.col("_u") == F.col(unit)
    hot = _hot_units(right, unit, partitions)
    if hot:
        schema = f"_h {records.schema[unit].dataType.simpleString()}, _salts bigint"
        hot_units = F.broadcast(records.sparkSession.createDataFrame(hot, schema))
        spread = F.pmod(F.xxhash64(F.spark_partition_id(), "_ts", "_value"), F.col("_salts"))
        right = right.join(hot_units, F.col(unit) == F.col("_h"), "left").select(
            unit, "_ts", "_value", F.coalesce(spread, F.lit(0)).alias("_row_salt")
        )
        left = left.join(hot_units, F.col("_u") == F.col("_h"), "left").select(
            "_u", "_start", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_salt")
        )
        cond = cond & (F.col("_salt") == F.col("_row_salt"))
    cond = cond & (F.col("_ts") >= F.col("_start")) & (F.col("_ts") < F.col("_start") + window)
    return (
        right.join(left, cond)
        .groupBy(F.col(unit).alias("_u"))
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_value").alias("_sum"))
    )


def _fixed(bounds: DataFrame, name: str) -> Column | None:
    """The value of a one-row table's column as a literal of the same type; None for NULL.

    Instants go by their microseconds, which name one instant in every time zone, and by no text.
    """
    kind = bounds.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        value = bounds.select(F.unix_micros(name)).first()[0]
        return None if value is None else F.timestamp_micros(F.lit(value))
    value = bounds.select(F.col(name).cast("string") if isinstance(kind, T.DatetimeType) else F.col(name)).first()[0]
    return None if value is None else F.lit(value).cast(kind)


def assignment_report(assignment: DataFrame, unit: str, ts: str, z: str = "z") -> DataFrame:
    """What ``experiment_panel`` makes of the assignment, as one row.

    ``n_rows``; ``n_dropped``, rows without a unit or time; ``n_units``; ``n_repeated``, units assigned more than once;
    ``n_conflicts``, units whose first time has more than one z, of which the smallest counts.
    """
    require(assignment, [unit, ts], [z])
    known = F.col(unit).isNotNull() & F.col(ts).isNotNull()
    at_time = assignment.groupBy(unit, ts).agg(
        F.count("*").alias("_n"), F.min(z).alias("_low"), F.max(z).alias("_high"), F.first(known).alias("_known")
    )
    first = F.min(F.struct(F.col(ts), (F.col("_low") < F.col("_high")).alias("conflict")))
    units = at_time.groupBy(unit, "_known").agg(F.sum("_n").alias("_n"), first.alias("_first"))
    counted = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")
    return units.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(~F.col("_known"), F.col("_n"))), F.lit(0)).alias("n_dropped"),
        counted(F.col("_known")).alias("n_units"),
        counted(F.col("_known") & (F.col("_n") > 1)).alias("n_repeated"),
        counted(F.col("_known") & F.col("_first.conflict")).alias("n_conflicts"),
    )


def experiment_panel(
    assignment: DataFrame,
    issuance: DataFrame,
    outcome: DataFrame,
    unit: str,
    ts: str,
    window: Column,
    z: str = "z",
    amount: str = "amount",
    value: str = "value",
    partitions: int | None = None,
) -> DataFrame:
    """One row per assigned unit: z, w, amount issued and outcome y in ``[ts, ts + window)``.

    Issuance and outcome are summed per unit separately, so several records of each do not
    multiply. A unit without a record keeps 0. A unit assigned more than once counts from its
    first assignment; ``assignment_report`` counts such units, and rows without a unit or time. The scans of
    the records read only the span of all windows, and units that hold more than an even share of those
    records are salted.
    """
    require(assignment, [unit, ts], [z])
    require(issuance, [unit, ts], [amount])
    require(outcome, [unit, ts], [value])
    parts = partitions or shuffle_partitions(assignment)
    assigned = (
        assignment.filter(F.col(unit).isNotNull() & F.col(ts).isNotNull())
        .groupBy(unit)
        .agg(F.min(F.struct(F.col(ts).alias("start"), F.col(z).alias("z"))).alias("_first"))
        .select(unit, F.col("_first.start").alias("_start"), F.col("_first.z").alias(z))
    )
    assigned = stage(assigned, "assigned")
    # records outside every window are left out by the scan itself
    span = stage(assigned.agg(F.min("_start").alias("first"), F.max(F.col("_start") + window).alias("last")), "span")
    first, last = _fixed(span, "first"), _fixed(span, "last")
    if first is not None and last is not None:
        issuance, outcome = (df.filter((F.col(ts) >= first) & (F.col(ts) < last)) for df in (issuance, outcome))
    issued = _window_sums(assigned, issuance, unit, ts, amount, window, parts)
    issued = issued.select("_u", F.col("_n").alias("_n_issued"), F.col("_sum").alias("_issued"))
    earned = _window_sums(assigned, outcome, unit, ts, value, window, parts)
    earned = earned.select(F.col("_u").alias("_v"), F.col("_sum").alias("_earned"))
    return (
        assigned.join(issued, F.col(unit) == F.col("_u"), "left")
        .join(earned, F.col(unit) == F.col("_v"), "left")
        .select(
            unit,
            F.col("_start").alias(ts),
            z,
            F.col("_n_issued").isNotNull().cast("int").alias("w"),
            F.coalesce("_issued", F.lit(0.0)).alias("amount"),
            F.coalesce("_earned", F.lit(0.0)).alias("y"),
        )
    )
