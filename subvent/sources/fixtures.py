"""Semi-synthetic experiment tables derived from the given tables; definitions in FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subvent.sources.tables import read_table

# fixed values of the fixtures
KNOTS = (0.0, 0.02, 0.04, 0.06, 0.08)
DRAW_MODULUS = 65537
DRAW_RANGE = 65536


def _unit_share(key: Column, factor: int, modulus: int) -> Column:
    return ((key * F.lit(factor)) % F.lit(modulus)) / F.lit(float(modulus))


def iv_panel(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order with a hidden cause of both issuance and outcome."""
    key = F.col("o_orderkey")
    orders = read_table(spark, folder, "orders")
    customer = read_table(spark, folder, "customer")
    base = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        key.alias("unit_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_orderdate").alias("assign_ts"),
        _unit_share(key, 7919, 1009).alias("u1"),
        _unit_share(key, 104729, 997).alias("u2"),
        _unit_share(key, 1299709, 991).alias("u3"),
    )
    z = (F.col("u1") < 0.5).cast("int")
    w = F.when(F.col("u1") < 0.5, F.col("u2") > 0.3).otherwise(F.col("u2") > 0.8).cast("int")
    tau = F.when(F.col("acctbal") >= 4500, 30.0).otherwise(10.0)
    return (
        base.withColumn("z", z)
        .withColumn("w", w)
        .withColumn("tau", tau)
        .withColumn("y", F.lit(100.0) + F.col("tau") * F.col("w") + 60.0 * F.col("u2") + 10.0 * (F.col("u3") - 0.5))
    )


def assignment(spark: SparkSession, folder: str) -> DataFrame:
    ids = read_table(spark, folder, "events").select(F.col("user_id").alias("unit_id")).distinct()
    start = F.lit("2024-01-08").cast("timestamp_ntz")
    days = F.make_dt_interval(days=(F.col("unit_id") % 7).cast("int"))
    return ids.select("unit_id", (F.col("unit_id") % 2).cast("int").alias("z"), (start + days).alias("ts"))


def issuance(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "events")
        .filter(F.col("event_type") == "signup")
        .select(F.col("user_id").alias("unit_id"), "ts", F.col("value").alias("amount"))
    )


def outcome(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "events")
        .filter(F.col("event_type") == "purchase")
        .select(F.col("user_id").alias("unit_id"), "ts", "value")
    )


def dose_panel(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item: outcome by dose, rising and convex in every segment."""
    d = F.col("dose")
    truth = (
        F.when(F.col("segment") == "A", 20.0 + 100.0 * d + 4000.0 * d * d)
        .when(F.col("segment") == "N", 20.0 + 2000.0 * d * d)
        .when(F.col("segment") == "R", 20.0 + 300.0 * d)
    )
    noise = ((F.col("order_key") * F.lit(7919) + F.col("line_no") * F.lit(104729)) % F.lit(1009)) / F.lit(1009.0) - 0.5
    return (
        read_table(spark, folder, "lineitem")
        .select(
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_returnflag").alias("segment"),
            F.col("l_discount").alias("dose"),
        )
        .withColumn("truth", truth)
        .withColumn("y", F.col("truth") + 20.0 * noise)
    )


def fixture_draw(unit: Column, tree: Column) -> Column:
    """A draw that other engines can repeat; three rounds modulo a prime."""
    m = F.lit(DRAW_MODULUS).cast("bigint")
    unit, tree = unit.cast("bigint"), tree.cast("bigint")
    h1 = (unit * 40503 + tree * 30011) % m
    h2 = (h1 * h1 + unit * 7 + tree * 13) % m
    return (h2 * h2 + h2 * 31 + tree) % m
