"""Reading the given parquet tables and saving results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
