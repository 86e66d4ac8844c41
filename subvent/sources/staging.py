"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}
_tables: dict[str, str] = {}  # names in the catalog, by path
_kept: set[str] = set()  # paths that outlive the scratch they are written in


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets its own."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="subvent-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which ``drop_staged`` deletes."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def kept_path(spark: SparkSession, name: str) -> str:
    """A :func:`new_path` for a table that a result goes on reading: leaving ``scratch`` does not delete it."""
    path = new_path(spark, name)
    _kept.add(path)
    return path


def named_table(path: str, table: str) -> None:
    """The table at ``path`` has a name in the catalog, which goes when its files go."""
    _tables[path] = table


def written_paths(spark: SparkSession) -> list[str]:
    """What this application has staged and not yet deleted."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete some of the staged tables."""
    held = _written.get(spark.sparkContext.applicationId, [])
    own = [p for p in paths if p in held]
    held[:] = [p for p in held if p not in own]
    _kept.difference_update(own)
    _delete(spark, own)


def release(path: str) -> None:
    """Let ``scratch`` delete a kept path after all."""
    _kept.discard(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was staged inside; nothing that is used later may still read it."""
    paths = _written.setdefault(spark.sparkContext.applicationId, [])
    before = set(paths)
    try:
        yield
    finally:
        own = [p for p in paths if p not in before and p not in _kept]
        paths[:] = [p for p in paths if p not in own]
        _delete(spark, own)


def stage(df: DataFrame, name: str, spread: bool = False) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts the lineage, survives the loss of an executor, and gives later passes a
    columnar scan with an exact row count in its footers. ``spread`` deals the rows out evenly, by no key, over one
    file per core or more: for compact tables whose rows fan out when read, where the usual file size would make too
    few and too heavy tasks.
    """
    spark = df.sparkSession
    if spread:
        files = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        df = df.repartition(files)
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables this application staged; results still reading them become invalid."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    _kept.difference_update(paths)
    _delete(spark, paths)
    return len(paths)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        if path in _tables:
            spark.sql(f"DROP TABLE IF EXISTS {_tables.pop(path)}")
        target = hadoop(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
