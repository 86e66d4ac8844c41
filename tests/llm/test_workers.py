"""Workers need no copy of the package, and nothing staged is left behind."""

import os
import subprocess
import sys

import pytest
import public_tokenizers

import corpus_pipeline
from subvent.llm import common, queries
from subvent.sources.staging import scratch

REPO = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
RUN = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
spark.range(1).mapInArrow(lambda b: b, "id long").collect()  # workers start before the driver knows the package
sys.path.insert(0, {repo!r})
import __spark_entry__ as contract
for name in {names!r}:
    contract.queries()[name](spark, {folder!r}).write.format("noop").mode("overwrite").save()
    print("done", name, flush=True)
"""


def test_every_query_runs_on_workers_without_the_package(tmp_path, small):
    names = [*queries.REGISTERED, "pipeline"]
    path = os.path.dirname(os.path.dirname(os.path.abspath(public_tokenizers.__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": path}
    code = RUN.format(repo=REPO, names=names, folder=small)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.stdout.split() == [x for n in names for x in ("done", n)], done.stderr[-3000:]


def test_a_chunked_table_leaves_the_catalog_with_its_files(spark):
    before = {t.name for t in spark.catalog.listTables()}
    with scratch(spark):
        common.chunked(spark.range(10), "gone")
        assert {t.name for t in spark.catalog.listTables()} > before
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("repeat", [1, 2])
def test_a_pipeline_leaves_its_last_rows_alone(spark, small, repeat):
    from subvent.sources.staging import written_paths

    before = set(written_paths(spark))
    found = corpus_pipeline.run(spark, small)
    left = set(written_paths(spark)) - before
    assert len(left) == 1 and "stage_packing" in left.pop() and found.count() > 0
