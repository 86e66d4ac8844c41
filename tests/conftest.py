import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from subvent.sources.staging import drop_staged

    drop_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def iv_panel(spark, medium):
    from subvent.sources.fixtures import iv_panel
    from subvent.sources.staging import stage

    return stage(iv_panel(spark, medium), "iv_panel")


@pytest.fixture(scope="session")
def dose_panel(spark, medium):
    from subvent.sources.fixtures import dose_panel
    from subvent.sources.staging import stage

    return stage(dose_panel(spark, medium), "dose_panel")
