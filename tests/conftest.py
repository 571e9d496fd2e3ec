from __future__ import annotations

import os
import sys
import tempfile

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
        # The queries generate more classes than the default cache holds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pricewright-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def stage(spark):
    from pricewright.stage import Stage

    return Stage(spark)


@pytest.fixture(scope="session")
def star(spark):
    from pricewright.sources.sample import sample_star

    return sample_star(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def prepared(spark, star):
    """Training rows of the current model on the smallest sample."""
    from pricewright.plans import jobs
    from pricewright.stage import Stage

    stage = Stage(spark)
    return stage.table(jobs.prepare(star, stage), "training_rows")
