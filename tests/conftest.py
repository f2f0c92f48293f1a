import os
import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="mirrorwell-tests-")
    session = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "4")
        # the tables are tiny: compiling a plan would take longer than running it
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.warehouse.dir", shared + "/warehouse")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from mirrorwell.session import work_dir

    return work_dir(spark, "test")
