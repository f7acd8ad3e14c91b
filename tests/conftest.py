import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from parcelflow.session import ENGINE_CONF

    b = (SparkSession.builder.master("local[*]").appName("parcelflow-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g"))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):  # local[*]: one machine
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="parcelflow-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def small_models(spark):
    from parcelflow.functions import AS_OF_DEFAULT
    from parcelflow.plans.build import Models, TableStore
    from parcelflow.session import scratch_path
    from parcelflow.sources import testdata

    # Written once (the build path), so every test reads stored tables.
    store = TableStore(spark, scratch_path(spark, "tests", next(tempfile._get_candidate_names())))
    return Models(testdata.raw_feeds(spark, SF_SMALL), AS_OF_DEFAULT, store=store)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="parcelflow-test-")
