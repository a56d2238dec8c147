import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("haulmark-tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    from haulmark.session import prepare
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from haulmark.catalog.registry import lake_for
    return lake_for(spark, SF_DIR)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
