import os
import sys
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


T0 = datetime(2024, 1, 1)


def minute(n: float) -> datetime:
    return T0 + timedelta(minutes=n)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def ntz(df, *columns):
    from pyspark.sql import functions as F
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
