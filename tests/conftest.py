import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from thermograph.session import local_session
    s = local_session(cores="*", shuffle_partitions=8)
    # Tests only: the shared checkpoint folder is unset locally.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


def readings_df(spark, rows):
    """Readings from (location, datetime, temperature text, humidity text)."""
    df = spark.createDataFrame(
        [tuple(None if v is None else (str(v) if i >= 2 else v) for i, v in enumerate(r)) for r in rows],
        "location string, dateTime timestamp, temperature string, humidity string")
    return df.selectExpr("location", "dateTime",
                         "cast(temperature as decimal(10,2)) AS temperature",
                         "cast(humidity as decimal(10,2)) AS humidity")
