import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="paceway-test-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cells(spark):
    """Cell layer from a dict {(gx, gy): value}."""

    def make(values):
        rows = [(x, y, None if v is None else float(v)) for (x, y), v in values.items()]
        return spark.createDataFrame(rows, "gx int, gy int, value double")

    return make


@pytest.fixture(scope="session")
def as_dict():
    def read(df, *keys):
        keys = keys or ("gx", "gy")
        out = {}
        for r in df.collect():
            key = tuple(r[k] for k in keys)
            assert key not in out, f"duplicate {key}"
            out[key] = r["value"]
        return out

    return read
