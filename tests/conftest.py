import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickframe import prepare  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").appName("tickframe-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield prepare(s)
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def frame(spark):
    """A DataFrame from rows and a DDL schema; times are given as text."""

    def make(rows, schema):
        names, types = [], []
        for part in schema.split(", "):
            n, t = part.split(" ")
            names.append(n)
            types.append(t)
        text = ", ".join(
            f"{n} {'string' if t in ('timestamp_ntz', 'timestamp', 'date') else t}"
            for n, t in zip(names, types)
        )
        df = spark.createDataFrame(rows, text)
        return df.select(*[df[n].cast(t).alias(n) for n, t in zip(names, types)])

    return make
