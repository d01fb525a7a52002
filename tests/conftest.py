import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from motorlake.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def values(spark, column, inputs, kind="string"):
    """``column`` over one input per row, in input order."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    got = rows.select("i", column(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(got, key=lambda r: r["i"])]


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
