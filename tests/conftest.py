import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from compare import session

    return session()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def column(spark, values, type_="string", name="c"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {type_}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
