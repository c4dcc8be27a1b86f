import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.plans.feature_store import FeatureStore  # noqa: E402
from millrace.session import fresh_dir, get_spark  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        master="local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__default__parallelism="4",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture
def store(spark):
    return FeatureStore(spark, f"t{uuid.uuid4().hex[:10]}")


@pytest.fixture
def folder(spark):
    return fresh_dir(spark, "test")


@pytest.fixture
def sf():
    return SF


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
