import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from paperloom.session import local_session

    session = local_session("8", shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def tables(spark):
    from paperloom.plans.derived import Tables

    return Tables(spark, DATA)


@pytest.fixture(scope="session")
def duck():
    from compare import connect

    return connect(DATA)


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate column expressions on one row of text values."""

    def run(*columns, **values):
        schema = ", ".join(f"`{k}` {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'bigint'}" for k, v in values.items())
        row = spark.createDataFrame([tuple(values.values())], schema).select(*columns).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return run
