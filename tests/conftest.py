import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shoplens.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def clean(spark):
    """The cleaned test transactions as a stage table."""
    from shoplens.plans.registry import stored_clean

    return stored_clean(spark, FOLDER)


@pytest.fixture(scope="session")
def clean_pandas(clean):
    frame = clean.toPandas()
    frame["TotalPrice"] = frame["TotalPrice"].astype(float)
    frame["UnitPrice"] = frame["UnitPrice"].astype(float)
    return frame
