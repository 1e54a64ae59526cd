import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forecourt.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def engineered(spark):
    from checks import base

    return base.engineered(spark, FOLDER).persist()


@pytest.fixture(scope="session")
def clean(spark):
    from checks import base

    return base.clean(spark, FOLDER).persist()
