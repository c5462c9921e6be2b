import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from shopflow.session import local_session

    session = local_session(8, "tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def shop(spark):
    from shopflow.sources.shop import Shop

    return Shop(spark, "/root/testdata/sf0.001")


def rows(frame, *order):
    """Collected rows as sorted tuples."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)
