import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clickloom.session import local_session

    session = local_session(cpus=4, app="tests", memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def set_(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            changed[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield set_
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
