import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillwise.session import local_session  # noqa: E402
from tillwise.sources.fixtures import Tables  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SF_DIR)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
