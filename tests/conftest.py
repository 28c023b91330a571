import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from listingflow.session import get_spark
    session = get_spark("listingflow-tests", master="local[*]", shuffle_partitions=8,
                        conf={"spark.ui.showConsoleProgress": "false"})
    from listingflow.session import checkpoint_root
    checkpoint_root(session)      # a temporary folder only if the deployment names none
    yield session


@pytest.fixture(scope="module", autouse=True)
def nothing_cached(spark):
    """What a module caches must not show in the plans of the next."""
    yield
    spark.catalog.clearCache()


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)
