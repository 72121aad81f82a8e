import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from boxoffice.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8, app_name="boxoffice-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from boxoffice.sources.tables import load_tables
    return load_tables(spark, SF_SMALL)


@pytest.fixture(scope="session")
def tables_mid(spark):
    from boxoffice.sources.tables import load_tables
    return load_tables(spark, SF_MID)
