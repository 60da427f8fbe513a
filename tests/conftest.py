import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from touchline.session import local_session

    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def tables(spark):
    from touchline.sources.adapter import Tables

    return Tables(spark, SF)


@pytest.fixture(scope="session")
def feed_rows(tables):
    return [r.asDict() for r in tables.feed.orderBy("combo_id", "pos").collect()]
