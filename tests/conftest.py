import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from simrec.session import fine_shuffles, get_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="simrec-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def own_shuffles(request):
    """What a registered query sets on the shared session does not reach the next test."""
    yield
    if "spark" in request.fixturenames:
        fine_shuffles(request.getfixturevalue("spark"), False)


@pytest.fixture
def ratings_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, "user_id string, item_id string, stars double")
    return make
