import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from regmine.session import get_session
    s = get_session("local[4]", app="regmine-tests", shuffle_partitions=4,
                    extra={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="regmine-test-ckpt-"))
    yield s


@pytest.fixture(scope="module")
def shared_mining():
    """Queries of a test module share the itemsets they mine (the library itself
    keeps nothing between queries); i7 to i9 mine them first or anew elsewhere."""
    from regmine.plans import catalog
    mined, kept = catalog.mined, {}

    def once(spark, sf, algo="apriori", years=False):
        if (sf, algo, years) not in kept:
            kept[sf, algo, years] = mined(spark, sf, algo, years)
        return kept[sf, algo, years]

    catalog.mined = once
    yield
    catalog.mined = mined


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
