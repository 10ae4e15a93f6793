import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starbi.session import local_session
    s = local_session(cores="*", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="starbi-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def star_small(spark):
    from starbi.plans.star import star_for
    return star_for(spark, SF_SMALL)


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="starbi-test-out-")
