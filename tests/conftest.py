import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lapse.session import build_session, checkpoint_dir

    # Long locations, so that plan tests see the names of landed tables.
    extra = {"spark.sql.maxMetadataStringLength": "1000"}
    s = build_session("local[4]", app_name="lapse-tests", shuffle_partitions=4, extra=extra)
    checkpoint_dir(s)  # sets a private folder only when the session names none
    yield s
    s.stop()
