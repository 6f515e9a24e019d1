import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from terrasol.session import get_session
    s = get_session("local[2]", 4, app_name="terrasol-tests")
    yield s
    s.stop()


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
