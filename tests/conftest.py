import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_TINY = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clipstat.session import local_session

    s = local_session(4, shuffle_partitions=8, app="clipstat-tests")
    yield s
    s.stop()


def write_api_file(folder, name, payload):
    """Pretty-printed, one object per file, as the fetcher lands them."""
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        json.dump(payload, f, ensure_ascii=False, indent=2)
