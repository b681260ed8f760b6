import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from check_queries import session
    s = session()
    s.sparkContext.setLogLevel("OFF")
    from lakeledger.session import name_folder
    name_folder(s, lambda: tempfile.mkdtemp(prefix="lakeledger-test-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def days():
    import datetime
    start = datetime.date(2020, 1, 1)
    return lambda n: start + datetime.timedelta(days=n)
