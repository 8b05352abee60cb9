import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    import os

    os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent.parent}:{os.environ.get('PYTHONPATH', '')}"
    from acopio.plans.session import session

    out = session("local[4]", "tests", spark__sql__shuffle__partitions="4", spark__ui__enabled="false")
    out.sparkContext.setLogLevel("ERROR")
    yield out
    out.stop()
