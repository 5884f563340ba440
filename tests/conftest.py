import os
import sys

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
_ROOT = os.path.dirname(_HERE)
sys.path.insert(0, _ROOT)
# Python workers import functions pickled from test modules by name
os.environ["PYTHONPATH"] = os.pathsep.join(
    [_ROOT, _HERE] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])


@pytest.fixture(scope="session")
def spark():
    from siftkit.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="siftkit-tests")
    yield s
    s.stop()


def plan_text(df) -> str:
    """The formatted physical plan, as ``explain`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
