import os
import sys
import tempfile

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
_ROOT = os.path.dirname(_HERE)
sys.path.insert(0, _ROOT)
# Python workers are started by the JVM with this environment; test-module
# functions are pickled by reference and must be importable there.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [_ROOT, _HERE] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])

from zonecast.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="zonecast-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="zonecast-test-ckpt-")})
    yield s
    s.stop()


def ts(text):
    import datetime as dt
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def trips_schema():
    return "pickup_datetime timestamp_ntz, PULocationID bigint, DOLocationID bigint"
