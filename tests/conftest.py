import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixture_rows import SENSOR_LINES  # noqa: E402
from tidemark.session import get_spark  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", 4, extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-test-ckpt-"),
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sensor(spark):
    """The sensor fixture as readings (id, timestamp, ts, temp, seq)."""
    from tidemark.sources import readings as rd
    lines = spark.createDataFrame([(l, i) for i, l in enumerate(SENSOR_LINES)], "value string, seq bigint")
    return rd.as_readings(rd.parse_reading(lines))
