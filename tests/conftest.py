import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from parley.plans.workspace import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "4", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def turns(spark):
    def make(calls):
        """{call_id: [(speaker, text), ...]} as a turns table."""
        rows = [(c, i, s, x, float(i * 10), float(i * 10 + 5))
                for c, ts in calls.items() for i, (s, x) in enumerate(ts)]
        return spark.createDataFrame(
            rows, "call_id string, turn_index int, speaker string, text string, "
                  "start_time double, end_time double")
    return make


def column(df, name):
    return [r[name] for r in df.select(name).collect()]
