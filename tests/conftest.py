import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wayfleet.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[4]", shuffle_partitions=2,
                            **{"spark.driver.memory": "6g",
                               "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def edge_row(seq, a, b, at, length=100.0, limit=36.0, name="road", edge_id=None):
    """Edge from node a to node b; ``at`` maps nodes to (lat, lon)."""
    return (seq, edge_id or f"E_{a}_{b}", name, limit, (a, *at[a]), (b, *at[b]), length)


@pytest.fixture(scope="session")
def make_edges(spark):
    from wayfleet.schemas import EDGE

    def make(rows):
        return spark.createDataFrame(rows, EDGE)
    return make
