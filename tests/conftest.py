import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from softsearch.config import build_session  # noqa: E402
from softsearch.operators.fcm import membership_matrix  # noqa: E402

DIM, CLUSTERS = 8, 4


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return os.path.join(os.environ.get("TESTDATA", "/root/testdata"), "sf0.001")


def direction(number: int, dim: int = DIM) -> list[float]:
    """A unit vector for each number, from sines of incommensurable angles."""
    v = np.sin((number + 1) * np.sqrt(np.arange(2, dim + 2)) * 2.399963)
    return [float(x) for x in (v / np.sqrt(v @ v)).astype(np.float32)]


def filed_under(cluster: int, boundary: bool = False, k: int = CLUSTERS) -> list[float]:
    """Memberships of a point near a centroid, or between it and the one after it."""
    d2 = np.full((1, k), 2.2)
    d2[0, cluster] = 0.3
    if boundary:
        d2[0, (cluster + 1) % k] = 0.42
    return [float(u) for u in membership_matrix(d2, 2.0)[0]]


@pytest.fixture(scope="session")
def toy(spark):
    """Three groups of 30 unit vectors, each along an arc that starts at its own corner."""
    corners, rows = np.linalg.qr(np.vander(np.linspace(0.2, 1.9, DIM)))[0], []
    for group in range(3):
        for i in range(30):
            turn = 0.01 * (i - 15)
            v = np.cos(turn) * corners[group] + np.sin(turn) * corners[3 + i % 4]
            rows.append((group * 30 + i, [float(x) for x in v], group))
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, true_cluster int").cache()
