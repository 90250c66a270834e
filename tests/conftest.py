import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pairclf.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def points(spark):
    """Four small classes of random vectors, as a feature table over several partitions."""
    import numpy as np

    random = np.random.default_rng(7)
    rows = []
    for number in range(240):
        label = "abcd"[min(number % 6, 3)]
        center = {"a": 0.0, "b": 1.0, "c": -1.0, "d": 0.5}[label]
        rows.append((label, [float(v) for v in random.normal(center, 2.0, 5)], f"{label}_{number}.jpg.json"))
    from pairclf.sources.feature_files import feature_rows

    return feature_rows(spark, rows).repartition(5).cache()
