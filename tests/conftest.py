import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from matchspark.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark(master="local[4]", shuffle_partitions=4)
    yield s


def game_frame(spark, rows=None):
    """In-memory game frame with both teams' prefixed statistics."""
    cols = ["GP", "off_PTS", "off_All", "off_Run", "off_Pass", "off_QB", "def_PA", "def_DEF", "def_QB"]
    base = rows or [
        ("2023", 1, "A", "B", 1, (17, 28.5, 82.3, 30.1, 50.2, 18.0, 20.1, 6.5, 15.2), (17, 24.0, 75.0, 28.0, 47.0, 16.5, 22.0, 7.1, 17.0)),
        ("2023", 2, "B", "C", 2, (17, 24.0, 75.0, 28.0, 47.0, 16.5, 22.0, 7.1, 17.0), (16, 21.5, 70.2, 25.1, 45.1, 14.0, 25.3, 8.0, 19.5)),
        ("2023", 3, "A", "C", 3, (17, 28.5, 82.3, 30.1, 50.2, 18.0, 20.1, 6.5, 15.2), (16, 21.5, 70.2, 25.1, 45.1, 14.0, 25.3, 8.0, 19.5)),
    ]
    data = [(s, w, t1, t2, gid, *map(float, a), *map(float, b)) for s, w, t1, t2, gid, a, b in base]
    schema = ("season string, week int, team1 string, team2 string, game_id long, "
              + ", ".join(f"team1_{c} double" for c in cols) + ", "
              + ", ".join(f"team2_{c} double" for c in cols))
    return spark.createDataFrame(data, schema)
