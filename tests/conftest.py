import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from corate.session import local_session
    s = local_session("*", shuffle_partitions=8, app="corate-tests",
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def ratings_df(spark, triples):
    return spark.createDataFrame([(int(u), int(i), float(r)) for u, i, r in triples],
                                 "user_id long, item_id long, rating double")


# FIXTURES.md A: toy 4x4, rating(u, i) = 4(u-1) + i
TOY = [(u, i, 4 * (u - 1) + i) for u in range(1, 5) for i in range(1, 5)]

# FIXTURES.md B: sparse, in-domain
SPARSE = [(1, 10, 5), (1, 20, 5), (1, 30, 1), (2, 10, 5), (2, 20, 4), (3, 10, 3),
          (3, 20, 4), (3, 40, 2), (4, 30, 4), (4, 40, 2), (5, 50, 3)]
