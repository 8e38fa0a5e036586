import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tonehive.session import session

    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.default.parallelism": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
