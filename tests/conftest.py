import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sparkmine.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Short-lived JVM: quick compilation beats peak speed on tiny tables.
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "8g",
        "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
    }
    session = get_spark("tests", "local[8]", conf)
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()
