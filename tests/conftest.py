import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from saltmarsh.session import session

    one = session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"})
    one.sparkContext.setLogLevel("ERROR")
    yield one
    one.stop()
