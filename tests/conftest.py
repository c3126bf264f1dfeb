import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import os

    os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent.parent}:{os.environ.get('PYTHONPATH', '')}"
    s = (
        SparkSession.builder.master("local[4]").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
