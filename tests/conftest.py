import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

REPO = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(REPO))
os.environ["PYTHONPATH"] = f"{REPO}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("TZ", "UTC")
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": f"file://{folder}/checkpoint", "spark.sql.warehouse.dir": f"file://{folder}/warehouse",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA
