import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("splatlake-tests").config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "4g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp")).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def spread(spark):
    """Force the forms meant for large inputs: no one-task shortcut, no broadcast."""
    for name, value in (("oneTaskBytes", "0"), ("oneTaskRows", "60"), ("broadcastBytes", "0")):
        spark.conf.set(f"spark.splatlake.{name}", value)
    yield
    for name in ("oneTaskBytes", "oneTaskRows", "broadcastBytes"):
        spark.conf.unset(f"spark.splatlake.{name}")


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
