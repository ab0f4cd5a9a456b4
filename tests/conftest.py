import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="strata-test-")
    session = (SparkSession.builder.master("local[4]").appName("strata-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def docs(spark, *texts, path="bronze/x.json"):
    """A DataFrame of JSON documents, one row per text."""
    return spark.createDataFrame([(path, t) for t in texts], "path string, doc string")
