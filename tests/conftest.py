import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    builder = (SparkSession.builder.master("local[4]").appName("lakeloom-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lakeloom-test-wh-")))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # the work folder comes from spark.checkpoint.dir; only where the session
    # names none does ensure_work_dir create a private one
    from lakeloom.session import ensure_work_dir, ship_package
    ensure_work_dir(s)
    ship_package(s)
    yield s


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)
