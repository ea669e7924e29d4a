"""Work-folder resolution in a session that names no spark.checkpoint.dir."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import sys
sys.path.insert(0, ROOT)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate())
assert spark.conf.get("spark.checkpoint.dir", None) is None
import __spark_entry__ as E
from lakeloom.session import ensure_work_dir
n = E.queries()["declared_csv"](spark, "/root/testdata/sf0.001").count()
assert E.queries()["dbf_scan"](spark, "/root/testdata/sf0.001").count() > 0
assert E.queries()["stream_landing"](spark, "/root/testdata/sf0.001").count() > 0
work = ensure_work_dir(spark)
assert work == ensure_work_dir(spark)
assert spark.sparkContext.getCheckpointDir() is not None
print("OK", n, work)
"""


def test_queries_run_without_checkpoint_dir():
    empty_conf = tempfile.mkdtemp(prefix="lakeloom-noconf-")
    env = dict(os.environ, SPARK_CONF_DIR=empty_conf)
    code = SCRIPT.replace("ROOT", repr(ROOT))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("OK ")][0]
    assert int(line.split()[1]) > 0
