"""The entry in a session that names no shared folder, as a plain local session is."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
RUN = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
assert not spark.conf.get("spark.checkpoint.dir", None)
import __spark_entry__ as driver
rows = driver.queries()["n1_null_check_orders_dirty_custkey"](spark, sys.argv[1]).collect()
rows += driver.queries()["t7_resample_events_minutes"](spark, sys.argv[1]).limit(1).collect()
print("ROWS", len(rows))
"""


def test_local_session_without_a_shared_folder(sf_dir, tmp_path):
    # an empty folder of settings: whatever this machine's defaults name does not count
    env = os.environ | {"PYTHONPATH": str(ROOT), "TMPDIR": str(tmp_path), "SPARK_CONF_DIR": str(tmp_path)}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    env.pop("PYSPARK_GATEWAY_SECRET", None)
    done = subprocess.run([sys.executable, "-c", RUN, sf_dir], env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 2" in done.stdout, done.stderr[-2000:]
