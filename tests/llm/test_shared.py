"""Operators that store tables run in a local session without a shared folder."""

import os
import subprocess
import sys
from pathlib import Path

CODE = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from terrafold.llm.common import stored
assert stored(stored(spark.range(7))).count() == 7
from terrafold.sources import shared
spark.sparkContext.master  # a cluster's master is refused
class Other:
    conf = spark.conf
    class sparkContext:
        master = "spark://host:7077"
try:
    shared.shared_dir(Other)
except ValueError as refused:
    print("refused", refused)
"""


def test_session_without_a_folder(tmp_path):
    (tmp_path / "empty").mkdir()
    env = {"SPARK_CONF_DIR": str(tmp_path / "empty"), "PYTHONPATH": str(Path(__file__).resolve().parents[2]), "SPARK_LOCAL_IP": "127.0.0.1"}
    env |= {k: v for k, v in os.environ.items() if k in ("JAVA_HOME", "HOME", "PATH")}
    done = subprocess.run([sys.executable, "-c", CODE], capture_output=True, text=True, env=env, timeout=120, check=False)
    assert done.returncode == 0 and "refused" in done.stdout, done.stderr[-2000:]
