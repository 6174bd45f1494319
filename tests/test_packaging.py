"""Python workers get the package from the session, wherever the driver was started."""

import os
import subprocess
import sys
from pathlib import Path

from tests.conftest import SMALL

ROOT = Path(__file__).resolve().parent.parent

PROGRAM = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from tidewater.session import build_session
from tidewater.catalog import QUERIES
spark = build_session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
print("rows", QUERIES["sv_flag"](spark, {SMALL!r}).count())
"""


def test_worker_code_runs_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith(("PYSPARK", "SPARK"))}
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split("rows ")[1]) > 0
