"""Every operator on workers that have no copy of the package."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

REPO = os.path.dirname(os.path.abspath(entry.__file__))
DATA = "/root/testdata/sf0.001"
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from growthkit import get_session
conf = {"spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": sys.argv[3], "spark.ui.showConsoleProgress": "false"}
spark = get_session(master="local[2]", **conf)
spark.sparkContext.setLogLevel("OFF")

def importable(rows):
    import importlib.util
    return [importlib.util.find_spec("growthkit") is not None for _ in rows]

assert spark.sparkContext.parallelize([1], 1).mapPartitions(importable).collect() == [False]
for name in sys.argv[4].split(","):
    entry.queries()[name](spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
    print("ran", name)
"""


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
def test_workers_need_no_copy(tmp_path):
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    env["PYTHONPATH"] = os.path.dirname(os.path.dirname(sys.modules["public_tokenizers"].__file__))
    command = [sys.executable, "-c", SCRIPT, REPO, DATA, str(tmp_path / "shared"), ",".join(names)]
    out = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200)
    assert out.stdout.split("\n")[:-1] == [f"ran {n}" for n in names], out.stderr[-3000:]
