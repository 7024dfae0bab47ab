import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = """
import sys
sys.path.insert(0, {root!r})
from basketry.plans import QUERIES
from basketry.session import get_spark
spark = get_spark(master="local[2]", **{{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "2g"}})
print("rows", QUERIES["nearest_centroid"](spark, "/root/testdata/sf0.001").count())
"""


def test_queries_run_from_another_folder(tmp_path):
    """Only the driver knows where the package is; workers get it shipped."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", PROGRAM.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.split("rows ")[1]) > 0
