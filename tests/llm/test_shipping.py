"""All queries with a worker path that lacks the repository."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])  # the driver's path only
from tripcast.config import get_session
from tripcast.llm import queries as Q
spark = get_session("local[4]", shuffle_partitions=4)
spark.sparkContext.setLogLevel("ERROR")
spark.sparkContext.setCheckpointDir(sys.argv[2])

def absent(rows):
    import importlib.util
    for _ in rows:
        yield importlib.util.find_spec("tripcast") is None

assert spark.sparkContext.parallelize(range(2), 2).mapPartitions(absent).collect() == [True, True]
for name, query in Q.queries().items():
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("ran", name)
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran op") == 13
