"""Sessions without a preset checkpoint folder, and with the caller's own."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.path.insert(0, {repo!r})
from feria.registry import QUERIES
from feria.session import checkpoint_dir, get_spark
spark = get_spark("local[2]", shuffle_partitions=2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
for name in ("clean_products", "describe_price"):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
try:
    checkpoint_dir(spark)
except ValueError as e:
    print("told:", e)
spark.sparkContext.setCheckpointDir({own!r})
mine = spark.sparkContext._jsc.sc().getCheckpointDir().get()
get_spark()
assert spark.sparkContext._jsc.sc().getCheckpointDir().get() == mine
print("fine")
"""


def test_no_checkpoint_folder_needed(tmp_dir):
    env = {**os.environ, "SPARK_CONF_DIR": os.path.join(tmp_dir, "conf"), "PYSPARK_PYTHON": sys.executable}
    os.makedirs(env["SPARK_CONF_DIR"])
    code = CODE.format(repo=REPO, own=os.path.join(tmp_dir, "own"))
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.split("\n")[-2:] == ["fine", ""] and "told:" in done.stdout, done.stderr[-3000:]
