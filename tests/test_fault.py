"""Task failures mid-job: numbering and windows still give the exact result.

Runs in a subprocess because it needs its own SparkContext with task retries
(``local[4,3]``).  A test-only UDF fails the first attempt of two input
tasks, so the map side of the range exchange is re-run.
"""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import json, sys
sys.path.insert(0, ROOT)
from pyspark import TaskContext
from pyspark.sql import functions as F, types as T
from loadcast.session import build_session, ensure_checkpoint_root
from loadcast.operators.features import lag_profile
from loadcast.sources.adapters import event_series, read_table

spark = build_session("loadcast-fault", master="local[4,3]", shuffle_partitions=4)
spark.sparkContext.setLogLevel("OFF")
ensure_checkpoint_root(spark)

@F.udf(T.DoubleType())
def flaky(v):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() in (0, 2):
        raise RuntimeError("injected task failure")
    return v

ev = event_series(read_table(spark, "/root/testdata/sf0.01", "events")).repartition(4)
noisy = ev.withColumn("mw", flaky("mw"))
halo = lag_profile(noisy, order=("ts", "event_id"), block=1024)
glob = lag_profile(ev, order=("ts", "event_id"), method="global")
cols = ["event_id", "lag_1", "lag_24", "lag_168", "ma_168"]
a = sorted(tuple(r[c] for c in cols) for r in halo.collect())
b = sorted(tuple(r[c] for c in cols) for r in glob.collect())
print(json.dumps({"equal": a == b, "rows": len(a)}))
"""


def test_numbering_survives_task_retries(scratch):
    os.makedirs(scratch, exist_ok=True)
    path = os.path.join(scratch, "fault_job.py")
    with open(path, "w") as f:
        f.write(f"ROOT = {ROOT!r}\n" + SCRIPT)
    out = subprocess.run([sys.executable, path], capture_output=True, text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.startswith("{")]
    assert lines, out.stderr[-2000:]
    res = json.loads(lines[-1])
    assert res == {"equal": True, "rows": 10000}
