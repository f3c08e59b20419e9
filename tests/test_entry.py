"""The driver contract in a plain session (no package defaults), in its own process."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "America/New_York").getOrCreate())
import __spark_entry__ as E
out = E.entry(spark)
rows = out.collect()
print("ENTRY", len(rows), out.schema.simpleString())
q, sql = E.queries(), E.oracle_sql()
assert set(sql) <= set(q)
for name in ("stream_score_counts", "pr_auc", "scan_csv"):
    print("QUERY", name, q[name](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_and_queries_in_a_plain_session():
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    import __spark_entry__ as E
    from oracle import duck
    out = subprocess.run([sys.executable, "-c", CODE], capture_output=True, text=True, timeout=600)
    assert "ENTRY 4 struct<prediction_class:string,model_name:string,n:bigint>" in out.stdout, \
        out.stderr[-3000:]
    for name in ("stream_score_counts", "pr_auc", "scan_csv"):
        n = len(duck("/root/testdata/sf0.001", E.oracle_sql()[name])[1])
        assert f"QUERY {name} {n}" in out.stdout, out.stdout


def test_bench_prints_one_json_line():
    import json
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "class_balance", "pr_auc"],
                         capture_output=True, text=True, timeout=600, env=env)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"class_balance", "pr_auc"}
    assert d["value"] == round(sum(d["queries"].values()), 3) and "errors" not in d


def test_scratch_paths_without_a_configured_checkpoint_dir(tmp_path):
    """With no spark.checkpoint.dir anywhere, a local folder is registered on
    the SparkContext (the session conf cannot be changed for it)."""
    conf_dir = tmp_path / "conf"
    conf_dir.mkdir()
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from txnscore.session import get_spark, scratch_path
s = get_spark("local[2]", extra={{"spark.ui.showConsoleProgress": "false"}})
print("PATH", scratch_path(s, "x"))
import __spark_entry__ as E
print("ROWS", E.queries()["stream_drain"](s, "/root/testdata/sf0.001").count())
"""
    env = dict(os.environ, SPARK_CONF_DIR=str(conf_dir))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         timeout=600, env=env)
    assert "txnscore-ckpt-" in out.stdout and "ROWS 1000" in out.stdout, out.stderr[-2000:]
