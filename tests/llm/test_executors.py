"""The queries where executors have no copy of this package: it is on the driver's path only."""

import os
import subprocess
import sys
import textwrap

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", {folder!r} + "/shared").config("spark.sql.warehouse.dir", {folder!r} + "/warehouse").getOrCreate())
import pickle
def lacks_it(rows):
    try:
        import feedmetrics
    except ModuleNotFoundError:
        yield from (r.id for r in rows)
assert spark.range(4).rdd.mapPartitions(lacks_it).count() == 4
import __spark_entry__
for name in {names!r}:
    assert __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all of them")
"""


@pytest.mark.parametrize("names", [
    ["op1_best_fit_packing", "op2_html_extraction", "op4_quality_classifier", "op7_toxicity", "op11_fill_in_middle",
     "op12_conversation_prefix_trie", "op13_pii"],
    ["op3_lm_scoring"]])
def test_queries_need_no_package_on_executors(tmp_path, names):
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(SCRIPT.format(root=ROOT, folder=str(tmp_path), names=names)))
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0 and "all of them" in done.stdout, done.stderr[-3000:]
