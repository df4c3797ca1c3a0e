"""Tasks must not need this package: a driver that finds it by its own path runs
the operators from a folder where the workers cannot import it."""

import os
import subprocess
import sys

import pytest

from tests.conftest import SF0001

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
sys.path.insert(0, sys.argv[1])
from tierflow.llm import registry
for name in sys.argv[3:]:
    print(name, registry.queries()[name](spark, sys.argv[2]).count())
"""


@pytest.mark.skipif(not os.path.isdir(SF0001), reason="driver test data not present")
def test_tasks_run_where_the_package_is_not_found(tmp_path):
    names = ["op1_ngram_join", "op3_decontamination", "op4_lm_scoring", "op6_url_filter", "op8_substring_dedup",
             "op12_embedding_whitening", "op13_hard_negatives"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", RUN, REPO, SF0001, *names], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert [line.split()[0] for line in out.stdout.splitlines() if line.startswith("op")] == names
