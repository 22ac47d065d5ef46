import os
import pathlib
import subprocess
import sys

REPO = str(pathlib.Path(__file__).resolve().parents[2])
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from tests.session import local_session
spark = local_session(2)

def importable(_):
    try:
        import tidemark
        return [True]
    except ImportError:
        return [False]

assert spark.sparkContext.parallelize([0], 1).flatMap(importable).collect() == [False]
from tidemark.llm.registry import QUERIES
for name in {names!r}:
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Models and code travel with the tasks: the workers' path has no tidemark."""
    names = ["op2_decontaminate", "op4_language", "op6_quality", "op8_perplexity", "op11_filter_audit", "op12_collocations", "op13_relative_parse"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO, names=names)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == names
