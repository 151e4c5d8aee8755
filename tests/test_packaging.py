"""Python steps run on workers that do not have the package."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path[:0] = [{repo!r}, {tests!r}]
from conftest import session
spark = session()
import __spark_entry__ as e
print("rows", e.queries()["knn_leaves"](spark, "/root/testdata/sf0.001").count())
print("near", e.queries()["nearest_centroid"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_need_no_installed_package(tmp_path):
    here = os.path.dirname(os.path.abspath(__file__))
    script = SCRIPT.format(repo=os.path.dirname(here), tests=here)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows 3000" in done.stdout and "near 500" in done.stdout, done.stderr[-2000:]
