"""Extraction must not rely on this package being importable on the workers."""

import os
import subprocess
import sys

from conftest import SF

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
QUERIES = ("extract_gl_cards", "extract_offer_cards", "extract_detail_tags", "strip_hidden_nodes")
# The package is put on the path of the driver alone, after the session has started.
CHILD = f"""
import sys
sys.path.insert(0, {ROOT!r})
from motorlake.session import local_session
spark = local_session("2")
import __spark_entry__ as contract
for name in {QUERIES!r}:
    print("rows of", name, contract.queries()[name](spark, {SF!r}).count())
"""


def test_extraction_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CHILD], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    counts = [int(line.split()[-1]) for line in done.stdout.splitlines() if line.startswith("rows of")]
    assert done.returncode == 0 and len(counts) == len(QUERIES) and min(counts) > 0, done.stdout + done.stderr[-2000:]
