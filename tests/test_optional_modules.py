"""The library without its optional modules: a copy of the tree that lacks them, and one where a package is missing."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

RUN = """
import sys
HIDDEN
import __spark_entry__ as entry
from triplake.session import local_session
queries, oracle = entry.queries(), entry.oracle_sql()
assert "kpi_monthly" in queries and "kpi_monthly" in oracle and len(queries) >= 49
assert "pipeline" not in queries and not [name for name in queries if name.startswith("op")]
spark = local_session(2, 2)
assert queries["kpi_monthly"](spark, "/root/testdata/sf0.001").count() == 71
assert queries["type_summary"](spark, "/root/testdata/sf0.001").count() == 4
spark.stop()
"""


@pytest.mark.parametrize(
    "left_out, hidden",
    [
        (("triplake/llm", "tests/llm", "corpus_pipeline.py"), ""),
        (("triplake/llm", "tests/llm"), ""),
        ((), "sys.modules['tiktoken'] = sys.modules['xxhash'] = None"),
    ],
    ids=["no folders", "pipeline left alone", "packages missing"],
)
def test_other_queries_run_without_them(tmp_path, left_out, hidden):
    copy = tmp_path / "copy"
    gone = {os.path.join(ROOT, path) for path in left_out}

    def skipped(folder, names):
        return {name for name in names if name in (".git", "__pycache__") or os.path.join(folder, name) in gone}

    shutil.copytree(ROOT, copy, ignore=skipped)
    run = subprocess.run([sys.executable, "-c", RUN.replace("HIDDEN", hidden)], cwd=copy, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
