"""The entry file with and without the training-data subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("left", ["nothing", "empty folder", "bytecode"])
def test_entry_without_the_subpackage(tmp_path, left):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "reuselens", tmp_path / "reuselens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    if left != "nothing":
        (tmp_path / "reuselens/llm/__pycache__").mkdir(parents=True)
    if left == "bytecode":
        (tmp_path / "reuselens/llm/__pycache__/queries.cpython-313.pyc").write_bytes(b"junk")
    (tmp_path / "corpus_pipeline.py").write_text("from reuselens.llm import quality\n")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q); print(any(n.startswith('op1_') for n in q))"
    env = os.environ | {"PYTHONPATH": str(tmp_path) + os.pathsep + os.environ.get("PYTHONPATH", "").replace(str(ROOT), "")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip() == "False"
