"""The driver's entry module, with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_imports_without_training_data_operators(tmp_path, pipeline):
    shutil.copytree(os.path.join(ROOT, "shoplake"), tmp_path / "shoplake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    if pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
    code = "import __spark_entry__ as e; print(sorted(e.queries()), sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True).stdout
    assert "unique_visitor_daily" in out and "op1_" not in out and "pipeline" not in out
