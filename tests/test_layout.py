import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_everything_else_stands_without_the_training_data_operators(tmp_path):
    """A copy of the library without the subpackage and its pipeline imports, and keeps its own queries."""
    shutil.copytree(ROOT / "tokenloom", tmp_path / "tokenloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(q for q in e.queries() if q.startswith('op') or q == 'pipeline'))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    count, left = run.stdout.split(" ", 1)
    assert int(count) > 70 and left.strip() == "[]"
