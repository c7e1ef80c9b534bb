"""The entry works without the corpus subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(top, before=""):
    code = f"{before}\nimport __spark_entry__ as e\nprint(*sorted(e.queries()))\nassert set(e.oracle_sql()) <= set(e.queries())"
    return subprocess.run([sys.executable, "-c", code], cwd=top, env=os.environ | {"PYTHONPATH": str(top)}, capture_output=True, text=True, check=False)


def test_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "voxloom"):
        copy = shutil.copytree if (ROOT / name).is_dir() else shutil.copy
        copy(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "voxloom" / "llm", ignore_errors=True)
    found = names(tmp_path)
    assert found.returncode == 0, found.stderr
    assert "duration_filter" in found.stdout.split() and not any(n.startswith("op") for n in found.stdout.split())
    (tmp_path / "corpus_pipeline.py").write_text("from voxloom.llm import packing\n")
    again = names(tmp_path)
    assert again.returncode == 0 and again.stdout == found.stdout
