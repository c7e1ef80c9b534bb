"""What is wrong inside the subpackage is not hidden; a package that it lacks takes only its own queries away."""

import shutil
from pathlib import Path

import pytest

from test_entry import ROOT, names


@pytest.fixture
def copy(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(ROOT / name, tmp_path / name)
    shutil.copytree(ROOT / "voxloom", tmp_path / "voxloom", ignore=shutil.ignore_patterns("__pycache__"))
    return tmp_path


def test_all_queries(copy):
    found = names(copy).stdout.split()
    assert "pipeline" in found and len([n for n in found if n.startswith("op")]) == 10


def test_a_missing_package(copy):
    found = names(copy, "import sys\nsys.modules['xxhash'] = None")
    assert found.returncode == 0 and "xxhash" in found.stderr
    assert "duration_filter" in found.stdout.split() and "pipeline" not in found.stdout.split()


@pytest.mark.parametrize("line", ["from voxloom.llm import nothing_here", "import voxloom.nothing_here", "1 / 0"])
def test_a_broken_module(copy, line):
    module = Path(copy) / "voxloom" / "llm" / "packing.py"
    module.write_text(module.read_text().replace("LENGTH = 2048", line, 1))
    assert names(copy).returncode != 0
