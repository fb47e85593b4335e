"""The driver contract without the optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SAY = "import __spark_entry__ as e; print(len(e.queries()), sum(k[:2] == 'op' and k[2].isdigit() or k == 'pipeline' for k in e.queries()))"


@pytest.mark.parametrize("left", ["pipeline file", "neither", "empty folder"])
def test_the_rest_imports_without_the_folders(tmp_path, left):
    shutil.copytree(ROOT / "flowlake", tmp_path / "flowlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if left == "pipeline file" and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    if left == "empty folder":
        (tmp_path / "flowlake" / "llm").mkdir()
    done = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    keys, optional = map(int, done.stdout.split()[-2:])
    assert keys > 85 and optional == 0


def test_an_operator_that_fails_to_import_is_not_passed_over(tmp_path):
    shutil.copytree(ROOT / "flowlake", tmp_path / "flowlake", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    broken = tmp_path / "flowlake" / "llm" / "queries.py"
    if not broken.parent.exists():
        broken.parent.mkdir()
    broken.write_text("import no_such_module_anywhere\n")
    done = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode != 0 and "no_such_module_anywhere" in done.stderr
