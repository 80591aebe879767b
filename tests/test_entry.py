"""The entry without its optional parts: deleted folders, missing libraries."""

import os
import shutil
import subprocess
import sys

import pytest

from lakestar.plans.queries import QUERIES

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print('found', *sorted(e.queries()))"


@pytest.fixture
def copy(tmp_path):
    """The repository without the optional folders and the pipeline."""
    def left_out(folder, names):
        return [n for n in names if n in (".git", "__pycache__", ".pytest_cache", "llm")]

    target = str(tmp_path / "copy")
    shutil.copytree(HERE, target, ignore=left_out)
    return target


def run(folder, *arguments):
    done = subprocess.run([sys.executable, *arguments], cwd=folder, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def found(output):
    return next(line for line in output.splitlines() if line.startswith("found")).split()[1:]


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_imports_without_the_optional_folder(copy, pipeline):
    if not pipeline and os.path.exists(f"{copy}/corpus_pipeline.py"):
        os.unlink(f"{copy}/corpus_pipeline.py")
    assert found(run(copy, "-c", LIST)) == sorted(QUERIES)
    assert "error" not in run(copy, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests").lower().replace(
        "overflowerror", "")[-300:]


def test_the_rest_imports_without_a_library(tmp_path):
    (tmp_path / "xxhash.py").write_text("raise ImportError('not here')\n")
    code = f"import sys; sys.path[:0] = [{str(tmp_path)!r}, {HERE!r}]; {LIST}"
    assert set(QUERIES) <= set(found(run(str(tmp_path), "-c", code)))
