import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_imports_and_collects_without_the_training_data_folders(tmp_path, pipeline):
    copy = tmp_path / "repo"
    gone = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", ".hypothesis", *([] if pipeline else ["corpus_*.py"]))
    shutil.copytree(ROOT, copy, ignore=gone)
    assert not (copy / "tablesync/llm").exists() and any(copy.glob("corpus_*.py")) == (any(ROOT.glob("corpus_*.py")) and pipeline)
    code = "import __spark_entry__ as m; names = set(m.queries()); assert 'flagship' in names and not any(n.startswith('op') or n == 'pipeline' for n in names); assert set(m.oracle_sql()) <= names"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
    subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"], cwd=copy, check=True, timeout=120, stdout=subprocess.DEVNULL)
