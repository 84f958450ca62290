"""The entry module with and without the operators for training data."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys
for name in {hidden!r}:
    sys.modules[name] = None  # importing it raises ImportError
import __spark_entry__ as entry
import bench
from affinity.plans.queries import QUERIES
print(set(entry.queries()) == set(QUERIES), set(entry.oracle_sql()) <= set(QUERIES))
"""


@pytest.mark.parametrize("hidden", [["affinity.llm", "corpus_pipeline"], ["affinity.llm"]])
def test_the_rest_imports_without_the_training_data_operators(hidden):
    code = CODE.format(hidden=hidden)
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == ["True", "True"]


def test_no_other_module_imports_them():
    for path in (ROOT / "affinity").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(), path
