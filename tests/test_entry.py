"""The entry points without the training-data part or a package that it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDE = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
names = set(e.queries())
assert len(names) > 400 and set(e.oracle_sql()) <= names, len(names)
assert not any(n.startswith("op1_") for n in names) and "pipeline" not in names
"""


@pytest.mark.parametrize("name", ["cohortspark.llm", "corpus_pipeline", "public_tokenizers", "xxhash", "zstandard"])
def test_other_queries_stay(name):
    run = subprocess.run([sys.executable, "-W", "ignore", "-c", HIDE.format(name=name)], cwd=ROOT, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
