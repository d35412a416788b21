"""The entry point without the optional corpus operators."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

CHECK = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:len(%r.split("."))] == %r.split("."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
names = set(e.queries())
assert len(names) > 140 and set(e.oracle_sql()) <= names
assert not any(n.startswith("op") or n == "pipeline" for n in names if n[2:3].isdigit() or n == "pipeline")
"""


@pytest.mark.parametrize("absent", ["ledgerloom.llm", "xxhash"])
def test_other_queries_need_no_corpus_operators(absent):
    done = subprocess.run([sys.executable, "-c", CHECK % (absent, absent)], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-800:]
