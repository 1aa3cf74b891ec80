"""The core queries load without the training-data part or the modules that only it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == sys.argv[1] or name.startswith(sys.argv[1] + "."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), any(x.startswith("op") for x in entry.queries()))
"""


def load(missing):
    return subprocess.run([sys.executable, "-c", PROGRAM, missing], capture_output=True, text=True, cwd=ROOT)


@pytest.mark.parametrize("missing", ["public_tokenizers", "regex", "tabledocs.llm", "corpus_pipeline"])
def test_core_without(missing):
    from workload.queries import ORACLE, QUERIES

    assert load(missing).stdout.split() == [str(len(QUERIES)), str(len(ORACLE)), "False"]


def test_missing_core_module_is_an_error():
    assert "tabledocs.plans" in load("tabledocs.plans").stderr
