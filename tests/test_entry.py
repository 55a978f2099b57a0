import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
from voxweave import queries as core

ROOT = Path(__file__).resolve().parent.parent


def test_without_the_corpus_operators(tmp_path):
    """Where they can't be imported, for whatever reason, all other queries are there."""
    for broken in ("raise ImportError('gone')", "import no_such_module"):
        code = f"""
import sys, types, importlib.abc, importlib.util
class Finder(importlib.abc.MetaPathFinder, importlib.abc.Loader):
    def find_spec(self, name, path, target=None):
        return importlib.util.spec_from_loader(name, self) if name.startswith("voxweave.llm") or name == "corpus_pipeline" else None
    def exec_module(self, module):
        exec({broken!r})
sys.meta_path.insert(0, Finder())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""
        out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True)
        assert out.stdout.split() == [str(len(core.QUERIES)), str(len(core.SQL))]


def test_sql_is_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(core.SQL) <= set(core.QUERIES)
