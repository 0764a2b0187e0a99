"""The entry module must work with and without the corpus subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(prefix: str) -> list[str]:
    code = f"import sys; {prefix}; import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()


def test_entry_without_the_corpus_operators():
    found = names("sys.modules['newsweave.llm'] = None")
    assert "pagerank" in found and not any(name.startswith("op") for name in found) and "pipeline" not in found
