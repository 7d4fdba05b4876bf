"""The registry: names, oracles, and the library without the training-data operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 150


def test_entry_without_llm():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ('corpus_pipeline', 'inkwell.llm') or name.startswith('inkwell.llm.'):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert not any(k.startswith('op') and k[2].isdigit() for k in e.queries()), 'operators are gone'
assert 'score_winners' in e.queries()
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_else_imports_llm():
    for path in (ROOT / "inkwell").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(), path
