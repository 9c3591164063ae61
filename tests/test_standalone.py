"""The library stands without the training-data subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

HIDDEN = """
import importlib, pkgutil, sys

class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == "starmart.llm" or name.startswith("starmart.llm.") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Hide())
import starmart
for m in pkgutil.walk_packages(starmart.__path__, "starmart."):
    if not m.name.startswith("starmart.llm"):
        importlib.import_module(m.name)
import __spark_entry__ as e
names = set(e.queries())
assert len(names) >= 63 and not any(n.startswith("op1") or n == "pipeline" for n in names), sorted(names)
assert set(e.oracle_sql()) <= names
print(len(names))
"""


def test_library_imports_without_the_llm_folder():
    out = subprocess.run([sys.executable, "-c", HIDDEN], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) >= 63


def test_no_module_outside_llm_imports_it():
    for path in (ROOT / "starmart").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "starmart").parts:
            assert "starmart.llm" not in path.read_text(), path
