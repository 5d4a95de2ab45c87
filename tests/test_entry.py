"""The entry file with and without the text operators."""

import importlib.util
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parent.parent

# Run in a process of its own: imports of this one stay as they are.
WITHOUT = """
import importlib.util, sys
found = importlib.util.find_spec
def hidden(name, *rest):
    if name in HIDDEN or any(name.startswith(n + ".") for n in HIDDEN):
        return None
    return found(name, *rest)
HIDDEN = {hide!r}
importlib.util.find_spec = hidden
class Refuse:
    def find_spec(self, name, path=None, target=None):
        if name in HIDDEN or any(name.startswith(n + ".") for n in HIDDEN):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Refuse())
import __spark_entry__ as entry
names = entry.queries()
assert "scd2_merge" in names and "scd2_merge" in entry.oracle_sql()
print(sorted(n for n in names if n.startswith("op") and n[2].isdigit() or n == "pipeline"))
"""


def names_without(hide):
    code = WITHOUT.replace("{hide!r}", repr(hide))
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return done.stdout.strip()


def test_entry_without_text_operators():
    assert names_without(("histload.llm",)) == "[]"
    assert names_without(("histload.llm", "corpus_pipeline")) == "[]"


def test_entry_without_the_pipeline():
    if importlib.util.find_spec("histload.llm") is not None:
        assert "pipeline" not in names_without(("corpus_pipeline",))
