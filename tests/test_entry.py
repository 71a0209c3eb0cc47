"""The driver contract where the text operators were taken away."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import __spark_entry__ as entry
names, sql = set(entry.queries()), set(entry.oracle_sql())
assert not any(n.startswith("op") or n == "pipeline" for n in names | sql), names
assert "kpi_averages" in names and sql <= names
print(entry.__file__)
"""


def stripped(scratch, corpus: bool):
    """A copy of the code without the text operators, with or without the pipeline beside it."""
    tree = os.path.join(scratch, f"tree{corpus}")
    os.makedirs(tree)
    shutil.copytree(os.path.join(ROOT, "cartwheel"), os.path.join(tree, "cartwheel"), ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * (corpus and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py"))):
        shutil.copy(os.path.join(ROOT, name), tree)
    return tree


def probe(tree: str) -> str:
    env = {**os.environ, "PYTHONPATH": tree}
    return subprocess.run([sys.executable, "-c", PROBE], cwd=tree, env=env, check=True, capture_output=True, text=True).stdout


def test_entry_imports_without_the_text_operators(scratch):
    for corpus in (False, True):
        tree = stripped(scratch, corpus)
        assert probe(tree).strip().startswith(tree)


def test_a_left_over_folder_is_no_package(scratch):
    tree = stripped(scratch, False)
    os.makedirs(os.path.join(tree, "cartwheel", "llm", "__pycache__"))
    probe(tree)
