"""The rest of the library does not need the text operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_import_without_the_text_operators(tmp_path):
    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(os.path.join(ROOT, "weftgraph"), tmp_path / "weftgraph", ignore=skip)
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; assert e.queries().keys() == e.oracle_sql().keys() and 'out_degrees' in e.queries()"
    environment = os.environ | {"PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, check=True)


def loaded_without(tmp_path, prepare):
    """The names of the queries that load in a copy of the repository after ``prepare``."""
    shutil.copytree(os.path.join(ROOT, "weftgraph"), tmp_path / "weftgraph", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(os.path.join(ROOT, name), tmp_path)
    prepare()
    code = "import __spark_entry__ as e; print(*e.queries())"
    environment = os.environ | {"PYTHONPATH": str(tmp_path)}
    run = subprocess.run([sys.executable, "-W", "always", "-c", code], cwd=tmp_path, env=environment, check=True, capture_output=True, text=True)
    return run.stdout.split(), run.stderr


def test_a_left_over_folder_is_no_part(tmp_path):
    def prepare():
        shutil.rmtree(tmp_path / "weftgraph" / "llm")
        (tmp_path / "weftgraph" / "llm" / "__pycache__").mkdir(parents=True)

    names, said = loaded_without(tmp_path, prepare)
    assert "out_degrees" in names and not any(n.startswith("op") for n in names) and "pipeline" not in names
    assert "no text operators" in said


def test_a_missing_dependency_of_the_text_operators(tmp_path):
    def prepare():
        (tmp_path / "public_tokenizers.py").write_text("raise ImportError('no public_tokenizers here')")

    names, said = loaded_without(tmp_path, prepare)
    assert "out_degrees" in names and "pipeline" not in names
    assert "no public_tokenizers here" in said
