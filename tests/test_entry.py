"""The entry point where the training-data package has been removed."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

_SAY = """
import __spark_entry__ as entry
print(sorted(entry.queries()) == sorted(entry.catalog.queries()), sorted(entry.oracle_sql()) == sorted(entry.catalog.oracles()), len(entry.queries()) > 50)
"""


def _copied(folder, *, pipeline):
    """The repository without its two training-data folders."""
    leave = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(REPO / "dimkeep", folder / "dimkeep", ignore=leave)
    shutil.copy(REPO / "__spark_entry__.py", folder)
    if pipeline:
        shutil.copy(REPO / "corpus_pipeline.py", folder)


def _said(folder):
    run = subprocess.run([sys.executable, "-c", _SAY], cwd=folder, capture_output=True, text=True, timeout=120)
    return run.stdout.split(), run.stderr


def test_all_other_queries_load_without_the_package(tmp_path):
    for pipeline in (False, True):  # the pipeline's file may go as well, or stay behind
        folder = tmp_path / str(pipeline)
        folder.mkdir()
        _copied(folder, pipeline=pipeline)
        assert _said(folder) == (["True", "True", "True"], "")
    (folder / "dimkeep" / "llm").mkdir()  # an empty folder is left
    assert _said(folder) == (["True", "True", "True"], "")


def test_an_error_inside_the_package_is_not_swallowed(tmp_path):
    _copied(tmp_path, pipeline=True)
    (tmp_path / "dimkeep" / "llm").mkdir()
    (tmp_path / "dimkeep" / "llm" / "__init__.py").write_text("import no_such_module_at_all\n")
    out, error = _said(tmp_path)
    assert out == [] and "no_such_module_at_all" in error
