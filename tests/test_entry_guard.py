"""The entry lists the library's own queries where the training-data subpackage is gone or cannot be imported."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(path):
    code = "import __spark_entry__ as E; q = E.queries(); print(len(q), 'a01_smape' in q, sum(n.startswith('op') or n == 'pipeline' for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=path, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True, check=True)
    n, own, extra = out.stdout.split()[-3:]
    return int(n), own == "True", int(extra)


@pytest.mark.parametrize("left", ["nothing", "caches", "broken"])
def test_entry_without_the_subpackage(tmp_path, left):
    for part in ("__spark_entry__.py", "pricelab"):
        source = os.path.join(ROOT, part)
        shutil.copytree(source, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__")) if os.path.isdir(source) else shutil.copy(source, tmp_path)
    folder = tmp_path / "pricelab" / "llm"
    if left == "caches":
        (folder / "__pycache__").mkdir(parents=True)
    elif left == "broken":
        folder.mkdir()
        (folder / "__init__.py").write_text("")
        (folder / "queries.py").write_text("import no_such_library_is_installed\n")
        (tmp_path / "corpus_pipeline.py").write_text("ORACLE_SQL = None\nrun = None\n")
    n, own, extra = names(tmp_path)
    assert own and n >= 100 and extra == 0
